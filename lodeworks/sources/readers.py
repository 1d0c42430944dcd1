"""Scans. Every reader takes an explicit schema where one is known, so that nothing is read twice to infer it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RECORD = "metric string, value double, as_of string, geo_level string, msa_code string, source_id string"


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """JSON lines, blank ones skipped."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, path: str, skip_bad: bool = False) -> DataFrame:
    return spark.read.option("ignoreCorruptFiles", skip_bad).option("mergeSchema", True).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; a byte-order mark is taken off the first name, names are trimmed; all text unless a schema is
    given, which is applied by name."""
    df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("enforceSchema", False).csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    if not schema:
        return df
    types = dict(f.strip().split() for f in schema.split(","))
    return df.select(*(F.expr(f"try_cast(`{c}` AS {t})").alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()))


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """By suffix; ValueError for another."""
    kind = path.rsplit(".", 1)[-1].lower()
    readers = {"jsonl": read_jsonl, "ndjson": read_jsonl, "json": read_json_array, "parquet": read_parquet, "csv": read_csv, "tsv": lambda s, p: read_csv(s, p, sep="\t")}
    if kind not in readers:
        raise ValueError(f"no reader for .{kind}")
    return readers[kind](spark, path)


def load_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of several formats as one table of the metric schema, extra columns dropped."""
    from lodeworks.operators.reshape import union_all

    fields = [f.strip().split() for f in RECORD.split(",")]
    one = lambda df: df.select(*(F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in fields))
    return union_all(*(one(read_any(spark, p)) for p in paths))


def read_sheet(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV as rows of a sheet: (row_idx, cells), ragged rows as they are. A sheet is one small file, which keeps its
    lines in order in one partition; the index is the line's."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("row_idx", "_l")).where("_l <> ''")
    cells = F.transform(F.split("_l", sep + r"(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1), lambda c: F.regexp_replace(F.trim(c), r'^"|"$', ""))
    return rows.select("row_idx", cells.alias("cells"))


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, sha256) of files of any kind."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("rowTag", row_tag).format("xml").load(path)


def latest_snapshot(spark: SparkSession, path: str, market: str) -> DataFrame:
    """Rows of the newest file for a market: names start with the market's first word and hold a date."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path).withColumn("_f", F.element_at(F.split(F.input_file_name(), "/"), -1))
    word = re.split(r"[^a-z0-9]+", market.lower())[0]
    df = df.where(F.lower("_f").startswith(word)).withColumn("_d", F.regexp_extract("_f", r"(\d{4}-\d{2}-\d{2})", 1))
    top = df.agg(F.max("_d").alias("_top"))
    return df.join(F.broadcast(top), F.col("_d") == F.col("_top")).drop("_f", "_d", "_top")  # one row


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def views_by_stem(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The Parquet files and folders of a folder by their names without suffix, each a temporary view of that name, too."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.parquet")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    out = {f.getPath().getName().removesuffix(".parquet"): spark.read.parquet(f.getPath().toString()) for f in found}
    for stem, df in out.items():
        df.createOrReplaceTempView(re.sub(r"\W", "_", stem))
    return out


#: Headers that a subject's floorplan sheet may have for each column (fixed values).
SUBJECT = {"code": ["PlanCode", "plan_code", "Floorplan"], "bed_type": ["BedType", "bed_type", "Beds"], "units": ["Units", "UnitCount", "units"], "sqft": ["SqFt", "AvgSqFt", "sqft"], "rent": ["AvgMarketRent", "MarketRent", "avg_market_rent"]}


def subject_floorplans(df: DataFrame) -> DataFrame:
    """(code, bed_type, units, sqft, rent) by whichever header a column has; rows whose numbers can't be read go."""
    first = lambda names: F.coalesce(*(F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in df.columns), F.lit(None).cast("string"))
    number = lambda c: F.regexp_replace(c, r"[$,]", "").try_cast("double")
    rows = df.select(first(SUBJECT["code"]).alias("code"), first(SUBJECT["bed_type"]).alias("bed_type"), *(number(first(SUBJECT[c])).alias(c) for c in ("units", "sqft", "rent")))
    return rows.dropna(subset=["code", "units", "sqft", "rent"])


def checked_config(text: str, keys: list[str]) -> dict:
    """A YAML document that must hold `keys`, dotted ones below others."""
    import yaml

    config = yaml.safe_load(text) or {}
    missing = []
    for key in keys:
        at = config
        for part in key.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at is None:
            missing.append(key)
    if missing:
        raise ValueError(f"missing keys: {', '.join(missing)}")
    return config
