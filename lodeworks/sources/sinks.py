"""Sinks: partitioned Parquet with replace-on-rerun, insert-if-absent, JSON and CSV with fixed columns, review queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.joins import insert_if_absent


def write_snapshot(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by partition columns; rows are dealt by them first, so that a partition is a few files."""
    df.repartition(*by).write.mode("append").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str, order: list[str] = ()) -> None:
    """History keyed by a date: only the partitions that `df` holds are replaced."""
    df = df.repartition(by)
    if order:
        df = df.sortWithinPartitions(*order)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; any other failure of a read is an error and raised as such."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def append_absent(df: DataFrame, path: str, keys: list[str], order: str) -> None:
    """Rows whose key the table does not hold yet."""
    old = df.sparkSession.read.parquet(path) if exists(df.sparkSession, path) else df.limit(0)
    insert_if_absent(old, df, keys, order).write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed columns in order; extra ones are dropped, missing ones empty."""
    df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)).write.mode("overwrite").option("header", True).csv(path)


def write_any(df: DataFrame, path: str) -> None:
    """By suffix: jsonl, json, csv, parquet."""
    kind = path.rsplit(".", 1)[-1].lower()
    w = df.write.mode("overwrite")
    if kind in ("jsonl", "json"):
        w.json(path)
    elif kind == "csv":
        w.option("header", True).csv(path)
    elif kind == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"no writer for .{kind}")


def review_csv(queue: DataFrame, path: str) -> None:
    """Review rows with an empty decision; only the header when there are none."""
    out = queue.withColumn("decision", F.lit(""))
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # a queue that people read


def log_event(spark, path: str, event: str, **fields: str) -> None:
    """One JSON line of an operations log."""
    row = spark.range(1).select(F.lit(event).alias("event"), F.current_timestamp().alias("at"), *(F.lit(v).alias(k) for k, v in fields.items()))
    row.write.mode("append").json(path)


def write_submarkets(df: DataFrame, path: str, by: str, at: str, is_forecast: str = "is_forecast") -> None:
    """One Parquet folder a submarket under `path`/data, and `path`/index: a CSV with each one's slug, actual and forecast rows, and
    first and last period, counted from what was written."""
    write_snapshot(df, f"{path}/data", [by])
    fc = F.coalesce(F.col(is_forecast), F.lit(False))
    index = df.sparkSession.read.parquet(f"{path}/data").groupBy(by).agg(F.count_if(~fc).alias("actual"), F.count_if(fc).alias("forecast"), F.min(at).alias("first"), F.max(at).alias("last"))
    index.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/index")  # a row a submarket


def write_forecasts(path: str, tag: str, comparison: DataFrame, backtests: DataFrame, ensemble: DataFrame) -> None:
    """The CSV family of a forecast run under `path`: v2_forecast_<tag>, v2_backtest_<model>_<tag> for every model, v2_ensemble_<tag>.
    Backtests are written once, in folders by model."""
    for name, df in (("forecast", comparison), ("ensemble", ensemble)):
        df.write.mode("overwrite").option("header", True).csv(f"{path}/v2_{name}_{tag}")
    named = backtests.withColumn("v2_backtest", F.concat_ws("_", F.lower("model"), F.lit(tag)))
    named.repartition("v2_backtest").write.mode("overwrite").option("header", True).partitionBy("v2_backtest").csv(f"{path}/v2_backtests_{tag}")


def replace_by_key(new: DataFrame, path: str, key: str, order: list[str]) -> None:
    """A history table with the rows of `new` in place of all that share their `key`, in the order asked for. The table is written to
    a folder of its own first and takes the old one's place only when whole."""
    spark = new.sparkSession
    out = new
    if exists(spark, path):
        old = spark.read.parquet(path)
        out = old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)
    out.orderBy(*order).write.mode("overwrite").parquet(f"{path}.next")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at, after, before = jvm(path), jvm(f"{path}.next"), jvm(f"{path}.before")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(before, True)
    if fs.exists(at) and not fs.rename(at, before):
        raise OSError(f"{path} could not be moved away")
    if not fs.rename(after, at):
        raise OSError(f"{path}.next could not take its place")
    fs.delete(before, True)
