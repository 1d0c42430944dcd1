"""Set and reshape operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_dates(df: DataFrame, ids: list[str], name: str = "month", value: str = "value") -> DataFrame:
    """Columns named by dates, and only those, to rows; NULLs dropped."""
    cols = [c for c in df.columns if re.fullmatch(r"\d{4}-\d{2}-\d{2}", c)]
    return df.unpivot(ids, cols, name, value).where(F.col(value).isNotNull())


def melt(df: DataFrame, ids: list[str], columns: dict[str, str], name: str = "metric", value: str = "value") -> DataFrame:
    """Columns to (label, value) rows, NaN and NULL dropped."""
    wide = df.select(*ids, *(F.col(c).cast("double").alias(label) for c, label in columns.items()))
    return wide.unpivot(ids, list(columns.values()), name, value).where(F.col(value).isNotNull() & ~F.isnan(value))


def one_hot(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """0/1 columns of all levels but the first, the reference."""
    return df.select("*", *(F.coalesce(F.col(column) == v, F.lit(False)).cast("int").alias(f"{column}_{re.sub('[^A-Za-z0-9]+', '_', v)}") for v in levels[1:]))


def expand(df: DataFrame, n: Column, name: str = "copy") -> DataFrame:
    """Each row n times, numbered from 1; none for n < 1 or NULL."""
    return df.where(n >= 1).select("*", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias(name))


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def conform(df: DataFrame, schema: dict[str, str], renames: dict[str, str] | None = None) -> DataFrame:
    """Renamed, NULL-filled and ordered to a fixed schema; whole-number columns are cast leniently, with 0 for nothing."""
    df = df.withColumnsRenamed(renames or {})
    cast = lambda c, t: F.coalesce(F.col(c).try_cast("double").cast(t), F.lit(0)).alias(c) if t in ("int", "bigint") else F.col(c).try_cast(t).alias(c)
    return df.select(*(cast(c, t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in schema.items()))
