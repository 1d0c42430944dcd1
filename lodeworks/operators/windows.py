"""Ordered-frame operators. All windows have partition keys; frames count rows, not time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def last_n(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, Window.currentRow)


def ffill(c: str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(running(w))


def guarded_mean(c: str, frame: WindowSpec, least: int) -> Column:
    """Mean over a frame that holds at least so many values."""
    return F.when(F.count(c).over(frame) >= least, F.avg(c).over(frame))


def pct_change(c: str, w: WindowSpec, n: int) -> Column:
    return F.col(c) / F.nullif(F.lag(c, n).over(w), F.lit(0)) - 1


def slope(c: str, at: str, frame: WindowSpec, least: int, most: int | None = None) -> Column:
    """Least-squares slope over a frame with at least `least` values; with `most`, NULL where a row of it has none."""
    ok = F.count(c).over(frame) >= least
    if most:
        ok = ok & (F.count(c).over(frame) == F.count(F.lit(1)).over(frame))
    return F.when(ok, F.regr_slope(F.col(c), F.col(at)).over(frame))


def cycle_phase(df: DataFrame, keys: list[str], at: str, vacancy: str, lookback: int = 8) -> DataFrame:
    """Four phases by vacancy against its rolling mean (20 rows, at least 8 values) and its slope over row positions
    (`lookback` rows, at least 4, none of them missing); UNKNOWN where either is missing."""
    w = Window.partitionBy(*keys).orderBy(at)
    mean = guarded_mean(vacancy, last_n(w, 20), 8)
    df = df.withColumn("_at", F.row_number().over(w))
    df = df.select("*", mean.alias("_mean"), slope(vacancy, "_at", last_n(w, lookback), 4, lookback).alias("_trend"))
    low = F.col(vacancy) < F.col("_mean")
    label = (
        F.when(F.col(vacancy).isNull() | F.col("_mean").isNull() | F.col("_trend").isNull(), "UNKNOWN")
        .when(low & (F.col("_trend") <= 0), "EXPANSION").when(low, "PEAK").when(F.col("_trend") > 0, "CONTRACTION").otherwise("TROUGH")
    )
    return df.withColumn("phase", label).drop("_at", "_mean", "_trend")


def compound(growth: Column, w: WindowSpec) -> Column:
    """Running product of 1 + growth / 4."""
    return F.product(1 + growth / 4).over(running(w))


def regime_change(df: DataFrame, keys: list[str], at: str, value: str, lookback: int = 4, sigmas: float = 2.0, window: int = 20) -> DataFrame:
    """Per key: whether any of the last `lookback` values is more than `sigmas` deviations from the mean of the last
    `window` ones; false with fewer values, or if they don't differ."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(at)))
    last = df.where(F.col(value).isNotNull()).withColumn("_back", back).where(F.col("_back") <= window)
    g = last.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"),
        F.collect_list(F.when(F.col("_back") <= lookback, F.col(value))).alias("_recent"),  # at most `lookback` values
    )
    far = F.exists("_recent", lambda v: F.abs(v - F.col("_mean")) / F.col("_sd") > sigmas)
    flag = F.coalesce((F.col("_n") >= window) & (F.col("_sd") > 0) & far, F.lit(False))
    return df.select(*keys).distinct().join(g, keys, "left").select(*keys, F.coalesce(flag, F.lit(False)).alias("regime_change"))


def carry_forward(df: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """The last value seen before or at each row: header rows above their details."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_v", value).withColumn(name, F.last("_v", ignorenulls=True).over(running(w))).drop("_v")


def section_on(df: DataFrame, keys: list[str], order: str, start: Column, stop: Column, name: str = "inside") -> DataFrame:
    """Whether a row is in a section: after a start marker and before the next stop marker; a new start opens it again."""
    w = running(Window.partitionBy(*keys).orderBy(order))
    mark = F.when(start, F.lit(True)).when(stop, F.lit(False))
    return df.withColumn(name, F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(False)) & ~F.coalesce(start, F.lit(False)))


def keep_best(df: DataFrame, keys: list[str], best: list[Column]) -> DataFrame:
    """The first row of each key by `best` (which must end in a unique order)."""
    w = Window.partitionBy(*keys).orderBy(*best)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def latest_with_ties(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All rows of each key's latest value: a map-side combined max and a join, no sort of the rows."""
    top = df.groupBy(*keys).agg(F.max(order).alias("_top"))
    return df.join(top, keys).where(F.col(order) == F.col("_top")).drop("_top")


def chunks(df: DataFrame, key: str, text: str, size: int = 800, overlap: int = 120) -> DataFrame:
    """Whitespace-normalised texts cut into windows of `size` characters that overlap; empty ones give none."""
    from lodeworks.functions.text import sanitize

    t = df.select(key, sanitize(text).alias("_t")).where("_t <> ''")
    step = size - overlap
    n = F.when(F.length("_t") <= size, F.lit(1)).otherwise(F.ceil((F.length("_t") - size) / step).cast("int") + 1)
    t = t.select(key, "_t", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    return t.select(key, "chunk", F.substring(F.col("_t"), F.col("chunk") * step + 1, F.lit(size)).alias("text"))


def lifecycle(status: Column, last_seen: Column, today: Column) -> Column:
    """active, unseen for over 30 days: inactive_30d; active or inactive for over 60: rented_or_pulled."""
    age = F.datediff(today, last_seen)
    return (
        F.when(status.isin("active", "inactive_30d") & (age > 60), "rented_or_pulled").when((status == "active") & (age > 30), "inactive_30d").otherwise(status)
    )


def forecast_flag(df: DataFrame, keys: list[str], period: str, qtd: Column, stored: Column) -> DataFrame:
    """Rows after the latest quarter-to-date period are forecasts, as are those so marked."""
    top = df.groupBy(*keys).agg(F.max(F.when(qtd, F.col(period))).alias("_q"))
    return df.join(top, keys).withColumn("is_forecast", F.coalesce(F.col(period) > F.col("_q"), F.lit(False)) | F.coalesce(stored, F.lit(False))).drop("_q")


def cumulative_share(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn("share", F.round(F.sum(value).over(running(w)) / F.nullif(total, F.lit(0)), 4))


def first_vs_last(df: DataFrame, keys: list[str], at: str, value: str, band: float = 0.005) -> DataFrame:
    """First and last value by `at`, yearly growth between them and its direction; min_by and max_by combine map-side."""
    g = df.groupBy(*keys).agg(F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"), (F.max(at) - F.min(at)).alias("years"))
    g = g.withColumn("cagr", F.when((F.col("first") > 0) & (F.col("years") > 0), F.pow(F.col("last") / F.col("first"), 1.0 / F.col("years")) - 1))
    return g.withColumn("direction", F.when(F.col("cagr") > band, "up").when(F.col("cagr") < -band, "down").when(F.col("cagr").isNotNull(), "flat")).withColumn("cagr", F.round("cagr", 6))


def next_run_id(used: DataFrame, run: str, base: str) -> DataFrame:
    """`base` if unused, else base__r{n} with the least unused n >= 2: one row."""
    n = F.when(F.col(run) == base, F.lit(1)).otherwise(F.regexp_extract(F.col(run), "__r([0-9]+)$", 1).try_cast("int"))
    taken = used.where((F.col(run) == base) | F.col(run).startswith(base + "__r")).agg(F.sort_array(F.collect_set(n)).alias("t"))
    free = F.array_min(F.array_except(F.sequence(F.lit(1), F.size("t") + 1), F.col("t")))
    return taken.select(F.when(free == 1, F.lit(base)).otherwise(F.concat(F.lit(base + "__r"), free.cast("string"))).alias("run_id"))
