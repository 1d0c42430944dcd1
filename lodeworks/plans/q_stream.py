"""Queries that run as streams over the landed files, in one pass of available data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodeworks.operators import models
from lodeworks.operators.shared import delete_at_end, shared_dir
from lodeworks.streaming import listings

from .q_relational import quarters
from .registry import query


def _landed(spark, sf_dir: str, name: str):
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{sf_dir}/{name}.parque[t]")


def _run(stream, spark, mode: str, keys: list[str]):
    """Run to the end of what has landed; every batch's changed rows are appended, and the latest of each key is read."""
    at = f"{shared_dir(spark)}/lodeworks-stream-{uuid.uuid4().hex}"
    delete_at_end(spark, at)

    def batch(df, number: int) -> None:
        df.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{at}/rows/part_no={number}")  # a batch tried again replaces itself

    q = stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{at}/rows").drop("part_no")
    top = rows.groupBy(*keys).agg(F.max("_batch").alias("_batch"))
    return rows.join(top, [*keys, "_batch"]).drop("_batch")


@query("stream01_window_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream01(spark, sf_dir):
    """Streaming: counts by day and kind, updated batch by batch."""
    s = _landed(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    out = s.select(F.to_date("w.start").alias("day"), "event_type", "n")
    return _run(out, spark, "update", ["day", "event_type"])


@query("stream02_first_of_key", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def stream02(spark, sf_dir):
    """Streaming: the keys seen, deduplicated within a watermark; a later repeat is not given again by the last read."""
    s = _landed(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", "40 days").dropDuplicatesWithinWatermark(["user_id", "event_type"])
    return _run(s.select("user_id", "event_type"), spark, "append", ["user_id", "event_type"])


@query("stream03_staleness", """WITH u AS (SELECT user_id, max(CAST(ts AS DATE)) AS seen FROM events GROUP BY 1) SELECT user_id, CASE WHEN date_diff('day', seen, DATE '2024-03-15') > 60 THEN 'rented_or_pulled'
WHEN date_diff('day', seen, DATE '2024-03-15') > 30 THEN 'inactive_30d' ELSE 'active' END AS status FROM u""")
def stream03(spark, sf_dir):
    """Streaming, WIN-30, ER-07: users as listings; what landed is read, then the clock strikes and timers fire."""
    at = f"{shared_dir(spark)}/lodeworks-stale-{uuid.uuid4().hex}"
    delete_at_end(spark, at)
    tick = lambda t: spark.sql(f"SELECT TIMESTAMP '{t}' AS at").write.mode("append").parquet(f"{at}/ticks")
    tick("2000-01-01 00:00:00")

    def batch(df, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{at}/rows/part_no={number}")

    for strike in (None, "2024-03-15 00:00:00"):
        if strike:
            tick(strike)
        ticks = spark.readStream.schema("at timestamp").parquet(f"{at}/ticks")
        changes = listings.lifecycle_changes(_landed(spark, sf_dir, "events"), ticks, "user_id", "ts")
        changes.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{at}/rows")
    return rows.groupBy("user_id").agg(F.max_by("status", F.struct("since", F.col("status") == "active")).alias("status"))


@query("mod04_cascade")
def mod04(spark, sf_dir):
    """MOD-04: tiers in order, each with the one above."""
    p = quarters(spark, sf_dir).withColumn("market", F.lit("all")).withColumn("n", F.col("n").cast("double"))
    c = models.cascade(p, "market", "q", "o_orderpriority", "n", ("1-URGENT", "3-MEDIUM", "5-LOW"))
    return c.select("market", "tier", F.round("rmse", 4).alias("rmse"), F.round("rmse_alone", 4).alias("rmse_alone"), "n")


@query("mod10_boosted")
def mod10(spark, sf_dir):
    """MOD-10."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return models.boosted(p, "p_retailprice", ["p_size"]).select("p_partkey", F.round("predicted", 2).alias("predicted"))


@query("pan06_hilbert_phase")
def pan06(spark, sf_dir):
    """PAN-06: monthly orders by priority as the series."""
    m = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("int")
    p = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority", m.alias("m")).agg(F.count("*").cast("double").alias("n"))
    return models.hilbert_phase(p, ["o_orderpriority"], "m", "n").select("o_orderpriority", "m", "phase")
