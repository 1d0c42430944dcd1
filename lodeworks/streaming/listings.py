"""Listings as a stream: new observations deduplicated within a watermark, windowed counts, staleness by event-time timers,
and micro-batches that are appended to a table once each."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodeworks.operators.joins import insert_if_absent
from lodeworks.sources.sinks import exists


def fresh(stream: DataFrame, key: str, at: str, late: str = "2 days") -> DataFrame:
    """The first of each key within the watermark; state older than it is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, at: str, key: str, width: str = "1 day", late: str | None = "1 day") -> DataFrame:
    """Rows by key and window, late ones up to the watermark included; `late` is None for a stream that has one."""
    g = (stream.withWatermark(at, late) if late else stream).groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), key, "n")


def append_once(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str) -> StreamingQuery:
    """Every micro-batch appends the rows whose key is not in the table, so a replayed batch adds nothing."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        old = spark.read.schema(df.schema).parquet(path) if exists(spark, path) else df.limit(0)
        insert_if_absent(old, df, keys, order).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Days unseen after which a listing is inactive, and after which it is gone (fixed values).
INACTIVE, GONE = 30, 60
_DAY = 86_400_000


def staleness(stream: DataFrame, key: str, at: str, late: str = "0 seconds") -> DataFrame:
    """Changes of state (key, status, since): a sighting makes a listing active; a timer in event time makes it inactive_30d
    once it has not been seen for more than INACTIVE days, and rented_or_pulled after more than GONE, when its state goes.
    Time moves with the watermark: rows with a null key are ticks of the clock that no listing belongs to. A sighting later
    than the watermark is dropped, as the state it would have changed may be gone."""

    def step(name: tuple, batches, state: GroupState):
        if pd.isna(name[0]):
            return
        seen, status = state.get if state.exists else (None, None)
        changes = []
        for pdf in () if state.hasTimedOut else batches:
            last = int(pdf["at"].max().timestamp() * 1000) // _DAY
            if status != "active":
                changes.append(("active", last))
            seen, status = last if seen is None else max(seen, last), "active"
        now = state.getCurrentWatermarkMs()
        if status == "active" and now >= (seen + INACTIVE + 1) * _DAY:
            status = "inactive_30d"
            changes.append((status, seen + INACTIVE + 1))
        if now >= (seen + GONE + 1) * _DAY:
            changes.append(("rented_or_pulled", seen + GONE + 1))
            if state.exists:
                state.remove()
        else:
            state.update((seen, status))
            state.setTimeoutTimestamp((seen + (INACTIVE if status == "active" else GONE) + 1) * _DAY - 1)
        yield pd.DataFrame({"key": [name[0]] * len(changes), "status": [s for s, _ in changes], "since": [pd.Timestamp(d * _DAY, unit="ms").date() for _, d in changes]})

    kind = dict(stream.dtypes)[key]
    rows = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at")).withWatermark("at", late)
    out = rows.groupBy("key").applyInPandasWithState(step, f"key {kind}, status string, since date", "seen long, status string", "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumnRenamed("key", key)


def lifecycle_changes(stream: DataFrame, ticks: DataFrame, key: str, at: str) -> DataFrame:
    """`staleness` of a stream whose clock is a second one (a column `at` of times), so that listings go stale while nothing is
    seen."""
    clock = ticks.select(F.lit(None).cast(dict(stream.dtypes)[key]).alias(key), F.col("at").cast("timestamp").alias(at))
    return staleness(stream.select(key, F.col(at).cast("timestamp").alias(at)).unionByName(clock), key, at)
