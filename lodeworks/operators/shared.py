"""Tables in the folder that driver and executors share, and connected components over distributed edges."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Paths of tables written and not yet deleted, with their sessions.
_WRITTEN: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session (tests, timing)
    gets a folder of its own, as all its tasks run on one machine; a cluster must name one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file:///tmp/checkpoints/lodeworks-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def table(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors, and lets
    several consumers read one computation. Files are deleted by `forget`, or when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodeworks-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._lodeworks_path = path
    return out


def delete_at_end(spark: SparkSession, path: str) -> None:
    """The files under `path` go when the session ends."""
    _WRITTEN[path] = spark


def forget(written: DataFrame) -> None:
    """Delete the files of a `table` that nothing will read again."""
    path = written._lodeworks_path
    _delete(_WRITTEN.pop(path), path)


@atexit.register
def _forget_all() -> None:
    for path, spark in _WRITTEN.items():
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone; the folder belongs to the application and goes with it
        pass


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "cc") -> DataFrame:
    """Connected components of undirected edges: (id, comp), comp the smallest id reachable; ids without an edge are
    not returned. Alternates large-star and small-star [Kiveris et al., SoCC 2014]: only minima are aggregated (map-side
    combined), no neighbourhood is collected, and a hub's rows are joined back with a join that Spark may split. Each
    round is written to the shared folder."""
    now = table(
        edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u != v").distinct(),
        label,
    )
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u != v")
            .distinct()
        )
        after = table(small, label)
        forget(now)  # only `small`, which is written, read it
        # Converged when every edge leads straight to a vertex that is nobody's child.
        deep = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        if deep.isEmpty() and after.join(after.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).isEmpty():
            break
        now = after
    roots = after.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    return after.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(roots)
