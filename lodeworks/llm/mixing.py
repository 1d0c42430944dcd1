"""Mixing sources to target weights by Pfair scheduling [Baruah et al. 1996], in built-in functions unless sources or
weights are too many for one row.

Each source's rows, in an order set by a hash, form blocks of BLOCK rows. Time is counted in slots of one block. In a
period source s places c_s of its C = sum c_s blocks; its i-th block (from 0) is released at floor(i C / c_s) and due
at ceil((i + 1) C / c_s); each slot goes to the released block with the earliest deadline. That keeps every source
less than one block away from its exact share c_s / C after every slot, and exactly on it where a period ends.

c_s is the source's weight while it has that many blocks left, then what it has left, then 0: all rows are placed once,
no row is dropped or repeated, and once a source is used up the others share its slots by their weights. So the
schedule is periodic but for at most two periods a source: of each kind of period one pattern is computed, and a row
finds its slot by arithmetic. S sources with C blocks a period have at most (2 S + 1) * C rows of patterns, whatever the
number of rows mixed; up to MAX_PATTERN rows they are computed in one row and broadcast. Beyond that the same schedule is
computed kind of period by kind of period with heaps in Python, written out block by block (never more rows than blocks) and joined by source and block; only
the blocks of one period have to fit in a task.

A row's rank in its source is counted in buckets of hash bits, whose sizes are then summed up: no source, however
large, lands in one task.

Defined cases: a null source is a source of its own; rows with equal ids and texts tie and are placed in either order;
an empty table gives an empty result; weights must be whole numbers of at least 1; extra columns pass by, whatever their
names, but for block, slot and position, which are replaced.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, table

#: Rows of a block, and most rows of patterns that are computed in one row and broadcast.
BLOCK, MAX_PATTERN = 16, 200_000
#: Least rows of a bucket within which ranks are counted; else it is the square root of all rows, so that neither a
#: bucket nor a source's list of buckets grows faster than that.
BUCKET = 256
#: Target weights of the registered query and of the pipeline, in blocks a period; other sources have 1.
WEIGHTS, OTHERS = {"src0": 4, "src1": 2, "src2": 2}, 1


#: Periods that one row lists at a time.
CHUNK = 4_096


def _weight(source: Column, weights: dict[str, int], others: int) -> Column:
    if len(weights) > 100:  # too deep for a chain of cases
        known = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
        return F.coalesce(F.try_element_at(known, source), F.lit(others)).cast("long")
    out = F.lit(others)
    for name, w in weights.items():
        out = F.when(source == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _schedule(c: Column) -> Column:
    """The sources' numbers slot by slot: earliest deadline first among the released blocks of one period, in which
    source k has c[k] blocks."""
    total = F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    empty = F.array().cast("array<int>")

    def step(at: Column, t: Column) -> Column:
        def offer(done: Column, k: Column) -> Column:
            share = F.get(at["c"], k)
            due = -F.floor(-((done + 1) * at["total"]).cast("double") / share)
            ready = (done < share) & (done * at["total"] < (t + 1) * share)  # floor(done total / share) <= t
            return F.when(ready, F.struct(due.alias("due"), k.alias("k")))

        pick = F.array_min(F.transform(at["done"], offer))["k"]
        chosen = F.struct(at["c"].alias("c"), at["total"].alias("total"), at["done"].alias("done"), at["out"].alias("out"), pick.alias("pick"))
        # A one-element array names `pick`, so that it is found once and not for every source.
        return F.get(
            F.transform(
                F.array(chosen),
                lambda x: F.struct(
                    x["c"].alias("c"), x["total"].alias("total"),
                    F.transform(x["done"], lambda d, k: d + (k == x["pick"]).cast("long")).alias("done"),
                    F.array_append(x["out"], x["pick"]).alias("out"),
                ),
            ),
            F.lit(0),
        )

    start = F.struct(c.alias("c"), total.alias("total"), F.transform(c, lambda x: F.lit(0).cast("long")).alias("done"), empty.alias("out"))
    return F.when(total > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), total - 1), start, step, lambda at: at["out"])).otherwise(empty)


def patterns(sizes: DataFrame, weights: dict[str, int], others: int, block: int) -> DataFrame:
    """For `sizes` (source, n): rows (source, i, q0, q1, weight, per_period, base, at): in periods q0 <= q < q1 the
    source's block q * weight + i stands in slot base + (q - q0) * per_period + at."""
    named = sizes.select("source", _weight(F.col("source"), weights, others).alias("w"), F.ceil(F.col("n") / block).cast("long").alias("blocks"))
    one = named.agg(F.sort_array(F.collect_list(F.struct("source", "w", "blocks"))).alias("s"))
    ends = F.transform("s", lambda x: F.floor(x["blocks"] / x["w"]))
    bounds = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), ends, F.transform(ends, lambda e: e + 1))))
    kinds = one.select("s", bounds.alias("bounds")).select("s", "bounds", F.posexplode("bounds").alias("j", "q0"))
    kinds = kinds.withColumn("q1", F.coalesce(F.get("bounds", F.col("j") + 1), F.col("q0") + 1))
    c = F.transform("s", lambda x: F.greatest(F.lit(0), F.least(x["w"], x["blocks"] - F.col("q0") * x["w"])))
    base = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.least(x["blocks"], F.col("q0") * x["w"]))
    kinds = kinds.select("s", "q0", "q1", base.alias("base"), c.alias("c"))
    placed = kinds.select("s", "q0", "q1", "base", _schedule(F.col("c")).alias("out"))
    rows = placed.select("s", "q0", "q1", "base", F.size("out").cast("long").alias("per_period"), F.posexplode("out").alias("at", "k"))
    rows = rows.select(F.get("s", F.col("k")).alias("x"), "q0", "q1", "base", "per_period", F.col("at").cast("long").alias("at"))
    rows = rows.select(F.col("x.source").alias("source"), F.col("x.w").alias("weight"), "q0", "q1", "base", "per_period", "at")
    i = F.row_number().over(Window.partitionBy("source", "q0").orderBy("at")) - 1
    return rows.withColumn("i", i.cast("long"))


def _place(live: pa.Table) -> pa.Table:
    """The slots of one kind of period: as `_schedule`, with the released blocks and those to come in heaps."""
    live = live.take(pc.sort_indices(live, sort_keys=[("source", "ascending")], null_placement="at_start"))
    c = live.column("c").to_pylist()
    total, done = sum(c), [0] * len(c)
    later, ready = [(0, k) for k in range(len(c))], []
    who, nth = [], []
    for t in range(total):
        while later and later[0][0] <= t:
            k = heapq.heappop(later)[1]
            heapq.heappush(ready, (-(-(done[k] + 1) * total // c[k]), k))
        k = heapq.heappop(ready)[1]
        who.append(k), nth.append(done[k])
        done[k] += 1
        if done[k] < c[k]:
            heapq.heappush(later, (done[k] * total // c[k], k))
    q0 = pa.array([live.column("q0")[0].as_py()] * total, pa.int64())
    own = live.take(pa.array(who, pa.int64()))
    return pa.Table.from_arrays([own.column("source"), own.column("w"), q0, pa.array(nth, pa.int64()), pa.array(range(total), pa.int64())], ["source", "w", "q0", "i", "at"])


def slots(sizes: DataFrame, weights: dict[str, int], others: int, block: int) -> DataFrame:
    """For `sizes` (source, n): the slot of every block, rows (source, block, slot), whatever the number of sources."""
    named = sizes.select("source", _weight(F.col("source"), weights, others).alias("w"), F.ceil(F.col("n") / block).cast("long").alias("blocks"))
    end = F.floor(F.col("blocks") / F.col("w"))
    # At most about the square root of eight times all blocks: so many different ends need that many blocks.
    ends = named.select(F.explode(F.array(F.lit(0).cast("long"), end, end + 1)).alias("e")).distinct().agg(F.sort_array(F.collect_list("e")).alias("bounds"))
    steps = F.transform("bounds", lambda e, j: F.struct(e.alias("q0"), F.coalesce(F.get("bounds", j + 1), e + 1).alias("q1")))
    pairs = named.crossJoin(F.broadcast(ends.select(steps.alias("steps"))))  # one row
    live = pairs.select("source", "w", "blocks", F.explode(F.filter("steps", lambda x: x["q0"] * F.col("w") < F.col("blocks"))).alias("x"))
    live = table(live.select("source", "w", "x.q0", "x.q1", F.least("w", F.col("blocks") - F.col("x.q0") * F.col("w")).alias("c")), "periods")
    kinds = live.groupBy("q0", "q1").agg(F.sum("c").alias("per"))
    before = Window.orderBy("q0").rowsBetween(Window.unboundedPreceding, -1)
    kinds = kinds.withColumn("base", F.coalesce(F.sum(F.col("per") * (F.col("q1") - F.col("q0"))).over(before), F.lit(0)))
    kind = dict(sizes.dtypes)["source"]
    placed = live.groupBy("q0").applyInArrow(_place, f"source {kind}, w long, q0 long, i long, at long").join(kinds, "q0")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("q1") - F.col("q0") - 1) / CHUNK))
    placed = placed.select("*", F.explode(chunks).alias("part"))
    low = F.col("q0") + F.col("part") * CHUNK
    placed = placed.select("*", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("q1")) - 1)).alias("q"))
    return placed.select("source", (F.col("q") * F.col("w") + F.col("i")).alias("block"), (F.col("base") + (F.col("q") - F.col("q0")) * F.col("per") + F.col("at")).alias("slot"))


def mix(
    df: DataFrame, weights: dict[str, int] = WEIGHTS, others: int = OTHERS, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", text_col: str | None = "text"
) -> DataFrame:
    """`df` with block (within the source, from 0), slot (of the schedule, from 0) and position (slot * block + place in
    the block): ordered by position, every prefix holds the sources by their weights to within a block each."""
    if others < 1 or any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("weights must be whole numbers of at least 1")
    df = df.drop("block", "slot", "position")
    t = free_name(df, "_mix_")
    order = F.xxhash64(F.col(id_col), F.xxhash64(text_col)) if text_col else F.xxhash64(id_col)
    count = df.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    sizes = table(count, "sources")
    total, n_sources = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    period = sizes.agg(F.coalesce(F.sum(_weight(F.col("source"), weights, others)), F.lit(0))).first()[0]
    bits = (total // max(BUCKET, math.isqrt(total))).bit_length()
    bucket = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    keyed = df.withColumn(f"{t}h", order).withColumn(f"{t}b", bucket)
    within = Window.partitionBy(source_col, f"{t}b").orderBy(f"{t}h", id_col)
    keyed = keyed.withColumn(f"{t}rank", F.row_number().over(within).cast("long"))
    buckets = df.select(F.col(source_col).alias(f"{t}s"), bucket.alias(f"{t}bb")).groupBy(f"{t}s", f"{t}bb").agg(F.count("*").alias(f"{t}n"))
    before = Window.partitionBy(f"{t}s").orderBy(f"{t}bb").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(f"{t}s", f"{t}bb", F.coalesce(F.sum(f"{t}n").over(before), F.lit(0)).alias(f"{t}before"))
    ranked = keyed.join(buckets, F.col(source_col).eqNullSafe(F.col(f"{t}s")) & (F.col(f"{t}b") == F.col(f"{t}bb")))
    rank = F.col(f"{t}before") + F.col(f"{t}rank") - 1
    ranked = ranked.withColumn(f"{t}rank", rank).withColumn("block", F.floor(F.col(f"{t}rank") / block)).withColumn(f"{t}w", _weight(F.col(source_col), weights, others))
    named = lambda p: p.select(*(F.col(c).alias(f"{t}p_{c}") for c in p.columns))
    p = lambda c: F.col(f"{t}p_{c}")
    same = F.col(source_col).eqNullSafe(p("source"))
    if (2 * n_sources + 1) * period > MAX_PATTERN:
        at = named(table(slots(sizes, weights, others, block), "slots"))
        found, slot = ranked.join(at, same & (F.col("block") == p("block"))), p("slot")
    else:
        ranked = ranked.withColumn(f"{t}q", F.floor(F.col("block") / F.col(f"{t}w"))).withColumn(f"{t}i", F.col("block") % F.col(f"{t}w"))
        at = F.broadcast(named(table(patterns(sizes, weights, others, block), "patterns")))
        q = F.col(f"{t}q")
        found = ranked.join(at, same & (F.col(f"{t}i") == p("i")) & (q >= p("q0")) & (q < p("q1")))
        slot = p("base") + (q - p("q0")) * p("per_period") + p("at")
    return found.select(*df.columns, "block", slot.alias("slot"), (slot * block + F.col(f"{t}rank") % block).alias("position"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix(docs, text_col=None).select("doc_id", "source", "block", "slot", "position")
