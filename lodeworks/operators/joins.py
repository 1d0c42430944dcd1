"""Joins: bands by grid cells, nearest neighbours within keys, fallbacks, points in polygons, upserts.

No pure theta join: bands and boxes become equi-joins on grid cells (the probe side is replicated to the neighbouring
cells), nearest neighbours aggregate by min_by within an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .windows import running

#: Grid cells are by so much wider than a band, as a difference that rounds to less than its width may be as wide.
SLACK = 1 + 1e-6
#: Steps into which `_first_within` cuts half a band.
STEPS = 1 << 16


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """`new` rows whose key is not there yet; of several the first by `order`."""
    first = Window.partitionBy(*keys).orderBy(order)
    fresh = new.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return fresh.join(existing.select(*keys).distinct(), keys, "left_anti")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def full_refresh(existing: DataFrame, new: DataFrame, provenance: Column) -> DataFrame:
    """Rows of a provenance replaced by the new ones."""
    return existing.where(~F.coalesce(provenance, F.lit(False))).unionByName(new)


def _cells(df: DataFrame, axes: list[str], width: float, spread: bool) -> DataFrame:
    for i, c in enumerate(axes):
        cell = F.floor(F.col(c) / (width * SLACK))
        df = df.withColumn(f"_c{i}", F.explode(F.array(cell - 1, cell, cell + 1)) if spread else cell)
    return df


def band_join(left: DataFrame, right: DataFrame, axes: list[tuple[str, str]], width: float, keys: list[tuple[str, str]] = ()) -> DataFrame:
    """Pairs whose axes differ by less than `width` each, in the axes' own type (32 bits where both are), and whose keys are
    equal. `right`, the smaller side, is copied to 3 cells an axis. NULLs match nothing."""
    a = _cells(left, [x for x, _ in axes], width, False)
    b = _cells(right, [y for _, y in axes], width, True).withColumnsRenamed({f"_c{i}": f"_d{i}" for i in range(len(axes))})
    on = [F.col(f"_c{i}") == F.col(f"_d{i}") for i in range(len(axes))] + [F.col(x) == F.col(y) for x, y in keys]
    single = lambda x, y: isinstance(left.schema[x].dataType, FloatType) and isinstance(right.schema[y].dataType, FloatType)
    near = [F.abs(F.col(x) - F.col(y)) < F.lit(width).cast("float" if single(x, y) else "double") for x, y in axes]
    return a.join(b, [*on, *near]).drop(*(f"_{k}{i}" for k in "cd" for i in range(len(axes))))


def band_first(left: DataFrame, right: DataFrame, axes: list[tuple[str, str]], width: float, left_key: str, order: str) -> DataFrame:
    """Of the matches of each left row the first by `order`: the key with the right row's columns. On one axis no pairs are
    made; on several a map-side combined minimum, so not all matches are shuffled."""
    rest = F.struct(order, *(c for c in right.columns if c != order))
    if len(axes) == 1:
        met = _first_within(left, right.select(F.col(axes[0][1]).alias("_y"), rest.alias("_m")), axes[0][0], width)
    else:
        met = band_join(left, right, axes, width).withColumn("_m", rest)
    return met.groupBy(left_key).agg(F.min("_m").alias("_m")).select(left_key, "_m.*")


def _first_within(left: DataFrame, right: DataFrame, x: str, width: float) -> DataFrame:
    """`left` rows with `_m`, the least of the `_m` of right rows whose `_y` differs from `x` by less than `width`. Both sides are
    reduced to their different values; of those, work is linear. Values are cut into steps, small beside the width. What lies
    wholly within the band is a run of steps as long as a block of them, so it is the end of one block and the beginning of
    the next, each a running minimum over one sort of both sides. Values in the few steps about the band's ends are compared
    one by one. Values up to 2^30 widths are told apart; a block's different values are sorted in one task, which may spill."""
    step, block = width / STEPS, 2 * STEPS - 4
    finite = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))
    values = right.where(finite(F.col("_y"))).groupBy("_y").agg(F.min("_m").alias("_m")).withColumn("_s", F.floor(F.col("_y") / step))
    xs = left.select(F.col(x).alias("_x")).where(finite(F.col("_x"))).distinct().withColumn("_low", F.floor((F.col("_x") - width) / step))
    ends = [*range(-1, 2), *range(block + 2, 2 * STEPS + 3)]
    near = xs.select("_x", F.explode(F.array(*(F.col("_low") + d for d in ends))).alias("_s")).join(values, "_s")
    found = near.where(F.abs(F.col("_x") - F.col("_y")) < width).select("_x", "_m")

    def side(at: Column, order: Column) -> DataFrame:
        # A value on the same step as a question comes before it.
        both = values.select("_s", "_m").unionByName(xs.select("_x", at.alias("_s")), allowMissingColumns=True).withColumn("_b", F.floor(F.col("_s") / block))
        w = running(Window.partitionBy("_b").orderBy(order, F.col("_x").isNotNull()))
        return both.select("_x", F.min("_m").over(w).alias("_m")).where("_x IS NOT NULL AND _m IS NOT NULL")

    first, last = F.col("_low") + 2, F.col("_low") + block + 1
    found = found.unionByName(side(first, F.desc("_s"))).unionByName(side(last, F.col("_s")))
    least = found.groupBy("_x").agg(F.min("_m").alias("_m"))
    return left.join(least, F.col(x) == F.col("_x")).drop("_x")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each key the last row by `order`: what a lookup table built row by row holds."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each key the first row by `order`."""
    rest = [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_m")).select(*keys, "_m.*").select(*df.columns)


def k_nearest(left: DataFrame, right: DataFrame, left_key: str, keys: list[tuple[str, str]], left_value: str, right_value: str, right_id: str, k: int) -> DataFrame:
    """Per left row the k right rows of equal keys with the least |difference|, ties to the least id: (left_key, right_id,
    diff, rank). Right rows are numbered within their key from either end; a left row learns where it stands among them
    from one sort of both sides, and meets the k numbers on either side by an equi-join. The work is linear in both sides
    and k, never in pairs; a key's rows are sorted in one task, which may spill. `left_key` must be unique."""
    names = [f"_k{i}" for i in range(len(keys))]
    of = lambda df, cols: [F.col(c).alias(n) for c, n in zip(cols, names, strict=True)]
    a = left.select(*of(left, [x for x, _ in keys]), F.col(left_key).alias("_a"), F.col(left_value).cast("double").alias("_v")).dropna(subset=["_v", *names])
    b = right.select(*of(right, [y for _, y in keys]), F.col(right_id).alias("_id"), F.col(right_value).cast("double").alias("_v")).dropna(subset=["_v", *names])
    by = Window.partitionBy(*names)
    up, down = (F.row_number().over(by.orderBy(x, "_id")) for x in ("_v", F.desc("_v")))
    b = b.select(*names, "_id", "_v", up.alias("_up"), down.alias("_down"), F.count("*").over(by).alias("_n"))
    both = a.select(*names, "_v", "_a", F.lit(0).alias("_right")).unionByName(b.select(*names, "_v", F.lit(1).alias("_right")), allowMissingColumns=True)
    before = F.sum("_right").over(by.orderBy("_v", "_right").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = both.select(*names, "_v", "_a", "_right", before.alias("_before"), F.sum("_right").over(by).alias("_all")).where("_right = 0 and _all > 0")
    steps = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_step")
    q = placed.select(*names, F.col("_v").alias("_q"), "_a", "_before", "_all", steps)
    above = q.withColumn("_up", (F.col("_before") + F.col("_step")).cast("int")).join(b.select(*names, "_up", "_id", "_v"), [*names, "_up"])
    below = q.withColumn("_down", (F.col("_all") - F.col("_before") + F.col("_step")).cast("int")).join(b.select(*names, "_down", "_id", "_v"), [*names, "_down"])
    found = above.select("_a", "_id", "_v", "_q").union(below.select("_a", "_id", "_v", "_q")).withColumn("diff", F.abs(F.col("_v") - F.col("_q")))
    rank = F.row_number().over(Window.partitionBy("_a").orderBy("diff", "_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("_a").alias(left_key), F.col("_id").alias(right_id), "diff", "rank")


def nearest(left: DataFrame, right: DataFrame, left_key: str, keys: list[tuple[str, str]], left_value: str, right_value: str, right_id: str) -> DataFrame:
    """Per left row the right row of equal keys with the least |difference|, ties to the least id: (left_key, right_id, diff)."""
    return k_nearest(left, right, left_key, keys, left_value, right_value, right_id, 1).drop("rank")


def fallback_nearest(left: DataFrame, right: DataFrame, left_key: str, key: tuple[str, str], second: tuple[str, str], left_value: str, right_value: str, right_id: str, k: int) -> DataFrame:
    """The k nearest right rows that agree in both keys, or, for left rows without any such, in the first key only:
    (left_key, right_id, diff, rank)."""
    exact = k_nearest(left, right, left_key, [key, second], left_value, right_value, right_id, k)
    rest = left.join(exact.select(left_key).distinct(), left_key, "left_anti")
    return exact.union(k_nearest(rest, right, left_key, [key], left_value, right_value, right_id, k))


def series_op(a: DataFrame, b: DataFrame, key: str, va: str, vb: str, op: str) -> DataFrame:
    """a op b where both have a value; a division by 0 gives no row."""
    x, y = F.col("_a"), F.col("_b")
    value = {"subtract": x - y, "divide": x / F.nullif(y, F.lit(0)), "multiply": x * y}[op]
    j = a.select(key, F.col(va).alias("_a")).join(b.select(key, F.col(vb).alias("_b")), key)
    return j.select(key, value.alias("value")).where("value is not null")


def year_earlier(df: DataFrame, month: str, value: str, keys: list[str]) -> DataFrame:
    """Each month end's value with that of the same month end a year before (Feb 28/29 by last_day)."""
    old = df.select(*keys, F.col(month).alias("_m"), F.col(value).alias("before"))
    on = [df[k] == old[k] for k in keys] + [F.last_day(F.add_months(df[month], -12)) == old["_m"]]
    return df.join(old, on, "left").select(*(df[k] for k in keys), df[month], df[value], "before", F.round(df[value] / F.nullif("before", F.lit(0)) - 1, 4).alias("yoy"))


def inside_polygon(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule over a ring's edges; points on the boundary by the half-open rule."""
    out = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 == y2:
            continue
        crosses = ((F.lit(float(y1)) > y) != (F.lit(float(y2)) > y)) & (x < F.lit(float(x2 - x1)) * (y - y1) / F.lit(float(y2 - y1)) + x1)
        out = out + crosses.cast("int")
    return out % 2 == 1


def inside_box_then_polygon(df: DataFrame, x: str, y: str, ring: list[tuple[float, float]]) -> DataFrame:
    """Rows within a polygon; its bounding box is a filter that reaches the scan."""
    xs, ys = zip(*ring, strict=True)
    box = F.col(x).between(min(xs), max(xs)) & F.col(y).between(min(ys), max(ys))
    return df.where(box).where(inside_polygon(F.col(x), F.col(y), ring))


def nested(parent: DataFrame, child: DataFrame, key: str, fields: list[str], order: str, name: str) -> DataFrame:
    """Parents with their children as an array ordered by `order`; parents without any are dropped. Arrays hold one
    parent's children, so use it where those are few."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), *fields)))
    return parent.join(child.groupBy(key).agg(rows.alias(name)), key)
