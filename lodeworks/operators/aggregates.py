"""Aggregations. Everything combines on the map side; exact quantiles by large_quantiles, in bounded memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zero(c: Column) -> Column:
    """NULL sums as 0."""
    return F.coalesce(c, F.lit(0))


def universe_summary(df: DataFrame, size: str, inside: Column) -> DataFrame:
    """One row: rows, summed size, and both for the rows inside; 0 for none."""
    return df.agg(
        F.count("*").alias("n"), zero(F.sum(size)).alias("total"), F.count_if(inside).alias("n_inside"), zero(F.sum(F.when(inside, F.col(size)))).alias("total_inside")
    )


def quartiles(df: DataFrame, keys: list[str], value: str, per: str) -> DataFrame:
    """Per group: n, p25/p50/p75 of `value` cut to whole numbers, median of value / per (2 places)."""
    ratio = df.select(*keys, (F.col(value) / F.nullif(F.col(per), F.lit(0))).alias("_r"))
    a = large_quantiles(df, keys, value, [0.25, 0.5, 0.75]).withColumnRenamed("quantiles", "_p")
    b = large_quantiles(ratio, keys, "_r", [0.5]).select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.round(F.get("quantiles", F.lit(0)), 2).alias("median_per"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return a.join(b, on, "left").select(*keys, "n", *(F.get("_p", F.lit(i)).cast("bigint").alias(n) for i, n in enumerate(("p25", "p50", "p75"))), "median_per")


def large_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], accuracy: int = 100_000) -> DataFrame:
    """Exact interpolated quantiles by group (array `quantiles`, with n) in bounded memory, where percentile() would hold
    every distinct value of a group: mergeable sketches give a bracket around each quantile, one pass counts what lies
    below and takes the nearest values outside, and only the values within the brackets (of about 4 rows in `accuracy`) are
    ranked, each with the number of its rows, so that ties cost nothing."""
    step = 2.0 / accuracy
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-step, step)]
    d = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(value).cast("double").alias("_v"))
    sketch = d.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("_v", ends, accuracy).alias("_e"))
    on = [F.col(f"_d.{k}").eqNullSafe(F.col(f"_s.{k}")) for k in keys] or F.lit(True)
    j = d.alias("_d").join(sketch.alias("_s"), on).select(*(F.col(f"_d.{k}").alias(k) for k in keys), "_v", "n", "_e")
    low, high = (lambda i: F.get("_e", F.lit(2 * i))), (lambda i: F.get("_e", F.lit(2 * i + 1)))
    v = F.col("_v")
    out = j.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.array(*(F.struct(F.count_if(v < low(i)).alias("below"), F.max(F.when(v < low(i), v)).alias("prev"), F.min(F.when(v > high(i), v)).alias("next"), F.count_if(v.between(low(i), high(i))).alias("inside")) for i in range(len(probs)))).alias("_o"),
    )
    which = F.explode(F.filter(F.array(*(F.when(v.between(low(i), high(i)), F.lit(i)) for i in range(len(probs)))), lambda i: i.isNotNull()))
    values = j.select(*keys, "n", "_v", which.alias("_i")).groupBy(*keys, "n", "_v", "_i").agg(F.count("*").alias("_c"))
    so_far = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("_hi", F.sum("_c").over(so_far))
    p = F.get(F.array(*map(F.lit, map(float, probs))), F.col("_i"))
    r = (F.col("n") - 1) * p
    below = F.get("_o", F.col("_i"))["below"]
    both = ranked.alias("_d").join(out.alias("_s"), on).select(
        *(F.col(f"_d.{k}").alias(k) for k in keys), F.col("_d.n").alias("n"), "_i", "_v", (F.col("_hi") - F.col("_c") + below).alias("_from"), (F.col("_hi") - 1 + below).alias("_to"), F.get("_o", F.col("_i")).alias("_o")
    )
    hit = lambda at: F.max(F.when((at >= F.col("_from")) & (at <= F.col("_to")), F.col("_v")))
    g = both.groupBy(*keys, "n", "_i").agg(hit(F.floor(r)).alias("_a"), hit(F.ceil(r)).alias("_b"), F.first("_o").alias("_o"))
    a, b = F.coalesce("_a", "_o.prev"), F.coalesce("_b", "_o.next")
    q = F.struct("_i", (a + (b - a) * (r - F.floor(r))).alias("q"))
    return g.groupBy(*keys, "n").agg(F.transform(F.array_sort(F.collect_list(q)), lambda x: x["q"]).alias("quantiles"))


def concentration(df: DataFrame, key: str, size: Column, n: int) -> DataFrame:
    """The n largest keys by summed size, then rows, then key: a top-k without a full sort."""
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(size).alias("total"), F.count("*").alias("n"))
    return out.orderBy(F.desc("total"), F.desc("n"), key).limit(n)


def coverage(df: DataFrame, source: str, at: str, start: str, end: str) -> DataFrame:
    """Rows per source in [start, end)."""
    return df.where((F.col(at) >= F.lit(start)) & (F.col(at) < F.lit(end))).groupBy(source).agg(F.count("*").alias("n"))


def global_median(df: DataFrame, value: str, per: str) -> DataFrame:
    """One row: rows, median of `value`, and of value / per (4 places)."""
    ratio = df.select((F.col(value) / F.nullif(F.col(per), F.lit(0))).alias("_r"))
    one = df.agg(F.count("*").alias("n"))
    a = large_quantiles(df, [], value, [0.5]).select(F.get("quantiles", F.lit(0)).alias("median"))
    b = large_quantiles(ratio, [], "_r", [0.5]).select(F.round(F.get("quantiles", F.lit(0)), 4).alias("median_per"))
    return one.join(a, F.lit(True), "left").join(b, F.lit(True), "left")  # rows of one each


def divergence(df: DataFrame, local: Column, value: str, least: int = 10) -> DataFrame:
    """One row: the median of the local rows less that of all, in percent too, and whether the local ones are few."""
    a = large_quantiles(df.where(local), [], value, [0.5]).select(F.get("quantiles", F.lit(0)).alias("_a"), F.col("n").alias("_n"))
    b = large_quantiles(df, [], value, [0.5]).select(F.get("quantiles", F.lit(0)).alias("_b"))
    diff = F.col("_a") - F.col("_b")
    one = b.join(a, F.lit(True), "left")  # rows of one each
    return one.select(F.round(diff, 4).alias("diff"), F.round(100 * diff / F.col("_b"), 4).alias("pct"), (F.coalesce("_n", F.lit(0)) < least).alias("small"))


def plan_summary(df: DataFrame, code: str, size: str, rent: str, bed: str | None = None, positive: bool = False) -> DataFrame:
    """Floorplan summary: group by code ('Unknown' for none), units, mean size (0 places) and rent (2 places) over what
    is there; with `positive`, zeros count as missing. The bed type is the least of the group."""
    there = (lambda c: F.when(F.col(c) > 0, F.col(c))) if positive else F.col
    key = F.coalesce(F.nullif(F.trim(F.col(code)), F.lit("")), F.lit("Unknown"))
    more = [F.min(bed).alias("bed_type")] if bed else []
    return df.groupBy(key.alias("plan_code")).agg(F.count("*").alias("units"), F.round(F.avg(there(size)), 0).alias("sqft"), F.round(F.avg(there(rent)), 2).alias("avg_rent"), *more)


def occupied_summary(df: DataFrame, keys: list[str], occupied: Column, order: dict[str, int] | None = None) -> DataFrame:
    """Units, occupied units and occupancy % by group, with the rank of a custom order of the last key."""
    out = df.groupBy(*keys).agg(F.count("*").alias("units"), F.count_if(occupied).alias("occupied")).withColumn("occupancy_pct", F.round(100.0 * F.col("occupied") / F.col("units"), 1))
    if not order:
        return out
    rank = F.lit(len(order))
    for value, i in order.items():
        rank = F.when(F.col(keys[-1]) == value, F.lit(i)).otherwise(rank)
    return out.withColumn("rank", rank)


def kpi_row(df: DataFrame, occupied: Column, contract: str, market: str) -> DataFrame:
    """One row: units, occupancy %, mean/min/max contract rent of occupied units, loss to lease %."""
    c, m = F.when(occupied, F.col(contract)), F.when(occupied, F.col(market))
    pct = lambda a, b: F.when(b > 0, F.round(100.0 * a / b, 2)).otherwise(F.lit(0.0))
    return df.agg(
        F.count("*").alias("units"), pct(F.count_if(occupied), F.count("*")).alias("occupancy_pct"), F.round(F.avg(c), 2).alias("avg_contract"),
        F.min(c).alias("min_contract"), F.max(c).alias("max_contract"), pct(F.sum(m) - F.sum(c), F.sum(m)).alias("loss_to_lease_pct"),
    )


def signature_rollup(df: DataFrame, beds: str, baths: str, sqft: str, rent: str, name: str) -> DataFrame:
    """Units by (beds, baths, sqft): count, least and largest positive rent, and the plan's name if there is one only, else
    a made-up one. Names are aggregated as min, max, never collected."""
    rents = F.when(F.col(rent) > 0, F.col(rent))
    made = F.concat(F.col(beds).cast("string"), F.lit("BR/"), F.col(baths).cast("int").cast("string"), F.lit("BA "), F.round(F.col(sqft), 0).cast("bigint").cast("string"), F.lit(" SF"))
    out = df.groupBy(beds, baths, sqft).agg(F.count("*").alias("available"), F.min(rents).alias("rent_min"), F.max(rents).alias("rent_max"), F.min(name).alias("_a"), F.max(name).alias("_b"))
    return out.select(beds, baths, sqft, "available", "rent_min", "rent_max", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(made).alias("plan"))


def partial_merge(df: DataFrame, order: str) -> DataFrame:
    """Merge of floorplans seen on several pages: key (name, beds, rounded sqft), without a name (beds, baths, sqft and
    rents); largest count, least positive least rent, largest rent, first non-zero sqft and baths by `order`."""
    named = F.trim(F.coalesce("name", F.lit(""))) != ""
    bare = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("beds", "baths", "sqft", "rent_min")))
    key = F.when(named, F.concat_ws("|", F.lower("name"), F.col("beds").cast("string"), F.round("sqft", 0).cast("string"))).otherwise(bare)
    first = lambda c: F.min_by(F.when(F.col(c) != 0, F.col(c)), F.when(F.col(c) != 0, F.col(order))).alias(c)
    return df.withColumn("_key", key).groupBy("_key").agg(
        F.min_by("name", order).alias("name"), F.min_by("beds", order).alias("beds"), first("baths"), first("sqft"), F.max("available").alias("available"),
        F.min(F.when(F.col("rent_min") > 0, F.col("rent_min"))).alias("rent_min"), F.max("rent_max").alias("rent_max"), F.min(order).alias(order),
    ).drop("_key")


def unit_type_rollup(df: DataFrame, group: str, beds: str, rent: str, sqft: str, free_months: str, total_units: str) -> DataFrame:
    """Per group and beds: units, face rent (mean positive), effective rent = face (12 - free) / 12, per square foot, and
    vacancy % over the group's units of all beds."""
    face = F.avg(F.when(F.col(rent) > 0, F.col(rent)))
    out = df.groupBy(group, beds).agg(F.count("*").alias("units"), face.alias("_face"), F.avg(F.when(F.col(sqft) > 0, F.col(sqft))).alias("_sqft"), F.max(free_months).alias("_free"), F.max(total_units).alias("_total"))
    w = Window.partitionBy(group)
    effective = F.col("_face") * (12 - F.col("_free")) / 12
    vacancy = F.when(F.max("_total").over(w) > 0, F.round(100.0 * F.sum("units").over(w) / F.max("_total").over(w), 2))
    return out.select(group, beds, "units", F.round("_face", 2).alias("face_rent"), F.round(effective, 2).alias("effective_rent"), F.round(effective / F.nullif("_sqft", F.lit(0)), 4).alias("effective_psf"), vacancy.alias("vacancy_pct"))


def weighted(value: str, weight: str) -> Column:
    """Mean weighted over rows that have both; NULL without weight."""
    both = F.col(value).isNotNull() & F.col(weight).isNotNull()
    return F.sum(F.when(both, F.col(value) * F.col(weight))) / F.nullif(F.sum(F.when(both, F.col(weight))), F.lit(0))


def weighted_or_one(value: str, weight: str) -> Column:
    """Weighted sum over the weights' sum, or over 1 if that is 0."""
    return F.sum(F.col(value) * F.col(weight)) / F.greatest(F.sum(weight), F.lit(1))


def flows_net(inflow: DataFrame, outflow: DataFrame, key: str, measures: list[str], n: int) -> DataFrame:
    """Two directions per key with their net, over all rows; then the n largest inflows (by the first measure)."""
    side = lambda df, name: df.groupBy(key).agg(*(F.sum(m).alias(f"{name}_{m}") for m in measures))
    both = side(inflow, "in").join(side(outflow, "out"), key, "full")
    net = [(zero(F.col(f"in_{m}")) - zero(F.col(f"out_{m}"))).alias(f"net_{m}") for m in measures]
    out = both.select(key, *(zero(F.col(f"{d}_{m}")).alias(f"{d}_{m}") for d in ("in", "out") for m in measures), *net)
    return out.orderBy(F.desc(f"in_{measures[0]}"), key).limit(n)


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows and percent of all rows by key; the total is one row, joined in."""
    out = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_total"))
    return out.crossJoin(F.broadcast(total)).select(key, "n", F.round(100.0 * F.col("n") / F.col("_total"), 2).alias("pct"))


def error_metrics(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """n, RMSE, MAE, median and largest absolute error, bias."""
    e = F.col(actual) - F.col(predicted)
    d = df.where(e.isNotNull()).withColumn("_e", e)
    return d.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.sqrt(F.avg(F.col("_e") * F.col("_e"))), 4).alias("rmse"), F.round(F.avg(F.abs("_e")), 4).alias("mae"),
        F.round(F.percentile(F.abs("_e"), F.lit(0.5)), 4).alias("med_ae"), F.round(F.max(F.abs("_e")), 4).alias("max_ae"), F.round(F.avg("_e"), 4).alias("bias"),
    )


def inverse_weights(df: DataFrame, rmse: str, model: str, excluded: tuple[str, ...] = ("Naive",)) -> DataFrame:
    """1 / RMSE normalised over the models that take part."""
    ok = df.where(~F.col(model).isin(list(excluded)) & (F.col(rmse) > 0))
    total = F.broadcast(ok.agg(F.sum(1 / F.col(rmse)).alias("_total")))  # one row
    return ok.crossJoin(total).withColumn("weight", F.round((1 / F.col(rmse)) / F.col("_total"), 6)).drop("_total")


def iqr_outliers(df: DataFrame, keys: list[str], value: str, k: float = 1.5) -> DataFrame:
    """Quartiles, fences and rows beyond them, by group, in bounded memory."""
    q = large_quantiles(df, keys, value, [0.25, 0.75]).withColumnRenamed("quantiles", "_q")
    q = q.select(*keys, F.get("_q", F.lit(0)).alias("q1"), F.get("_q", F.lit(1)).alias("q3")).withColumn("_i", k * (F.col("q3") - F.col("q1")))
    out = (F.col(value) < F.col("q1") - F.col("_i")) | (F.col(value) > F.col("q3") + F.col("_i"))
    return df.join(q, keys).groupBy(*keys).agg(F.round(F.first("q1"), 4).alias("q1"), F.round(F.first("q3"), 4).alias("q3"), F.count_if(out).alias("outliers"), F.count("*").alias("n"))


def descriptives(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, mean, sample deviation, extremes, and bias-corrected skewness and excess kurtosis."""
    n = F.col("n").cast("double")
    raw = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.skewness(value).alias("_g"), F.kurtosis(value).alias("_k"))
    skew = F.when(n > 2, F.col("_g") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_k") + 6))
    return raw.select(*keys, "n", *(F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max")), F.round(skew, 4).alias("skew"), F.round(kurt, 4).alias("kurt"))


def charge_pivot(df: DataFrame, unit: str, text: str, amount: str, rules: list[tuple[str, str]]) -> DataFrame:
    """Ledger lines to one column a bucket: the first rule (bucket, regex) that a line's text fits takes it."""
    from lodeworks.functions.text import first_match

    bucket = first_match(F.lower(text), rules, F.lit("other"))
    names = [*dict.fromkeys([r[0] for r in rules]), "other"]
    return df.withColumn("_b", bucket).groupBy(unit).agg(*(zero(F.round(F.sum(F.when(F.col("_b") == b, F.col(amount))), 2)).alias(b) for b in names))


def worst_of(df: DataFrame, keys: list[str], status: str, ranks: dict[str, int]) -> DataFrame:
    """The status of the highest rank in each group."""
    rank = F.lit(-1)
    for s, r in ranks.items():
        rank = F.when(F.col(status) == s, F.lit(r)).otherwise(rank)
    return df.groupBy(*keys).agg(F.max_by(status, F.struct(rank, F.col(status))).alias(status))


def affordability(rent: Column, income: Column, share: float = 0.30) -> Column:
    """Struct: income needed for the rent, what the household has of it, and whether it is enough."""
    need = rent * 12 / share
    return F.struct(need.alias("required"), F.round(income / F.nullif(need, F.lit(0.0)), 4).alias("ratio"), (income >= need).alias("affordable"))
