"""Quarterly submarket panels: derived columns, cross-tier and metro panels, and the supply-risk score.

A panel has a few hundred rows a market, so all windows are partitioned by market and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.text import dimension_score

from . import windows as win
from .aggregates import weighted, zero

#: Thresholds of the risk dimensions: name, metric, high risk, moderate, whether low values are the risk (fixed values).
DIMENSIONS = [
    ("pipeline_depth", "uc_share", 0.10, 0.05, False),
    ("delivery_timing", "deliveries_next_4q_share", 0.08, 0.04, False),
    ("absorption_trend", "absorption_delivery_ratio_4q", 0.7, 1.0, True),
    ("rent_momentum", "effective_rent_growth_yoy", -0.03, 0.0, True),
]
POINTS, PROCEED, CAUTION = 25, 70, 40
#: Columns that a panel needs, missing ones being null: those that stay null, and those of which null is 0.
MEASURES = ["vacancy_rate", "stabilized_vacancy", "occupancy_rate", "inventory_units", "absorption_units_12mo", "effective_rent_unit", "asking_rent_unit", "effective_rent_growth_yoy", "asking_rent_growth_yoy"]
COUNTS = ["under_construction", "deliveries", "deliveries_12mo", "deliveries_gross", "construction_starts_12mo"]


def _or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def growth_columns(df: DataFrame, keys: list[str]) -> DataFrame:
    """inventory_growth_yoy over 4 quarters (a missing inventory taken from the quarter before), and deliveries against
    organic growth: the inventory a year ago times the mean growth of 8 quarters, if that is above 0."""
    w = Window.partitionBy(*keys).orderBy("q")
    df = df.withColumn("_inv", win.ffill("inventory_units", w))
    df = df.withColumn("inventory_growth_yoy", F.col("_inv") / _or_null(F.lag("_inv", 4).over(w)) - 1)
    organic = F.lag("inventory_units", 4).over(w) * win.guarded_mean("inventory_growth_yoy", win.last_n(w, 8), 8)
    organic = F.when(organic > 0, organic)
    return df.withColumn("delivery_vs_organic_growth", F.col("deliveries_12mo") / organic).drop("_inv")


def submarket_panel(df: DataFrame, keys: list[str]) -> DataFrame:
    """From (keys, q, is_forecast, MEASURES, COUNTS), one row a quarter: measures with their derived columns. Shares are over
    inventory; cumulative surplus adds up deliveries less implied absorption; the equilibrium is the mean vacancy so far (8
    values at least), and quarters to it stand where the last 4 quarters (2 at least) absorbed anything on the mean."""
    num = lambda c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
    w = Window.partitionBy(*keys).orderBy("q")
    p = df.select(*keys, "q", "is_forecast", *(num(c).alias(c) for c in MEASURES), *(F.coalesce(num(c), F.lit(0.0)).alias(c) for c in COUNTS))
    inv = _or_null(F.col("inventory_units"))
    p = p.withColumns({
        "vacancy_gap": F.col("vacancy_rate") - F.col("stabilized_vacancy"), "uc_share": F.col("under_construction") / inv,
        "deliveries_12mo_share": F.col("deliveries_12mo") / inv, "absorption_12mo_share": F.col("absorption_units_12mo") / inv,
        "absorption_delivery_ratio": F.col("absorption_units_12mo") / _or_null(F.col("deliveries_12mo")),
        "occupied_units": F.col("inventory_units") * (1 - F.col("vacancy_rate")),
        "supply_pressure": (F.col("deliveries_12mo") - F.col("absorption_units_12mo")) / inv,
    })
    p = p.withColumn("quarterly_absorption_implied", F.col("occupied_units") - F.lag("occupied_units").over(w))
    p = p.withColumn("quarterly_excess", F.col("deliveries") - zero(F.col("quarterly_absorption_implied")))
    p = p.withColumn("cumulative_net_surplus", F.sum("quarterly_excess").over(win.running(w)))
    p = p.withColumn("equilibrium_vacancy", win.guarded_mean("vacancy_rate", win.running(w), 8))
    p = p.withColumn("units_to_equilibrium", (F.col("vacancy_rate") - F.col("equilibrium_vacancy")) * F.col("inventory_units"))
    pace = win.guarded_mean("quarterly_absorption_implied", win.last_n(w, 4), 2)
    p = p.withColumn("quarters_to_equilibrium", F.when(pace > 0, F.col("units_to_equilibrium") / pace))
    return growth_columns(p, keys)


#: Columns that submarket_panel derives.
DERIVED = [
    "vacancy_gap", "uc_share", "deliveries_12mo_share", "absorption_12mo_share", "absorption_delivery_ratio", "occupied_units", "quarterly_absorption_implied", "quarterly_excess",
    "cumulative_net_surplus", "equilibrium_vacancy", "units_to_equilibrium", "quarters_to_equilibrium", "inventory_growth_yoy", "delivery_vs_organic_growth", "supply_pressure",
]


def cross_tier(df: DataFrame, key: str, tier: str, subject: str, high: str) -> DataFrame:
    """Subject rows with the high tier's columns of the same market and quarter, totals over tiers, the high tier's share
    and the rent gap. One pass: tiers are pivoted by conditional aggregates."""
    of = lambda v, c: F.max(F.when(F.col(tier) == v, F.col(c)))
    g = df.groupBy(key, "q").agg(
        of(subject, "inventory").alias("inventory"), of(high, "inventory").alias("high_inventory"), F.sum("inventory").alias("total_inventory"),
        of(subject, "rent").alias("rent"), of(high, "rent").alias("high_rent"),
    ).where("inventory is not null")
    share = F.col("high_inventory") / F.nullif(F.col("total_inventory"), F.lit(0))
    return g.withColumn("high_share", share).withColumn("rent_gap", F.col("high_rent") - F.col("rent")).withColumn("rent_premium", F.col("high_rent") / F.nullif("rent", F.lit(0)) - 1)


def metro_panel(df: DataFrame, keys: list[str]) -> DataFrame:
    """From submarket panels: per keys and quarter counts summed (missing ones as 0), rates weighted by inventory, forecast if
    any row is, the number of submarkets, and the derived shares. Without deliveries the absorption ratio is 2, or 0 where
    absorption is negative."""
    counts = ["inventory_units", "under_construction", "deliveries", "deliveries_12mo", "absorption_units_12mo", "construction_starts_12mo"]
    rates = ["vacancy_rate", "effective_rent_unit", "effective_rent_growth_yoy", "asking_rent_growth_yoy"]
    g = df.groupBy(*keys, "q").agg(
        F.bool_or("is_forecast").alias("is_forecast"), *(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in counts),
        *(weighted(c, "inventory_units").alias(c) for c in rates), F.count("*").alias("submarket_count"),
    )
    inv, d12, a12 = _or_null(F.col("inventory_units")), F.col("deliveries_12mo"), F.col("absorption_units_12mo")
    g = g.withColumn("uc_share", F.col("under_construction") / inv).withColumn("deliveries_12mo_share", d12 / inv).withColumn("supply_pressure", (d12 - a12) / inv)
    ratio = F.when(d12 > 0, a12 / d12).when(a12 >= 0, 2.0).otherwise(0.0)
    return growth_columns(g.withColumn("absorption_delivery_ratio", ratio), keys)


def risk_metrics(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Per market, from a submarket panel: the latest actual quarter's uc_share and rent growth; deliveries of the first four
    forecast quarters over its inventory (its 12-month share without forecasts); and its 12-month absorption over
    the last four actual quarters' deliveries (2 without deliveries, 0 if absorption is negative then)."""
    back = F.row_number().over(Window.partitionBy(*keys, "is_forecast").orderBy(F.when(F.col("is_forecast"), F.col("q")).otherwise(-F.col("q"))))
    four = panel.withColumn("_n", back).where("_n <= 4")
    latest = lambda c: F.max_by(c, F.when(~F.col("is_forecast"), F.col("q")))
    g = four.groupBy(*keys).agg(
        F.max(F.when(~F.col("is_forecast"), F.col("q"))).alias("as_of"), *(latest(c).alias(c) for c in ("uc_share", "inventory_units", "deliveries_12mo_share", "absorption_units_12mo", "effective_rent_growth_yoy")),
        F.sum(F.when(F.col("is_forecast"), F.col("deliveries"))).alias("_next"), F.sum(F.when(~F.col("is_forecast"), F.col("deliveries"))).alias("_last"),
    ).where("as_of is not null")
    a = F.col("absorption_units_12mo")
    next_ = F.when(F.col("_next").isNotNull() & (F.col("inventory_units") > 0), F.col("_next") / F.col("inventory_units")).otherwise(F.col("deliveries_12mo_share"))
    ratio = F.when(F.col("_last") > 0, a / F.col("_last")).when(a >= 0, 2.0).when(a < 0, 0.0)
    return g.select(*keys, "as_of", "uc_share", next_.alias("deliveries_next_4q_share"), ratio.alias("absorption_delivery_ratio_4q"), "effective_rent_growth_yoy")


def risk_score(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Supply risk of each market: four dimensions of 25 points, >= 70 PROCEED, >= 40 CAUTION, else PASS. Markets without an
    actual quarter score 0 and are UNKNOWN."""
    m = risk_metrics(panel, keys)
    scores = {name: dimension_score(F.col(c), high, moderate, POINTS, invert) for name, c, high, moderate, invert in DIMENSIONS}
    out = m.select(*keys, "as_of", *(s.alias(f"{name}_score") for name, s in scores.items()))
    total = F.expr(" + ".join(f"{name}_score" for name in scores))
    verdict = F.when(total >= PROCEED, "PROCEED").when(total >= CAUTION, "CAUTION").otherwise("PASS")
    out = out.withColumn("score", total).withColumn("verdict", verdict)
    every = panel.select(*keys).distinct().join(out, keys, "left")
    return every.withColumn("score", F.coalesce("score", F.lit(0))).withColumn("verdict", F.coalesce("verdict", F.lit("UNKNOWN")))


def split_actual(panel: DataFrame, keys: list[str], gaps: int = 2, least: int = 40) -> DataFrame:
    """A panel's rows with `usable`: the market has at least `least` actual quarters and misses at most `gaps` between
    its first and its last one."""
    w = Window.partitionBy(*keys)
    actual = F.when(~F.col("is_forecast"), F.col("q"))
    n = F.count(actual).over(w)
    missing = F.max(actual).over(w) - F.min(actual).over(w) + 1 - n
    return panel.withColumn("usable", F.coalesce((n >= least) & (missing <= gaps), F.lit(False)))


def quarter_panel(df: DataFrame, at: str, tier: str, size: str) -> DataFrame:
    """A panel of any dated table: rows as inventory, mean size as rent, by quarter and tier."""
    q = (F.year(at) * 4 + F.quarter(at) - 1).cast("int")
    return df.groupBy(tier, q.alias("q")).agg(F.count("*").alias("inventory"), F.round(F.avg(size), 4).alias("rent"))
