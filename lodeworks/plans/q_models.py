"""Queries of the forecasting operators: monthly orders by priority stand for the quarters of a submarket's tiers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeworks.operators import arima, diagnostics, forecast

from .q_relational import t
from .q_scalar import _PANEL, order_panel
from .registry import query

KEY = "o_orderpriority"
MONTHS = """(SELECT o_orderpriority, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS m, count(*) AS n, avg(o_totalprice) AS price, CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS share
FROM orders GROUP BY 1, 2)"""
#: A small search of orders for backtests, which repeat it at every origin.
FEW = (1, 1, ((0, 0),))


def months(spark, sf_dir):
    m = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("int")
    share = F.count(F.when(F.col("o_orderstatus") == "F", 1)).cast("double") / F.count("*")
    return t(spark, sf_dir, "orders").groupBy(KEY, m.alias("m")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("price"), share.alias("share"))


def panel(spark, sf_dir):
    """Months as a panel: growth of the mean price over the month before, the rest from counts."""
    w = Window.partitionBy(KEY).orderBy("m")
    n = F.col("n")
    p = months(spark, sf_dir).select(
        KEY, "m", (F.col("price") / F.lag("price").over(w) - 1).alias("effective_rent_growth_yoy"), (F.col("share") / 4).alias("vacancy_rate"), (n % 40).alias("deliveries_12mo"),
        (n % 50 - 10).alias("absorption_units_12mo"), (n % 30).alias("under_construction"), (n * 10).alias("inventory_units"),
    )
    return forecast.features(p, [KEY], "m")


_W = "(PARTITION BY o_orderpriority ORDER BY q"
_SHARES = ", ".join(f"coalesce({c} / nullif(inventory_units, 0), 0) AS {n}" for c, n in (("deliveries_12mo", "del"), ("absorption_units_12mo", "ab"), ("under_construction", "uc")))


@query("pan04_features", f"""WITH p AS ({_PANEL}), f AS (SELECT o_orderpriority, q, {_SHARES}, last_value(effective_rent_growth_yoy IGNORE NULLS) OVER {_W} ROWS UNBOUNDED PRECEDING) AS g, last_value(vacancy_rate IGNORE NULLS) OVER {_W} ROWS UNBOUNDED PRECEDING) AS v FROM p)
SELECT o_orderpriority, q, round(del, 6) AS deliveries_pct_inventory, round(ab, 6) AS absorption_pct_inventory, round(g, 6) AS rent_growth_yoy, round(v, 6) AS vacancy_rate, round(lag(v) OVER {_W}), 6) AS vacancy_rate_lag1, round(lag(del) OVER {_W}), 6) AS deliveries_pct_inventory_lag1,
round(lag(ab) OVER {_W}), 6) AS absorption_pct_inventory_lag1, round(lag(g) OVER {_W}), 6) AS rent_growth_yoy_lag1, round(lag(uc) OVER {_W}), 6) AS uc_pct_inventory_lag1 FROM f""")
def pan04b(spark, sf_dir):
    """PAN-04: features of a panel with gaps in inventory and vacancy."""
    f = forecast.features(order_panel(spark, sf_dir), [KEY], "q")
    return f.select(KEY, "q", *(F.round(c, 6).alias(c) for c in ("deliveries_pct_inventory", "absorption_pct_inventory", "rent_growth_yoy", "vacancy_rate", *forecast.FEATURES)))


_E = f"""s AS (SELECT {KEY}, m, CAST(n AS DOUBLE) - avg(n) OVER (PARTITION BY {KEY}) AS e, count(*) OVER (PARTITION BY {KEY}) AS t, row_number() OVER (PARTITION BY {KEY} ORDER BY m) AS i FROM {MONTHS}),
g AS (SELECT a.{KEY}, any_value(a.t) AS t, CAST(a.i - b.i AS INT) AS k, sum(a.e * b.e) AS v FROM s a JOIN s b ON a.{KEY} = b.{KEY} AND a.i >= b.i GROUP BY 1, 3), own AS (SELECT {KEY}, v AS v0 FROM g WHERE k = 0)"""


def tail_sql(x: str, df: int) -> str:
    """Tail of chi-square in DuckDB: a finite sum for even degrees; a series for odd ones."""
    z = f"({x} / 2)"
    if df % 2 == 0:
        return f"exp(-{z}) * list_sum(list_transform(range(0, {df // 2}), lambda j: pow({z}, j) / gamma(j + 1)))"
    return f"greatest(0, 1 - list_sum(list_transform(range(0, 400), lambda j: exp((j + {df / 2}) * ln(greatest({z}, 1e-300)) - lgamma(j + {df / 2 + 1}) - {z}))))"


@query("mod16_ljung_box", f"""WITH {_E}, q AS (SELECT {KEY}, l.lag, any_value(t) * (any_value(t) + 2) * sum(pow(v / v0, 2) / (t - k)) AS q FROM g JOIN own USING ({KEY}), (VALUES (4), (8), (12)) l(lag) WHERE k BETWEEN 1 AND l.lag AND l.lag < t GROUP BY 1, 2)
SELECT {KEY}, CAST(lag AS BIGINT) AS lag, round(q, 4) AS statistic, round(CASE lag WHEN 4 THEN {tail_sql("q", 4)} WHEN 8 THEN {tail_sql("q", 8)} ELSE {tail_sql("q", 12)} END, 6) AS p FROM q""")
def mod16b(spark, sf_dir):
    """MOD-16: autocorrelation of the series."""
    return diagnostics.ljung_box(months(spark, sf_dir), [KEY], "m", "n").select(KEY, "lag", F.round("statistic", 4).alias("statistic"), F.round("p", 6).alias("p"))


@query("mod16_kpss", f"""WITH {_E}, f AS (SELECT {KEY}, t, v0, CAST(floor(pow(t, CAST(2 AS DOUBLE) / 9)) AS INT) AS few FROM own JOIN (SELECT DISTINCT {KEY}, t FROM s) USING ({KEY})),
w AS (SELECT f.{KEY}, any_value(f.t) AS t, any_value(v0) AS v0, any_value(v0) / any_value(f.t) + sum(v / (CAST(f.t AS DOUBLE) / 2)) AS s0, sum(k * v / (CAST(f.t AS DOUBLE) / 2)) AS s1 FROM f JOIN g ON g.{KEY} = f.{KEY} AND k BETWEEN 1 AND few GROUP BY 1),
l AS (SELECT *, CAST(greatest(0, least(floor(1.1447 * cbrt(pow(s1 / s0, 2)) * cbrt(CAST(t AS DOUBLE))), t - 1)) AS BIGINT) AS lags FROM w),
r AS (SELECT l.{KEY}, any_value(lags) AS lags, (any_value(v0) + 2 * coalesce(sum(v * (1 - CAST(k AS DOUBLE) / (lags + 1))), 0)) / any_value(l.t) AS r, any_value(l.t) AS t FROM l LEFT JOIN g ON g.{KEY} = l.{KEY} AND k BETWEEN 1 AND lags GROUP BY 1),
c AS (SELECT {KEY}, sum(pow(c, 2)) AS c FROM (SELECT {KEY}, sum(e) OVER (PARTITION BY {KEY} ORDER BY i) AS c FROM s) GROUP BY 1), x AS (SELECT {KEY}, c / pow(t, 2) / r AS x, lags FROM r JOIN c USING ({KEY}))
SELECT {KEY}, round(x, 6) AS statistic, round(CASE WHEN x <= 0.347 THEN 0.1 WHEN x <= 0.463 THEN 0.1 - (x - 0.347) / 0.116 * 0.05 WHEN x <= 0.574 THEN 0.05 - (x - 0.463) / 0.111 * 0.025 WHEN x <= 0.739 THEN 0.025 - (x - 0.574) / 0.165 * 0.015 ELSE 0.01 END, 6) AS p, lags FROM x""")
def mod16c(spark, sf_dir):
    """MOD-16: stationarity."""
    return diagnostics.kpss(months(spark, sf_dir), [KEY], "m", "n").select(KEY, F.round("statistic", 6).alias("statistic"), F.round("p", 6).alias("p"), "lags")


@query("mod16_unit_root")
def mod16d(spark, sf_dir):
    """MOD-16: unit root, with the lags chosen by AIC."""
    return diagnostics.adf(months(spark, sf_dir), [KEY], "m", "price").select(KEY, F.round("statistic", 6).alias("statistic"), F.round("p", 6).alias("p"), "lags", "rows")


@query("mod16_granger")
def mod16e(spark, sf_dir):
    """MOD-16: does the share of finished orders help to predict the mean price."""
    return diagnostics.granger(months(spark, sf_dir), [KEY], "m", "price", "share").select(KEY, "lag", F.round("statistic", 6).alias("statistic"), F.round("p", 6).alias("p"))


def simple_backtest(spark, sf_dir):
    """Persistence, the value a year ago, and the mean of the last four months."""
    w = Window.partitionBy(KEY).orderBy("m")
    s = months(spark, sf_dir).withColumn("n", F.col("n").cast("double"))
    s = s.withColumns({"Naive": F.lag("n").over(w), "Year": F.lag("n", 12).over(w), "Four": F.avg("n").over(w.rowsBetween(-4, -1))}).where("Year IS NOT NULL")
    bt = s.unpivot([KEY, "m", "n"], ["Naive", "Year", "Four"], "model", "predicted").withColumnRenamed("n", "actual")
    return bt.withColumn("lo", F.col("predicted") - 5).withColumn("hi", F.col("predicted") + 5)


_BT = f"""bt AS (SELECT {KEY}, m, x.model, a.n - x.p AS e, a.n - p1 AS b FROM (SELECT *, CAST(lag(n) OVER w AS DOUBLE) AS p1, CAST(lag(n, 12) OVER w AS DOUBLE) AS p12, avg(n) OVER (PARTITION BY {KEY} ORDER BY m ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS p4
FROM {MONTHS} WINDOW w AS (PARTITION BY {KEY} ORDER BY m)) a, LATERAL (VALUES ('Naive', p1), ('Year', p12), ('Four', p4)) x(model, p) WHERE p12 IS NOT NULL)"""


@query("agg36_diebold_mariano", f"""WITH {_BT}, d AS (SELECT {KEY}, model, count(*) AS n, avg(b * b - e * e) / sqrt(var_samp(b * b - e * e) / count(*)) AS z FROM bt WHERE model <> 'Naive' GROUP BY 1, 2)
SELECT {KEY}, model, n, round(z, 6) AS statistic, round({tail_sql("(z * z)", 1)}, 6) AS p FROM d""")
def agg36b(spark, sf_dir):
    """AGG-36: models against persistence."""
    return diagnostics.diebold_mariano(simple_backtest(spark, sf_dir), [KEY], "m").select(KEY, "model", "n", F.round("statistic", 6).alias("statistic"), F.round("p", 6).alias("p"))


@query("agg37_accuracy", f"""WITH {_BT}, x AS (SELECT *, lag(e) OVER (PARTITION BY {KEY}, model ORDER BY m) AS e1, e - avg(e) OVER (PARTITION BY {KEY}, model) AS c, row_number() OVER (PARTITION BY {KEY}, model ORDER BY m) AS i FROM bt),
a AS (SELECT {KEY}, model, count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(e) AS bias, corr(e, e1) AS acf1, avg(CASE WHEN abs(e) <= 5 THEN 1.0 ELSE 0 END) AS coverage, sum(c * c) AS own FROM x GROUP BY 1, 2),
r AS (SELECT a.{KEY}, a.model, a.i - b.i AS k, sum(a.c * b.c) AS v FROM x a JOIN x b ON a.{KEY} = b.{KEY} AND a.model = b.model AND a.i - b.i BETWEEN 1 AND 5 GROUP BY 1, 2, 3),
q AS (SELECT {KEY}, model, any_value(n) * (any_value(n) + 2) * sum(pow(v / own, 2) / (n - k)) AS q FROM a JOIN r USING ({KEY}, model) GROUP BY 1, 2)
SELECT {KEY}, model, n, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(bias, 4) AS bias, round(acf1, 6) AS acf1, round({tail_sql("q", 5)}, 6) AS ljung_box_p, round(coverage, 4) AS coverage FROM a JOIN q USING ({KEY}, model)""")
def agg37(spark, sf_dir):
    """AGG-37."""
    a = diagnostics.accuracy(simple_backtest(spark, sf_dir), [KEY], "m")
    places = {"rmse": 4, "mae": 4, "bias": 4, "acf1": 6, "ljung_box_p": 6, "coverage": 4}
    return a.select(KEY, "model", "n", *(F.round(c, p).alias(c) for c, p in places.items()))


@query("mod07_arima")
def mod07(spark, sf_dir):
    """MOD-07: the search over orders and seasonal orders, differences by the unit-root test."""
    best = arima.best(arima.search(months(spark, sf_dir), [KEY], "m", "price", 2, 2), [KEY])
    return best.select(KEY, "p", "d", "q", "sp", "sq", F.round("aic", 2).alias("aic"), F.transform("forecast", lambda x: F.round(x, 2)).alias("forecast"))


@query("mod06_naive_backtest", f"""WITH g AS (SELECT {KEY}, m, price / lag(price) OVER (PARTITION BY {KEY} ORDER BY m) - 1 AS y FROM {MONTHS}), s AS (SELECT *, row_number() OVER w - 1 AS i, lag(y) OVER w AS p, y - lag(y) OVER w AS d FROM g WHERE y IS NOT NULL WINDOW w AS (PARTITION BY {KEY} ORDER BY m)),
r AS (SELECT *, lag(y) OVER (PARTITION BY {KEY} ORDER BY m) AS before, lag(y, 2) OVER (PARTITION BY {KEY} ORDER BY m) AS earlier, stddev_samp(d) OVER (PARTITION BY {KEY} ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS sd FROM s)
SELECT {KEY}, m, round(y, 6) AS actual, round(earlier, 6) AS predicted, round(earlier - 1.28 * sd, 6) AS lo, round(earlier + 1.28 * sd, 6) AS hi FROM r WHERE i >= 40""")
def mod06(spark, sf_dir):
    """MOD-06, MOD-12: persistence at every origin. The first month has no growth, so each origin trains on one row less, as the rule has it."""
    bt = forecast.backtest(panel(spark, sf_dir), [KEY], "m", ("Naive",))
    return bt.select(KEY, "m", *(F.round(c, 6).alias(c) for c in ("actual", "predicted", "lo", "hi")))


@query("mod12_panel_backtest")
def mod12b(spark, sf_dir):
    """MOD-06 to MOD-12, WIN-11: six models on the whole panel at all origins."""
    bt = forecast.backtest(panel(spark, sf_dir), [KEY], "m", orders=FEW)
    return bt.select(KEY, "model", "m", *(F.round(c, 6).alias(c) for c in ("actual", "predicted", "lo", "hi")))


@query("mod13_full_fit")
def mod13(spark, sf_dir):
    """MOD-13: every model on all rows, eight periods ahead."""
    return forecast.full_fit(panel(spark, sf_dir), [KEY], "m", orders=FEW).select(KEY, "model", "h", F.round("predicted", 6).alias("predicted"), "n")


_FITS = f"""fits AS (SELECT {KEY}, CASE o_orderstatus WHEN 'P' THEN 'Naive' ELSE o_orderstatus END AS model, CAST(month(o_orderdate) AS INT) AS h, avg(o_totalprice) AS predicted, count(*) AS n, coalesce(var_samp(o_totalprice), 0) * (count(*) - 1) AS ssr FROM orders WHERE month(o_orderdate) <= 8 GROUP BY 1, 2, 3),
acc AS (SELECT {KEY}, CASE o_orderstatus WHEN 'P' THEN 'Naive' ELSE o_orderstatus END AS model, stddev_samp(o_totalprice) AS rmse FROM orders GROUP BY 1, 2),
fa AS (SELECT * FROM fits JOIN acc USING ({KEY}, model) WHERE model <> 'Naive' AND rmse > 0)"""


def status_fits(spark, sf_dir):
    """Orders by status as models: mean prices of the first eight months as forecasts, deviations as backtest errors."""
    o = t(spark, sf_dir, "orders").select(KEY, F.when(F.col("o_orderstatus") == "P", "Naive").otherwise(F.col("o_orderstatus")).alias("model"), F.month("o_orderdate").alias("h"), F.col("o_totalprice").alias("x"))
    fits = o.where("h <= 8").groupBy(KEY, "model", "h").agg(F.avg("x").alias("predicted"), F.count("*").alias("n"), (F.coalesce(F.var_samp("x"), F.lit(0.0)) * (F.count("*") - 1)).alias("ssr"))
    return fits, o.groupBy(KEY, "model").agg(F.stddev_samp("x").alias("rmse"))


@query("mod14_bands", f"""WITH {_FITS}, g AS (SELECT {KEY}, h, sum(predicted / rmse) / sum(1 / rmse) AS v, sqrt(sum(ssr) / sum(n)) AS sd, avg(rmse) AS r FROM fa GROUP BY 1, 2)
SELECT {KEY}, h, round(v, 2) AS predicted, round(v - 1.28 * sd * sqrt(h), 2) AS lo80, round(v + 1.28 * sd * sqrt(h), 2) AS hi80, round(v - 1.96 * sd * sqrt(h), 2) AS lo95, round(v + 1.96 * sd * sqrt(h), 2) AS hi95, round(v - r * sqrt(h), 2) AS bear, round(v + r * sqrt(h), 2) AS bull FROM g""")
def mod14b(spark, sf_dir):
    """MOD-14: weights, pooled bands and scenarios."""
    c = forecast.combined(*status_fits(spark, sf_dir), [KEY])
    return c.select(KEY, "h", *(F.round(x, 2).alias(x) for x in ("predicted", "lo80", "hi80", "lo95", "hi95", "bear", "bull")))


@query("mod15_vendor", f"""WITH {_FITS}, v AS (SELECT {KEY}, CAST(month(o_orderdate) AS INT) AS h, median(o_totalprice) AS vendor FROM orders WHERE month(o_orderdate) <= 6 GROUP BY 1, 2), w AS (SELECT {KEY}, model, avg(predicted) AS mean, avg(vendor) AS vendor, 1 / any_value(rmse) AS i FROM fa JOIN v USING ({KEY}, h) GROUP BY 1, 2),
x AS (SELECT *, i / sum(i) OVER (PARTITION BY {KEY}) AS weight, mean - vendor AS spread FROM w), y AS (SELECT {KEY}, model, weight, mean, spread, weight * spread AS contribution FROM x UNION ALL SELECT {KEY}, 'Ensemble', sum(weight), sum(weight * mean), sum(weight * spread), sum(weight * spread) FROM x GROUP BY 1)
SELECT {KEY}, model, round(weight, 6) AS weight, round(mean, 2) AS mean, round(spread, 2) AS spread, round(contribution, 2) AS contribution, CASE WHEN spread > 0 THEN 'BULL' ELSE 'BEAR' END AS direction FROM y""")
def mod15(spark, sf_dir):
    """MOD-15, AGG-41, JOIN-26: each model's pull from a vendor's forecast, for which monthly medians stand."""
    vendor = t(spark, sf_dir, "orders").where(F.month("o_orderdate") <= 6).groupBy(KEY, F.month("o_orderdate").alias("h")).agg(F.percentile("o_totalprice", F.lit(0.5)).alias("vendor"))
    v = forecast.against_vendor(*status_fits(spark, sf_dir), vendor, [KEY])
    return v.select(KEY, "model", F.round("weight", 6).alias("weight"), *(F.round(c, 2).alias(c) for c in ("mean", "spread", "contribution")), "direction")


@query("mod18_document")
def mod18(spark, sf_dir):
    """MOD-18, MOD-17: accuracy, weights, confidence and regime of every market as JSON."""
    p = panel(spark, sf_dir)
    return forecast.document(forecast.backtest(p, [KEY], "m", ("Naive", "BVAR", "Ridge", "ElasticNet")), p, [KEY], "m")
