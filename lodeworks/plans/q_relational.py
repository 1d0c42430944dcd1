"""Queries of aggregations, joins, windows and reshaping over the driver's tables. Every docstring names the inventory
entry that the query exercises."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators import aggregates as agg
from lodeworks.operators import joins, reshape, spatial
from lodeworks.operators import windows as win

from .registry import query


def t(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: str):
    return F.to_date(c)


def quarters(spark, sf_dir: str) -> DataFrame:
    """Quarterly orders by priority: q (ordinal), n, total. A few rows a priority, whatever the number of orders."""
    q = (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).cast("int")
    return t(spark, sf_dir, "orders").groupBy("o_orderpriority", q.alias("q")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


QUARTERS = """(SELECT o_orderpriority, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INT) AS q, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1, 2)"""


@query("agg01_universe_summary", """SELECT count(*) AS n, coalesce(round(sum(c_acctbal), 2), 0) AS total, count(*) FILTER (n_regionkey = 1) AS n_inside,
coalesce(round(sum(c_acctbal) FILTER (n_regionkey = 1), 2), 0) AS total_inside FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def agg01(spark, sf_dir):
    """AGG-01."""
    df = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.universe_summary(df, "c_acctbal", F.col("n_regionkey") == 1).select("n", F.round("total", 2).alias("total"), "n_inside", F.round("total_inside", 2).alias("total_inside"))


@query("agg02_quartiles_by_group", """SELECT l_returnflag, count(l_extendedprice) AS n, CAST(trunc(quantile_cont(l_extendedprice, 0.25)) AS BIGINT) AS p25,
CAST(trunc(quantile_cont(l_extendedprice, 0.5)) AS BIGINT) AS p50, CAST(trunc(quantile_cont(l_extendedprice, 0.75)) AS BIGINT) AS p75,
round(quantile_cont(l_extendedprice / nullif(l_quantity, 0), 0.5), 2) AS median_per FROM lineitem GROUP BY 1""")
def agg02(spark, sf_dir):
    """AGG-02: quartiles interpolated, then cut."""
    return agg.quartiles(t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")


@query("agg03_concentration_topn", """SELECT CAST(l_suppkey AS VARCHAR) AS owner, round(sum(l_quantity), 2) AS total, count(*) AS n FROM lineitem WHERE l_suppkey IS NOT NULL
GROUP BY l_suppkey ORDER BY total DESC, n DESC, owner LIMIT 10""")
def agg03(spark, sf_dir):
    """AGG-03, SORT-04."""
    df = t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("owner"), "l_quantity")
    return agg.concentration(df, "owner", F.col("l_quantity"), 10).withColumn("total", F.round("total", 2))


@query("agg05_coverage_by_source", """SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def agg05(spark, sf_dir):
    """AGG-05: half-open range, pushed to the scan."""
    df = t(spark, sf_dir, "events")
    return df.where((F.col("ts") >= F.to_timestamp(F.lit("2024-01-05"))) & (F.col("ts") < F.to_timestamp(F.lit("2024-01-20")))).groupBy("event_type").agg(F.count("*").alias("n"))


@query("agg06_global_median", """SELECT count(*) AS n, quantile_cont(o_totalprice, 0.5) AS median, round(quantile_cont(o_totalprice / nullif(o_custkey, 0), 0.5), 4) AS median_per
FROM orders WHERE o_orderstatus = 'F'""")
def agg06(spark, sf_dir):
    """AGG-06."""
    return agg.global_median(t(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), "o_totalprice", "o_custkey")


@query("agg07_left_join_group_minmax", """SELECT coalesce(c_mktsegment, 'none') AS segment, count(*) AS n, min(o_totalprice) AS least, max(o_totalprice) AS most
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 GROUP BY 1 ORDER BY n DESC, segment LIMIT 20""")
def agg07(spark, sf_dir):
    """AGG-07, JOIN-05: columns are pruned before the join."""
    c = t(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    df = t(spark, sf_dir, "orders").select("o_custkey", "o_totalprice").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    g = df.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("segment")).agg(F.count("*").alias("n"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))
    return g.orderBy(F.desc("n"), "segment").limit(20)


@query("agg08_active_count", "SELECT count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def agg08(spark, sf_dir):
    """AGG-04, AGG-08: filtered counts."""
    return t(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).agg(F.count("*").alias("n"))


@query("agg09_churn", """SELECT count(*) FILTER (f >= DATE '2024-01-16') AS n_new, count(*) FILTER (l < DATE '2024-01-16') AS n_gone
FROM (SELECT user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM events GROUP BY 1)""")
def agg09(spark, sf_dir):
    """AGG-09: new and gone since a date."""
    u = t(spark, sf_dir, "events").groupBy("user_id").agg(F.min(day("ts")).alias("f"), F.max(day("ts")).alias("l"))
    cut = F.lit("2024-01-16").cast("date")
    return u.agg(F.count_if(F.col("f") >= cut).alias("n_new"), F.count_if(F.col("l") < cut).alias("n_gone"))


@query("agg10_divergence", """SELECT round(a - b, 4) AS diff, round(100 * (a - b) / b, 4) AS pct, n < 10 AS small FROM
(SELECT quantile_cont(o_totalprice, 0.5) AS a, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'), (SELECT quantile_cont(o_totalprice, 0.5) AS b FROM orders)""")
def agg10(spark, sf_dir):
    """AGG-10: a local median against the index."""
    return agg.divergence(t(spark, sf_dir, "orders"), F.col("o_orderpriority") == "1-URGENT", "o_totalprice")


@query("agg12_plan_summary", """SELECT coalesce(nullif(trim(p_brand), ''), 'Unknown') AS plan_code, count(*) AS units, round(avg(p_size), 0) AS sqft, round(avg(p_retailprice), 2) AS avg_rent,
min(p_type) AS bed_type FROM part GROUP BY 1""")
def agg12(spark, sf_dir):
    """AGG-12."""
    return agg.plan_summary(t(spark, sf_dir, "part"), "p_brand", "p_size", "p_retailprice", "p_type")


@query("agg13_plan_summary_positive", """SELECT coalesce(nullif(trim(p_brand), ''), 'Unknown') AS plan_code, count(*) AS units, round(avg(CASE WHEN p_size > 0 THEN p_size END), 0) AS sqft,
round(avg(CASE WHEN p_retailprice > 0 THEN p_retailprice END), 2) AS avg_rent FROM part GROUP BY 1""")
def agg13(spark, sf_dir):
    """AGG-13, AGG-14."""
    return agg.plan_summary(t(spark, sf_dir, "part"), "p_brand", "p_size", "p_retailprice", positive=True)


@query("agg16_occupied_summary", """SELECT o_orderpriority, o_orderstatus, count(*) AS units, count(*) FILTER (o_totalprice > 100000) AS occupied,
round(100.0 * count(*) FILTER (o_totalprice > 100000) / count(*), 1) AS occupancy_pct, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS rank
FROM orders GROUP BY 1, 2""")
def agg16(spark, sf_dir):
    """AGG-15, AGG-16, AGG-17, SORT-03."""
    return agg.occupied_summary(t(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], F.col("o_totalprice") > 100000, {"O": 0, "P": 1, "F": 2})


@query("agg18_kpi_row", """SELECT count(*) AS units, round(100.0 * count(*) FILTER (o_orderstatus = 'O') / count(*), 2) AS occupancy_pct, round(avg(c), 2) AS avg_contract, min(c) AS min_contract,
max(c) AS max_contract, round(100.0 * (sum(m) - sum(c)) / sum(m), 2) AS loss_to_lease_pct FROM (SELECT o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS c,
CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 1.1 + 5 END AS m FROM orders)""")
def agg18(spark, sf_dir):
    """AGG-18."""
    return agg.kpi_row(t(spark, sf_dir, "orders").withColumn("market", F.col("o_totalprice") * F.lit(1.1) + 5), F.col("o_orderstatus") == "O", "o_totalprice", "market")


@query("agg19_signature_rollup", """SELECT beds, baths, sqft, count(*) AS available, min(CASE WHEN rent > 0 THEN rent END) AS rent_min, max(CASE WHEN rent > 0 THEN rent END) AS rent_max,
CASE WHEN min(p_brand) = max(p_brand) THEN min(p_brand) ELSE concat(beds, 'BR/', CAST(baths AS INT), 'BA ', CAST(round(sqft, 0) AS BIGINT), ' SF') END AS plan
FROM (SELECT p_size % 4 AS beds, CAST(1 + p_size % 2 AS DOUBLE) AS baths, CAST(500 + p_size * 10 AS DOUBLE) AS sqft, p_retailprice - 1000 AS rent, p_brand FROM part) GROUP BY 1, 2, 3""")
def agg19(spark, sf_dir):
    """AGG-19, AGG-20, AGG-46."""
    units = t(spark, sf_dir, "part").select((F.col("p_size") % 4).alias("beds"), (1 + F.col("p_size") % 2).cast("double").alias("baths"), (500 + F.col("p_size") * 10).cast("double").alias("sqft"), (F.col("p_retailprice") - 1000).alias("rent"), "p_brand")
    return agg.signature_rollup(units, "beds", "baths", "sqft", "rent", "p_brand")


@query("agg21_partial_merge", """SELECT min_by(name, p_partkey) AS name, min_by(beds, p_partkey) AS beds, min_by(baths, p_partkey) FILTER (baths <> 0) AS baths, min_by(sqft, p_partkey) FILTER (sqft <> 0) AS sqft,
max(available) AS available, min(rent_min) FILTER (rent_min > 0) AS rent_min, max(rent_max) AS rent_max, min(p_partkey) AS p_partkey FROM
(SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS name, p_size % 4 AS beds, CAST(p_size % 3 AS DOUBLE) AS baths, CAST(p_size % 7 AS DOUBLE) AS sqft, p_size AS available,
p_retailprice - 1200 AS rent_min, p_retailprice AS rent_max FROM part)
GROUP BY CASE WHEN trim(name) <> '' THEN concat_ws('|', lower(name), CAST(beds AS VARCHAR), CAST(sqft AS VARCHAR)) ELSE concat_ws('|', CAST(beds AS VARCHAR), CAST(baths AS VARCHAR), CAST(sqft AS VARCHAR), CAST(rent_min AS VARCHAR)) END""")
def agg21(spark, sf_dir):
    """AGG-21."""
    p = t(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")).alias("name"), (F.col("p_size") % 4).alias("beds"), (F.col("p_size") % 3).cast("double").alias("baths"),
        (F.col("p_size") % 7).cast("double").alias("sqft"), F.col("p_size").alias("available"), (F.col("p_retailprice") - 1200).alias("rent_min"), F.col("p_retailprice").alias("rent_max"),
    )
    return agg.partial_merge(p, "p_partkey")


@query("agg22_unit_type_rollup", """SELECT p_brand, beds, units, round(face, 2) AS face_rent, round(face * (12 - free) / 12, 2) AS effective_rent, round(face * (12 - free) / 12 / nullif(s, 0), 4) AS effective_psf,
CASE WHEN max(total) OVER (PARTITION BY p_brand) > 0 THEN round(100.0 * sum(units) OVER (PARTITION BY p_brand) / max(total) OVER (PARTITION BY p_brand), 2) END AS vacancy_pct FROM
(SELECT p_brand, p_size % 4 AS beds, count(*) AS units, avg(CASE WHEN p_retailprice > 0 THEN p_retailprice END) AS face, avg(CASE WHEN p_size > 0 THEN p_size END) AS s, max(CAST(1.3 AS DOUBLE)) AS free, max(250) AS total FROM part GROUP BY 1, 2)""")
def agg22(spark, sf_dir):
    """AGG-22."""
    p = t(spark, sf_dir, "part").select("p_brand", (F.col("p_size") % 4).alias("beds"), "p_retailprice", "p_size", F.lit(1.3).alias("free"), F.lit(250).alias("total"))
    return agg.unit_type_rollup(p, "p_brand", "beds", "p_retailprice", "p_size", "free", "total")


@query("agg23_weighted_avg", """SELECT l_returnflag, round(sum(l_quantity * l_extendedprice) / greatest(sum(l_quantity), 1), 4) AS price FROM lineitem GROUP BY 1""")
def agg23(spark, sf_dir):
    """AGG-23."""
    return t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(agg.weighted_or_one("l_extendedprice", "l_quantity"), 4).alias("price"))


@query("agg24_zero_fill", """SELECT n_name, count(s_suppkey) AS units, coalesce(round(min(s_acctbal), 2), 0) AS least FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000 GROUP BY 1""")
def agg24(spark, sf_dir):
    """AGG-24: groups without members are zero-filled."""
    s = t(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("units"), F.min("s_acctbal").alias("least"))
    df = t(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return df.select("n_name", F.coalesce("units", F.lit(0)).alias("units"), F.coalesce(F.round("least", 2), F.lit(0.0)).alias("least"))


@query("agg26_weighted_panel", f"""SELECT q, CAST(sum(n) AS BIGINT) AS n, round(sum(total * n) / nullif(sum(n), 0), 2) AS mean_total, count(*) AS tiers FROM {QUARTERS} GROUP BY 1""")
def agg26(spark, sf_dir):
    """AGG-26, PAN-03: sums of counts, weighted means of rates."""
    return quarters(spark, sf_dir).groupBy("q").agg(F.sum("n").alias("n"), F.round(agg.weighted("total", "n"), 2).alias("mean_total"), F.count("*").alias("tiers"))


@query("agg27_round_then_sum", "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(sum(round(o_totalprice, 0)) AS BIGINT) AS total FROM orders GROUP BY 1")
def agg27(spark, sf_dir):
    """AGG-27: rounded row by row, then summed."""
    return t(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(F.round("o_totalprice", 0)).cast("bigint").alias("total"))


@query("agg28_flows_net_topn", """WITH f AS (SELECT n_name, o_orderstatus, 1 AS one, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
i AS (SELECT n_name, sum(one) AS a, sum(v) AS b FROM f WHERE o_orderstatus = 'F' GROUP BY 1), o AS (SELECT n_name, sum(one) AS a, sum(v) AS b FROM f WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT n_name, CAST(coalesce(i.a, 0) AS BIGINT) AS in_one, round(coalesce(i.b, 0), 2) AS in_v, CAST(coalesce(o.a, 0) AS BIGINT) AS out_one, round(coalesce(o.b, 0), 2) AS out_v,
CAST(coalesce(i.a, 0) - coalesce(o.a, 0) AS BIGINT) AS net_one, round(coalesce(i.b, 0) - coalesce(o.b, 0), 2) AS net_v FROM i FULL JOIN o USING (n_name) ORDER BY in_one DESC, n_name LIMIT 15""")
def agg28(spark, sf_dir):
    """AGG-28, JOIN-12, JOIN-13, SORT-05: net flows over all rows, then the top."""
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    f = t(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.lit(1).alias("one"), F.col("o_totalprice").alias("v")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    net = agg.flows_net(f.where("o_orderstatus = 'F'"), f.where("o_orderstatus = 'O'"), "n_name", ["one", "v"], 15)
    return net.select("n_name", "in_one", F.round("in_v", 2).alias("in_v"), "out_one", F.round("out_v", 2).alias("out_v"), "net_one", F.round("net_v", 2).alias("net_v"))


@query("agg29_field_coverage", """SELECT o_orderpriority, round(count(*) FILTER (o_totalprice > 1000) / count(*), 4) AS priced, round(count(*) FILTER (o_orderstatus <> '') / count(*), 4) AS stated FROM orders GROUP BY 1""")
def agg29(spark, sf_dir):
    """AGG-29."""
    return t(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.round(F.count_if(F.col("o_totalprice") > 1000) / F.count("*"), 4).alias("priced"), F.round(F.count_if(F.col("o_orderstatus") != "") / F.count("*"), 4).alias("stated"))


@query("agg30_distinct_lists", """SELECT n_regionkey, count(*) AS n, array_to_string(list_sort(list_distinct(list(n_name))), ',') AS names FROM nation GROUP BY 1""")
def agg30(spark, sf_dir):
    """AGG-30, AGG-47."""
    return t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("n_name")), ",").alias("names"))


@query("agg31_distribution_pct", "SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM events GROUP BY 1")
def agg31(spark, sf_dir):
    """AGG-31."""
    return agg.distribution(t(spark, sf_dir, "events"), "event_type")


@query("agg32_rebinned", """SELECT CASE WHEN p_size < 10 THEN 'a' WHEN p_size < 30 THEN 'b' ELSE 'c' END AS bin, CAST(sum(n) AS BIGINT) AS n FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1) GROUP BY 1""")
def agg32(spark, sf_dir):
    """AGG-32, AGG-33: bins of bins."""
    bins = t(spark, sf_dir, "part").groupBy("p_size").agg(F.count("*").alias("n"))
    return bins.groupBy(F.when(F.col("p_size") < 10, "a").when(F.col("p_size") < 30, "b").otherwise("c").alias("bin")).agg(F.sum("n").alias("n"))


@query("agg34_totals_top_share", """WITH g AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS kinds,
round((SELECT sum(n) FROM (SELECT n FROM g ORDER BY n DESC, c_nationkey LIMIT 5)) / sum(n), 4) AS top5 FROM g""")
def agg34(spark, sf_dir):
    """AGG-34: the share of the five largest."""
    g = t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    top = g.orderBy(F.desc("n"), "c_nationkey").limit(5).agg(F.sum("n").alias("t"))
    one = g.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    return one.crossJoin(F.broadcast(top)).select("total", "kinds", F.round(F.col("t") / F.col("total"), 4).alias("top5"))  # one row each


@query("agg35_affordability", """SELECT c_custkey, round(1000 * 12 / CAST(0.3 AS DOUBLE), 4) AS required, round(c_acctbal * 7 / (1000 * 12 / CAST(0.3 AS DOUBLE)), 4) AS ratio, c_acctbal * 7 >= 1000 * 12 / CAST(0.3 AS DOUBLE) AS affordable FROM customer""")
def agg35(spark, sf_dir):
    """AGG-35, FN-55."""
    a = agg.affordability(F.lit(1000.0), F.col("c_acctbal") * 7)
    return t(spark, sf_dir, "customer").select("c_custkey", a.alias("a")).select("c_custkey", F.round("a.required", 4).alias("required"), "a.ratio", "a.affordable")


@query("agg36_error_metrics", f"""SELECT o_orderpriority, count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(quantile_cont(abs(e), 0.5), 4) AS med_ae, round(max(abs(e)), 4) AS max_ae,
round(avg(e), 4) AS bias FROM (SELECT o_orderpriority, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY q) AS e FROM {QUARTERS}) WHERE e IS NOT NULL GROUP BY 1""")
def agg36(spark, sf_dir):
    """AGG-36, MOD-06: persistence as the forecast."""
    w = Window.partitionBy("o_orderpriority").orderBy("q")
    return agg.error_metrics(quarters(spark, sf_dir).withColumn("p", F.lag("n").over(w)), ["o_orderpriority"], "n", "p")


@query("agg38_inverse_weights", f"""SELECT o_orderpriority, round((1 / r) / sum(1 / r) OVER (), 6) AS weight FROM (SELECT o_orderpriority, round(sqrt(avg(e * e)), 4) AS r FROM
(SELECT o_orderpriority, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY q) AS e FROM {QUARTERS}) WHERE e IS NOT NULL GROUP BY 1) WHERE o_orderpriority <> '5-LOW' AND r > 0""")
def agg38(spark, sf_dir):
    """AGG-38, SORT-07."""
    return agg.inverse_weights(agg36(spark, sf_dir), "rmse", "o_orderpriority", ("5-LOW",)).select("o_orderpriority", "weight")


@query("agg39_iqr_outliers", """WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT o_orderpriority, round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, count(*) FILTER (o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS n
FROM orders JOIN q USING (o_orderpriority) GROUP BY 1""")
def agg39(spark, sf_dir):
    """AGG-39: quartile fences."""
    return agg.iqr_outliers(t(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice")


@query("agg39_descriptives", """SELECT o_orderpriority, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS min,
round(max(o_totalprice), 4) AS max, round(skewness(o_totalprice), 4) AS skew, round(kurtosis(o_totalprice), 4) AS kurt FROM orders GROUP BY 1""")
def agg39b(spark, sf_dir):
    """AGG-39: bias-corrected moments."""
    return agg.descriptives(t(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")


@query("agg40_group_of_four", f"""SELECT o_orderpriority, CAST(floor(i / 4) AS BIGINT) AS year, round(avg(n), 4) AS n FROM (SELECT o_orderpriority, n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY q) - 1 AS i FROM {QUARTERS}) GROUP BY 1, 2""")
def agg40(spark, sf_dir):
    """AGG-40: annual means of quarterly rows."""
    i = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("q")) - 1
    return quarters(spark, sf_dir).withColumn("i", i).groupBy("o_orderpriority", F.floor(F.col("i") / 4).alias("year")).agg(F.round(F.avg("n"), 4).alias("n"))


@query("agg42_worst_status", """SELECT o_custkey, CASE max(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END) WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus FROM orders GROUP BY 1""")
def agg42(spark, sf_dir):
    """AGG-42."""
    return agg.worst_of(t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", {"F": 0, "O": 1, "P": 2})


@query("agg45_charge_pivot", """SELECT l_orderkey, coalesce(round(sum(l_extendedprice) FILTER (l_returnflag = 'A'), 2), 0) AS rent, coalesce(round(sum(l_extendedprice) FILTER (l_returnflag = 'N'), 2), 0) AS pet,
coalesce(round(sum(l_extendedprice) FILTER (l_returnflag NOT IN ('A', 'N')), 2), 0) AS other FROM lineitem GROUP BY 1""")
def agg45(spark, sf_dir):
    """AGG-45, FN-33: the first rule takes a line."""
    return agg.charge_pivot(t(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice"), "l_orderkey", "l_returnflag", "l_extendedprice", [("rent", "^a$"), ("pet", "^n$")])


# ------------------------------------------------------------------ joins


@query("join03_last_wins", """SELECT n_name, s_suppkey FROM nation LEFT JOIN (SELECT s_nationkey, max(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey""")
def join03(spark, sf_dir):
    """JOIN-03, JOIN-21, JOIN-23, JOIN-24: lookup in which the last duplicate wins."""
    s = joins.last_wins(t(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey"), ["s_nationkey"], "s_suppkey")
    return t(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_name", "s_suppkey")


@query("join04_band_first_match", """SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY s_suppkey) AS n FROM customer JOIN supplier
ON abs(c_acctbal - s_acctbal) < 25) WHERE n = 1""")
def join04(spark, sf_dir):
    """JOIN-02, JOIN-04, ER-08: band join by grid cells, first match in register order."""
    c, s = t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), t(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return joins.band_first(c, s, [("c_acctbal", "s_acctbal")], 25.0, "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey")


@query("join02_box_join", """SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND a.label = b.label AND abs(a.embedding[1] - b.embedding[1]) < 0.02 AND abs(a.embedding[2] - b.embedding[2]) < 0.02""")
def join02(spark, sf_dir):
    """JOIN-01, JOIN-02: a box of two axes with an equal key."""
    e = t(spark, sf_dir, "embeddings").select("vec_id", "label", F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"))
    a, b = (e.select(*(F.col(c).alias(f"{k}{c}") for c in e.columns)) for k in "ab")
    return joins.band_join(a, b, [("ax", "bx"), ("ay", "by")], 0.02, [("alabel", "blabel")]).where("avec_id < bvec_id").select(F.col("avec_id").alias("a"), F.col("bvec_id").alias("b"))


@query("join06_semi_delete", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def join06(spark, sf_dir):
    """JOIN-06, JOIN-27, SNK-03: rows of a set are deleted by an anti join."""
    c = t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("o_orderkey")


@query("join07_year_earlier", """WITH m AS (SELECT last_day(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1) SELECT a.month, a.n, b.n AS before, round(a.n / b.n - 1, 4) AS yoy
FROM m a LEFT JOIN m b ON b.month = last_day(a.month - INTERVAL 12 MONTH)""")
def join07(spark, sf_dir):
    """JOIN-07, WIN-23."""
    m = t(spark, sf_dir, "orders").groupBy(F.last_day("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return joins.year_earlier(m, "month", "n", [])


@query("join08_tiers", f"""SELECT a.q, a.n AS subject, b.n AS high, c.n AS mid, round(a.total - b.total, 2) AS gap FROM {QUARTERS} a LEFT JOIN {QUARTERS} b ON a.q = b.q AND b.o_orderpriority = '1-URGENT'
LEFT JOIN {QUARTERS} c ON a.q = c.q AND c.o_orderpriority = '3-MEDIUM' WHERE a.o_orderpriority = '5-LOW'""")
def join08(spark, sf_dir):
    """JOIN-08, JOIN-09, JOIN-10, JOIN-26, PAN-02, MOD-19: one pivoted pass instead of a join a tier."""
    tier = lambda p, c: F.max(F.when(F.col("o_orderpriority") == p, F.col(c)))
    g = quarters(spark, sf_dir).groupBy("q").agg(tier("5-LOW", "n").alias("subject"), tier("1-URGENT", "n").alias("high"), tier("3-MEDIUM", "n").alias("mid"), F.round(tier("5-LOW", "total") - tier("1-URGENT", "total"), 2).alias("gap"))
    return g.where("subject is not null")


@query("join11_series_ops", """WITH a AS (SELECT last_day(o_orderdate) AS m, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1), b AS (SELECT last_day(l_shipdate) AS m, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1)
SELECT m, round(a.v / nullif(b.v, 0), 4) AS value FROM a JOIN b USING (m) WHERE a.v / nullif(b.v, 0) IS NOT NULL""")
def join11(spark, sf_dir):
    """JOIN-11, SET-05: two series on the dates both have."""
    a = t(spark, sf_dir, "orders").groupBy(F.last_day("o_orderdate").alias("m")).agg(F.round(F.sum("o_totalprice"), 2).alias("a"))
    b = t(spark, sf_dir, "lineitem").groupBy(F.last_day("l_shipdate").alias("m")).agg(F.round(F.sum("l_extendedprice"), 2).alias("b"))
    return joins.series_op(a, b, "m", "a", "b", "divide").withColumn("value", F.round("value", 4))


@query("join15_fallback_knn", """WITH j AS (SELECT s.p_partkey AS a, c.p_partkey AS b, s.p_size = c.p_size AS e, abs(s.p_retailprice - c.p_retailprice) AS d FROM part s JOIN part c ON s.p_brand = c.p_brand
WHERE s.p_partkey % 100 = 0), k AS (SELECT *, max(CAST(e AS INT)) OVER (PARTITION BY a) AS x FROM j)
SELECT a, b, CAST(n AS INT) AS rank FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY d, b) AS n FROM k WHERE e OR x = 0) WHERE n <= 8""")
def join15(spark, sf_dir):
    """JOIN-15, JOIN-16, WIN-22: cohorts are the parts divisible by 100 (the operator's query set), against all parts."""
    p = t(spark, sf_dir, "part")
    a = p.where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("a"), F.col("p_brand").alias("ab"), F.col("p_size").alias("as_"), F.col("p_retailprice").alias("ap"))
    b = p.select(F.col("p_partkey").alias("b"), F.col("p_brand").alias("bb"), F.col("p_size").alias("bs"), F.col("p_retailprice").alias("bp"))
    return joins.fallback_nearest(a, b, "a", ("ab", "bb"), ("as_", "bs"), "ap", "bp", "b", 8).select("a", "b", "rank")


@query("join14_first_wins", """SELECT n_name, s_suppkey, s_acctbal FROM nation JOIN (SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1) ON n_nationkey = s_nationkey""")
def join14(spark, sf_dir):
    """JOIN-14: lookup in which the first row of a key counts."""
    s = joins.first_wins(t(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal"), ["s_nationkey"], "s_suppkey")
    return t(spark, sf_dir, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey")).select("n_name", "s_suppkey", "s_acctbal")


@query("join17_nearest", """SELECT c_custkey, s_suppkey, round(d, 2) AS diff FROM (SELECT c_custkey, s_suppkey, abs(c_acctbal - s_acctbal) AS d, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - s_acctbal), s_suppkey) AS n
FROM customer JOIN supplier ON c_nationkey = s_nationkey) WHERE n = 1""")
def join17(spark, sf_dir):
    """JOIN-17, JOIN-18."""
    c, s = t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return joins.nearest(c, s, "c_custkey", [("c_nationkey", "s_nationkey")], "c_acctbal", "s_acctbal", "s_suppkey").withColumn("diff", F.round("diff", 2))


RING = [(-0.5, -0.5), (0.6, -0.3), (0.4, 0.5), (0.0, 0.1), (-0.4, 0.6)]


def _edges(x, y):
    return " + ".join(
        f"CAST((({y1} > {y}) <> ({y2} > {y})) AND ({x} < CAST({x2 - x1} AS DOUBLE) * ({y} - {y1}) / CAST({y2 - y1} AS DOUBLE) + {x1}) AS INT)" for (x1, y1), (x2, y2) in zip(RING, RING[1:] + RING[:1], strict=True)
    )


@query("join25_point_in_polygon", f"SELECT vec_id FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings) WHERE ({_edges('x', 'y')}) % 2 = 1")
def join25(spark, sf_dir):
    """JOIN-25: one polygon, whose box reaches the scan."""
    e = t(spark, sf_dir, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    return joins.inside_box_then_polygon(e, "x", "y", RING).select("vec_id")


#: Corners of a supplier's area about its middle.
CORNERS = [(-3.25, -2.125), (4.75, -1.875), (2.25, 5.125), (-1.5, 3.375)]
_QUADS = "UNION ALL ".join(
    f"SELECT s_suppkey, s_suppkey * 37 % 100 + {a[0]} AS x1, s_nationkey * 4 + {a[1]} AS y1, s_suppkey * 37 % 100 + {b[0]} AS x2, s_nationkey * 4 + {b[1]} AS y2 FROM supplier " for a, b in zip(CORNERS, CORNERS[1:] + CORNERS[:1], strict=True)
)


@query("join25_many_polygons", f"""WITH e AS ({_QUADS}), p AS (SELECT c_custkey, CAST(c_custkey * 73 % 1000 AS DOUBLE) / 10 AS x, CAST((c_acctbal + 1000) / 110 AS DOUBLE) AS y FROM customer)
SELECT c_custkey, s_suppkey FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < CAST(x2 - x1 AS DOUBLE) * (y - CAST(y1 AS DOUBLE)) / CAST(y2 - y1 AS DOUBLE) + CAST(x1 AS DOUBLE) GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def join25b(spark, sf_dir):
    """JOIN-25, FN-51: customers as points, suppliers' areas as a table of polygons."""
    x, y = F.col("s_suppkey") * 37 % 100, F.col("s_nationkey") * 4
    areas = t(spark, sf_dir, "supplier").select("s_suppkey", F.array(*(F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y")) for a, b in CORNERS)).alias("ring"))
    points = t(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") * 73 % 1000).cast("double") / 10).alias("x"), ((F.col("c_acctbal") + 1000) / 110).cast("double").alias("y"))
    return spatial.within(points, "x", "y", areas, "s_suppkey", 4.0).select("c_custkey", "s_suppkey")


@query("snk01_insert_if_absent", """SELECT c_custkey, o_orderkey FROM (SELECT o_custkey AS c_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)
WHERE n = 1 AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def snk01(spark, sf_dir):
    """SNK-01."""
    old = t(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    return joins.insert_if_absent(old, t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), ["c_custkey"], "o_orderkey")


@query("snk02_upsert", """SELECT c_custkey, c_acctbal AS v FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 0.5 AS v FROM customer WHERE c_custkey % 3 = 0""")
def snk02(spark, sf_dir):
    """SNK-02, SNK-04, SNK-05."""
    c = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("v"))
    return joins.upsert(c, c.where("c_custkey % 3 = 0").withColumn("v", F.lit(0.5)), ["c_custkey"])


# ------------------------------------------------------------------ windows

def w():
    return Window.partitionBy("o_orderpriority").orderBy("q")


OVER = "OVER (PARTITION BY o_orderpriority ORDER BY q)"
ROWS = "OVER (PARTITION BY o_orderpriority ORDER BY q ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


@query("win01_lags", f"SELECT o_orderpriority, q, lag(n) {OVER} AS n1, lag(total) {OVER} AS total1, n - lag(n) {OVER} AS dn FROM {QUARTERS}")
def win01(spark, sf_dir):
    """WIN-01, WIN-02, WIN-04."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.lag("n").over(w()).alias("n1"), F.lag("total").over(w()).alias("total1"), (F.col("n") - F.lag("n").over(w())).alias("dn"))


@query("win03_ffill", f"SELECT o_orderpriority, q, last_value(CASE WHEN q % 3 = 0 THEN n END IGNORE NULLS) {ROWS.format('UNBOUNDED')} AS n FROM {QUARTERS}")
def win03(spark, sf_dir):
    """WIN-03."""
    return quarters(spark, sf_dir).withColumn("n", F.when(F.col("q") % 3 == 0, F.col("n"))).select("o_orderpriority", "q", win.ffill("n", w()).alias("n"))


@query("win05_cumsum", f"SELECT o_orderpriority, q, CAST(sum(n) {ROWS.format('UNBOUNDED')} AS BIGINT) AS n FROM {QUARTERS}")
def win05(spark, sf_dir):
    """WIN-05."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.sum("n").over(win.running(w())).alias("n"))


@query("win06_expanding", f"SELECT o_orderpriority, q, CASE WHEN count(n) {ROWS.format('UNBOUNDED')} >= 8 THEN round(avg(n) {ROWS.format('UNBOUNDED')}, 4) END AS n FROM {QUARTERS}")
def win06(spark, sf_dir):
    """WIN-06."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.round(win.guarded_mean("n", win.running(w()), 8), 4).alias("n"))


@query("win07_rolling", f"SELECT o_orderpriority, q, CASE WHEN count(n) {ROWS.format(3)} >= 2 THEN round(1000 / nullif(avg(n) {ROWS.format(3)}, 0), 4) END AS n FROM {QUARTERS}")
def win07(spark, sf_dir):
    """WIN-07."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.round(1000 / F.nullif(win.guarded_mean("n", win.last_n(w(), 4), 2), F.lit(0.0)), 4).alias("n"))


@query("win08_pct_change", f"SELECT o_orderpriority, q, round(n / nullif(lag(n, 4) {OVER}, 0) - 1, 4) AS n FROM {QUARTERS}")
def win08(spark, sf_dir):
    """WIN-08."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.round(win.pct_change("n", w(), 4), 4).alias("n"))


_GAPPY = f"(SELECT o_orderpriority, q, CASE WHEN q % 13 <> 0 THEN n / 100 END AS v FROM {QUARTERS})"


@query("win09_cycle_phase", f"""SELECT o_orderpriority, q, CASE WHEN v IS NULL OR m IS NULL OR s IS NULL THEN 'UNKNOWN' WHEN v < m AND s <= 0 THEN 'EXPANSION' WHEN v < m THEN 'PEAK' WHEN s > 0 THEN 'CONTRACTION' ELSE 'TROUGH' END AS phase
FROM (SELECT o_orderpriority, q, v, CASE WHEN count(v) {ROWS.format(19)} >= 8 THEN avg(v) {ROWS.format(19)} END AS m, CASE WHEN count(v) {ROWS.format(7)} >= 4 AND count(v) {ROWS.format(7)} = count(*) {ROWS.format(7)} THEN regr_slope(v, i) {ROWS.format(7)} END AS s
FROM (SELECT *, row_number() {OVER} AS i FROM {_GAPPY}))""")
def win09(spark, sf_dir):
    """WIN-09, PAN-05: quarters with missing values."""
    df = quarters(spark, sf_dir).withColumn("v", F.when(F.col("q") % 13 != 0, F.col("n") / 100))
    return win.cycle_phase(df, ["o_orderpriority"], "q", "v").select("o_orderpriority", "q", "phase")


@query("win10_regime", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY q DESC) AS back FROM {_GAPPY} WHERE v IS NOT NULL),
g AS (SELECT o_orderpriority, count(*) AS n, avg(v) AS m, stddev_samp(v) AS sd FROM r WHERE back <= 20 GROUP BY 1)
SELECT o_orderpriority, coalesce(bool_or(n >= 20 AND sd > 0 AND abs(v - m) / sd > 2), false) AS regime_change FROM r JOIN g USING (o_orderpriority) WHERE back <= 4 GROUP BY 1""")
def win10(spark, sf_dir):
    """WIN-10, MOD-17: the last 4 values against the mean of the last 20."""
    df = quarters(spark, sf_dir).withColumn("v", F.when(F.col("q") % 13 != 0, F.col("n") / 100))
    return win.regime_change(df, ["o_orderpriority"], "q", "v")


@query("win12_compound_product", f"SELECT o_orderpriority, q, round(product(1 + 0.02 * (q % 5) / 4) {ROWS.format('UNBOUNDED')}, 6) AS level FROM {QUARTERS}")
def win12(spark, sf_dir):
    """WIN-12, MOD-05."""
    return quarters(spark, sf_dir).select("o_orderpriority", "q", F.round(win.compound(F.lit(0.02) * (F.col("q") % 5), w()), 6).alias("level"))


@query("win13_carry_forward", """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked FROM conversations""")
def win13(spark, sf_dir):
    """WIN-13, WIN-14."""
    return win.carry_forward(t(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn")), "asked").select("conv_id", "turn", "asked")


@query("win15_section", """SELECT user_id, count(*) FILTER (coalesce(m, false) AND event_type <> 'signup') AS n FROM (SELECT user_id, event_type, last_value(CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN false END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM events) GROUP BY 1""")
def win15(spark, sf_dir):
    """WIN-15: sections between markers."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return win.section_on(e, ["user_id"], "event_id", F.col("event_type") == "signup", F.col("event_type") == "error").groupBy("user_id").agg(F.count_if("inside").alias("n"))


@query("win16_keep_best", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, o_orderkey) AS n FROM orders) WHERE n = 1""")
def win16(spark, sf_dir):
    """WIN-16, WIN-18: best of each key, the first on ties."""
    rank = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return win.keep_best(t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], [rank, F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("win17_prefer_actual", """SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY CAST(event_type = 'error' AS INT), event_id) AS n FROM events) WHERE n = 1""")
def win17(spark, sf_dir):
    """WIN-17, WIN-19."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return win.keep_best(e, ["user_id"], [(F.col("event_type") == "error").cast("int"), F.col("event_id")]).select("user_id", "event_type")


@query("win20_last_n", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n <= 3""")
def win20(spark, sf_dir):
    """WIN-20."""
    return win.last_rows(t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("win21_latest_ties", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS n FROM orders) WHERE n = 1""")
def win21(spark, sf_dir):
    """WIN-21."""
    return win.latest_with_ties(t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", day("o_orderdate").alias("d")), ["o_custkey"], "d").select("o_custkey", "o_orderkey")


@query("win25_chunk_text", """WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents), c AS (SELECT doc_id, t, unnest(range(CASE WHEN length(t) <= 800 THEN 1 ELSE CAST(ceil((length(t) - 800) / 680.0) AS INT) + 1 END)) AS k FROM s WHERE t <> '')
SELECT doc_id, CAST(k AS INT) AS chunk, md5(substr(t, CAST(k AS INT) * 680 + 1, 800)) AS digest FROM c""")
def win25(spark, sf_dir):
    """WIN-25, FN-42."""
    return win.chunks(t(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "chunk", F.md5("text").alias("digest"))


@query("win26_forecast_flag", f"""WITH x AS (SELECT *, max(CASE WHEN q % 7 = 0 THEN q END) OVER (PARTITION BY o_orderpriority) AS m FROM {QUARTERS}) SELECT o_orderpriority, q, coalesce(q > m, false) OR n < 5 AS is_forecast FROM x""")
def win26(spark, sf_dir):
    """WIN-26, FN-22."""
    return win.forecast_flag(quarters(spark, sf_dir), ["o_orderpriority"], "q", F.col("q") % 7 == 0, F.col("n") < 5).select("o_orderpriority", "q", "is_forecast")


@query("win27_next_and_trailing", f"""WITH x AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY q DESC) AS b FROM {QUARTERS}) SELECT o_orderpriority, CAST(sum(n) FILTER (b <= 4) AS BIGINT) AS next4, CAST(sum(n) FILTER (b > 4 AND b <= 8) AS BIGINT) AS trailing4 FROM x GROUP BY 1""")
def win27(spark, sf_dir):
    """WIN-27."""
    b = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("q")))
    return quarters(spark, sf_dir).withColumn("b", b).groupBy("o_orderpriority").agg(F.sum(F.when(F.col("b") <= 4, F.col("n"))).alias("next4"), F.sum(F.when(F.col("b").between(5, 8), F.col("n"))).alias("trailing4"))


@query("win28_cumulative_share", f"SELECT o_orderpriority, q, round(sum(n) {ROWS.format('UNBOUNDED')} / sum(n) OVER (PARTITION BY o_orderpriority), 4) AS share FROM {QUARTERS}")
def win28(spark, sf_dir):
    """WIN-28."""
    return win.cumulative_share(quarters(spark, sf_dir), ["o_orderpriority"], [F.col("q")], "n").select("o_orderpriority", "q", "share")


@query("win30_lifecycle", """WITH u AS (SELECT user_id, max(CAST(ts AS DATE)) AS seen FROM events GROUP BY 1) SELECT user_id, CASE WHEN date_diff('day', seen, DATE '2024-03-15') > 60 THEN 'rented_or_pulled'
WHEN date_diff('day', seen, DATE '2024-03-15') > 30 THEN 'inactive_30d' ELSE 'active' END AS status FROM u""")
def win30(spark, sf_dir):
    """WIN-30, ER-07."""
    u = t(spark, sf_dir, "events").groupBy("user_id").agg(F.max(day("ts")).alias("seen"))
    return u.select("user_id", win.lifecycle(F.lit("active"), F.col("seen"), F.lit("2024-03-15").cast("date")).alias("status"))


@query("win31_first_last", """WITH y AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders GROUP BY 1, 2), g AS (SELECT o_orderpriority, min_by(n, y) AS first, max_by(n, y) AS last, max(y) - min(y) AS years FROM y GROUP BY 1),
c AS (SELECT *, CASE WHEN first > 0 AND years > 0 THEN pow(last / first, 1.0 / years) - 1 END AS c FROM g)
SELECT o_orderpriority, first, last, years, round(c, 6) AS cagr, CASE WHEN c > 0.005 THEN 'up' WHEN c < -0.005 THEN 'down' WHEN c IS NOT NULL THEN 'flat' END AS direction FROM c""")
def win31(spark, sf_dir):
    """WIN-31."""
    y = t(spark, sf_dir, "orders").groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return win.first_vs_last(y, ["o_orderpriority"], "y", "n")


# ------------------------------------------------------------------ reshape


@query("set07_unpivot", """SELECT n_regionkey, month, n FROM (SELECT n_regionkey, count(*) FILTER (n_nationkey % 2 = 0) AS a, count(*) FILTER (n_nationkey % 2 = 1) AS b FROM nation GROUP BY 1), LATERAL (VALUES ('2024-01-31', a), ('2024-02-29', b)) v(month, n)""")
def set07(spark, sf_dir):
    """SET-07, SRC-15, PRJ-13."""
    even = F.col("n_nationkey") % 2 == 0
    wide = t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count_if(even).alias("2024-01-31"), F.count_if(~even).alias("2024-02-29"), F.max("n_name").alias("name"))
    return reshape.unpivot_dates(wide, ["n_regionkey"], "month", "n")


@query("set08_melt", """SELECT p_partkey, metric, value FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, p_retailprice AS b FROM part), LATERAL (VALUES ('size', a), ('price', b)) v(metric, value) WHERE value IS NOT NULL""")
def set08(spark, sf_dir):
    """SET-08, SET-09."""
    return reshape.melt(t(spark, sf_dir, "part"), ["p_partkey"], {"p_size": "size", "p_retailprice": "price"})


@query("set10_onehot", "SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INT) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INT) AS o_orderstatus_P FROM orders")
def set10(spark, sf_dir):
    """SET-10, PAN-07."""
    return reshape.one_hot(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"]).drop("o_orderstatus")


@query("set11_expand", "SELECT p_partkey, CAST(unnest(range(1, p_size % 5 + 1)) AS INT) AS copy FROM part")
def set11(spark, sf_dir):
    """SET-11, SET-12."""
    return reshape.expand(t(spark, sf_dir, "part"), F.col("p_size") % 5).select("p_partkey", "copy")


@query("set01_union", "SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS bal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def set01(spark, sf_dir):
    """SET-01, SET-02, SRC-06."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return reshape.union_all(c, t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))).select("k", "name", "bal")


@query("set13_nested", """SELECT n_nationkey, n_name, array_to_string(list(s_name ORDER BY s_suppkey), ',') AS suppliers FROM nation JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1, 2""")
def set13(spark, sf_dir):
    """SET-13."""
    s = t(spark, sf_dir, "supplier").withColumn("n_nationkey", F.col("s_nationkey"))
    n = joins.nested(t(spark, sf_dir, "nation"), s, "n_nationkey", ["s_name"], "s_suppkey", "rows")
    return n.select("n_nationkey", "n_name", F.array_join(F.transform("rows", lambda r: r["s_name"]), ",").alias("suppliers"))
