"""Queries of comparable properties: orders, line items and customers stand for cohorts, unit types and comps."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.operators import comps

from .q_relational import t
from .registry import query


@query("agg43_thin_cohorts", """SELECT o_custkey, count(*) AS n, 'thin_cohort_' || o_custkey || '_only_' || count(*) || '_comps' AS flag FROM orders GROUP BY 1 HAVING count(*) < 3""")
def agg43(spark, sf_dir):
    """AGG-43: customers with fewer than three orders."""
    return comps.thin_cohorts(t(spark, sf_dir, "orders"), "o_custkey")


@query("agg43_single_evidence", "SELECT l_orderkey, 'om_only_comp_' || l_orderkey AS flag FROM lineitem GROUP BY 1 HAVING bool_and(coalesce(l_returnflag, '') = 'N')")
def agg43b(spark, sf_dir):
    """AGG-43: orders all of whose lines have one flag."""
    return comps.single_evidence(t(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "N")


@query("agg44_overview", """WITH u AS (SELECT l_orderkey, list(CASE WHEN l_quantity >= 10 THEN l_extendedprice END) AS r FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 7 END, len(r), 0) AS INTEGER) AS units, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END, list_min(r)) AS min_rent, list_max(r) AS max_rent FROM orders LEFT JOIN u ON l_orderkey = o_orderkey""")
def agg44(spark, sf_dir):
    """AGG-44: orders as comps, their lines as available units, some of which have no price."""
    u = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.when(F.col("l_quantity") >= 10, F.col("l_extendedprice")).alias("rent"))).alias("units"))
    o = t(spark, sf_dir, "orders").join(u, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    key = F.col("o_orderkey")
    x = comps.overview(F.when(key % 5 == 0, key % 7), F.col("units"), F.when(key % 3 == 0, F.col("o_totalprice")), F.lit(None).cast("double"))
    return o.select("o_orderkey", x.alias("x")).select("o_orderkey", F.col("x.units").cast("int").alias("units"), "x.min_rent", "x.max_rent")


@query("join22_merge_extractions", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_acctbal > 0 THEN 'new' ELSE 'old' END AS plan, CASE WHEN c_custkey % 3 = 0 AND c_acctbal > 0 THEN 'a,b,c' ELSE 'a,b' END AS specials,
CASE WHEN c_custkey % 3 = 0 AND c_acctbal > 0 THEN 'llm_extracted' ELSE 'site' END AS platform, c_custkey % 3 = 0 AND c_acctbal > 0 AS extracted FROM customer""")
def join22(spark, sf_dir):
    """JOIN-22: a third of the comps has an extraction, some of those without plans."""
    c = t(spark, sf_dir, "customer")
    arr = lambda *xs: F.array(*map(F.lit, xs))
    snapshot = c.select("c_custkey", arr("old").alias("floorplans"), arr("a", "b").alias("specials"), F.lit("site").alias("platform"))
    found = c.where("c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_acctbal") > 0, arr("new")).otherwise(F.array().cast("array<string>")).alias("floorplans"), arr("b", "c", "a").alias("specials"), F.lit("").alias("platform"))
    m = comps.merge_extractions(snapshot, found, "c_custkey")
    return m.select("c_custkey", F.get("floorplans", F.lit(0)).alias("plan"), F.array_join("specials", ",").alias("specials"), "platform", "extracted")


@query("prj28_catchment", "SELECT c_custkey FROM customer WHERE c_nationkey % 3 = 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY')")
def prj28(spark, sf_dir):
    """PRJ-28: segments as zips, a third of which can't be read."""
    zip_code = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment"))
    return t(spark, sf_dir, "customer").where(comps.in_catchment(zip_code, ["BUILDING", "MACHINERY"])).select("c_custkey")


@query("sort08_largest_payload", "SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS k FROM conversations WHERE text IS NOT NULL) WHERE k = 1")
def sort08(spark, sf_dir):
    """SORT-08: the longest turn of a conversation, the first of equals."""
    return comps.largest_payload(t(spark, sf_dir, "conversations"), ["conv_id"], "text", "turn")


@query("agg11_places", "SELECT o_custkey, max(o_totalprice) AS lat, max(o_orderkey) AS lon FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def agg11(spark, sf_dir):
    """AGG-11."""
    o = t(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("lat"), F.col("o_orderkey").alias("lon"))
    return comps.places(o, "o_custkey")
