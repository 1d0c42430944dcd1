"""Queries of plan codes, classifiers and public series over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.functions import plans
from lodeworks.operators import series

from .q_relational import t
from .registry import query

_CODE = "concat(['A', 'b', 'S', 'PH', 'C', 'X', '7'][p_partkey % 7 + 1], p_size, CASE p_partkey % 3 WHEN 0 THEN '-PL' WHEN 1 THEN 'T' ELSE '' END)"
RULES = [{"match_type": "suffix", "pattern": "t", "bed_type": "town"}, {"match_type": "regex", "pattern": r"^([A-C])(\d)", "bed_type": "{1}-{2}"}, {"match_type": "contains", "pattern": "h", "bed_type": "pent"}, {"pattern": "s", "bed_type": "Studio"}]


def codes(spark, sf_dir):
    letter = F.get(F.array(*map(F.lit, ("A", "b", "S", "PH", "C", "X", "7"))), (F.col("p_partkey") % 7).cast("int"))
    end = F.when(F.col("p_partkey") % 3 == 0, "-PL").when(F.col("p_partkey") % 3 == 1, "T").otherwise("")
    return t(spark, sf_dir, "part").select("p_partkey", F.concat(letter, F.col("p_size").cast("string"), end).alias("code"))


@query("fn34_plan_rules", f"""WITH c AS (SELECT p_partkey, replace(upper({_CODE}), '-PL', '') AS c FROM part)
SELECT p_partkey, CASE WHEN suffix(c, 'T') THEN 'town' WHEN regexp_matches(c, '^[A-C]\\d') THEN concat(c[1], '-', c[2]) WHEN contains(c, 'H') THEN 'pent' WHEN prefix(c, 'S') THEN 'Studio' ELSE '' END AS bed_type FROM c""")
def fn34(spark, sf_dir):
    """FN-34: suffix, regex with groups, contains and prefix rules; the first that matches counts."""
    return codes(spark, sf_dir).select("p_partkey", plans.plan_rules(F.col("code"), RULES, "bed_type").alias("bed_type"))


@query("fn35_bed_letter", f"""SELECT p_partkey, coalesce(MAP {{'S': 'Studio', 'A': '1BR', 'B': '2BR', 'C': '3BR', 'D': '4BR', 'E': '4BR'}}[upper(regexp_extract({_CODE}, '^([A-Za-z])', 1))], '') AS bed_type FROM part""")
def fn35(spark, sf_dir):
    """FN-35."""
    return codes(spark, sf_dir).select("p_partkey", plans.bed_by_letter(F.col("code")).alias("bed_type"))


@query("fn36_clean_plan", """WITH r AS (SELECT p_partkey, upper(concat(' ', split_part(p_name, ' ', 1), CASE p_partkey % 3 WHEN 0 THEN concat('  ', split_part(p_name, ' ', 1), ' x') WHEN 1 THEN ', w/d' ELSE ' b' END)) AS x FROM part),
c AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(trim(x), '\\s+', ' ', 'g'), ',?\\s*W/D\\b', '', 'g')) AS x FROM r)
SELECT p_partkey, CASE WHEN split_part(x, ' ', 2) <> '' AND split_part(x, ' ', 1) = split_part(x, ' ', 2) THEN split_part(x, ' ', 1) ELSE x END AS plan FROM c""")
def fn36(spark, sf_dir):
    """FN-36."""
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    raw = F.concat(F.lit(" "), first, F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("  "), first, F.lit(" x"))).when(F.col("p_partkey") % 3 == 1, ", w/d").otherwise(" b"))
    return t(spark, sf_dir, "part").select("p_partkey", plans.clean_plan(raw).alias("plan"))


@query("fn37_resident", """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS resident FROM customer""")
def fn37(spark, sf_dir):
    """FN-37."""
    kind = F.col("c_custkey") % 4
    raw = F.when(kind == 0, F.concat(F.lit("VACANT  unit "), "c_name")).when(kind == 1, F.concat("c_name", F.lit("  T00123 1/05/2025"))).otherwise(F.concat(F.lit(" "), "c_name"))
    return t(spark, sf_dir, "customer").select("c_custkey", plans.resident_name(raw).alias("resident"))


@query("fn26_target_year", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 2030 ELSE CAST(year(o_orderdate) + 5 AS INT) END AS target FROM orders")
def fn26(spark, sf_dir):
    """FN-26."""
    y = F.year("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 3 == 0, "long run").when(F.col("o_orderkey") % 3 == 1, F.concat(y.cast("string"), F.lit(" - "), (y + 5).cast("string"))).otherwise(F.concat((y + 5).cast("string"), F.lit("-x")))
    return t(spark, sf_dir, "orders").select("o_orderkey", plans.target_year(raw).alias("target"))


@query("fn40_classifiers", """SELECT c_custkey, [NULL, 'reit', 'private_equity', 'private', 'other'][c_custkey % 5 + 1] AS ownership, ['renovated', 'partial', 'classic', 'unknown', NULL][c_custkey % 5 + 1] AS renovation FROM customer""")
def fn40(spark, sf_dir):
    """FN-40."""
    pick = lambda xs: F.get(F.array(*map(F.lit, xs)), (F.col("c_custkey") % 5).cast("int"))
    return t(spark, sf_dir, "customer").select("c_custkey", plans.ownership(pick(("Unknown", "Public REIT", "Private Equity fund", "private owner", "city"))).alias("ownership"), plans.renovation(pick(("Fully renovated", "light", "Original", "n/a", " "))).alias("renovation"))


@query("src21_employment", """WITH m AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS msa_code, concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS as_of, unnest(['qcew_employment_month3', 'qcew_avg_weekly_wage', 'qcew_total_quarterly_wages']) AS metric,
unnest([CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS DOUBLE) END, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_totalprice AS DOUBLE) END, 7.0]) AS value FROM orders)
SELECT o_orderkey, metric, value, as_of, 'msa' AS geo_level, msa_code, 'qcew' AS source_id FROM m WHERE value IS NOT NULL""")
def src21(spark, sf_dir):
    """SRC-21: landed rows; markers of missing values give no record."""
    o, k = t(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(
        "o_orderkey", F.col("o_custkey").alias("msa"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("qtr"), F.when(k % 3 != 0, F.col("o_custkey").cast("string")).otherwise(".").alias("month3_emplvl"),
        F.when(k % 4 != 0, F.col("o_totalprice").cast("string")).otherwise("").alias("avg_wkly_wage"), F.lit("7").alias("total_qtrly_wages"), F.lit("n/a").alias("qtrly_estabs"),
    )
    return series.employment(rows, ["o_orderkey"], "msa", "year", "qtr", "qcew")


@query("prj10_unemployment", """SELECT o_orderkey, 'unemployment_rate' AS metric, CAST(o_custkey % 9 + 4 AS DOUBLE) AS value, concat(year(o_orderdate), '-', monthname(o_orderdate)) AS as_of, 'msa' AS geo_level, CAST(o_custkey AS VARCHAR) AS msa_code, 'bls' AS source_id FROM orders WHERE o_orderkey % 5 = 0""")
def prj10(spark, sf_dir):
    """PRJ-10, SRC-23: landed rows; markers of missing values are dropped."""
    o = t(spark, sf_dir, "orders")
    raw = F.get(F.array(*map(F.lit, ("", ".", "-", "NA", "N/A"))), (F.col("o_orderkey") % 5).cast("int"))
    rows = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "MMMM").alias("periodName"), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" "), (F.col("o_custkey") % 9 + 4).cast("string"))).otherwise(raw).alias("value"))
    return series.unemployment(rows, ["o_orderkey"], "o_custkey", "bls")


@query("prj09_sale_prices", """SELECT o_orderkey, 'median_sale_price' AS metric, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(o_totalprice AS DOUBLE) END AS value, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS as_of, 'msa' AS geo_level, CAST(o_custkey AS VARCHAR) AS msa_code, 'redfin' AS source_id FROM orders WHERE o_orderstatus = 'F'""")
def prj09(spark, sf_dir):
    """PRJ-09, SRC-24: one region's rows; a missing price is 0."""
    o = t(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.col("o_orderstatus").alias("region"), F.col("o_custkey").alias("region_code"), F.to_date("o_orderdate").alias("period_end"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice").cast("string")).alias("median_sale_price"))
    return series.sale_prices(rows, ["o_orderkey"], "F", "redfin")


@query("prj11_permits", """SELECT o_orderkey, 'permits_total' AS metric, CAST(o_custkey * 2 + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 2 END AS BIGINT) AS value, strftime(o_orderdate, '%Y-%m') AS as_of, 'msa' AS geo_level, CAST(o_custkey AS VARCHAR) AS msa_code, 'fred' AS source_id FROM orders""")
def prj11(spark, sf_dir):
    """PRJ-11, SRC-22: halves go to the even number."""
    o = t(spark, sf_dir, "orders")
    value = (F.col("o_custkey") * 2 + F.when(F.col("o_orderkey") % 2 == 0, 0.5).otherwise(1.5)).cast("string")
    rows = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), value.alias("permit"))
    return series.permits(rows, ["o_orderkey"], "o_custkey", "fred")


@query("agg25_backfill_rents", """WITH u AS (SELECT l_partkey, min(CAST(l_extendedprice AS DOUBLE)) AS lo, max(CAST(l_extendedprice AS DOUBLE)) AS hi FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_retailprice AS DOUBLE) ELSE coalesce(lo, 0) END AS rent_min, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_retailprice AS DOUBLE) ELSE hi END AS rent_max FROM part LEFT JOIN u ON p_partkey = l_partkey""")
def agg25(spark, sf_dir):
    """AGG-25: plans without a rent take it from their units."""
    price = F.col("p_retailprice").cast("double")
    p = t(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, price).otherwise(0.0).alias("rent_min"), F.when(F.col("p_partkey") % 3 == 0, price).alias("rent_max"))
    u = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("rent"))
    return series.backfill_rents(p, u, "p_partkey")
