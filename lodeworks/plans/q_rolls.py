"""Queries of rent rolls by rules: customers by nation stand for the sheets of properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.operators import ledgers, roll_rules

from .q_relational import t
from .registry import query

#: Every cell as text, and the mapping that reads it.
CELLS = [
    ("Unit", "CAST(floor(c_custkey / 2) AS STRING)"), ("Floorplan", "concat(substring(c_mktsegment, 1, 1), CAST(c_custkey % 5 AS STRING))"), ("SQFT", "concat('1,', CAST(100 + c_custkey % 800 AS STRING), ' SF')"),
    ("Unit/Lease Status", "element_at(array('o', 'VACANT', 'Occupied-NTV', 'Applicant', ''), CAST(c_custkey % 5 AS INT) + 1)"), ("Name", "c_name"), ("Move-In", "if(c_custkey % 3 = 0, '', concat(CAST(1 + c_custkey % 12 AS STRING), '/7/2024'))"),
    ("Market Rent", "concat('$', CAST(floor(c_acctbal) AS STRING), '.50')"), ("Lease Rent", "CAST(c_custkey % 2000 AS STRING)"), ("RENT", "if(c_custkey % 7 = 0, '', CAST(c_custkey % 1500 AS STRING))"), ("CONC", "CAST(c_custkey % 50 AS STRING)"),
]
MAPPING = {
    "file_settings": {"header_row": "auto", "detect_header_keywords": ["unit"]},
    "column_mappings": {"unit_id": ["Unit #", "Unit"], "floorplan_code": ["Floorplan"], "sqft": ["SQFT"], "status": ["Unit/Lease Status"], "resident_name": ["Name"], "move_in_date": ["Move-In"], "market_rent": ["Market Rent"], "lease_rent": ["Lease Rent"]},
    "income_columns": {"base_rent": ["RENT"], "concessions": ["CONC"]},
    "status_mappings": {"Occupied": ["Occupied", "O"], "Notice": ["Occupied-NTV"], "Vacant": ["Vacant"]},
    "row_filters": {"include_statuses": ["Occupied", "Notice", "Vacant"]},
    "transformations": {"calculate_total_rent": True, "infer_bed_type_from_floorplan": True, "floorplan_bed_prefix_map": {"A": "1BR", "AUTO": "4BR", "B": "2BR", "F": "3BR"}},
    "floorplan_mappings": {"M1": {"bed_type": "Studio", "bath_count": 1, "sqft": 400}},
    "floorplan_bed_bath_patterns": [{"pattern": "^h", "bed_type": "2BR", "bath_count": 2.5}],
}


def sheets(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    rows = c.select("c_nationkey", (F.col("c_custkey") + 1).cast("long").alias("row_idx"), F.array(*(F.expr(e) for _, e in CELLS)).alias("cells"))
    head = c.select("c_nationkey").distinct().select("c_nationkey", F.lit(0).cast("long").alias("row_idx"), F.array(*(F.lit(n) for n, _ in CELLS)).alias("cells"))
    return head.unionByName(rows)


_UNITS = """x AS (SELECT c_nationkey, c_custkey AS i, CAST(c_custkey // 2 AS VARCHAR) AS unit_id, substr(c_mktsegment, 1, 1) || CAST(c_custkey % 5 AS VARCHAR) AS plan, 1100 + c_custkey % 800 AS sqft, ['Occupied', 'Vacant', 'Notice', 'Applicant', ''][c_custkey % 5 + 1] AS status, c_name AS resident_name,
CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '2024-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-07' END AS move_in_date, CASE WHEN floor(c_acctbal) < 0 THEN floor(c_acctbal) - 0.5 ELSE floor(c_acctbal) + 0.5 END AS market, CAST(c_custkey % 2000 AS DOUBLE) AS lease,
CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 1500 AS DOUBLE) END AS base, CAST(c_custkey % 50 AS DOUBLE) AS conc FROM customer WHERE c_custkey % 5 <> 3),
y AS (SELECT *, CASE WHEN plan = 'M1' THEN 'Studio' WHEN plan LIKE 'A%' THEN '1BR' WHEN plan LIKE 'B%' THEN '2BR' WHEN plan LIKE 'F%' THEN '3BR' WHEN plan LIKE 'H%' THEN '2BR' ELSE '' END AS bed_type, CASE WHEN plan = 'M1' THEN CAST(1 AS DOUBLE) WHEN plan LIKE 'H%' THEN CAST(2.5 AS DOUBLE) END AS bath_count,
CASE WHEN plan = 'M1' THEN 400 ELSE sqft END AS size, coalesce(base - conc, lease) AS total FROM x),
u AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, unit_id ORDER BY CASE status WHEN 'Occupied' THEN 5 WHEN 'Notice' THEN 4 WHEN 'Vacant' THEN 2 ELSE 1 END DESC, move_in_date <> '' DESC, coalesce(nullif(total, 0), nullif(lease, 0), 0) DESC, i) AS k FROM y)"""


@query("pipe06_standardise", f"""WITH {_UNITS} SELECT c_nationkey, unit_id, plan AS floorplan_code, bed_type, bath_count, CAST(size AS INTEGER) AS sqft, market AS market_rent, lease AS lease_rent, status, resident_name, move_in_date, '' AS lease_start, base AS base_rent, conc AS concessions, total AS total_rent FROM u WHERE k = 1""")
def pipe06(spark, sf_dir):
    """PIPE-06, PRJ-06, PRJ-19, FN-14, FN-15, FN-16, FN-39: sheets of any order of columns to canonical units."""
    units = roll_rules.standardise(sheets(spark, sf_dir), ["c_nationkey"], MAPPING)
    return units.select("c_nationkey", "unit_id", "floorplan_code", "bed_type", "bath_count", "sqft", "market_rent", "lease_rent", "status", "resident_name", "move_in_date", "lease_start", "base_rent", "concessions", "total_rent")


@query("agg12_roll_summary", f"""WITH {_UNITS} SELECT c_nationkey, plan AS "PlanCode", min(bed_type) AS "BedType", count(*) AS "Units", round_even(avg(size), 0) AS "SqFt", round(avg(market), 2) AS "AvgMarketRent" FROM u WHERE k = 1 GROUP BY 1, 2""")
def agg12b(spark, sf_dir):
    """AGG-12: floorplans of standardised rolls."""
    return roll_rules.plan_summary(roll_rules.standardise(sheets(spark, sf_dir), ["c_nationkey"], MAPPING), ["c_nationkey"])


@query("fn20_snapshot_month", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m') END AS month FROM orders")
def fn20(spark, sf_dir):
    """FN-20: names with the year first, the year last, eight digits in a row, and none."""
    d = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(F.lit("RentRoll_"), d("yyyy-MM-dd"))).when(k == 1, F.concat(F.lit("RentRoll"), d("MM_dd_yyyy"))).when(k == 2, F.concat(F.lit("roll "), d("MMddyyyy"))).otherwise("roll")
    return t(spark, sf_dir, "orders").select("o_orderkey", roll_rules.snapshot_month(name).alias("month"))


@query("prj21_ledger_units", """SELECT c_custkey FROM customer WHERE c_mktsegment NOT LIKE '%HOUSE%' AND c_mktsegment <> 'MACHINERY' AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_name LIKE '%1'""")
def prj21(spark, sf_dir):
    """PRJ-21: segments before the key as ids, one of them a charge code; sizes and rents that are missing or text."""
    key = F.col("c_custkey")
    unit, plan = F.concat("c_mktsegment", F.when(F.col("c_mktsegment") != "MACHINERY", " 1").otherwise("")), F.when(F.col("c_name").endswith("1"), F.col("c_name")).otherwise(" ")
    sqft, rent = F.when(key % 5 != 0, F.concat(F.lit("1,"), key.cast("string"))), F.when(key % 7 == 0, "total").otherwise("$5")
    return t(spark, sf_dir, "customer").where(ledgers.ledger_unit(unit, plan, sqft, rent, ["house"], ["machinery"], ["[a-z]+"])).select("c_custkey")


@query("prj22_listed_units", """WITH u AS (SELECT c_nationkey, c_custkey AS i, CASE WHEN c_custkey % 211 = 0 THEN 'Future Residents' WHEN c_custkey % 13 = 0 THEN '1-' || c_custkey WHEN c_custkey % 17 = 0 THEN c_custkey || ' Total' WHEN c_custkey % 3 = 0 THEN 'A' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS unit FROM customer),
e AS (SELECT c_nationkey, min(i) AS e FROM u WHERE unit = 'Future Residents' GROUP BY 1) SELECT c_nationkey, i AS row_idx, unit FROM u LEFT JOIN e USING (c_nationkey) WHERE (e IS NULL OR i < e) AND unit NOT LIKE '%-%' AND unit NOT LIKE '%Total%' AND unit NOT LIKE 'Future%'""")
def prj22(spark, sf_dir):
    """PRJ-22: each nation's list up to the section that ends it."""
    k = F.col("c_custkey")
    text = k.cast("string")
    unit = F.when(k % 211 == 0, "Future Residents").when(k % 13 == 0, F.concat(F.lit("1-"), text)).when(k % 17 == 0, F.concat(text, F.lit(" Total"))).when(k % 3 == 0, F.concat(F.lit("A"), text)).otherwise(text)
    rows = t(spark, sf_dir, "customer").select("c_nationkey", k.alias("row_idx"), unit.alias("unit"))
    return ledgers.listed_units(rows, ["c_nationkey"], "unit", skip=["total"], stop=["future residents"])


@query("prj26_unit_numbers", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 AND p_partkey BETWEEN 100 AND 300 THEN CAST(p_partkey AS INTEGER) END AS unit FROM part")
def prj26(spark, sf_dir):
    """PRJ-26: numbers with and without decimals, and cells that are none."""
    k = F.col("p_partkey")
    cell = F.when(k % 4 == 0, "Total").when(k % 4 == 1, F.concat(k.cast("string"), F.lit(".0"))).otherwise(k.cast("string"))
    return t(spark, sf_dir, "part").select("p_partkey", ledgers.unit_number(cell).alias("unit"))
