"""Rent rolls by rules: values, headers, filters, repeated units, errors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import roll_rules as rr

RULES = """
source_system: test
file_settings: {header_row: auto, detect_header_keywords: [Unit]}
column_mappings:
  unit_id: [Unit]
  floorplan_code: [Floorplan, Plan]
  sqft: [SQFT]
  status: [Unit/Lease Status]
  resident_name: [Name]
  move_in_date: [Move-In]
  lease_start: [Lease Start]
  lease_end: [Lease End]
  market_rent: [Market + Addl.]
  lease_rent: [Lease Rent]
  bed_type: [Bed/Bath]
  bath_count: [Baths]
income_columns: {base_rent: [RENT], pet_rent: [PETRENT], concessions: [CONC]}
status_mappings: {Occupied: [Occupied, O], Notice: [Occupied-NTV], Vacant: [Vacant]}
bed_type_mappings: {Studio: [STU, 0], 1BR: [1]}
row_filters: {include_statuses: [Occupied, Notice, Vacant], skip_patterns: ["^Totals", "^--"], section_terminator_patterns: ["Future"]}
transformations: {date_format: "%Y-%m-%d %H:%M:%S", alternate_date_formats: ["%m/%d/%Y"], calculate_total_rent: true, parse_bed_bath_combined: true}
floorplan_mappings: {B2P: {bed_type: 2BR, bath_count: 2, sqft: 883}}
floorplan_bed_bath_patterns: [{pattern: "^ph", bed_type: 4BR, bath_count: 3.5}]
"""
HEAD = ["Unit", "Plan", "SQFT", "Unit/Lease Status", "Name", "Move-In", "Lease Start", "Lease End", "Market + Addl.", "Lease Rent", "Bed/Bath", "RENT", "PETRENT", "CONC"]
ROWS = [
    ["Rent roll As Of = 3/31/2025"], [], HEAD,
    ["101", "A1", "1,050 SF", "o", "Ann", "2024-05-01 00:00:00", "5/1/2024", "soon", "$1,500.00", "1400", "1/1.5", "1300", "50", "25"],
    ["Totals", "", "", "", "", "", "", "", "9", "9"],
    ["102", "B2P", "", "Vacant", "", "", "", "", "(50)", "-", "", "", "", ""],
    ["103", "PH1", "n/a", "Occupied-NTV", "Bo", "13/45/2024", "", "", "", "1.2.3", "", "900", "", "-30"],
    ["104", "Z", "700", "Applicant"], ["105", "A1", "700", "", "", "", "", "", "", "800", "STU"], ["106", "", "700", "Vacant", "", "", "", "", "", "", "12"],
    ["101", "A1", "1050", "Vacant", "Later", "", "6/1/2026", "", "", "1600"], ["", "A1"], ["107"],
]


def sheets(spark, *many):
    rows = [(f"s{k}", i, cells) for k, sheet in enumerate(many) for i, cells in enumerate(sheet)]
    return spark.createDataFrame(rows, "sheet string, row_idx int, cells array<string>")


def test_golden_rows(spark):
    got = {(r.sheet, r.unit_id): r for r in rr.standardise(sheets(spark, ROWS), ["sheet"], rr.load(RULES)).collect()}
    assert sorted(u for _, u in got) == ["101", "102", "103", "105", "106", "107"]
    a = got["s0", "101"]
    assert (a.bed_type, a.bath_count, a.sqft, a.status, a.market_rent, a.lease_rent, a.move_in_date, a.lease_start, a.lease_end, a.total_rent) == ("1BR", 1.5, 1050, "Occupied", 1500.0, 1400.0, "2024-05-01", "2024-05-01", "soon", 1325.0)
    b = got["s0", "102"]
    assert (b.bed_type, b.bath_count, b.sqft, b.market_rent, b.lease_rent, b.total_rent, b.base_rent) == ("2BR", 2.0, 883, 50.0, None, None, None)
    c = got["s0", "103"]
    assert (c.bed_type, c.bath_count, c.sqft, c.status, c.move_in_date, c.lease_rent, c.total_rent, c.concessions) == ("4BR", 3.5, None, "Notice", "13/45/2024", None, 870.0, -30.0)
    assert (got["s0", "105"].bed_type, got["s0", "105"].status, got["s0", "106"].bed_type, got["s0", "107"].status) == ("Studio", "", "12", "")


def test_sheets_of_other_orders_and_terminators(spark):
    """Columns in another order, a header that comes twice, and a section that ends the sheet, which keeps repeated units."""
    other = [["Unit", "Lease Rent", "Plan", "Lease Rent"], ["1", "5", "X", "7"], ["1", "6", "X", "8"], ["", " future residents"], ["2", "1", "X", "1"]]
    got = rr.standardise(sheets(spark, ROWS, other, [["no header"]]), ["sheet"], rr.load(RULES)).collect()
    assert sorted((r.unit_id, r.lease_rent) for r in got if r.sheet == "s1") == [("1", 7.0), ("1", 8.0)]
    assert len([r for r in got if r.sheet == "s0"]) == 6


def test_repeated_units_keep_the_physical_row(spark):
    """The vacant row without a lease to come, and the row that has moved in."""
    rules = {"column_mappings": {c: [c] for c in rr.CANONICAL}, "transformations": {"date_format": "%Y-%m-%d"}}
    head = ["unit_id", "status", "move_in_date", "lease_start", "lease_rent"]
    rows = [head, ["2-225", "Vacant", "", "", "0"], ["2-225", "Vacant", "", "2026-05-22", "1276"], ["8-826", "Notice", "2025-03-29", "2025-03-29", "1398"], ["8-826", "Notice", "", "2026-06-20", "1632"], ["9", "x", "", "", "1"], ["9", "x", "", "", "1"]]
    got = {r.unit_id: r for r in rr.standardise(sheets(spark, rows), ["sheet"], rules).collect()}
    assert len(got) == 3 and got["2-225"].lease_rent == 0 and got["8-826"].move_in_date == "2025-03-29" and got["9"].row_idx == 5


def test_floorplan_prefixes_ignore_variant_digits(spark):
    rules = {"column_mappings": {"unit_id": ["u"], "floorplan_code": ["p"], "bed_type": ["p"]}, "transformations": {"infer_bed_type_from_floorplan": True, "floorplan_bed_prefix_map": {"A": "1BR", "B": "2BR", "C": "3BR", "AL": "Loft"}}}
    rows = [["u", "p"], ["1", "A4 Alt 2"], ["2", "B1 Alt 1"], ["3", "c1"], ["4", "AL9"], ["5", "Q2"]]
    got = {r.unit_id: r.bed_type for r in rr.standardise(sheets(spark, rows), ["sheet"], rules).collect()}
    assert got == {"1": "1BR", "2": "2BR", "3": "3BR", "4": "Loft", "5": "Q2"}


def test_derived_status_and_summary(spark):
    rules = {"column_mappings": {"unit_id": ["u"], "resident_name": ["n"], "lease_rent": ["r"], "floorplan_code": ["p"], "market_rent": ["m"], "sqft": ["s"]}, "transformations": {"derive_status_from_name": True}}
    rows = [["u", "n", "r", "p", "m", "s"], ["1", "VACANT", "5", "a", "100", "10"], ["2", "Model", "5", "a", "101.333", "11"], ["3", "Ann", "0", "", "", ""], ["4", "Ann", "9"], ["5", "", ""]]
    units = rr.standardise(sheets(spark, rows), ["sheet"], rules)
    assert {r.unit_id: r.status for r in units.collect()} == {"1": "Vacant", "2": "Non-Revenue", "3": "Vacant", "4": "Occupied", "5": ""}
    s = {r.PlanCode: r for r in rr.plan_summary(units, ["sheet"]).collect()}
    assert (s["a"].Units, s["a"].SqFt, s["a"].AvgMarketRent, s["Unknown"].Units, s["Unknown"].SqFt) == (2, 10.0, 100.67, 3, 0.0)


def test_detect():
    configs = {"mine": rr.load(RULES), "other": {"column_mappings": {"unit_id": ["Unit"]}}}
    assert rr.detect(["Unit Code", " floor plan", "MARKET RENT", "x"], configs) == "yardi"
    assert rr.detect(HEAD, configs) == "mine" and rr.detect(["Unit", "Name"], configs) is None and rr.detect([], {}) is None


def test_errors_are_all_told():
    bad = {"column_mappings": {"unit": ["Unit"], "sqft": "SQFT"}, "row_filters": {"skip_patterns": ["("]}, "transformations": {"date_format": "%q"}, "colours": {}, "file_settings": {"header_row": -1}}
    assert len(rr.check(bad)) == 7 and rr.check([]) and not rr.check(rr.load(RULES))
    with pytest.raises(rr.RuleError, match="unknown field"):
        rr.Compiled(bad)
    with pytest.raises(rr.RuleError):
        rr.load("column_mappings: []")


def test_snapshot_and_property(spark):
    names = [("RentRoll_2025-11-26", "2025-11"), ("RentRoll11_26_2025", "2025-11"), ("roll 01152024", "2024-01"), ("roll", "2025-03")]
    df = spark.createDataFrame(names, "name string, want string").select("want", rr.snapshot_month(F.col("name"), F.lit("x As Of = 3/31/2025")).alias("got"))
    assert all(r.want == r.got for r in df.collect())
    got = rr.property_of(sheets(spark, [["Rent Roll", "The OAKS at Mill"], ["x"]], [["none"]]), ["sheet"], {"oaks": "Oaks", "mill": "Mill"}).collect()
    assert {r.sheet: r.property for r in got} == {"s0": "Oaks", "s1": None}
