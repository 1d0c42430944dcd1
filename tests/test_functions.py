"""Scalar functions and validation: golden values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodeworks.functions import text as fn
from lodeworks.functions import validate as val


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("123 Main St., Gainesville, TX 76240", "123 main street"), ("  123  N.  Main  St  ", "123 north main street"), ("456 W. Elm Ave., Suite 200", "456 west elm avenue"),
        ("789 SE 4th Pl.", "789 southeast 4th place"), ("   ", None), (None, None), ("12 Oak Terr Apt. 5", "12 oak terrace"), ("9 Kings Way, Unit. 7-B, TX", "9 kings way"),
        ("1 Cafe\u0301 St", "1 caf\u00e9 street"), ("5 Elm Sq, USA", "5 elm usa"),
    ],
)
def test_address(spark, raw, want):
    assert one(spark, fn.address_normalise, raw) == want


def test_address_parts(spark):
    p = one(spark, fn.address_parts, "123 Main St #4B, Gainesville, TX 76240")
    assert (p.number, p.token, p.unit, p.zip) == ("123", "main", "4b", "76240")
    p = one(spark, fn.address_parts, "1 Oak St, TX 76240, USA")
    assert (p.number, p.token, p.unit, p.zip) == ("1", "oak", None, "76240")
    p = one(spark, fn.address_parts, "7 St Apt. 9")
    assert (p.number, p.token, p.unit, p.zip) == ("7", "street", "9", None)
    assert tuple(one(spark, fn.address_parts, "PO Box 1")) == (None, None, None, None)


def test_unit_pattern_eats_inside_words(spark):
    assert one(spark, fn.address_normalise, "1200 webster street") == "1200 web street"


@pytest.mark.parametrize(("raw", "want"), [("KARL KLEMENT L.L.C.", "karl klement"), ("FOO BAR & ASSOCIATES", "foo bar associates"), ("XYZ TRUST", "xyz"), ("LLC", ""), (None, ""), ("O'Brien Partners Tr", "o'brien"), ("Smith Trustee, et al.", "smith trustee et al"), ("A & B Limited L.P.", "a b limited")])
def test_owner(spark, raw, want):
    assert one(spark, fn.owner_normalise, raw) == want


@pytest.mark.parametrize(("raw", "want"), [("$1,250.50", 1250.5), ("(50)", 50.0), ("1-2", None), ("", None), (None, None)])
def test_currency(spark, raw, want):
    assert one(spark, fn.currency, raw) == want


@pytest.mark.parametrize(("raw", "want", "kind"), [("2025 Q3", 2025 * 4 + 2, "actual"), ("2026 Q1 EST", 2026 * 4, "forecast"), ("2026 Q1 QTD", 2026 * 4, "actual"), ("January 2025", None, None)])
def test_quarter(spark, raw, want, kind):
    assert one(spark, fn.quarter, raw) == want
    assert one(spark, fn.quarter_kind, raw) == kind


@pytest.mark.parametrize(("raw", "want"), [("19100", "C1910"), ("12420", "C1242"), ("C1910", "C1910"), ("x", None)])
def test_area_code(spark, raw, want):
    assert one(spark, fn.area_code, raw) == want


def test_small_ones(spark):
    assert one(spark, fn.slug, "4 & 5 Star") == "4_5_star"
    assert one(spark, fn.slug, "All") == "all"
    assert one(spark, lambda c: fn.iso_date(c), "3/29/2025") == "2025-03-29"
    assert one(spark, lambda c: fn.iso_date(c), "soon") == "soon"
    assert one(spark, lambda c: fn.iso_date(c, lenient=True), "soon") is None
    assert one(spark, fn.free_months, "8 weeks free or 1 month free") == round(8 / 4.33, 2)
    assert one(spark, fn.free_months, None) == 0.0
    assert one(spark, fn.beds, "Studio A") == 0 and one(spark, fn.beds, "2 bed") == 2
    assert one(spark, fn.strip_tags, "<p>a &amp; b</p><script>x</script>") == "a & b"
    assert one(spark, fn.natural_key, "A10") > one(spark, fn.natural_key, "A9")
    assert one(spark, lambda c: fn.size_class(c), 3, "int") == "mf-small"
    assert one(spark, lambda c: fn.number_or(c, 0, "int"), "$1,200") == 1200 and one(spark, lambda c: fn.number_or(c, 7), "n/a") == 7.0
    assert one(spark, lambda c: fn.longest_prefix(c, {"A": "1BR", "A4": "4"}), "a4 Alt 2") == "4"
    assert one(spark, lambda c: fn.unslug(c, {"Mckinney": "McKinney"}), "north_mckinney") == "North McKinney"
    assert one(spark, lambda c: fn.bed_bath(c), "2/1.5") == (2, 1.5)
    assert one(spark, fn.nan_to_null, float("nan"), "double") is None


def test_haversine(spark):
    d = spark.range(1).select(fn.haversine_miles(F.lit(32.78), F.lit(-96.8), F.lit(33.63), F.lit(-97.13)).alias("d")).first()[0]
    assert 60 < d < 63


@pytest.mark.parametrize(("value", "want"), [(0.20, 0), (0.02, 25), (0.095, 12), (0.1499, 1), (None, 12)])
def test_dimension_score(spark, value, want):
    assert one(spark, lambda c: fn.dimension_score(c, 0.15, 0.04, 25), value, "double") == want


def test_range_validate(spark):
    df = spark.createDataFrame([(50_000.0, 99, 1.0, 900), (1200.0, 2, 1.0, -100), (None, 0, 1.0, 500)], "asking_rent double, beds int, baths double, sqft int")
    rows = val.range_validate(df).collect()
    assert rows[0].asking_rent is None and rows[0].beds is None and set(rows[0].issues) == {"asking_rent_out_of_range", "beds_out_of_range"}
    assert rows[1].sqft is None and rows[1].beds == 2
    assert rows[2].issues == []


def test_panel_gates(spark):
    rows = [(q, 0.1, 0.02) for q in range(45)]
    gate = lambda r: val.panel_gates(spark.createDataFrame(r, "q int, v double, g double"), "q", "v", "g").first().reason
    assert gate(rows) is None
    assert gate(rows[:20]) == "Insufficient history"
    assert gate([(q, 0.65, g) for q, _, g in rows]) == "Vacancy out of plausible range"
    assert gate([r for r in rows if r[0] not in (3, 5, 7)]) == "Too many gaps"


def test_report_and_gate(spark):
    df = spark.createDataFrame([(1, None, "2024-01-01"), (2, "x", "1/2/24")], "id int, name string, day string")
    assert sorted(map(tuple, val.validation_report(df, "id", ["name"], ["day"]).collect())) == [(1, "name", "missing"), (2, "day", "not_iso")]
    g = spark.createDataFrame([(100, 5, 2), (100, 4, 2), (10, 1, 1)], "u int, p int, k int").select(val.quality_gate(F.col("u"), F.col("p"), F.col("k")).alias("g"))
    assert [r.g for r in g.collect()] == [True, False, False]


def test_house_numbers_of_five_digits_are_no_zips(spark):
    p = one(spark, fn.address_parts, "12345 N. Oak St, Apt. 4, Gainesville, TX 76240")
    assert (p.number, p.token, p.unit, p.zip) == ("12345", "oak", "4", "76240")
    p = one(spark, fn.address_parts, " 12345 Elm St")
    assert (p.number, p.token, p.zip) == ("12345", "elm", None)
    assert one(spark, fn.address_parts, "76240, Gainesville").zip == "76240" and one(spark, fn.zip_code, "76240-1234 TX") == "76240"


@pytest.mark.parametrize(("text", "want"), [("l'éthe und", "weak:the+und"), ("the_ und", None), ("THE Und", "weak:the+und"), ("for ſale", "sale")])
def test_weak_patterns_have_ascii_boundaries(spark, text, want):
    from lodeworks.functions import validate

    assert one(spark, lambda c: validate.strong_or_weak(c, [("sale", "(?i)for sale")], [("the", r"(?i)\bthe\b"), ("und", r"(?i)\bund\b")]), text) == want
