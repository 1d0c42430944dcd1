"""Comparable properties: nulls, ties and missing parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.operators import comps


def test_flags(spark):
    rows = spark.createDataFrame([("1BR", 1), ("1BR", 2), ("2BR", 1), ("2BR", 2), ("2BR", 3), (None, 1)], "c string, x int")
    assert {r.c: r.flag for r in comps.thin_cohorts(rows, "c").collect()} == {"1BR": "thin_cohort_1BR_only_2_comps", None: None}
    units = spark.createDataFrame([("Oak Park", "om_floorplan"), ("Oak Park", "om_floorplan"), ("Pine", "om_floorplan"), ("Pine", None), (None, "om_floorplan")], "comp string, quality string")
    assert {r.flag for r in comps.single_evidence(units, "comp", "quality").collect()} == {"om_only_comp_oak_park", "om_only_comp_unknown_comp"}


def test_overview_and_merge(spark):
    df = spark.createDataFrame([(None, [(None,), (5.0,), (3.0,)], None, 9.0), (7, None, None, None), (None, [], 1.0, None)], "n int, u array<struct<rent:double>>, lo double, hi double")
    got = [tuple(r.x) for r in df.select(comps.overview(F.col("n"), F.col("u"), F.col("lo"), F.col("hi")).alias("x")).collect()]
    assert got == [(3, 3.0, 9.0), (7, None, None), (0, 1.0, None)]
    snap = spark.createDataFrame([("a", ["p"], None, "x", 1), ("b", ["p"], ["s"], "x", 2), (None, ["p"], ["s"], "x", 3)], "slug string, floorplans array<string>, specials array<string>, platform string, k int")
    found = spark.createDataFrame([("a", ["q"], ["t", "t"], None), ("b", [], ["t"], "y"), ("z", ["q"], [], "y")], "slug string, floorplans array<string>, specials array<string>, platform string")
    got = {r.k: (r.floorplans, r.specials, r.platform, r.extracted) for r in comps.merge_extractions(snap, found, "slug").collect()}
    assert got == {1: (["q"], ["t"], "llm_extracted", True), 2: (["p"], ["s"], "x", False), 3: (["p"], ["s"], "x", False)}


def test_choices(spark):
    rows = spark.createDataFrame([("u", 1, "aa"), ("u", 2, "bb"), ("u", 3, None), ("v", 1, "")], "url string, n int, body string")
    assert {r.url: (r.n, r.body) for r in comps.largest_payload(rows, ["url"], "body", "n").collect()} == {"u": (1, "aa"), "v": (1, "")}
    zips = spark.createDataFrame([("1",), ("2",), (None,), ("",)], "z string")
    assert [r.z for r in zips.where(comps.in_catchment(F.col("z"), ["1"])).collect()] == ["1", None, ""]
    obs = spark.createDataFrame([("c", 1.0, 5.0), ("c", 2.0, 4.0), ("c", 9.0, None), ("d", None, None)], "c string, lat double, lon double")
    assert [tuple(r) for r in comps.places(obs, "c").collect()] == [("c", 2.0, 5.0)]
