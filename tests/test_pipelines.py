"""Steps over landed data."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from lodeworks.operators import pipelines as p


def test_text_steps(spark):
    page = '<script type="application/ld+json">{"address": {"streetAddress": "1 Main St", "addressLocality": "Gainesville", "addressRegion": "TX", "postalCode": "76240"}}</script>'
    rows = [(1, page), (2, '<div class="mapaddress">2 Oak</div>'), (3, "<p>at 3 Elm St, Gainesville, TX 76240 now</p>"), (4, "none"), (5, None)]
    got = {r.k: r.a for r in spark.createDataFrame(rows, "k int, h string").select("k", p.page_address(F.col("h")).alias("a")).collect()}
    assert got == {1: "1 Main St, Gainesville, TX 76240", 2: "2 Oak", 3: "3 Elm St, Gainesville, TX 76240", 4: None, 5: None}
    df = spark.createDataFrame([('```json\n{"a": 3}\n```',)], "t string")
    assert df.select(p.lenient_json(F.col("t"), "a int")["a"]).first()[0] == 3
    e = spark.createDataFrame([('[{"source": "x"}]',), ('{"rows": [{"source": ""}]}',), ("no",)], "t string").select(p.evidence_rows(F.col("t"), "struct<source:string>").alias("r"))
    assert [r.v for r in e.select(p.valid_evidence(F.col("r")).alias("v")).collect()] == [True, False, False]


def test_runs(spark):
    m = spark.createDataFrame([("a", "u"), ("b", ""), ("c", "u")], "name string, url string")
    s = spark.createDataFrame([("a", 3, "ok")], "name string, units int, status string")
    assert {r.name: (r.units, r.status) for r in p.manifest_run(m, s, "name", "url").collect()} == {"a": (3, "ok"), "b": (None, "no_url"), "c": (None, "fetch_error")}
    d = spark.createDataFrame([(datetime.date(2024, 2, 5), datetime.date(2024, 9, 27))], "f date, t date")
    assert [(r.year, r.quarter) for r in p.quarters_until(d, F.col("f"), F.col("t")).collect()] == [(2024, 1), (2024, 2)]
    c = spark.createDataFrame([("g", "1"), ("g", "2"), ("g", "3"), ("h", "1"), ("i", None)], "g string, c string")
    assert {r.g: r.status for r in p.comps_status(c, "g", "c", F.lit(True)).collect()} == {"g": "ok", "h": "needs_analyst_input", "i": "error"}
    assert p.with_distance(spark.createDataFrame([(33.0, -97.0)], "a double, b double"), "a", "b", (33.0, -97.0)).first().distance_mi == 0
