"""Units of charge ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.operators import ledgers


def test_ledger_units(spark):
    rows = [("101", "A1", "$700", "1,200.50", True), (" UTRSH ", "A1", "700", "1", False), ("Future 7", "A1", "700", "1", False), ("102", " ", "700", "1", False), ("103", "A1", "x", "1", False), ("104", "A1", "700", None, False), ("B-9", "A1", "1", "1", False), (None, "A", "1", "1", False)]
    df = spark.createDataFrame(rows, "u string, p string, s string, r string, want boolean")
    got = df.select("want", ledgers.ledger_unit(*(F.col(c) for c in "upsr"), ["future"], ["utrsh", "garage"], [r"\d+$"]).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_listed_units_end_with_their_section(spark):
    rows = [("s", 0, "Unit"), ("s", 1, "101"), ("s", 2, "A102"), ("s", 3, "1-2"), ("s", 4, "103 Total"), ("s", 5, None), ("s", 6, "Future Applicants"), ("s", 7, "104"), (None, 0, "7"), (None, 1, "1-2")]
    df = spark.createDataFrame(rows, "sheet string, row_idx int, unit string")
    take = lambda **k: sorted((str(r.sheet), r.row_idx) for r in ledgers.listed_units(df, ["sheet"], "unit", skip=["total"], stop=["applicants"], **k).collect())
    assert take() == [("None", 0), ("s", 1), ("s", 2)] and take(dash=True) == [("None", 0), ("None", 1), ("s", 1), ("s", 2), ("s", 3)]


def test_unit_number(spark):
    df = spark.createDataFrame([("101", 101), (" 209.0", 209), ("99", None), ("301", None), ("300.9", 300), ("x", None), (None, None), ("NaN", None)], "c string, want int")
    assert all(r.want == r.got for r in df.select("want", ledgers.unit_number(F.col("c")).alias("got")).collect())
