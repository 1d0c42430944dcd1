"""Sinks that replace, families of files, views of a folder, configurations."""

from __future__ import annotations

import pytest

from lodeworks.sources import readers, sinks


def test_submarkets_and_views(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 5, None)], "sub string, q int, is_forecast boolean")
    sinks.write_submarkets(df, str(tmp_path / "m"), "sub", "q")
    index = {r["sub"]: (r.actual, r.forecast, r["first"], r["last"]) for r in spark.read.option("header", True).csv(str(tmp_path / "m/index")).collect()}
    assert index == {"a": ("1", "1", "1", "2"), "b": ("1", "0", "5", "5")}
    df.write.parquet(str(tmp_path / "v/one-x.parquet"))
    df.limit(1).write.parquet(str(tmp_path / "v/two.parquet"))
    (tmp_path / "v/three.csv").write_text("x")
    views = readers.views_by_stem(spark, str(tmp_path / "v"))
    assert sorted(views) == ["one-x", "two"] and spark.sql("SELECT count(*) FROM one_x").first()[0] == 3 and readers.views_by_stem(spark, str(tmp_path / "none")) == {}


def test_forecast_family(spark, tmp_path):
    bt = spark.createDataFrame([("Ridge", 1), ("BVAR", 2), ("BVAR", 3)], "model string, q int")
    for _ in range(2):
        sinks.write_forecasts(str(tmp_path), "4_5", bt, bt, bt.limit(1))
    read = lambda p: spark.read.option("header", True).csv(str(tmp_path / p))
    assert read("v2_forecast_4_5").count() == 3 and read("v2_ensemble_4_5").count() == 1
    assert {r.v2_backtest: r["count"] for r in read("v2_backtests_4_5").groupBy("v2_backtest").count().collect()} == {"ridge_4_5": 1, "bvar_4_5": 2}


def test_replace_by_key(spark, tmp_path):
    at = str(tmp_path / "history")
    put = lambda *rows: sinks.replace_by_key(spark.createDataFrame(rows, "day string, unit string, x int"), at, "day", ["day", "unit"])
    put(("d1", "u1", 1), ("d1", "u2", 1))
    put(("d2", "u1", 2))
    put(("d1", "u9", 3))
    assert [tuple(r) for r in spark.read.parquet(at).orderBy("day", "unit").collect()] == [("d1", "u9", 3), ("d2", "u1", 2)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["history"]


def test_subject_floorplans_and_configs(spark):
    df = spark.createDataFrame([("A1", None, "1BR", "10", "$1,000", "1,500"), (None, "B1", None, "5", "x", "1"), ("C", None, None, "5", "600", "700")], "PlanCode string, Floorplan string, Beds string, Units string, SqFt string, MarketRent string")
    assert [tuple(r) for r in readers.subject_floorplans(df).collect()] == [("A1", "1BR", 10.0, 1000.0, 1500.0), ("C", None, 5.0, 600.0, 700.0)]
    assert readers.checked_config("a: {b: 1}\nc: x", ["a.b", "c"])["a"]["b"] == 1
    with pytest.raises(ValueError, match="a.z, d"):
        readers.checked_config("a: {b: 1}", ["a.z", "d", "a.b"])
