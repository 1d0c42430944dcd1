"""Sources, sinks and streams over small files."""

from __future__ import annotations

import json

import pytest

from lodeworks.sources import readers, sinks
from lodeworks.streaming import listings


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿zip , rent\n76240,1450\n76241,x\n")
    rows = readers.read_csv(spark, str(tmp_path / "a.csv"), "zip string, rent double, more int").orderBy("zip").collect()
    assert [tuple(r) for r in rows] == [("76240", 1450.0, None), ("76241", None, None)]
    (tmp_path / "b.jsonl").write_text('{"metric": "m", "value": 1.5, "extra": 3}\n\n{"metric": "n", "value": 2}\n')
    (tmp_path / "c.json").write_text(json.dumps([{"metric": "o", "value": 3.0}]))
    got = readers.load_records(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "c.json")])
    assert sorted((r.metric, r.value, r.as_of) for r in got.collect()) == [("m", 1.5, None), ("n", 2.0, None), ("o", 3.0, None)]
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.pdf")
    with pytest.raises(ValueError):
        readers.required(got, ["metric", "nothing"])
    (tmp_path / "s.csv").write_text('Title\nUnit,Rent\n101,"1,200"\n')
    sheet = readers.read_sheet(spark, str(tmp_path / "s.csv")).orderBy("row_idx").collect()
    assert [r.cells for r in sheet] == [["Title"], ["Unit", "Rent"], ["101", "1,200"]]
    assert readers.read_binary(spark, str(tmp_path), "*.json").first().length > 0
    assert readers.read_documents(spark, str(tmp_path), "*.json").count() == 1


def test_latest_snapshot(spark, tmp_path):
    for day, v in (("2025-01-01", 1), ("2025-02-01", 2)):
        spark.createDataFrame([(v,)], "v int").toPandas().to_parquet(tmp_path / f"dallas_{day}.parquet")
    assert [r.v for r in readers.latest_snapshot(spark, str(tmp_path), "Dallas-Fort Worth").collect()] == [2]


def test_sinks(spark, tmp_path):
    at = str(tmp_path / "h")
    df = lambda rows: spark.createDataFrame(rows, "unit string, rent int, snapshot_date string")
    sinks.replace_partitions(df([("1", 5, "2025-01"), ("1", 6, "2025-02")]), at, "snapshot_date", ["unit"])
    sinks.replace_partitions(df([("1", 7, "2025-02")]), at, "snapshot_date")
    assert sorted((r.rent, str(r.snapshot_date)[:7]) for r in spark.read.parquet(at).collect()) == [(5, "2025-01"), (7, "2025-02")]
    at = str(tmp_path / "p")
    sinks.append_absent(df([("1", 5, "d"), ("1", 4, "d")]), at, ["unit"], "rent")
    sinks.append_absent(df([("1", 9, "d"), ("2", 3, "d")]), at, ["unit"], "rent")
    assert sorted((r.unit, r.rent) for r in spark.read.parquet(at).collect()) == [("1", 4), ("2", 3)]
    sinks.write_any(df([("1", 5, "d")]), str(tmp_path / "x.jsonl"))
    assert readers.read_any(spark, str(tmp_path / "x.jsonl")).count() == 1
    sinks.log_event(spark, str(tmp_path / "log"), "run_start", run="r1")
    assert spark.read.json(str(tmp_path / "log")).first().event == "run_start"


def test_streams(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "1.json").write_text('{"k": 1, "v": "b", "at": "2025-01-01T00:00:00Z"}\n{"k": 1, "v": "a", "at": "2025-01-01T00:00:00Z"}\n{"k": 2, "v": "c", "at": "2025-01-02T00:00:00Z"}\n')
    stream = lambda: spark.readStream.schema("k int, v string, at timestamp").json(str(src))
    for _ in range(2):
        q = listings.append_once(stream(), out, str(tmp_path / "cp"), ["k"], "v")
        q.awaitTermination(60)
        (src / "2.json").write_text('{"k": 2, "v": "z", "at": "2025-01-03T00:00:00Z"}\n{"k": 3, "v": "d", "at": "2025-01-03T00:00:00Z"}\n')
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    q = listings.counts(listings.fresh(stream(), "k", "at"), "at", "k", late=None).writeStream.format("memory").queryName("n").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("n").columns == ["start", "k", "n"]
