"""Aggregations, joins, windows, reshaping, entity resolution, panels, models, rent rolls, extraction."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeworks.operators import aggregates as agg
from lodeworks.operators import entity, extract, joins, models, panels, rent_roll, reshape
from lodeworks.operators import windows as win
from lodeworks.operators.shared import components


def test_universe_and_quartiles(spark):
    df = spark.createDataFrame([(80, True), (12, False), (4, True)], "units int, city boolean")
    assert tuple(agg.universe_summary(df, "units", F.col("city")).first()) == (3, 96, 2, 84)
    rents = spark.createDataFrame([(2, float(r), 800.0) for r in range(1000, 1500, 100)], "beds int, rent double, sqft double")
    r = agg.quartiles(rents, ["beds"], "rent", "sqft").first()
    assert (r.n, r.p25, r.p50, r.p75) == (5, 1100, 1200, 1300)


def test_concentration_and_flows(spark):
    o = spark.createDataFrame([("a", 100), ("a", 80), ("b", 50)], "owner string, units int")
    assert tuple(agg.concentration(o, "owner", F.col("units"), 1).first()) == ("a", 180, 2)
    i = spark.createDataFrame([("06037", 1098, 129_472_000)], "k string, h long, agi long")
    u = spark.createDataFrame([("06037", 900, 63_900_000)], "k string, h long, agi long")
    r = agg.flows_net(i, u, "k", ["h", "agi"], 5).first()
    assert (r.in_h, r.net_h, r.net_agi) == (1098, 198, 65_572_000)


def test_rollups(spark):
    u = spark.createDataFrame([(1, 1.0, 700.0, 1500.0, "A1"), (1, 1.0, 700.0, 1550.0, "A1"), (2, 2.0, 900.0, 0.0, "B"), (2, 2.0, 900.0, 5.0, "C")], "beds int, baths double, sqft double, rent double, name string")
    rows = {r.beds: r for r in agg.signature_rollup(u, "beds", "baths", "sqft", "rent", "name").collect()}
    assert (rows[1].plan, rows[1].available, rows[1].rent_min, rows[1].rent_max) == ("A1", 2, 1500, 1550)
    assert (rows[2].plan, rows[2].rent_min) == ("2BR/2BA 900 SF", 5)
    p = spark.createDataFrame([(1, "A", 1, 0.0, 700.0, 3, 1600.0, 1700.0), (2, "a", 1, 1.0, 700.2, 7, 1500.0, 1800.0)], "o int, name string, beds int, baths double, sqft double, available int, rent_min double, rent_max double")
    r = agg.partial_merge(p, "o").first()
    assert (r.available, r.rent_min, r.rent_max, r.baths) == (7, 1500, 1800, 1.0)


def test_errors_and_moments(spark):
    e = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (5.0, 3.0)], "a double, p double")
    r = agg.error_metrics(e, [], "a", "p").first()
    assert (r.n, r.rmse, r.mae, r.med_ae, r.max_ae) == (3, 1.291, 1.0, 1.0, 2.0)
    x = np.random.default_rng(0).gamma(2, size=50)
    d = agg.descriptives(spark.createDataFrame([(float(v),) for v in x], "v double"), [], "v").first()
    import pandas as pd

    assert abs(d["skew"] - pd.Series(x).skew()) < 1e-3 and abs(d["kurt"] - pd.Series(x).kurt()) < 1e-3


def test_charges(spark):
    rows = [(1, "0111", "", ""), (2, "", "rent", "1,200.00"), (3, "", "pet fee", "25"), (4, "", "concession", "(10)"), (5, "0112", "", ""), (6, "", "garage", "7")]
    df = spark.createDataFrame([("p", *r) for r in rows], "property string, row_idx int, unit string, text string, amount string")
    out = {r._unit: r for r in rent_roll.ledger(df, "unit", "text", "amount", [("rent", "rent"), ("pet", "pet"), ("concession", "concession")], ["property"]).collect()}
    assert (out["p|0111"].rent, out["p|0111"].pet, out["p|0111"].concession) == (1200.0, 25.0, 10.0) and out["p|0112"].other == 7.0


def test_band_join_is_the_theta_join(spark):
    rng = random.Random(0)
    a = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(150)]
    b = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(150)] + [(999, None, 0.0)]
    got = joins.band_join(spark.createDataFrame(a, "i int, x double, y double"), spark.createDataFrame(b, "j int, u double, v double"), [("x", "u"), ("y", "v")], 0.05)
    want = {(i, j) for i, x, y in a for j, u, v in b if u is not None and abs(x - u) < 0.05 and abs(y - v) < 0.05}
    rows = [(r.i, r.j) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) and want


def test_fallback_and_nearest(spark):
    left = spark.createDataFrame([(1, 2, 2.0, 900.0), (2, 3, 1.0, 900.0)], "k int, beds int, baths double, sqft double")
    right = spark.createDataFrame([(10, 2, 2.0, 800.0), (11, 2, 1.0, 901.0), (12, 3, 2.0, 950.0)], "id int, b int, c double, s double")
    got = joins.fallback_nearest(left, right, "k", ("beds", "b"), ("baths", "c"), "sqft", "s", "id", 8)
    assert sorted((r.k, r.id) for r in got.collect()) == [(1, 10), (2, 12)]
    near = joins.nearest(left, right, "k", [("beds", "b")], "sqft", "s", "id").collect()
    assert sorted((r.k, r.id) for r in near) == [(1, 11), (2, 12)]


def test_inserts(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, joins.insert_if_absent(old, new, ["k"], "v").collect())) == [(2, "c")]
    assert sorted(map(tuple, joins.upsert(old, new, ["k"]).collect())) == [(1, "b"), (2, "c"), (2, "d")]
    assert joins.full_refresh(old, new, F.col("v") == "a").count() == 3


def test_windows(spark):
    df = spark.createDataFrame([("a", q, None if q % 3 else float(q)) for q in range(10)], "k string, q int, v double")
    w = Window.partitionBy("k").orderBy("q")
    rows = df.select("q", win.ffill("v", w).alias("f"), win.guarded_mean("v", win.running(w), 2).alias("m")).orderBy("q").collect()
    assert [r.f for r in rows] == [0, 0, 0, 3, 3, 3, 6, 6, 6, 9] and rows[2].m is None and rows[3].m == 1.5
    s = spark.createDataFrame([(1, "x"), (2, "start"), (3, "a"), (4, "stop"), (5, "b"), (6, "start"), (7, "c")], "i int, t string").withColumn("k", F.lit(1))
    assert [r.i for r in win.section_on(s, ["k"], "i", F.col("t") == "start", F.col("t") == "stop").where("inside").orderBy("i").collect()] == [3, 7]


@pytest.mark.parametrize(("status", "days", "want"), [("active", 35, "inactive_30d"), ("inactive_30d", 70, "rented_or_pulled"), ("active", 70, "rented_or_pulled"), ("active", 30, "active"), ("gone", 90, "gone")])
def test_lifecycle(spark, status, days, want):
    df = spark.createDataFrame([(status,)], "s string")
    assert df.select(win.lifecycle(F.col("s"), F.date_sub(F.lit("2025-06-01").cast("date"), days), F.lit("2025-06-01").cast("date"))).first()[0] == want


def test_chunks(spark):
    t = " ".join(str(i) for i in range(500))
    got = [r.text for r in win.chunks(spark.createDataFrame([(1, t + "  \n"), (2, ""), (3, None)], "k int, t string"), "k", "t").orderBy("chunk").collect()]
    want = [t[i : i + 800] for i in range(0, len(t), 680) if i == 0 or i + 120 < len(t)]
    assert got == want


def test_run_id(spark):
    runs = lambda *r: spark.createDataFrame([(x,) for x in r], "r string")
    ids = [win.next_run_id(runs(*r), "r", "2025-W01").first()[0] for r in (("x",), ("2025-W01",), ("2025-W01", "2025-W01__r2", "2025-W01__r4"))]
    assert ids == ["2025-W01", "2025-W01__r2", "2025-W01__r3"]


def test_reshape(spark):
    df = spark.createDataFrame([("76240", 1450.0, None, "n")], ["zip", "2024-01-31", "2024-02-29", "name"], verifySchema=False) if False else spark.sql("SELECT '76240' zip, 1450.0D `2024-01-31`, CAST(NULL AS DOUBLE) `2024-02-29`, 'n' name")
    assert [tuple(r) for r in reshape.unpivot_dates(df, ["zip"]).collect()] == [("76240", "2024-01-31", 1450.0)]
    x = spark.createDataFrame([(1, 2), (2, None), (3, 0)], "k int, n int")
    assert sorted((r.k, r["copy"]) for r in reshape.expand(x, F.col("n")).collect()) == [(1, 1), (1, 2)]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    parent = list(range(60))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def obs(spark, rows):
    return spark.createDataFrame(rows, "ord long, addr string, beds double, baths double, zip string, number string, token string, lat double, lon double, rent double, sqft double, day string, source string")


def test_fold_cases(spark):
    rows = [
        (1, "1 main street", 2.0, 1.0, "76240", "1", "main", 33.6, -97.1, 1200.0, 800.0, "2025-01-01", "a"), (2, "9 oak street", 2.0, 1.0, "76240", "9", "oak", 33.9, -97.5, 1000.0, None, "2025-01-01", "a"),
        (3, "1 main street", 2.0, 1.0, "76240", "1", "main", None, None, 1250.0, None, "2025-01-08", "b"), (4, None, 2.0, 1.0, None, None, None, 33.6002, -97.1002, 1200.0, None, "2025-01-08", "b"),
        (5, "1 main street", None, 1.0, "76240", "1", "main", None, None, 900.0, None, "2025-01-08", "b"), (6, "1 main street", 2.0, 2.0, "76240", "1", "main", None, None, 1300.0, None, "2025-01-09", "c"),
    ]
    o = obs(spark, rows)
    f = entity.fold(o)
    got = {r.ord: (r.action, r.canonical, r.tier) for r in f.collect()}
    assert got == {1: ("new", 1, None), 2: ("new", 2, None), 3: ("merged", 1, "strict"), 4: ("review", 1, "near"), 5: ("new", 5, None), 6: ("merged", 1, "flex")}
    c = {r.canonical: r for r in entity.canonical(o, f).collect()}
    assert (c[1].rent, c[1].min_rent, c[1].max_rent, c[1].sqft, c[1].sources, c[1].confidence) == (1300.0, 1200.0, 1300.0, 800.0, ["a", "b", "c"], 0.92)
    d = entity.apply_decisions(f, spark.createDataFrame([(4, "merge_into:2")], "ord long, decision string"))
    assert [(r.action, r.canonical, r.manual_override) for r in d.where("ord = 4").collect()] == [("merged", 2, True)]
    assert entity.review_queue(f).count() == 1


def test_fold_equals_one_global_fold(spark):
    import pandas as pd

    rng = random.Random(9)
    rows = []
    for i in range(150):
        n, tok, z = str(rng.randint(1, 12)), rng.choice(["main", "oak"]), rng.choice(["76240", "76241"])
        addr = rng.choice([f"{n} {tok} street", f"{n} {tok}", None])
        here = rng.random() < 0.5
        rows.append((i, addr, rng.choice([1.0, 2.0, None]), rng.choice([1.0, 2.0]), z, n, tok, 33 + rng.randint(0, 40) / 2000 if here else None, -97.0 if here else None, 1.0, 1.0, "d", "s"))
    o = obs(spark, rows)
    whole = entity._fold(pd.DataFrame([r[:9] for r in rows], columns=["ord", "addr", "beds", "baths", "zip", "number", "token", "lat", "lon"]))
    got = sorted((r.ord, r.action, r.canonical) for r in entity.fold(o).collect())
    assert got == sorted(zip(whole.ord, whole.action, whole.canonical, strict=True))


def plain_fold(rows):
    """Every canonical listing tried for every observation, in the order of their creation."""
    canon, out = [], []
    for i, addr, beds, baths, z, n, tok, lat, lon in rows:
        tests = [
            lambda c: None not in (addr, baths) and c["addr"] == addr and c["baths"] == baths, lambda c: addr is not None and c["addr"] == addr,
            lambda c: None not in (z, n, tok) and c["zip"] == z and (c["addr"] or "").startswith(f"{n} {tok}"),
            lambda c: None not in (lat, lon) and any(abs(a - round(lat, 3)) < entity.BOX and abs(b - round(lon, 3)) < entity.BOX for a, b in c["at"]),
        ]
        hit, tier = next(((c, k) for k, t in enumerate(tests) for c in canon if beds is not None and c["beds"] == beds and t(c)), (None, None))
        here = [(lat, lon)] if None not in (lat, lon) else []
        if hit is None:
            canon.append({"id": i, "addr": addr, "beds": beds, "baths": baths, "zip": z, "at": here})
            out.append((i, "new", i))
        else:
            if tier < 2:
                hit["at"] += here
            out.append((i, "merged" if tier < 2 else "review", hit["id"]))
    return out


def random_observations(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        num, tok, z = str(rng.randint(1, 12)), rng.choice(["main", "oak"]), rng.choice(["76240", "76241", None])
        addr = rng.choice([f"{num} {tok} street", f"{num} {tok}", f"{num}b {tok}", None])
        here = rng.random() < 0.6
        rows.append((i, addr, rng.choice([1.0, 2.0, None]), rng.choice([1.0, 2.0, None]), z, num, rng.choice([tok, tok[:2], None]), 33 + rng.randint(0, 400) / 20_000 if here else None, -97.0 + rng.randint(0, 3) / 3000 if here else None))
    return rows


FOLDED = "ord long, addr string, beds double, baths double, zip string, number string, token string, lat double, lon double"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_plain(spark, seed):
    rows = random_observations(seed, 400)
    got = sorted((r.ord, r.action, r.canonical) for r in entity.fold(spark.createDataFrame(rows, FOLDED)).collect())
    assert got == plain_fold(rows)


def test_ledger_runs_equal_one(spark, tmp_path):
    """Observations landed in three parts, one of them twice; a run that was cut off is done again."""
    rows = random_observations(7, 300)
    whole = plain_fold(rows)
    ledger = entity.Ledger(spark, str(tmp_path / "ledger"))
    for part in (rows[:120], rows[:200], rows[:200], rows):
        ledger.run(spark.createDataFrame(part, FOLDED))
        done = sorted((r.ord, r.action, r.canonical) for r in ledger.decisions().collect())
        assert done == whole[: len(part)]
    assert {r.id for r in ledger.listings().collect()} == {i for i, a, _ in whole if a == "new"}
    spark.createDataFrame([(5,)], "ord long").write.parquet(str(tmp_path / "ledger/run=4/decisions"))  # cut off: no listings
    ledger.run(spark.createDataFrame(rows, FOLDED))
    assert sorted((r.ord, r.action, r.canonical) for r in ledger.decisions().collect()) == whole


def test_fold_of_a_hot_address_is_linear():
    import time

    import pandas as pd

    def took(n):
        rows = [(i, f"1 main street{i % 2 * (i // 1000)}", 2.0, 1.0, "76240", "1", "main", 33 + i % 977 * 1e-6, -97 - i % 991 * 1e-6) for i in range(n)]
        began = time.process_time()
        got = entity._fold(pd.DataFrame(rows, columns=entity._COLUMNS))
        assert len(got) == n and (got.action == "new").sum() < n / 500
        return time.process_time() - began

    small, large = took(10_000), took(100_000)
    assert large < 40 * small


def test_renormalise(spark):
    rows = [("12 Main St.", "old", 0), ("12 Main St.", "kept", entity.ADDRESS_VERSION), ("12 Main St.", None, None)]
    got = entity.renormalise(spark.createDataFrame(rows, "address string, addr string, addr_version int")).collect()
    assert got[1].addr == "kept" and got[0].addr == got[2].addr != "old" and {r.addr_version for r in got} == {entity.ADDRESS_VERSION}


def test_closed_brackets(spark):
    """Nested arrays, brackets and escaped quotes in strings, cut-off values, and long ones."""
    long = '["' + "x" * 300_000 + '", "' + '\\"]' * 30_000 + '"]'
    rows = [('[1,[2,{"a":[]}],3] rest]', '[1,[2,{"a":[]}],3]'), ('{"a":"]}","b":"\\"}"} x', '{"a":"]}","b":"\\"}"}'), ("[1,[2]", None), ('["', None), ("[]", "[]"), (long + ";]", long), (None, None), ("x", None)]
    got = spark.createDataFrame(rows, "text string, want string").select("want", extract.closed(F.col("text")).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    page = [('<script>a=[1]; "floorplans" : [{"n":"]"},[0]]; "floorplans":[2]', '[{"n":"]"},[0]]'), ('"floorplans": ' + " " * 99 + "[1]", None), ("none", None)]
    got = spark.createDataFrame(page, "text string, want string").select("want", extract.behind(F.col("text"), '"floorplans"').alias("got")).collect()
    assert all(r.want == r.got for r in got)
    doc = [('x=[[5],[{"m":[1,{"MinRent":"7"}]},{"MinRent":9,"Name":"a]b"}]]', 9), ('[{"MinRent":1}', None), ('"MinRent"', None), ("", None)]
    read = extract.around(F.col("text"), '"MinRent"', "array<struct<MinRent:int>>", lambda x: F.exists(x, lambda p: p["MinRent"] == 9))
    got = spark.createDataFrame(doc, "text string, want int").select("want", F.array_max(F.transform(read, lambda p: p["MinRent"])).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_links(spark):
    reg = spark.createDataFrame([("p1", 1, "1 main street", 33.0, -97.0), ("p2", 2, "1 main street", 33.1, -97.0), ("p3", 3, None, 33.2, -97.0)], "property_id string, property_ord int, addr string, lat double, lon double")
    lst = spark.createDataFrame([(1, "1 main street", None, None), (2, "x", 33.2002, -97.0001), (3, None, 10.0, 10.0)], "listing_id int, addr string, lat double, lon double")
    assert {r.listing_id: r.property_id for r in entity.link_properties(lst, reg).collect()} == {1: "p2", 2: "p3", 3: None}


def panel_rows(**more):
    """50 actual quarters and 6 forecast ones of a steady market."""
    return [{"m": "a", "q": q, "is_forecast": q >= 50, "inventory_units": 1000.0, "vacancy_rate": 0.08, "stabilized_vacancy": 0.07, "under_construction": 20.0, "deliveries": 5.0, "deliveries_12mo": 20.0, "absorption_units_12mo": 40.0, "effective_rent_growth_yoy": 0.04} | more for q in range(56)]


PANEL = "m string, q int, is_forecast boolean, inventory_units double, vacancy_rate double, stabilized_vacancy double, under_construction double, deliveries double, deliveries_12mo double, absorption_units_12mo double, effective_rent_growth_yoy double"


def scored(spark, **more):
    return panels.risk_score(panels.submarket_panel(spark.createDataFrame(panel_rows(**more), PANEL), ["m"]), ["m"]).first()


def test_risk_score(spark):
    good = scored(spark)
    assert (good.score, good.verdict, good.as_of) == (100, "PROCEED", 49)
    deep = scored(spark, under_construction=150.0)
    assert deep.pipeline_depth_score == 0 and deep.score == 75
    edge = scored(spark, under_construction=50.0, effective_rent_growth_yoy=0.0)  # at the moderate thresholds
    assert (edge.pipeline_depth_score, edge.rent_momentum_score) == (24, 25)
    bad = scored(spark, under_construction=200.0, deliveries=30.0, absorption_units_12mo=10.0, effective_rent_growth_yoy=-0.05)
    assert (bad.score, bad.verdict) == (0, "PASS")
    none = scored(spark, deliveries=0.0, absorption_units_12mo=-1.0, effective_rent_growth_yoy=None)
    assert (none.absorption_trend_score, none.rent_momentum_score) == (0, 12)
    only = spark.createDataFrame([r | {"is_forecast": True} for r in panel_rows()], PANEL)
    assert panels.risk_score(panels.submarket_panel(only, ["m"]), ["m"]).first().verdict == "UNKNOWN"


def test_panel(spark):
    rows = panel_rows()
    for r in rows:
        r["inventory_units"], r["vacancy_rate"] = 1000.0 * 1.01 ** r["q"], None if r["q"] == 5 else 0.10 - 0.001 * r["q"]
    got = {r.q: r for r in panels.submarket_panel(spark.createDataFrame(rows, PANEL), ["m"]).collect()}
    assert got[0].quarterly_absorption_implied is None and got[0].quarterly_excess == 5.0 and got[5].occupied_units is None
    want = 1000 * 1.01**20 * (1 - 0.08) - 1000 * 1.01**19 * (1 - 0.081)
    assert abs(got[20].quarterly_absorption_implied - want) < 1e-9 and abs(got[20].quarterly_excess - (5 - want)) < 1e-9
    assert got[7].equilibrium_vacancy is None and abs(got[8].equilibrium_vacancy - sum(0.10 - 0.001 * q for q in range(9) if q != 5) / 8) < 1e-12
    assert abs(got[20].inventory_growth_yoy - (1.01**4 - 1)) < 1e-12 and got[10].delivery_vs_organic_growth is None and got[11].delivery_vs_organic_growth is not None
    assert abs(got[11].delivery_vs_organic_growth - 20 / (1000 * 1.01**7 * (1.01**4 - 1))) < 1e-9
    usable = panels.split_actual(spark.createDataFrame([r for r in rows if r["q"] not in (3, 9)], PANEL), ["m"])
    assert {r.usable for r in usable.collect()} == {True}
    assert {r.usable for r in panels.split_actual(spark.createDataFrame([r for r in rows if r["q"] not in (3, 9, 10)], PANEL), ["m"]).collect()} == {False}
    metro = panels.metro_panel(panels.submarket_panel(spark.createDataFrame(rows, PANEL), ["m"]).union(panels.submarket_panel(spark.createDataFrame(panel_rows(), PANEL), ["m"])), ["m"])
    r = metro.where("q = 20").first()
    assert r.submarket_count == 2 and abs(r.vacancy_rate - (1000 * 1.01**20 * 0.08 + 80) / (1000 * 1.01**20 + 1000)) < 1e-12


def test_cycle_phase_and_regime(spark):
    level = lambda q: 0.05 + 0.02 * np.sin(2 * np.pi * q / 24)
    df = spark.createDataFrame([("a", q, None if q == 40 else float(level(q))) for q in range(60)] + [("b", q, 0.05) for q in range(10)], "m string, q int, v double")
    got = {(r.m, r.q): r.phase for r in win.cycle_phase(df, ["m"], "q", "v").collect()}
    assert got["a", 3] == got["a", 40] == got["a", 45] == "UNKNOWN"
    for q in (25, 30, 32):  # against the definition
        past = [level(x) for x in range(max(0, q - 19), q + 1)]
        trend = np.polyfit(range(8), [level(x) for x in range(q - 7, q + 1)], 1)[0]
        low = level(q) < np.mean(past)
        assert got["a", q] == ("EXPANSION" if low and trend <= 0 else "PEAK" if low else "CONTRACTION" if trend > 0 else "TROUGH")
    assert {got["b", q] for q in (7, 8, 9)} <= {"TROUGH", "CONTRACTION", "EXPANSION", "PEAK"}  # a level series is never below its mean by more than rounding
    flag = lambda rows: win.regime_change(spark.createDataFrame(rows, "m string, q int, v double"), ["m"], "q", "v").first().regime_change
    calm = [("a", q, 0.03 + 0.001 * (q % 2)) for q in range(30)]
    assert not flag(calm) and flag([*calm[:-1], ("a", 29, 0.2)]) and not flag(calm[:19]) and not flag([("a", q, 1.0) for q in range(30)])
    assert not flag([*calm[:20], ("a", 20, 0.2), *[("a", q, 0.03 + 0.001 * (q % 2)) for q in range(21, 30)]])  # longer ago than 4


def test_models(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, -2.0, 0.0] + 4 + rng.normal(scale=0.01, size=60)
    df = spark.createDataFrame([("g", *map(float, r), 1.0, float(v)) for r, v in zip(x, y, strict=True)], "g string, a double, b double, c double, k double, y double")
    r = models.ols(df, ["g"], "y", ["a", "b", "c", "k"]).first()
    assert np.allclose([r.a, r.b, r.c, r.k, r.intercept], [1, -2, 0, 0, 4], atol=0.02) and r.r2 > 0.999 and not r.low_confidence
    beta, c, _ = models.ridge_fit(x, y, (1e-6,))
    assert np.allclose(beta, [1, -2, 0], atol=0.02) and abs(c - 4) < 0.02
    b, _ = models.elastic_net(x, y, 0.5, 0.5)
    assert abs(b[2]) < 0.05 and b[1] < 0
    bt = models.backtest(spark.createDataFrame([("m", q, float(10 + q)) for q in range(40)], "m string, q long, v double"), ["m"], "q", "v")
    m = {r.model: r for r in models.metrics(bt, ["m"], "q").collect()}
    assert set(m) == set(models.MODELS) and abs(m["Naive"].rmse - 1) < 1e-9 and m["AR"].rmse < 1e-6 and m["Naive"].n == 28
    s = models.scenarios(spark.createDataFrame([("m", q, 0.04) for q in range(4)], "m string, q int, g double"), ["m"], "q", "g", 0.02)
    assert abs(s.where("scenario = 'base' and q = 3").first().level - 1.01**4) < 1e-12


def test_rent_roll(spark):
    cells = [["Report"], ["Unit", "Type", "Sq Ft", "Status", "Rent", "Move In"], ["101", "A4 Alt 2", "709", "Occupied-NTV", "$1,275.00", "3/29/2025"], ["101", "A4 Alt 2", "709", "Vacant", "", ""], ["", "", "", "", "", ""], ["Total", "", "", "", "9", ""], ["102", "B1", "900", "Vacant", "0", ""]]
    sheet = spark.createDataFrame(list(enumerate(cells)), "row_idx int, cells array<string>")
    rows = rent_roll.from_sheet(sheet, ["unit"])
    units = rent_roll.canonical_units(rows, {"plan_code": ["Type"], "sqft": ["Sq Ft"], "lease_rent": ["Rent"], "move_in": ["Move In"]}, {"Occupied": ["Occupied-NTV"], "Vacant": ["vacant"]}, {"A": "1BR"}, stop="Total")
    best = rent_roll.keep_best_units(units).collect()
    assert [(u.unit, u.status, u.bed_type, u.sqft, u.lease_rent, u.move_in) for u in best] == [("101", "Occupied", "1BR", 709, 1275.0, "2025-03-29")]
    assert rent_roll.find_column(["Bldg  Unit", "unit "], ["Unit", "bldg unit"]) == "unit "
    assert rent_roll.detect_config(["a", "b", "c"], {"x": ["a"], "y": ["a", "b", "c"]}) == "y"
    v = rent_roll.validate(units, 2).first()
    assert (v.units, v.count_ok, v.zero_rent) == (2, True, 0)
    assert rent_roll.contiguous_prefix(sheet, F.get("cells", F.lit(0)), r"^\d+$", 2).count() == 2


def test_extract(spark):
    html = '<html><title> A  B </title><a href="/x">go</a><p>one</p><p>two</p><script type="application/ld+json">{"name": "N", "n": 3}</script><script>var plans = [{"name": "A1", "beds": 1}];</script></html>'
    df = spark.createDataFrame([(1, html), (2, None)], "k int, html string")
    r = df.select(extract.title("html").alias("t"), extract.ld_json("html", "name string, n int").alias("j"), extract.script_variable("html", "plans", "array<struct<name:string,beds:int>>").alias("p")).first()
    assert r.t == "A B" and tuple(r.j) == ("N", 3) and [tuple(x) for x in r.p] == [("A1", 1)]
    assert [tuple(x) for x in extract.links(df, "k", "html").collect()] == [(1, 0, "/x", "go")]
    assert [x.text for x in extract.paragraphs(df, "k", "html").orderBy("pos").collect()] == ["one", "two"]
    md = "# Rents\n| Unit | Rent |\n|---|---|\n| **1BR** | $900 |\ntext\n## B\n| x | y |\n|--|--|\n| 1 | 2 |"
    rows = extract.markdown_tables(spark.createDataFrame([(1, md)], "k int, t string"), "k", "t").orderBy("line").collect()
    assert [(r.heading, r.cells) for r in rows] == [("Rents", ["1BR", "$900"]), ("B", ["1", "2"])]
    feed = "<rss><item><title><![CDATA[Flat]]></title><link>u</link></item></rss>"
    assert [(x.title, x.link) for x in extract.rss(spark.createDataFrame([(1, feed)], "k int, x string"), "k", "x").collect()] == [("Flat", "u")]


def test_boosted_in_shares(spark, monkeypatch):
    """Whatever the splits of the input, no task trains on more than a fixed number of rows; small frames stay as they are."""
    from pyspark.ml.regression import GBTRegressor

    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, points: seen.append(points) or fit(self, points))
    x = spark.range(0, 250_000, 1, 1).select("id", (F.col("id") % 10).cast("double").alias("z"), F.when(F.col("id") % 10 > 4, 10.0).otherwise(0.0).alias("y"))
    got = models.boosted(x, "y", ["z"], rounds=3)
    shares = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 250_000 and max(shares) <= 100_000
    assert got.select(F.count("*"), F.countDistinct("id"), F.max(F.abs(F.col("y") - F.col("predicted"))) < 1).first() == (250_000, 250_000, True)
    models.boosted(x.limit(1000), "y", ["z"], rounds=1)
    assert "RoundRobin" not in seen[1]._jdf.queryExecution().executedPlan().toString()


def test_cascade_boosted_phase(spark):
    rng = np.random.default_rng(1)
    rows = [("m", q, t, float(rng.normal() + (q % 7))) for q in range(40) for t in ("a", "b", "c")]
    c = models.cascade(spark.createDataFrame(rows, "m string, q int, t string, y double"), "m", "q", "t", "y", ("a", "b", "c")).collect()
    assert [r.tier for r in c] == ["a", "b", "c"] and c[0].rmse == c[0].rmse_alone
    x = spark.createDataFrame([(float(i), float(i % 10 > 4) * 10) for i in range(100)], "x double, y double").withColumn("z", F.col("x") % 10)
    assert models.boosted(x, "y", ["z"]).select(F.max(F.abs(F.col("y") - F.col("predicted")))).first()[0] < 1
    wave = [("m", q, float(np.sin(2 * np.pi * q / 20))) for q in range(80)] + [("short", q, 1.0) for q in range(10)]
    p = models.hilbert_phase(spark.createDataFrame(wave, "m string, q int, v double"), ["m"], "q", "v").collect()
    assert {r.m for r in p} == {"m"} and len(p) == 80
    middle = [r for r in p if 20 <= r.q < 60]
    for r in middle:  # a sine's phase is that of the cosine a quarter behind
        angle = (2 * np.pi * r.q / 20 - np.pi / 2) % (2 * np.pi)
        assert abs(np.exp(1j * r.angle) - np.exp(1j * angle)) < 0.25 and abs(r.amplitude - 1) < 0.2
        assert r.phase == ["EXPANSION", "PEAK", "CONTRACTION", "TROUGH"][int((r.angle % (2 * np.pi)) // (np.pi / 2))]
    b, a = models.butter_band(2 / 32, 2 / 16)
    gain = lambda f: abs(np.polyval(b, np.exp(2j * np.pi * f)) / np.polyval(a, np.exp(2j * np.pi * f)))
    assert abs(gain(1 / 32) - 0.5**0.5) < 1e-9 and abs(gain(1 / 16) - 0.5**0.5) < 1e-9 and gain(1e-6) < 1e-6 and gain(0.4) < 0.05
    assert abs(models.zero_phase(b, a, np.ones(100))).max() < 1e-9
    turns = np.unwrap([r.angle for r in sorted(p, key=lambda r: r.q)])
    assert abs((turns[60] - turns[20]) - 4 * np.pi) < 0.3


def test_schemas(spark, tmp_path):
    from lodeworks.sources import schemas

    assert len(schemas.apply_schema(spark, str(tmp_path / "db"))) == 7 and schemas.apply_schema(spark, str(tmp_path / "db")) == []
    t = schemas.read_table(spark, str(tmp_path / "db"), "rent_index")
    assert t.count() == 0 and t.columns == ["zip", "month", "home_type", "value"]
    twice = spark.sql("SELECT 'z' zip, DATE'2025-01-31' month, 'a' home_type, 1.0D value UNION ALL SELECT 'z', DATE'2025-01-31', 'a', 2.0D")
    assert schemas.duplicate_keys(twice, "rent_index").first().n == 2


def test_large_quantiles(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 4), ("c", 10), ("d", 333), ("e", 2000)) for v in (rng.integers(0, 50, n) if g == "d" else rng.normal(size=n))] + [("a", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    for accuracy in (100_000, 100):
        got = {r.g: r for r in agg.large_quantiles(df, ["g"], "v", probs, accuracy).collect()}
        for g in ("a", "b", "c", "d", "e", None):
            v = [x for k, x in rows if k == g and x is not None]
            assert got[g].n == len(v) and np.allclose(got[g].quantiles, np.quantile(v, probs))
    one = agg.large_quantiles(df, [], "v", [0.5]).first()
    assert np.allclose(one.quantiles, np.median([x for _, x in rows if x is not None]))


def test_fold_holds_no_texts(spark):
    """Addresses as long as documents: what a fold keeps does not grow with their length, and decisions are those of texts."""
    import tracemalloc

    import pandas as pd

    long = "12 oak " + "x" * 20_000
    rows = [(1, long, 2.0, 1.0, "76240", "12", "oak", None, None), (2, "12 oakwood", 2.0, 1.0, "76240", "12", "oakw", None, None), (3, long, 2.0, 1.0, "76240", "12", "oak", None, None), (4, "12 oakwood lane", 2.0, None, "76240", "12", "oakw", None, None)]
    want = [(1, "new", 1), (2, "new", 2), (3, "merged", 1), (4, "review", 2)]
    tracemalloc.start()
    got = entity._fold(pd.DataFrame(rows, columns=entity._COLUMNS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(zip(got["ord"], got["action"], got["canonical"], strict=True)) == want and peak < 2_000_000
    assert sorted((r.ord, r.action, r.canonical) for r in entity.fold(spark.createDataFrame(rows, FOLDED)).collect()) == want
    keyed = entity.keyed(spark.createDataFrame(rows, FOLDED).select(*entity._COLUMNS))
    assert max(len(r.addr) for r in keyed.collect()) == 64


def test_box_in_single_precision(spark):
    """32-bit axes are compared as such: a difference of 0.02 as a float is no less than 0.02."""
    import numpy as np

    y = float(np.float32(0.02))
    a, b = spark.createDataFrame([(0.0,)], "x float"), spark.createDataFrame([(y,), (0.0199,)], "y float")
    assert joins.band_join(a, b, [("x", "y")], 0.02).count() == 1
    assert joins.band_join(a.select(F.col("x").cast("double")), b.select(F.col("y").cast("double")), [("x", "y")], 0.02).count() == 2


def test_first_of_a_band_makes_no_pairs(spark):
    """As brute force, at the ends of bands too (in doubles), with repeats, nulls, NaN and infinities; and without a join of pairs."""
    import random

    rng = random.Random(3)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    xs = [rng.randrange(-20_000, 20_000) / 100 for _ in range(600)] + [0.1, 0.1, *odd]
    ys = [x + d for x in xs[:100] for d in (25.0, -25.0)] + [rng.randrange(-20_000, 20_000) / 100 for _ in range(40)] + odd
    a, b = spark.createDataFrame(list(enumerate(xs)), "i int, x double"), spark.createDataFrame([(n * 7919 % 1009, y) for n, y in enumerate(ys)], "j int, y double")
    want = {}
    for i, x in enumerate(xs):
        met = [n * 7919 % 1009 for n, y in enumerate(ys) if x is not None and y is not None and abs(x - y) < 25.0]
        if met:
            want[i] = min(met)
    got = joins.band_first(a, b, [("x", "y")], 25.0, "i", "j")
    assert {r.i: r.j for r in got.collect()} == want
    one = spark.createDataFrame([(1, 0.0)] * 50, "i int, x double"), spark.createDataFrame([(j, 1.0) for j in range(50)], "j int, y double")
    many = joins.band_first(*one, [("x", "y")], 25.0, "i", "j")
    assert many.collect() == [(1, 0, 1.0)] and "Window" in many._jdf.queryExecution().executedPlan().toString()
