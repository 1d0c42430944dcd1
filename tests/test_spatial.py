"""Points in a table of polygons against the plain test, and the parcel import."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import spatial

RING = "array<struct<x:double,y:double>>"


def plain(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def star(rng, cx, cy, size, n):
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    return [(cx + size * (0.3 + rng.random()) * math.cos(a), cy + size * (0.3 + rng.random()) * math.sin(a)) for a in turns]


@pytest.mark.parametrize("width", [0.7, 3.0, 40.0])
def test_thousand_polygons(spark, width):
    """Stars of 3 to 40 corners, some with a hole or a second part, some with corners on the grid's lines; points anywhere, on
    corners and on lines."""
    rng = random.Random(4)
    polygons = {}
    for i in range(1000):
        cx, cy, size = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.4, 1.5, 6])
        rings = [star(rng, cx, cy, size, rng.randint(3, 40))]
        if i % 5 == 0:
            rings.append(star(rng, cx, cy, size / 4, 5))
        if i % 7 == 0:
            rings.append([(float(round(x)), float(round(y))) for x, y in star(rng, cx + 9, cy, 3, 6)])
        polygons[i] = rings
    points = [(k, rng.uniform(-60, 60), rng.uniform(-60, 60)) for k in range(300)] + [(300 + k, float(rng.randint(-50, 50)), float(rng.randint(-50, 50))) for k in range(150)]
    points += [(500 + k, *polygons[rng.randrange(1000)][0][0]) for k in range(50)] + [(900, None, 1.0)]
    p = spark.createDataFrame(points, "k int, x double, y double")
    q = spark.createDataFrame([(i, r) for i, rings in polygons.items() for r in rings], f"id int, ring {RING}")
    got = {(r.k, r.id) for r in spatial.within(p, "x", "y", q, "id", width).collect()}
    assert got == {(k, i) for k, x, y in points if x is not None for i, rings in polygons.items() if plain(x, y, rings)}


def test_no_theta_join(spark):
    p, q = spark.createDataFrame([(1, 1.0, 1.0)], "k int, x double, y double"), spark.createDataFrame([(1, [(0.0, 0.0), (2.0, 0.0)])], f"id int, ring {RING}")
    found = spatial.within(p, "x", "y", q, "id", 1.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and found.count() == 0


def test_geojson(spark):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    docs = [
        ("a", json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Polygon", "coordinates": [square, hole]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[[[9, 9], [10, 9], [10, 10]]]]}}]})),
        ("b", json.dumps({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square]}})), ("c", json.dumps({"type": "Polygon", "coordinates": [hole]})), ("d", "no json"), ("e", None),
    ]
    q = spatial.polygons_of(spark.createDataFrame(docs, "id string, doc string"), "id", "doc")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.5, 1.5), (3, 9.9, 9.5)], "k int, x double, y double")
    got = sorted((r.k, r.id) for r in spatial.within(points, "x", "y", q, "id", 1.0).collect())
    assert got == [(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "a")]


def test_import_parcels(spark):
    schema = "parcel_id string, owner_name string, property_address string, county string, city string, zip string, latitude double, longitude double, property_type string, unit_count int, year_built int"
    row = lambda i, owner="Oak L.L.C.", addr="12 Main St", lat=1.0, lon=1.0, kind="residential_mf", units=60, county="Cooke": (i, owner, addr, county, "G", "76240", lat, lon, kind, units, 1990)
    parcels = [
        row("a"), row("b", lat=None, addr="9 Oak St", units=7), row("c", lon=0.0, addr="8 Unknown St", units=4), row("d", lat=30.0, units=None), row("e", addr="Main St"), row("f", kind="sfr"), row("g", kind="sfr", owner="Pine Apartments"),
        row("h", kind="sfr", owner="Apartments Leasing"), row("i", owner="DIRECTV LLC"), row("j", county="Dallas"), row("k"), row("l", owner=None),
    ]
    places = spark.createDataFrame([("9 Oak St", 2.0, 2.0), ("8 Unknown St", None, None)], "address string, lat double, lon double")
    limits = spark.createDataFrame([(1, [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0)])], f"id int, ring {RING}")
    got = {r.parcel_id: r for r in spatial.import_parcels(spark.createDataFrame(parcels, schema), places, limits, "Cooke", ["residential_mf"], ["APARTMENTS"], ["k"], 1.0).collect()}
    assert sorted(got) == ["a", "b", "c", "d", "g"]
    assert {k: (r.in_city_limits, r.property_type) for k, r in got.items()} == {"a": (True, "mf-large"), "b": (True, "mf-small"), "c": (None, "fourplex"), "d": (False, "mf-small"), "g": (True, "mf-large")}
    assert got["a"].property_id.startswith("p_") and got["a"].owner_entity_normalized == "oak" and got["b"].lat == 2.0


def test_equal_polygons_are_met_once(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    polygons = spark.createDataFrame([(k, ring) for k in range(50)] + [(99, [(x + 1, y) for x, y in ring])], "id int, ring array<struct<x:double,y:double>>")
    out = spatial.within(spark.createDataFrame([(1, 0.5, 1.0), (2, 2.0, 2.0), (3, 9.0, 9.0)], "n int, x double, y double"), "x", "y", polygons, "id", 1.0)
    assert sorted((r.n, r.id) for r in out.collect()) == [(1, k) for k in range(50)] + [(2, k) for k in [*range(50), 99]]
    assert "_shape" in out._jdf.queryExecution().optimizedPlan().toString()
