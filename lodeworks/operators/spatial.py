"""Points in many polygons, and the parcel import that uses them.

Polygons are a table of rings. Their edges are cut into a grid: for every cell that a polygon reaches, a row holds whether
the edges to the right of the cell cross its rows an odd number of times, and the edges that have to be looked at. A point
meets the polygons of its cell in an equi-join and looks at those edges alone, by the even-odd rule with half-open edges, so
holes and several parts need nothing more. Cells of many points are split by Spark, as the polygons' side is small.

Defined cases: points without coordinates are in no polygon; a point on an edge belongs to one side of it by the half-open
rule; rings of fewer than three corners hold nothing; a polygon's closing corner may be given or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import address_normalise, hashed_id, owner_normalise, size_class

#: Slack by which an edge must pass a cell to count without a look, against the rounding of cell borders.
SLACK = 1e-9


def polygons_of(documents: DataFrame, key: str, geojson: str) -> DataFrame:
    """(key, feature, ring): the rings of all polygons in GeoJSON collections, features or bare geometries, each an array of
    (x, y)."""
    doc = F.col(geojson)
    geometry = lambda path: F.get_json_object(doc, path)
    features = F.from_json(geometry("$.features"), "array<struct<geometry:struct<type:string,coordinates:string>>>")
    one = F.array(F.struct(F.struct(F.coalesce(geometry("$.geometry.type"), geometry("$.type")).alias("type"), F.coalesce(geometry("$.geometry.coordinates"), geometry("$.coordinates")).alias("coordinates")).alias("geometry")))
    rows = documents.select(key, F.posexplode(F.coalesce(features, one)).alias("feature", "f")).select(key, "feature", "f.geometry.*")
    rings = "array<array<array<double>>>"
    parts = F.when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", rings))).when(F.col("type") == "MultiPolygon", F.from_json("coordinates", f"array<{rings}>"))
    rows = rows.select(key, "feature", F.explode(F.flatten(parts)).alias("r"))
    return rows.select(key, "feature", F.transform("r", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))).alias("ring"))


def cells(polygons: DataFrame, key: str, width: float) -> DataFrame:
    """(key, cx, cy, odd, edges): the grid index of `polygons` (key, ring)."""
    corners = F.filter("ring", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    rows = polygons.select(key, corners.alias("c")).where(F.size("c") >= 3)
    turned = F.concat(F.slice("c", 2, F.size("c") - 1), F.slice("c", 1, 1))
    edges = rows.select(key, F.explode(F.arrays_zip(F.col("c").alias("a"), turned.alias("b"))).alias("e"))
    edges = edges.select(key, F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).where("y1 <> y2")
    at = lambda c: F.floor(c / width)
    strips = edges.withColumn("cy", F.explode(F.sequence(at(F.least("y1", "y2") - SLACK), at(F.greatest("y1", "y2") + SLACK))))
    strip = strips.groupBy(key, "cy").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"), at(F.min(F.least("x1", "x2"))).alias("lo"), at(F.max(F.greatest("x1", "x2")) + SLACK).alias("hi"),
    )
    out = strip.withColumn("cx", F.explode(F.sequence("lo", "hi")))
    right = lambda e: F.least(e["x1"], e["x2"]) > (F.col("cx") + 1) * width + SLACK
    through = lambda e: (F.least(e["y1"], e["y2"]) <= F.col("cy") * width - SLACK) & (F.greatest(e["y1"], e["y2"]) >= (F.col("cy") + 1) * width + SLACK)
    left = lambda e: F.greatest(e["x1"], e["x2"]) < F.col("cx") * width - SLACK
    odd = F.size(F.filter("edges", lambda e: right(e) & through(e))) % 2 == 1
    looked_at = F.filter("edges", lambda e: ~left(e) & ~(right(e) & through(e)))
    return out.select(key, "cx", "cy", odd.alias("odd"), looked_at.alias("edges")).where(F.col("odd") | (F.size("edges") > 0))


def within(points: DataFrame, x: str, y: str, polygons: DataFrame, key: str, width: float) -> DataFrame:
    """`points` with `key` of every polygon (key, ring) that holds them; `width` of the grid's cells is best about the size of a
    small polygon."""
    # Polygons of equal rings are met once, by the least of their keys; what follows adds the others.
    shapes = polygons.groupBy(key).agg(F.array_sort(F.collect_list("ring")).alias("rings")).withColumn("_shape", F.sha2(F.to_json("rings"), 256))
    ones = shapes.groupBy("_shape").agg(F.min(key).alias("_p"), F.any_value("rings").alias("rings"))
    same = shapes.select("_shape", key).join(ones.select("_shape", "_p"), "_shape").select("_p", key)
    index = cells(ones.select("_p", F.explode("rings").alias("ring")), "_p", width)
    # Points are few bytes and meet many polygons, so they are spread over all cores first.
    points = points.repartition(4 * points.sparkSession.sparkContext.defaultParallelism)
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    met = points.withColumns({"_cx": F.floor(px / width), "_cy": F.floor(py / width)}).join(index, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy")))
    crossed = lambda e: ((e["y1"] > py) != (e["y2"] > py)) & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    inside = (F.col("odd").cast("int") + F.size(F.filter("edges", crossed))) % 2 == 1
    return met.where(inside).select(*points.columns, "_p").join(same, "_p").select(*points.columns, key)


#: Owners that lease equipment, not homes (fixed values).
LEASING = ["FINANCIAL", "LEASING LLC", "LEASE TRUST", "DONLEN", "DIRECTV", "DISH NETWORK", "PITNEY BOWES", "ADT "]
PROVENANCE = "cooke_cad"


def parcel_filter(county: str, kinds: list[str], keywords: list[str] = (), excluded: list[str] = ()) -> Column:
    """Parcels of a county with an address that begins with a digit and a kind, or an owner with a keyword; without lessors of
    equipment and the excluded ones."""
    owner = F.upper("owner_name")
    named = F.lit(False)
    for k in keywords:
        named = named | owner.contains(k.upper())
    kind = F.col("property_type").isin(*kinds) | (named & ~owner.contains("FINANCIAL") & ~owner.contains("LEASING"))
    lessor = F.lit(False)
    for k in LEASING:
        lessor = lessor | owner.contains(k)
    out = (F.lower("county") == county.lower()) & F.col("property_address").rlike("^[0-9]") & kind & ~lessor
    return out & ~F.col("parcel_id").isin(*excluded) if excluded else out


def import_parcels(parcels: DataFrame, places: DataFrame, limits: DataFrame, county: str, kinds: list[str], keywords: list[str] = (), excluded: list[str] = (), width: float = 0.05) -> DataFrame:
    """Register rows of the parcels that pass `parcel_filter`: ids by hash, missing or zero coordinates from `places` (address, lat,
    lon: looked-up ones), owner, address and size class normalised, and whether they lie within the `limits` (id, ring), NULL
    without coordinates. The rows replace all of their provenance (see `replace_provenance`)."""
    rows = parcels.where(parcel_filter(county, kinds, keywords, excluded))
    known = places.groupBy(F.col("address").alias("property_address")).agg(F.first(F.struct("lat", "lon"), ignorenulls=True).alias("_p"))
    blank = lambda c: F.nullif(F.col(c), F.lit(0.0))
    rows = rows.join(known, "property_address", "left")
    missing = blank("latitude").isNull() | blank("longitude").isNull()
    rows = rows.select(
        hashed_id(F.col("parcel_id"), prefix="p_").alias("property_id"), "parcel_id", F.col("property_address").alias("address"), address_normalise(F.col("property_address")).alias("addr"), "city", "zip",
        F.when(missing, F.col("_p.lat")).otherwise(F.col("latitude")).alias("lat"), F.when(missing, F.col("_p.lon")).otherwise(F.col("longitude")).alias("lon"),
        size_class("unit_count").alias("property_type"), F.col("unit_count").alias("units"), "year_built", F.col("owner_name").alias("owner_name_raw"), owner_normalise("owner_name").alias("owner_entity_normalized"), F.lit(PROVENANCE).alias("source_of_truth"),
    )
    inside = within(rows.select("property_id", "lat", "lon"), "lon", "lat", limits.select(F.lit(1).alias("_in"), "ring"), "_in", width)
    rows = rows.join(inside.select("property_id", "_in").distinct(), "property_id", "left")
    return rows.withColumn("in_city_limits", F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.col("_in").isNotNull())).drop("_in")
