"""Floorplan engines over landed pages and payloads: an engine is picked by address, else by what a page holds, in the
registry's order; each turns a payload into unit rows; units are rolled up to plans.

JSON is parsed by explicit schemas (what does not parse is NULL and gives no rows), lookups inside a document are map
lookups inside the row, so no engine joins or shuffles; only the rollup groups by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import beds as bed_number
from lodeworks.functions.text import number_or, strip_tags

from .extract import cards

#: Engines in order of preference: name, parts of addresses, marks in pages (fixed values).
REGISTRY = [
    ("cortland", ["cortland.com"], ['"floorplan_name"']),
    ("sightmap", ["sightmap.com"], ["sightmap"]),
    ("knock", ["doorway-api.knockrentals.com"], ["units_data"]),
    ("livebh", ["livebh.com"], ["data-floorplans="]),
    ("tonti_rentcafe", ["tontiproperties.com"], ["AvailableUnitsCount"]),
    ("apartments247", ["apartments247.com"], ["apartments247"]),
]
UNIT = "unit_number string, beds int, baths double, sqft double, rent double, rent_max double, available_date string, available_count int, floorplan_name string"


def every_engine() -> list:
    """(name, parts of addresses, marks, parser) of all engines, in the registry's order."""
    from .site_engines import SITES

    return [(*e, ENGINES[e[0]]) for e in REGISTRY] + SITES


def resolve(url: Column, html: Column, registry: list | None = None, fallback: str = "llm") -> Column:
    """Name of the first engine with a part of its addresses in the url, else with a mark in the page, else the fallback."""
    registry = every_engine() if registry is None else registry
    low = F.lower(F.coalesce(url, F.lit("")))
    out = F.lit(fallback)
    for tests in (lambda e: [F.coalesce(html.contains(m), F.lit(False)) for m in e[2]], lambda e: [low.contains(p.lower()) for p in e[1]]):
        for e in reversed(registry):
            for hit in tests(e):
                out = F.when(hit, F.lit(e[0])).otherwise(out)
    return out


def _num(c: Column, default: float = 0.0) -> Column:
    return number_or(c.cast("string"), default)


def _unit(number, beds, baths, sqft, rent, rent_max, date, count, name) -> Column:
    s = lambda c: c.cast("string")
    cols = [s(number), beds.cast("int"), baths.cast("double"), sqft.cast("double"), rent.cast("double"), rent_max.cast("double"), s(date), count.cast("int"), s(name)]
    return F.struct(*(c.alias(f.split()[0]) for c, f in zip(cols, UNIT.split(", "), strict=True)))


def _rows(df: DataFrame, key: str, units: Column, keep: Column) -> DataFrame:
    """(key, unit columns) of an array of unit structs, those that `keep` wants."""
    return df.select(key, F.explode(units).alias("u")).select(key, "u.*").where(keep)



def unit_objects(df: DataFrame, key: str, html: str) -> DataFrame:
    """Unit objects that stand in a page as flat JSON with rent_min and floorplan_name."""
    schema = "apartment_number string, bedrooms string, bathrooms string, square_feet string, rent_min string, rent_max string, made_ready_date string, floorplan_name string"
    objects = F.regexp_extract_all(F.col(html), F.lit(r'(\{[^{}]*"(?:rent_min|floorplan_name)"[^{}]*\})'), F.lit(1))
    parsed = F.filter(F.transform(objects, lambda o: F.from_json(o, schema)), lambda u: u["rent_min"].isNotNull() & u["floorplan_name"].isNotNull())
    unit = lambda u: _unit(u["apartment_number"], _num(u["bedrooms"]), _num(u["bathrooms"], 1), _num(u["square_feet"]), _num(u["rent_min"]), F.nullif(_num(u["rent_max"]), F.lit(0.0)), u["made_ready_date"], F.lit(1), u["floorplan_name"])
    return _rows(df, key, F.transform(parsed, unit), F.lit(True))


def attribute_plans(df: DataFrame, key: str, html: str) -> DataFrame:
    """Plans in a data-floorplans attribute, escaped or not; those without rent and size go."""
    f = "floorplan_"
    schema = f"array<struct<{f}bedrooms:string,{f}bathrooms:string,{f}sqft_min:string,{f}rent_min:string,{f}rent_max:string,{f}units_available:string,{f}name:string,{f}post_title:string>>"
    raw = F.regexp_extract(html, r"(?s)data-floorplans='(\[.*?\])'", 1)
    for a, b in (("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(a), F.lit(b))

    def unit(p: Column) -> Column:
        beds, baths, rent = _num(p[f"{f}bedrooms"]), _num(p[f"{f}bathrooms"]), _num(p[f"{f}rent_min"])
        made = F.concat(beds.cast("int").cast("string"), F.lit("BR/"), baths.cast("int").cast("string"), F.lit("BA"))
        name = F.coalesce(F.nullif(F.trim(p[f"{f}name"]), F.lit("")), F.nullif(F.trim(p[f"{f}post_title"]), F.lit("")), made)
        most = _num(p[f"{f}rent_max"])
        return _unit(F.lit(None), beds, baths, _num(p[f"{f}sqft_min"]), rent, F.when(most > 0, most).otherwise(rent), F.lit(None), _num(p[f"{f}units_available"]), name)

    return _rows(df, key, F.transform(F.from_json(raw, schema), unit), F.expr("rent > 0 or sqft > 0"))


def rest_plans(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Plans of a REST payload {floorplans: [...]}; unpriced ones go."""
    schema = "floorplans array<struct<FloorplanName:string,Beds:string,Baths:string,MinimumSQFT:string,MaximumSQFT:string,MinimumRent:string,MaximumRent:string,AvailableUnitsCount:string>>"

    def unit(p: Column) -> Column:
        rent, size = _num(p["MinimumRent"]), _num(p["MinimumSQFT"])
        size = F.when(size > 0, size).otherwise(_num(p["MaximumSQFT"]))
        return _unit(F.lit(None), _num(p["Beds"]), _num(p["Baths"], 1), size, rent, _num(F.coalesce(p["MaximumRent"], p["MinimumRent"])), F.lit(None), _num(p["AvailableUnitsCount"]), F.trim(p["FloorplanName"]))

    return _rows(df, key, F.transform(F.from_json(payload, schema)["floorplans"], unit), F.expr("rent > 0"))


def _lookup(plans: Column, plan_id: str) -> Column:
    return F.map_from_entries(F.transform(F.filter(plans, lambda p: p[plan_id].isNotNull()), lambda p: F.struct(p[plan_id].alias("k"), p.alias("v"))))


def map_units(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Units of an interactive map {data: {units, floor_plans}}, with their plan looked up; unpriced ones go."""
    inner = "units array<struct<unit_number:string,floor_plan_id:string,price:string,area:string,available_on:string>>, floor_plans array<struct<id:string,bedroom_count:string,bathroom_count:string,filter_label:string,name:string>>"
    doc = F.coalesce(F.from_json(payload, f"data struct<{inner.replace(' array', ':array').replace(', ', ',')}>")["data"], F.from_json(payload, inner))
    df = df.withColumn("_d", doc).withColumn("_m", _lookup(F.coalesce(F.col("_d.floor_plans"), F.array().cast("array<struct<id:string,bedroom_count:string,bathroom_count:string,filter_label:string,name:string>>")), "id"))

    def unit(u: Column) -> Column:
        p = F.element_at(F.col("_m"), u["floor_plan_id"])
        beds = _num(p["bedroom_count"])
        name = F.coalesce(F.nullif(p["filter_label"], F.lit("")), F.nullif(p["name"], F.lit("")), F.concat(beds.cast("int").cast("string"), F.lit("BR")))
        return _unit(u["unit_number"], beds, _num(p["bathroom_count"], 1), _num(u["area"]), _num(u["price"]), F.lit(None), u["available_on"], F.lit(1), name)

    return _rows(df, key, F.transform("_d.units", unit), F.expr("rent > 0"))


def doorway_units(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Units of {units_data: {units, layouts}}: hidden, leased, reserved, unavailable and unpriced ones go."""
    unit_t = "struct<name:string,layoutId:string,layoutName:string,price:string,displayPrice:string,bedrooms:string,bathrooms:string,area:string,availableOn:string,hidden:boolean,leased:boolean,reserved:boolean,available:boolean>"
    layout_t = "struct<id:string,name:string,bedrooms:string,bathrooms:string,area:string>"
    df = df.withColumn("_d", F.from_json(payload, f"units_data struct<units:array<{unit_t}>,layouts:array<{layout_t}>>")["units_data"])
    df = df.withColumn("_m", _lookup(F.coalesce(F.col("_d.layouts"), F.array().cast(f"array<{layout_t}>")), "id"))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    open_ = F.filter("_d.units", lambda u: no(u["hidden"]) & no(u["leased"]) & no(u["reserved"]) & F.coalesce(u["available"], F.lit(True)))

    def unit(u: Column) -> Column:
        p = F.element_at(F.col("_m"), u["layoutId"])
        beds = _num(F.coalesce(u["bedrooms"], p["bedrooms"]))
        name = F.coalesce(u["layoutName"], p["name"], F.concat(beds.cast("int").cast("string"), F.lit("BR")))
        return _unit(u["name"], beds, _num(F.coalesce(u["bathrooms"], p["bathrooms"]), 1), _num(F.coalesce(u["area"], p["area"])), _num(F.coalesce(u["price"], u["displayPrice"])), F.lit(None), u["availableOn"], F.lit(1), name)

    return _rows(df, key, F.transform(open_, unit), F.expr("rent > 0"))


def plan_array(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Units nested in an array of plans; a unit takes from its plan what it lacks."""
    unit_t = "struct<number:string,bed:string,bath:string,sq_ft:string,rent:string,available_date:string>"
    schema = f"array<struct<name:string,bed:string,bath:string,sq_ft:string,rent:string,rent_from:string,units:array<{unit_t}>>>"
    rows = df.select(key, F.explode(F.from_json(payload, schema)).alias("p")).select(key, "p", F.explode("p.units").alias("v"))
    p, v = F.col("p"), F.col("v")
    beds = bed_number(F.coalesce(v["bed"], p["bed"], F.lit("0")))
    unit = _unit(v["number"], beds, _num(F.coalesce(v["bath"], p["bath"]), 1), _num(F.coalesce(v["sq_ft"], p["sq_ft"])), _num(F.coalesce(v["rent"], p["rent"], p["rent_from"])), F.lit(None), v["available_date"], F.lit(1), F.coalesce(p["name"], F.concat(beds.cast("string"), F.lit("BR"))))
    return rows.select(key, unit.alias("u")).select(key, "u.*").where("rent > 0")


def card_plans(df: DataFrame, key: str, html: str, card: str, fields: dict[str, str]) -> DataFrame:
    """Plans of repeated cards; `fields` holds regexes for name, beds, baths, sqft, rent, available (any may lack)."""
    got = cards(df, key, html, card, fields)
    of = lambda c: F.col(c) if c in fields else F.lit(None).cast("string")
    unit = _unit(F.lit(None), bed_number(of("beds")), _num(of("baths"), 1), _num(of("sqft")), _num(of("rent")), _num(of("rent")), F.lit(None), _num(of("available"), 1), of("name"))
    return got.select(key, unit.alias("u")).select(key, "u.*").where("rent > 0 or sqft > 0")


def label_lines(df: DataFrame, key: str, html: str, labels: dict[str, str]) -> DataFrame:
    """Plans written as labelled lines: a line that fits labels['name'] opens a plan, later ones fill its fields."""
    from pyspark.sql import Window

    from .windows import running

    lines = df.select(key, F.posexplode(F.split(F.regexp_replace(html, r"(?i)<br\s*/?>|</(?:p|div|li|h\d|td|tr)>", "\n"), "\n")).alias("line", "_l")).withColumn("_l", strip_tags("_l"))
    w = running(Window.partitionBy(key).orderBy("line"))
    lines = lines.withColumn("_plan", F.count_if(F.col("_l").rlike(labels["name"])).over(w)).where("_plan > 0")
    first = lambda c: F.min_by(F.regexp_extract("_l", labels[c], 1), F.when(F.col("_l").rlike(labels[c]), F.col("line")))
    got = lines.groupBy(key, "_plan").agg(*(first(c).alias(c) for c in labels))
    of = lambda c: F.col(c) if c in labels else F.lit(None).cast("string")
    unit = _unit(F.lit(None), bed_number(of("beds")), _num(of("baths"), 1), _num(of("sqft")), _num(of("rent")), _num(of("rent")), F.lit(None), F.lit(1), of("name"))
    return got.select(key, unit.alias("u")).select(key, "u.*")


def plan_summary(units: DataFrame, key: str) -> DataFrame:
    """Plans by name: beds, baths and size of the first unit by number, least and largest positive rent, availability."""
    order = F.coalesce("unit_number", F.lit(""))
    least = F.min(F.when(F.col("rent") > 0, F.col("rent")))
    most = F.max(F.when(F.col("rent_max") > 0, F.col("rent_max")))
    g = units.groupBy(key, "floorplan_name").agg(
        *(F.min_by(c, order).alias(c) for c in ("beds", "baths", "sqft")), least.alias("rent_min"), F.coalesce(most, F.max(F.when(F.col("rent") > 0, F.col("rent")))).alias("rent_max"), F.sum("available_count").alias("available_units")
    )
    return g.fillna(0.0, ["rent_min", "rent_max"])


def drop_implausible(units: DataFrame, low: float = 400, high: float = 15_000) -> DataFrame:
    """Units whose rent lies outside an open range go."""
    return units.where((F.col("rent") > low) & (F.col("rent") < high))


ENGINES = {"cortland": unit_objects, "sightmap": map_units, "knock": doorway_units, "livebh": attribute_plans, "tonti_rentcafe": rest_plans, "apartments247": plan_array}


def extract_all(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Units of all pages by the engines that claim them: (key, engine, unit columns). One branch an engine, each reading
    its own pages only. Pages that no engine claims, or whose engine finds nothing, are in `page_status`."""
    from .reshape import union_all

    claimed = pages.withColumn("_e", resolve(F.col(url), F.col(payload)))
    return union_all(*(parser(claimed.where(F.col("_e") == name), key, payload).withColumn("engine", F.lit(name)) for name, _, _, parser in every_engine()))


def page_status(pages: DataFrame, units: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Every page once: (key, engine, n_units, status), the status being ok, empty (its engine found no unit) or unclaimed."""
    n = units.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("n_units"))
    out = pages.select(key, resolve(F.col(url), F.col(payload)).alias("engine")).join(n, F.col(key) == F.col("_k"), "left")
    status = F.when(F.col("engine") == "llm", "unclaimed").when(F.col("n_units").isNull(), "empty").otherwise("ok")
    return out.select(key, "engine", F.coalesce("n_units", F.lit(0)).alias("n_units"), status.alias("status"))
