"""Floorplan engines on small payloads."""

from __future__ import annotations

import html as h
import json

from pyspark.sql import functions as F

from lodeworks.operators import engines

PAGES = [
    (1, "https://cortland.com/x", 'var u=[{"apartment_number":"101","bedrooms":1,"bathrooms":1,"square_feet":700,"rent_min":1200,"rent_max":1300,"floorplan_name":"A1"},{"apartment_number":"102","bedrooms":1,"bathrooms":1,"square_feet":700,"rent_min":1100,"rent_max":0,"floorplan_name":"A1"}]'),
    (2, "https://sightmap.com/app", json.dumps({"data": {"units": [{"unit_number": "1", "floor_plan_id": 5, "price": 900, "area": 500, "available_on": "2025-01-01"}, {"unit_number": "2", "price": 0}], "floor_plans": [{"id": 5, "bedroom_count": 2, "bathroom_count": 2, "name": "B"}]}})),
    (3, "x", json.dumps({"units_data": {"units": [{"name": "7", "layoutId": "q", "price": "$1,500", "leased": False}, {"name": "8", "price": "900", "leased": True}], "layouts": [{"id": "q", "name": "L", "bedrooms": 3, "area": 1000}]}})),
    (4, "https://livebh.com", "<div data-floorplans='" + h.escape(json.dumps([{"floorplan_bedrooms": "1", "floorplan_bathrooms": 1, "floorplan_sqft_min": 600, "floorplan_rent_min": "1000", "floorplan_units_available": 2, "floorplan_name": ""}, {"floorplan_name": "empty"}])) + "'>"),
    (5, "x", json.dumps({"floorplans": [{"FloorplanName": " T ", "Beds": "2", "Baths": "1.5", "MinimumSQFT": "0", "MaximumSQFT": "800", "MinimumRent": "1400", "AvailableUnitsCount": "3"}, {"FloorplanName": "u"}]})),
    (6, "https://apartments247.com", json.dumps([{"name": "S", "bed": "Studio", "bath": "1", "sq_ft": "450", "rent": "$800", "units": [{"number": "9"}, {"number": "10", "rent": "$850"}]}])),
    (7, "none", "<html></html>"),
    (8, None, None),
]


def pages(spark):
    return spark.createDataFrame(PAGES, "k int, url string, body string")


def test_resolve(spark):
    got = {r.k: r.e for r in pages(spark).select("k", engines.resolve(F.col("url"), F.col("body")).alias("e")).collect()}
    assert got == {1: "cortland", 2: "sightmap", 3: "knock", 4: "livebh", 5: "tonti_rentcafe", 6: "apartments247", 7: "llm", 8: "llm"}


def test_extract_all(spark):
    rows = sorted((r.k, r.unit_number, r.beds, r.baths, r.sqft, r.rent, r.available_count, r.floorplan_name) for r in engines.extract_all(pages(spark), "k", "url", "body").collect())
    assert sorted(rows, key=str) == sorted(
        [
            (1, "101", 1, 1.0, 700.0, 1200.0, 1, "A1"), (1, "102", 1, 1.0, 700.0, 1100.0, 1, "A1"), (2, "1", 2, 2.0, 500.0, 900.0, 1, "B"), (3, "7", 3, 1.0, 1000.0, 1500.0, 1, "L"),
            (4, None, 1, 1.0, 600.0, 1000.0, 2, "1BR/1BA"), (5, None, 2, 1.5, 800.0, 1400.0, 3, "T"), (6, "10", 0, 1.0, 450.0, 850.0, 1, "S"), (6, "9", 0, 1.0, 450.0, 800.0, 1, "S"),
        ],
        key=str,
    )


def test_summary_and_range(spark):
    units = engines.extract_all(pages(spark), "k", "url", "body")
    p = {r.k: r for r in engines.plan_summary(units, "k").collect()}
    assert (p[1].rent_min, p[1].rent_max, p[1].available_units) == (1100.0, 1300.0, 2)
    assert engines.drop_implausible(units, 900, 1300).where("k = 2").count() == 0


def test_cards_and_lines(spark):
    html = '<div class="card"><h3>A</h3><b>2 Beds</b><i>900 sq ft</i><u>$1,300</u></div><div class="card"><h3>B</h3><b>Studio</b><i>400 sq ft</i></div>'
    df = spark.createDataFrame([(1, html)], "k int, h string")
    got = engines.card_plans(df, "k", "h", r'(?s)<div class="card">(.*?)</div>', {"name": "<h3>(.*?)</h3>", "beds": "<b>(.*?)</b>", "sqft": r"<i>(\d+)", "rent": r"<u>(.*?)</u>"})
    assert sorted((r.floorplan_name, r.beds, r.sqft, r.rent) for r in got.collect()) == [("A", 2, 900.0, 1300.0), ("B", 0, 400.0, 0.0)]
    text = "<p>Plan: A</p><p>Beds: 1</p><p>Rent: $900</p><p>Plan: B</p><p>Beds: 2</p>"
    got = engines.label_lines(spark.createDataFrame([(1, text)], "k int, h string"), "k", "h", {"name": r"Plan: (\w+)", "beds": r"Beds: (\d)", "rent": r"Rent: \$(\d+)"})
    assert sorted((r.floorplan_name, r.beds, r.rent) for r in got.collect()) == [("A", 1, 900.0), ("B", 2, 0.0)]


def test_every_claimed_page_is_accounted_for(spark):
    df = pages(spark).unionByName(spark.createDataFrame([(20, "https://x.securecafe.com", "<p>nothing</p>"), (21, "https://www.entrata.com", '[{"Beds":1,"MinRent":900,"Name":"A"}]'), (22, "https://maac.com/a", None)], "k int, url string, body string"))
    units = engines.extract_all(df, "k", "url", "body")
    got = {r.k: (r.engine, r.n_units, r.status) for r in engines.page_status(df, units, "k", "url", "body").collect()}
    assert len(got) == len(PAGES) + 3
    assert got[20] == ("rentcafe", 0, "empty") and got[21] == ("entrata", 1, "ok") and got[22] == ("maa", 0, "empty") and got[8] == ("llm", 0, "unclaimed") and got[1] == ("cortland", 2, "ok")


def test_long_cards_stay(spark):
    """A card of over 5,000 characters is read up to there and keeps the one behind it."""
    from lodeworks.operators import site_engines

    card = '<div class="single-floorplan" listing-sqft="{0}" listing-price="{1}"><h3>B{0}</h3><p>2 Bed</p><p>1 Bath</p>{2}</div>'
    page = card.format(700, 900, "x" * 5200) + card.format(800, 950, "") + '<div class="single-floorplan"'
    got = site_engines.listing_cards(spark.createDataFrame([(1, page), (2, "none"), (3, None)], "id int, html string"), "id", "html").collect()
    assert sorted((r.id, r.sqft, r.rent, r.floorplan_name) for r in got) == [(1, 700.0, 900.0, "B700"), (1, 800.0, 950.0, "B800")]


def test_rentcafe_shapes(spark):
    """Each page by the first shape that yields: the script's array with brackets in names, the page's own array, prices in the
    text; malformed and cut-off ones give nothing."""
    from lodeworks.operators import site_engines

    pages = [
        (1, 'ysi.fpList = [{"Name":"A [x]; ]","Beds":1,"Baths":"1","MaxSqFt":"600","MinRent":"$1,000"},{"Name":"b"}];'),
        (2, '{"floorplans":[{"name":"C","beds":2,"baths":2,"sqft":900,"lowPrice":1500,"highPrice":1700,"units":[{"a":[1]}]},{"beds":0,"minRent":800},{"name":"unpriced"}]}'),
        (3, "<p>1 Bed</p><p>1 Bath</p><b>650 sq ft</b> $1,200/mo <p>2 BR 2 BA 1,000 SF</p> $1,500 - $1,800 <i>1 bed 1 bath 650 SF</i> $1,200 / month $99/mo"),
        (4, '{"floorplans":[{"name":"C","lowPrice":1500}'), (5, ""), (6, None),
    ]
    got = site_engines.rentcafe(spark.createDataFrame(pages, "id int, html string"), "id", "html").collect()
    assert sorted((r.id, r.beds, r.baths, r.sqft, r.rent, r.floorplan_name) for r in got) == [
        (1, 1, 1.0, 600.0, 1000.0, "A [x]; ]"), (2, 0, 1.0, 0.0, 800.0, "0BR/1BA"), (2, 2, 2.0, 900.0, 1500.0, "C"), (3, 1, 1.0, 650.0, 1200.0, "1BR/1BA 650SF"), (3, 2, 2.0, 1000.0, 1500.0, "2BR/2BA 1000SF"),
    ]


def test_units_in_text(spark):
    """Fields by their labels in each unit's part: two layouts, a unit without a rent, one without a plan, text before the first."""
    from lodeworks.operators import site_engines

    page = "<p>12 Beds, Rent starting at $9</p><script>Unit #0 1 Beds, 1 Baths 1 Sq. Ft. Rent starting at $1</script>"
    page += "<div>Unit #4-101</div><p>2 Beds, 1.5 Baths</p><p>1,050 Sq. Ft.</p><i>The Long Oak 1,050 SF</i><p>Rent starting at</p><b>$</b><b>1,450</b><p>Move-in:</p><p>May 5</p>"
    page += "<div>Unit #202 1 Bed, 1 Bath 700 Sq. Ft. Rent starting at $1,100</div><div>Unit #303 1 Bed 700 Sq. Ft. Call us</div>"
    got = site_engines.text_units(spark.createDataFrame([(1, page), (2, ""), (3, None)], "id int, html string"), "id", "html").collect()
    assert sorted((r.unit_number, r.beds, r.baths, r.sqft, r.rent, r.floorplan_name) for r in got) == [("202", 1, 1.0, 700.0, 1100.0, None), ("4-101", 2, 1.5, 1050.0, 1450.0, "The Long Oak")]
    assert {r.unit_number: r.available_date for r in got} == {"4-101": "May 5", "202": None}


def test_queries_name_their_page(spark, sf):
    from lodeworks.plans import registry

    assert registry.QUERIES["ext18_plausible"](spark, sf).count() > 0
    assert {r.status for r in registry.QUERIES["ext_page_status"](spark, sf).select("status").distinct().collect()} == {"ok", "empty", "unclaimed"}


def test_xml_patterns_run_once_an_item(spark):
    """Blanks become NULL without finding them again: the plan holds a field's pattern once in each of the three places where it has the array of types, not four times; blank fields count as missing ones."""
    from lodeworks.operators import site_engines

    page = "<UnitTypeModel><DbaUnitTypeId>1</DbaUnitTypeId><BathRooms> </BathRooms><Area>700</Area><DbaUnitType> </DbaUnitType><UnitTypeCode>B</UnitTypeCode></UnitTypeModel>"
    out = site_engines.typed_units(spark.createDataFrame([(1, page)], "k int, body string"), "k", "body")
    assert [(r.beds, r.baths, r.sqft, r.floorplan_name) for r in out.collect()] == [(0, 0.0, 700.0, "B")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("UnitTypeCode\\b") <= 3
