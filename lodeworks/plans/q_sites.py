"""Queries of the floorplan engines: parts as plans, written into pages of each site's form, and read back by its engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.operators import engines, listing_sites, rent_points, site_engines

from .q_relational import t
from .registry import query

#: What a page holds of a part.
FIELDS = {
    "key": "p_partkey", "beds": "p_size % 4", "baths": "1 + p_size % 2", "sqft": "400 + 10 * p_size", "rent": "500 + CAST(floor(p_retailprice) AS BIGINT)", "name": "concat('A', p_partkey)",
    "more": "600 + CAST(floor(p_retailprice) AS BIGINT)",
}
ORACLE = "SELECT p_partkey, CAST(p_size % 4 AS INT) AS beds, CAST(1 + p_size % 2 AS DOUBLE) AS baths, CAST(400 + 10 * p_size AS DOUBLE) AS sqft, CAST(500 + floor(p_retailprice) AS DOUBLE) AS rent, {name} AS floorplan_name FROM part"


def pages(spark, sf_dir: str, template: str, spread: bool = False) -> DataFrame:
    """(p_partkey, body): the template with its <<fields>> filled in. Parts are few bytes and their pages many, so where nothing
    after deals the pages out, the parts are spread over all cores first."""
    part = t(spark, sf_dir, "part")
    if spread:
        part = part.repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey")
    parts = re.split(r"<<(\w+)>>", template)
    body = F.concat(*(F.expr(f"CAST({FIELDS[x]} AS STRING)") if i % 2 else F.lit(x) for i, x in enumerate(parts)))
    return part.select("p_partkey", body.alias("body"))


_XML = (
    "<GetFloorPlans><unitTypeModel><UnitTypeModel><DbaUnitTypeId><<key>></DbaUnitTypeId><NumBedRooms><<beds>></NumBedRooms><BathRooms><<baths>></BathRooms><Area><<sqft>></Area><DbaUnitType><<name>></DbaUnitType></UnitTypeModel></unitTypeModel>"
    "<hotSheetUnitsModel><HotSheetUnitsModel><DbaUnitTypeId><<key>></DbaUnitTypeId><Rent><<rent>></Rent><UnitNumber>1</UnitNumber></HotSheetUnitsModel><HotSheetUnitsModel><DbaUnitTypeId>-1</DbaUnitTypeId><Rent>9</Rent></HotSheetUnitsModel></hotSheetUnitsModel></GetFloorPlans>"
)
_MADE = "concat(p_size % 4, 'BR/', 1 + p_size % 2, 'BA ', 400 + 10 * p_size, 'SF')"

#: Query, inventory entry, engine, page, and the plan's name in SQL where it is not the part's.
CASES = [
    ("ext01_unit_objects", "EXT-01", engines.unit_objects, 'var u=[{"apartment_number":"1","bedrooms":<<beds>>,"bathrooms":<<baths>>,"square_feet":<<sqft>>,"rent_min":<<rent>>,"rent_max":<<more>>,"floorplan_name":"<<name>>"},{"rent_min":1}]', None),
    ("ext02_unit_cards", "EXT-02", site_engines.anchor_cards, '<a href="#" data-jd-fp-selector="unit-card" class="jd-fp-unit-card"><p class="jd-fp-unit-card__floorplan-title"><span><<name>></span></p><h4 class="jd-fp-card-info__title">#12</h4><span><<beds>> bed</span><span><<baths>> bath</span><span><<sqft>> sq. ft.</span><b>Starting at $<<rent>></b></a><a data-jd-fp-selector="unit-card"><span>1 bed</span></a>', None),
    ("ext03_detail_boxes", "EXT-03", site_engines.detail_boxes, "<dl><dt>RENT</dt> <dd>$<<rent>></dd><dt>Bed / Bath</dt><dd><<beds>> bd / <<baths>> ba</dd><dt>Square Feet</dt><dd><<sqft>></dd><dt>Available</dt><dd>NOW</dd></dl>", _MADE),
    ("ext04_tile_cards", "EXT-04", site_engines.tile_cards, '<div class="resi__floor_plan"><div class="uk-tile uk-padding-small"><b>A1</b><i><<beds>> Bed</i><i><<baths>> Bath</i><i><<sqft>> SF</i><u>Starting at $<<rent>></u><em>3 Units</em></div><div class="uk-tile uk-padding-small"><i>2 Bed</i></div></div>', "'A1'"),
    ("ext04_modal_units", "EXT-04", site_engines.modal_units, '<floor-plan-units-modalv2 :units="[{&quot;unitNumber&quot;:&quot;1&quot;,&quot;unitBedrooms&quot;:&quot;<<beds>>&quot;,&quot;unitBathrooms&quot;:<<baths>>,&quot;unitInteriorSquareFeet&quot;:<<sqft>>,&quot;unitPrice&quot;:<<rent>>,&quot;floorPlanName&quot;:&quot;<<name>>&quot;,&quot;unitAvailable&quot;:true},{&quot;unitAvailable&quot;:false}]"></floor-plan-units-modalv2>', None),
    ("ext05_listing_cards", "EXT-05", site_engines.listing_cards, '<div class="x single-floorplan" listing-sqft=" <<sqft>>" listing-price="<<rent>>"><h3>B2</h3><p><<beds>> Bed</p><p><<baths>> Bath</p><div class="floorplan-availability">2 Vacant</div></div><div class="single-floorplan" listing-sqft="<<sqft>>" listing-price="1"><h3>B2</h3><p><<beds>> Bed</p><p><<baths>> Bath</p><div class="no-availability"></div></div>', "'B2'"),
    ("ext07_attribute_plans", "EXT-07", engines.attribute_plans, "<div data-floorplans='[{\"floorplan_bedrooms\":\"<<beds>>\",\"floorplan_bathrooms\":<<baths>>,\"floorplan_sqft_min\":<<sqft>>,\"floorplan_rent_min\":\"<<rent>>\",\"floorplan_name\":\"<<name>>\"}]'></div>", None),
    ("ext08_text_units", "EXT-08", site_engines.text_units, "<h1>MAA</h1><div>Unit #<<key>></div><p><<beds>> Beds, <<baths>> Baths</p><p><<sqft>> Sq. Ft.</p><p>The Oak 900 SF</p><p>Rent starting at</p><b>$<<rent>></b><div>Unit #x</div>", "'The Oak'"),
    ("ext09_typed_units_json", "EXT-09", site_engines.typed_units, '{"unitTypeModel":[{"dbaUnitTypeId":<<key>>,"numBedRooms":<<beds>>,"bathRooms":<<baths>>,"area":<<sqft>>,"dbaUnitType":"<<name>>"}],"hotSheetUnitsModel":[{"dbaUnitTypeId":<<key>>,"rent":<<rent>>,"unitNumber":"7"},{"dbaUnitTypeId":-1,"rent":5}]}', None),
    ("ext09_typed_units_xml", "EXT-09", site_engines.typed_units, _XML, None),
    ("ext10_item_cards", "EXT-10", site_engines.item_cards, '<ul><li class="floorplanItem" id="floorplan_1" data-bedrooms="<<beds>>"><div class="floorplanName"><h3><<name>></h3></div><div class="floorplanBeds"><span class="statValue"><<beds>></span></div><div class="floorplanBaths"><span class="statValue"><<baths>></span></div><div class="floorplanSquareFootage"><span class="statValue"><<sqft>></span></div><div class="priceFullValue"><span class="priceMinValue">$<<rent>></span>to-<span class="priceMaxValue">$<<more>></span></div><div class="floorplanAvailability">Available on May 1, 2025</div></li></ul>', None),
    ("ext11_rest_plans", "EXT-11", engines.rest_plans, '{"floorplans":[{"FloorplanName":" <<name>> ","Beds":"<<beds>>","Baths":"<<baths>>","MinimumSQFT":"0","MaximumSQFT":"<<sqft>>","MinimumRent":"<<rent>>","AvailableUnitsCount":"3"},{"FloorplanName":"u"}]}', None),
    ("ext13_card_fields", "EXT-13", site_engines.rentcafe_cards, '<h2 data-selenium-id="Floorplan0Name"><b><<name>></b></h2><span data-selenium-id="Floorplan0Beds"></span><span data-selenium-id=\'Floorplan0BedsMobile\'><<beds>> Beds</span><i data-selenium-id="Floorplan0Baths"><<baths>></i><i data-selenium-id="Floorplan0SqFt">300 - <<sqft>> Sq.Ft.</i><i data-selenium-id="Floorplan0Rent">$<<more>> - $<<rent>></i><i data-selenium-id="Floorplan0Availability">Waitlist</i><i data-selenium-id="Floorplan1Name">unpriced</i>', None),
    ("ext13_script_array", "EXT-13", site_engines.rentcafe_array, '<script>ysi.fpList = [{"Name":"<<name>>","Beds":<<beds>>,"Baths":"<<baths>>","MinSqFt":"1","MaxSqFt":"<<sqft>>","Rentcol":"$<<rent>>-$<<more>>","UnitsAvailable":"2"},{"Name":"unpriced"}];</script>', None),
    ("ext13_page_array", "EXT-13", site_engines.rentcafe_blob, '<script>w={"floorplans":[{"name":"<<name>>","beds":<<beds>>,"baths":"<<baths>>","sqft":<<sqft>>,"lowPrice":<<rent>>,"units":[{"note":"] } \\" ["}]},{"name":"unpriced"}]};</script>', None),
    ("ext13_priced_text", "EXT-13", site_engines.priced_text, "<div><p><<beds>> Bed</p><p><<baths>> Bath</p><b><<sqft>> sq ft</b> $<<rent>> / month</div><i>$99/mo</i>", _MADE),
    ("ext14_json_array", "EXT-14", site_engines.entrata_array, 'x = [[1],[{"Beds":<<beds>>,"Baths":<<baths>>,"MinSqFt":<<sqft>>,"MinRent":<<rent>>,"MaxRent":null,"AvailableCount":1,"Name":""}]]', _MADE),
    ("ext14_portal_detail", "EXT-14", site_engines.portal_detail, '<title>x</title><h1 class="fp-name"><<name>></h1><div class="sticky-fp-info-wrapper"><<name>> | $<<rent>>/month | x</div><p><<sqft>> SqFt</p><p><<baths>> Bath</p><p>Studio, 1-2 Bedroom</p>', None),
    ("ext15_doorway_units", "EXT-15", engines.doorway_units, '{"units_data":{"units":[{"name":"7","layoutId":"q","price":"$<<rent>>"},{"name":"8","layoutId":"q","price":"5","leased":true}],"layouts":[{"id":"q","name":"<<name>>","bedrooms":"<<beds>>","bathrooms":"<<baths>>","area":"<<sqft>>"}]}}', None),
    ("ext15_map_units", "EXT-15", engines.map_units, '{"data":{"units":[{"unit_number":"1","floor_plan_id":"5","price":"<<rent>>","area":"<<sqft>>"},{"unit_number":"2","price":"0"}],"floor_plans":[{"id":"5","bedroom_count":"<<beds>>","bathroom_count":"<<baths>>","name":"<<name>>"}]}}', None),
    ("ext15_plan_array", "EXT-15", engines.plan_array, '[{"name":"<<name>>","bed":"<<beds>>","bath":"<<baths>>","sq_ft":"<<sqft>>","rent":"$<<rent>>","units":[{"number":"9"}]}]', None),
]


PAGES = {name: page for name, _, _, page, _ in CASES}


def _register(name: str, entry: str, engine, page: str, plan: str | None) -> None:
    oracle = ORACLE.format(name=plan or "concat('A', p_partkey)")
    if name == "ext14_portal_detail":  # beds by the plan's first letter
        oracle = oracle.replace("CAST(p_size % 4 AS INT)", "CAST(1 AS INT)")

    def run(spark, sf_dir):
        return engine(pages(spark, sf_dir, page), "p_partkey", "body").select("p_partkey", "beds", "baths", "sqft", "rent", "floorplan_name")

    run.__doc__ = f"{entry}: {engine.__doc__}"
    query(name, oracle)(run)


for _case in CASES:
    _register(*_case)


@query("ext06_price_lines", "SELECT p_partkey, CAST(p_size % 4 AS INT) AS beds, CAST(400 + 10 * p_size AS DOUBLE) AS sqft, CAST(500 + floor(p_retailprice) AS DOUBLE) AS rent, '1 Oak, Homewood' AS floorplan_name FROM part")
def ext06(spark, sf_dir):
    """EXT-06: lines before and after a price."""
    page = "<p>2 Elm, Birmingham</p><p>x</p><p>1 Oak, Homewood</p><b>$<<rent>>+</b><p>/ MONTH</p><p><<beds>> bed</p><p><<sqft>> sqft</p><b>$100+</b>"
    return site_engines.price_lines(pages(spark, sf_dir, page), "p_partkey", "body").select("p_partkey", "beds", "sqft", "rent", "floorplan_name")


@query("ext18_plausible", f"SELECT * FROM ({ORACLE.format(name=_MADE)}) WHERE rent > 1402 AND rent < 1450")
def ext18(spark, sf_dir):
    """EXT-18: units whose rent is out of range go."""
    units = site_engines.entrata_array(pages(spark, sf_dir, PAGES["ext14_json_array"]), "p_partkey", "body")
    return engines.drop_implausible(units, 1_402, 1_450).select("p_partkey", "beds", "baths", "sqft", "rent", "floorplan_name")


@query("ext_page_status", """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'maa' WHEN 1 THEN 'entrata' ELSE 'llm' END AS engine, CAST(CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_units,
CASE p_partkey % 3 WHEN 0 THEN 'empty' WHEN 1 THEN 'ok' ELSE 'unclaimed' END AS status FROM part""")
def ext_status(spark, sf_dir):
    """EXT-19: engines are chosen by address, then marks; every page is accounted for."""
    kind = F.col("p_partkey") % 3
    p = pages(spark, sf_dir, PAGES["ext14_json_array"])
    p = p.select("p_partkey", F.when(kind == 0, "https://www.maac.com/x").otherwise("https://x.test/").alias("url"), F.when(kind == 1, F.col("body")).otherwise(F.lit("<p>none</p>")).alias("body"))
    return engines.page_status(p, engines.extract_all(p, "p_partkey", "url", "body"), "p_partkey", "url", "body")


_SEARCH = (
    '<script id="ld_searchpage_results">{"itemListElement":[{"item":{"name":"Home <<key>>"}},{"item":{"name":"Lost"}}]}</script><li class="cl-static-search-result"><a href="https://x.org/apa/d/<<key>>/1.html"><div class="title"> Home <<key>> </div></a></li>'
    '<li class="cl-static-search-result"><div class="title">No link</div></li><li class="cl-static-search-result"><a href="https://x.org/apa/d/gone/1.html"><div class="title">Lost</div></a></li>'
)
_POST = (
    '<span id="titletextonly">Apartment <<key>></span><span class="price">$<<rent>></span><b><<beds>>BR / <<baths>>Ba</b><i><<sqft>>sqft</i><script type="application/ld+json">{"broken</script>'
    '<p class="mapaddress"><<key>> Oak St</p><section id="postingbody">A duplex near 76240-1234.</section>'
)


@query("ext17_posts", """SELECT 'https://x.org/apa/d/' || p_partkey || '/1.html' AS url, 'duplex' AS listing_kind, p_partkey || ' Oak St' AS address_raw, '76240' AS zip, 'Gainesville' AS city, CAST(p_size % 4 AS DOUBLE) AS beds, CAST(1 + p_size % 2 AS DOUBLE) AS baths,
CASE WHEN 400 + 10 * p_size >= 100 THEN CAST(400 + 10 * p_size AS INTEGER) END AS sqft, CAST(500 + floor(p_retailprice) AS INTEGER) AS asking_rent, 'Apartment ' || p_partkey AS title FROM part WHERE p_partkey % 3 <> 0""")
def ext17(spark, sf_dir):
    """EXT-17, EXT-19, FN-31, JOIN-23, PIPE-12: search pages joined to the pages of their posts, a third of which has not landed."""
    results = listing_sites.search_results(pages(spark, sf_dir, _SEARCH), "p_partkey", "body")
    key = F.col("p_partkey")
    details = pages(spark, sf_dir, _POST).where(key % 3 != 0).select(F.concat(F.lit("https://x.org/apa/d/"), key.cast("string"), F.lit("/1.html")).alias("url"), F.col("body").alias("html"))
    return listing_sites.posts(results, details, "run").select("url", "listing_kind", "address_raw", "zip", "city", "beds", "baths", "sqft", "asking_rent", "title")


_PLACARDS = (
    '<article class="placard placard-option-gold" data-listingid="a<<key>>" data-url="u<<key>>"><span class="js-placardTitle title"><<name>></span><div class="property-address" title="<<key>> Oak St, TX 76240"></div><div class="bedTextBox">1 Bed</div> <div class="priceTextBox"><span>$<<rent>>+</span></div>'
    '<div class="bedTextBox">3 Beds, <<baths>> Baths, 1,<<rent>> sq ft</div><div class="priceTextBox"><span>$<<more>></span></div><div class="bedTextBox">Studio</div><div class="priceTextBox"><span>$1</span></div></article>'
    '<div class="placard" data-listingid="b<<key>>" data-url="v"><div class="property-title" title="<<key>> Elm St"></div><p class="property-pricing">$<<rent>> - $<<more>></p><p class="property-beds"><<beds>> - 4 Beds</p></div><div class="placard">no id</div></body>'
)


@query("ext17_placards", """WITH p AS (SELECT p_partkey, CAST(1 + p_size % 2 AS DOUBLE) AS baths, p_size % 4 AS beds, CAST(500 + floor(p_retailprice) AS INTEGER) AS rent, CAST(600 + floor(p_retailprice) AS INTEGER) AS more FROM part)
SELECT p_partkey, 'a' || p_partkey || '-1br' AS source_listing_id, p_partkey || ' Oak St, TX 76240' AS address_raw, '76240' AS zip, CAST(1 AS DOUBLE) AS beds, CAST(NULL AS DOUBLE) AS baths, CAST(NULL AS INTEGER) AS sqft, rent AS asking_rent, 'A' || p_partkey AS title FROM p
UNION ALL SELECT p_partkey, 'a' || p_partkey || '-3br', p_partkey || ' Oak St, TX 76240', '76240', 3, baths, CAST('1' || rent AS INTEGER), more, 'A' || p_partkey FROM p
UNION ALL SELECT p_partkey, 'b' || p_partkey, p_partkey || ' Elm St', NULL, beds, NULL, NULL, rent, p_partkey || ' Elm St — ' || beds || '-4BR/?-?BA' FROM p""")
def ext17b(spark, sf_dir):
    """EXT-17, EXT-19, SET-12: placards of both forms, one row a bed type or one with its ranges."""
    cards = listing_sites.placards(pages(spark, sf_dir, _PLACARDS), "p_partkey", "body")
    o = listing_sites.placard_observations(cards, "run")
    key = F.regexp_extract("source_listing_id", r"^[ab](\d+)", 1).cast("long")
    return o.select(key.alias("p_partkey"), "source_listing_id", "address_raw", "zip", "beds", "baths", "sqft", "asking_rent", "title")


_REPORT = (
    "**Property:** Home <<key>>\n## 2-Bedroom\n| Property | SF | Effective | $/SF |\n|---|---|---|---|\n| **Home <<key>>** | <<sqft>> | $<<rent>> | - |\n| Other | 1,<<sqft>> | n/a | $1.5 |\n| Market Avg | 1 | 1 | 1 |\n| None | 0 | 1 | 1 |\n"
    "### Studio\n| Community | Sq Ft | Effective Rent |\n|---|---|---|\n| Subject | <<sqft>> | <<more>> |\n| Subject | <<sqft>> | <<more>> |\n| short |\n## Taxes\n| Property | SF | $/SF |\n|---|---|---|\n| Other | 1 | 2 |"
)


@query("mod21_rent_points", """WITH p AS (SELECT p_partkey, CAST(400 + 10 * p_size AS DOUBLE) AS sf, 500 + floor(p_retailprice) AS rent, 600 + floor(p_retailprice) AS more, CAST('1' || (400 + 10 * p_size) AS DOUBLE) AS big FROM part)
SELECT p_partkey, '2BR' AS unit_type, 'Home ' || p_partkey AS property_name, sf, round(rent / sf, 6) AS eff_psf, true AS is_subject FROM p UNION ALL SELECT p_partkey, '2BR', 'Other', big, 1.5, false FROM p UNION ALL SELECT p_partkey, 'Studio', 'Subject', sf, round(more / sf, 6), true FROM p""")
def mod21(spark, sf_dir):
    """MOD-21, SRC-29, FN-11, FN-50: points of reports with three tables, two of them of rents."""
    return rent_points.rent_points(pages(spark, sf_dir, _REPORT, spread=True), "p_partkey", "body").withColumn("eff_psf", F.round("eff_psf", 6))
