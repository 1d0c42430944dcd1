"""Listing sites: search pages with their posts, placards of both forms, missing and malformed fields, into entity resolution."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from lodeworks.operators import entity
from lodeworks.operators import listing_sites as ls

URL = "https://x.org/apa/d/{}/1.html"


def static(*items):
    return "<ol>" + "".join(f'<li class="cl-static-search-result" title="t"><a href="{u}"><div class="title">{t}</div></a></li>' for t, u in items) + '<li class="cl-static-search-result"><a href="https://x.org/other"></a></li></ol>'


def listed(*names):
    return f'<script type="application/ld+json" id="ld_searchpage_results">{json.dumps({"itemListElement": [{"item": {"name": n}} for n in names]})}</script>'


def test_search_results(spark):
    a, b, c = (URL.format(x) for x in "abc")
    pages = [(1, listed("Two", " One ", "", "Lost") + static(("One", a), ("Two", b), ("Three", c))), (2, static((" One ", a), ("Two", b), ("One", c))), (3, "<script id='x'>"), (4, None), (5, '<script id="ld_searchpage_results">{bad</script>' + static(("One", a)))]
    got = ls.search_results(spark.createDataFrame(pages, "id int, html string"), "id", "html").orderBy("id", "pos").collect()
    assert [(r.id, r.title, r.url) for r in got] == [(1, "Two", b), (1, "One", a), (2, "One", c), (2, "Two", b), (5, "One", a)]


POST = """<span id="titletextonly">Nice {kind} 2BR</span><span class="price"> $1,250 </span><b>2BR / 1.5Ba</b> 900ft<sup>2</sup>
<div data-latitude="33.61" data-longitude="-97.12"></div>{place}<section id="postingbody">See it at 12 <b>North Oak</b> Street. {zip}</section>post id: 77"""
LD = '<script type="application/ld+json">{}</script>'


def test_posts(spark):
    """Addresses from structured data, the map, the body; titles by keyword; a page that has not landed and one without marks."""
    street = json.dumps({"address": {"streetAddress": "9 Elm St", "addressLocality": "Gainesville", "postalCode": "76241"}})
    details = {
        "ld": POST.format(kind="apt", zip="", place=LD.format("{bad") + LD.format('{"address":{"streetAddress":" "}}') + LD.format(street)),
        "map": POST.format(kind="Duplex", zip="76240-1234", place='<p class="mapaddress"> 5 Main St </p>'), "body": POST.format(kind="house", zip="76240", place=""), "none": "<html>nothing</html>",
    }
    df = spark.createDataFrame([(URL.format(k), h) for k, h in details.items()], "url string, html string")
    results = spark.createDataFrame([(f"Home {k}", URL.format(k)) for k in [*details, "lost", "map"]] + [("Car", URL.format("body"))], "title string, url string")
    got = {r.url.split("/")[-2]: r for r in ls.posts(results, df, "r1", ["HOME", "rent"]).collect()}
    assert set(got) == {"ld", "map", "none"}  # the least of equal posts' titles counts, and Car has no keyword
    got = {r.url.split("/")[-2]: r for r in ls.posts(results, df, "r1").collect()}
    assert got["ld"].address_raw == "9 Elm St, Gainesville, 76241" and got["ld"].zip == "76241" and got["ld"].listing_kind == "mf" and got["ld"].city is None
    m = got["map"]
    assert (m.address_raw, m.zip, m.city, m.listing_kind, m.beds, m.baths, m.sqft, m.asking_rent, m.lat, m.lon) == ("5 Main St", "76240", "Gainesville", "duplex", 2.0, 1.5, 900, 1250, 33.61, -97.12)
    assert got["body"].address_raw == "12 North Oak Street" and got["body"].listing_kind == "sfr"
    n = got["none"]
    assert (n.beds, n.asking_rent, n.address_raw, n.title, n.body) == (None, None, "", "Home none", "")
    assert n.source_listing_id == hashlib.sha1(n.url.encode()).hexdigest()[:12] and m.observation_id == hashlib.sha1(b"craigslist|77|r1").hexdigest()
    assert ls.posts(results, df, "r1").columns == ls.OBSERVATION


def test_placards(spark):
    new = '<article class="placard placard-option-gold" data-listingid="L1" data-url="u1" data-streetaddress="1 A St"><div class="placardCarouselImgCount">3</div><span class="js-placardTitle title"> The Oaks </span><div class="property-address js-url" title="1 A St, Town, TX 76240"></div>'
    new += "".join(f'<div class="bedTextBox">{b}</div>\n<div class="priceTextBox"><span>{r}+</span></div>' for b, r in (("1 Bed", "$1,150"), ("3 Beds, 2 Baths, 1,300 sq ft", "&#36;1,900"), ("Studio", "$900"), ("2 Beds", "Call")))
    old = '<div class="placard" data-listingid="L2" data-url="u2"><div class="property-title" title="426 N Clements St"></div><p class="property-pricing">$1,000 - $1,400</p><p class="property-beds">1 - 3 Beds</p><p class="property-baths">2 Baths</p><p class="property-sqft">700 - 1,250 Sq Ft</p></div>'
    bare = '<article class="placard" data-listingid="L3" data-url="u3" data-streetaddress="9 B St"><p class="property-pricing">Call</p></article><article class="placard">no id</article>'
    pages = spark.createDataFrame([(1, new + "</article>" + old + bare + "</body>"), (2, "x"), (3, None)], "id int, html string")
    cards = {r.listing_id: r for r in ls.placards(pages, "id", "html").collect()}
    assert set(cards) == {"L1-1br", "L1-3br", "L2", "L3"}
    a, b, c = cards["L1-3br"], cards["L2"], cards["L3"]
    assert (a.name, a.address_raw, a.beds_max, a.baths_min, a.sqft_min, a.rent_max, cards["L1-1br"].rent_min, cards["L1-1br"].baths_min) == ("The Oaks", "1 A St, Town, TX 76240", 3.0, 2.0, 1300, 1900, 1150, None)
    assert (b.address_raw, b.beds_min, b.beds_max, b.baths_max, b.sqft_min, b.sqft_max, b.rent_min, b.rent_max) == ("426 N Clements St", 1.0, 3.0, 2.0, 700, 1250, 1000, 1400)
    assert (c.address_raw, c.name, c.rent_min, c.beds_min) == ("9 B St", None, None, None)
    got = {r.source_listing_id: r for r in ls.placard_observations(ls.placards(pages, "id", "html"), "r1").collect()}
    assert got["L2"].title == "426 N Clements St — 1-3BR/2-2BA" and got["L2"].beds == 1.0 and got["L1-3br"].title == "The Oaks" and got["L1-1br"].zip == "76240"


def test_observations_feed_the_fold(spark):
    """The same home on both sites, found by its address and beds."""
    card = '<div class="placard" data-listingid="L" data-url="u"><div class="property-title" title="426 N Clements St"></div><p class="property-beds">2 Beds</p></div>'
    cards = ls.placard_observations(ls.placards(spark.createDataFrame([(1, card)], "id int, html string"), "id", "html"), "r")
    page = POST.format(kind="house", zip="", place='<p class="mapaddress">426 North Clements Street</p>')
    posts = ls.posts(spark.createDataFrame([("t", "u")], "title string, url string"), spark.createDataFrame([("u", page)], "url string, html string"), "r")
    both = cards.unionByName(posts).withColumn("n", F.when(F.col("source") == "craigslist", 2).otherwise(1))
    obs = entity.observations(both.drop("addr", "zip"), "n", "address_raw")
    got = {r.ord: (r.action, r.canonical) for r in entity.fold(obs).collect()}
    assert got == {1: ("new", 1), 2: ("merged", 1)}


def test_placards_of_five_digit_houses(spark):
    card = '<div class="placard" data-listingid="L{0}" data-url="u"><div class="property-title" title="{0}"></div><p class="property-beds">2 Beds</p></div>'
    pages = spark.createDataFrame([(1, card.format("12345 Elm St") + card.format("12345 Oak St, TX 76240"))], "id int, html string")
    got = {r.address_raw: r.zip for r in ls.placard_observations(ls.placards(pages, "id", "html"), "r").collect()}
    assert got == {"12345 Elm St": None, "12345 Oak St, TX 76240": "76240"}
