"""Listing sites over landed pages: search pages joined to the pages of their posts, placards fanned out by bed type, both
mapped to the observations that entity resolution reads. Element names and labels are what the sites dictate (fixed values).

Defined cases: pages without the marks give no rows; a field that is missing or malformed is NULL; a post named twice comes
once, at its first place; a post whose page has not landed gives no observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import address_normalise, zip_code

from .extract import attribute

#: Columns of an observation.
OBSERVATION = [
    "observation_id", "run_id", "source", "source_listing_id", "url", "listing_kind", "address_raw", "addr", "city", "zip", "lat", "lon", "beds", "baths", "sqft", "asking_rent", "title", "body",
]
STREET = r"(?i)\b(\d{1,5}\s+[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,3}\s+(?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard|Drive|Dr|Lane|Ln|Pkwy|Parkway|Pl|Place|Way|Ct|Court|Cir|Circle))\b"
HOME_ZIP, HOME_CITY = "76240", "Gainesville"
BODY = 2000


def _got(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def _id(source: str, listing: Column, run_id: str) -> Column:
    return F.sha1(F.concat(F.lit(f"{source}|"), listing, F.lit(f"|{run_id}")))


# ----------------------------------------------------------------- posts


def search_results(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, title, url) of a search page: the titles of its structured list in order with the links of the static list, or
    the static list alone where there is none."""
    items = F.slice(F.split(html, '<li class="cl-static-search-result"'), 2, 1_000_000)
    found = F.transform(items, lambda x: F.struct(F.trim(_got(x, r'<div class="title">([^<]+)</div>')).alias("title"), F.trim(_got(x, r'<a href="(https://[^"]+/apa/d/[^"]+)"')).alias("url")))
    static = F.filter(found, lambda x: x["title"].isNotNull() & x["url"].isNotNull())
    block = _got(F.col(html), r'(?s)<script[^>]+id="ld_searchpage_results"[^>]*>(.*?)</script>')
    listed = F.from_json(block, "itemListElement array<struct<item:struct<name:string>>>")["itemListElement"]
    names = F.filter(F.transform(listed, lambda x: F.trim(x["item"]["name"])), lambda n: n.isNotNull() & (n != ""))
    rows = pages.select(key, static.alias("s"), F.when(F.size(names) > 0, names).otherwise(F.array_distinct(F.transform(static, lambda x: x["title"]))).alias("n"))
    # Of equal titles the last link counts.
    url = lambda n: F.try_element_at(F.filter("s", lambda x: x["title"] == n), F.lit(-1))["url"]
    rows = rows.select(key, F.posexplode("n").alias("pos", "title"), "s").select(key, "pos", "title", url(F.col("title")).alias("url")).where("url IS NOT NULL")
    first = rows.groupBy(key, "url").agg(F.min(F.struct("pos", "title")).alias("f"))
    return first.select(key, "f.pos", "f.title", "url")


def post(html: Column) -> Column:
    """The fields of a post's page. The address comes from structured data, else the map block, else the first street in the body;
    the zip from the body, else the address."""
    body = F.trim(_got(html, r'(?s)<section id="postingbody">(.*?)</section>'))
    blocks = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]+type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    places = F.transform(blocks, lambda b: F.from_json(b, "address struct<streetAddress:string,addressLocality:string,addressRegion:string,postalCode:string>")["address"])
    parts = lambda a: F.filter(F.array(*(F.trim(a[f]) for f in ("streetAddress", "addressLocality", "addressRegion", "postalCode"))), lambda x: x.isNotNull() & (x != ""))
    structured = F.get(F.transform(F.filter(places, lambda a: F.trim(a["streetAddress"]) != ""), lambda a: F.array_join(parts(a), ", ")), F.lit(0))
    mapped = F.nullif(F.trim(_got(html, r'<p class="mapaddress">([^<]+)</p>')), F.lit(""))
    street = F.regexp_replace(_got(F.regexp_replace(body, r"<[^>]+>", " "), STREET), r"\s+", " ")
    address = F.coalesce(structured, mapped, street, F.lit(""))
    five = r"\b(\d{5})(?:-\d{4})?\b"
    sqft = F.coalesce(_got(html, r"(?i)(\d{3,5})\s*ft<sup>2</sup>"), _got(html, r"(?i)(\d{3,5})\s*sqft"))
    place = lambda g: _got(html, r'data-latitude="([0-9.\-]+)"\s+data-longitude="([0-9.\-]+)"', g).try_cast("double")
    return F.struct(
        _got(html, r"(?i)post id:\s*(\d+)").alias("source_listing_id"), _got(html, r"(?i)(\d+(?:\.\d+)?)\s*BR\b").try_cast("double").alias("beds"), _got(html, r"(?i)(\d+(?:\.\d+)?)\s*Ba\b").try_cast("double").alias("baths"),
        sqft.try_cast("int").alias("sqft"), _number(_got(html, r'<span class="price">\s*\$([0-9,]+)\s*</span>')).cast("int").alias("asking_rent"), place(1).alias("lat"), place(2).alias("lon"),
        F.coalesce(_got(body, five), zip_code(address)).alias("zip"), address.alias("address_raw"), _got(html, r'<span id="titletextonly">([^<]+)</span>').alias("title"), F.substring(F.coalesce(body, F.lit("")), 1, BODY).alias("body"),
    )


def kind(title: Column, body: Column) -> Column:
    """duplex by title or body, fourplex or mf by title, else sfr."""
    t, b = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(body, F.lit("")))
    return F.when(t.contains("duplex") | b.contains("duplex"), "duplex").when(t.contains("fourplex") | t.contains("4-plex"), "fourplex").when(t.rlike("apartment|apt|complex| unit "), "mf").otherwise("sfr")


def posts(results: DataFrame, details: DataFrame, run_id: str, keywords: list[str] = ()) -> DataFrame:
    """Observations of the posts that search results (title, url) name, by the pages that landed (url, html): the two levels of a
    site met by address. With `keywords`, only titles that hold one."""
    named = results.groupBy("url").agg(F.min("title").alias("_title"))
    if keywords:
        named = named.where(F.exists(F.array(*(F.lit(k.lower()) for k in keywords)), lambda k: F.lower("_title").contains(k)))
    rows = named.join(details.select("url", post(F.col("html")).alias("p")), "url")
    p = rows.select("url", "_title", "p.*")
    listing = F.coalesce("source_listing_id", F.substring(F.sha1("url"), 1, 12))
    return p.select(
        _id("craigslist", listing, run_id).alias("observation_id"), F.lit(run_id).alias("run_id"), F.lit("craigslist").alias("source"), listing.alias("source_listing_id"), "url", kind(F.col("title"), F.col("body")).alias("listing_kind"), "address_raw",
        address_normalise(F.col("address_raw")).alias("addr"), F.when(F.col("zip") == HOME_ZIP, HOME_CITY).alias("city"), "zip", "lat", "lon", "beds", "baths", "sqft", "asking_rent", F.coalesce("title", "_title").alias("title"), "body",
    )


# ----------------------------------------------------------------- placards


def placards(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, listing_id, url, name, address_raw, beds_min ... rent_max) of a search page's placards: one row a bed type where the
    placard lists rents by beds, else one with its ranges."""
    parts = F.slice(F.split(html, r'<(?:article|div)\s+class="placard(?=[\s"])'), 2, 1_000_000)
    rows = pages.select(key, F.posexplode(parts).alias("pos", "c"))
    tag, body = F.substring_index("c", ">", 1), F.col("c")
    title = F.coalesce(_got(body, r'class="js-placardTitle title">([^<]+)<'), _got(body, r'class="property-title"\s+title="([^"]+)"'))
    street = F.nullif(attribute(tag, "data-streetaddress"), F.lit(""))
    rows = rows.select(key, "c", attribute(tag, "data-listingid").alias("_id"), attribute(tag, "data-url").alias("url"), F.trim(title).alias("name"), street.alias("street"))
    given = F.coalesce(_got(F.col("c"), r'class="property-address[^"]*"\s+title="([^"]+)"'), _got(F.col("c"), r'class="property-address">([^<]+)<'))
    address = F.coalesce(F.trim(given), F.col("street"), F.when(F.col("name").rlike(r"^\d+\s+\w"), F.col("name")))
    box = F.lit(r'class="bedTextBox">([^<]+)</div>\s*<div class="priceTextBox">\s*<span>(?:&#36;|\$)?([0-9,]+)')
    boxes = F.arrays_zip(F.regexp_extract_all("c", box, F.lit(1)).alias("beds"), F.regexp_extract_all("c", box, F.lit(2)).alias("rent"))
    rows = rows.where("_id <> ''").select(key, "_id", "url", "name", address.alias("address_raw"), "c", boxes.alias("boxes"))
    whole = lambda c: _number(c).cast("int")
    fan = rows.where(F.size("boxes") > 0).select(key, "_id", "url", "name", "address_raw", F.explode("boxes").alias("b"))
    detail = r"(?i)^\s*(\d+(?:\.\d+)?)\s*Beds?(?:,\s*(\d+(?:\.\d+)?)\s*Baths?)?(?:,\s*([0-9,]+)\s*sq\s*ft)?"
    f = lambda g: _got(F.col("b.beds"), detail, g)
    fan = fan.select(key, "_id", "url", "name", "address_raw", f(1).cast("double").alias("beds"), f(2).cast("double").alias("baths"), whole(f(3)).alias("sqft"), whole(F.col("b.rent")).alias("rent")).where("beds IS NOT NULL")
    out = ["beds", "baths", "sqft", "rent"]
    one = fan.select(key, F.concat("_id", F.lit("-"), F.col("beds").cast("int").cast("string"), F.lit("br")).alias("listing_id"), "url", "name", "address_raw", *(F.col(c).alias(f"{c}_{m}") for c in out for m in ("min", "max")))
    text = lambda name, pattern, g: _got(F.col("c"), rf'(?i)class="property-{name}">\s*{pattern}', g)
    ranges = {"beds": ("beds", r"([0-9.]+)(?:\s*-\s*([0-9.]+))?\s*Beds?"), "baths": ("baths", r"([0-9.]+)(?:\s*-\s*([0-9.]+))?\s*Baths?"), "sqft": ("sqft", r"([0-9,]+)(?:\s*-\s*([0-9,]+))?\s*Sq"), "rent": ("pricing", r"[^<0-9]*([0-9,]+)(?:\s*-\s*[^<0-9]*([0-9,]+))?")}
    cast = lambda c, x: x.try_cast("double") if c in ("beds", "baths") else whole(x)
    old = rows.where(F.size("boxes") == 0).select(
        key, F.col("_id").alias("listing_id"), "url", "name", "address_raw", *(cast(c, x).alias(f"{c}_{m}") for c, (n, p) in ranges.items() for m, x in (("min", text(n, p, 1)), ("max", F.coalesce(text(n, p, 2), text(n, p, 1)))))
    )
    return one.unionByName(old)


def placard_observations(cards: DataFrame, run_id: str) -> DataFrame:
    """Observations of placards: exact values of fanned-out ones, the least of a range, which the title then tells."""
    g = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"\.0$", ""), F.lit("?"))
    span = F.concat(g("beds_min"), F.lit("-"), g("beds_max"), F.lit("BR/"), g("baths_min"), F.lit("-"), g("baths_max"), F.lit("BA"))
    title = F.when(F.col("beds_min") != F.col("beds_max"), F.concat_ws(" — ", "name", span)).otherwise(F.col("name"))
    raw = F.coalesce("address_raw", F.lit(""))
    return cards.select(
        _id("apartments_com", F.col("listing_id"), run_id).alias("observation_id"), F.lit(run_id).alias("run_id"), F.lit("apartments_com").alias("source"), F.col("listing_id").alias("source_listing_id"), "url", F.lit("mf").alias("listing_kind"),
        raw.alias("address_raw"), address_normalise(raw).alias("addr"), F.lit(HOME_CITY).alias("city"), zip_code(raw).alias("zip"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
        F.col("beds_min").alias("beds"), F.col("baths_min").alias("baths"), F.col("sqft_min").alias("sqft"), F.col("rent_min").alias("asking_rent"), title.alias("title"), F.lit(None).cast("string").alias("body"),
    )
