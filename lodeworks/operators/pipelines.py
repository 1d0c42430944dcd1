"""Whole steps over landed data: scrape runs against a manifest, address extraction, lenient JSON, periods to load, and
statuses of grouped results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import haversine_miles, strip_tags

from .extract import ld_json


def lenient_json(text: Column, schema: str) -> Column:
    """JSON in a text with fences or words around it: what stands between the outermost braces."""
    return F.from_json(F.regexp_extract(F.regexp_replace(text, r"```(?:json)?", ""), r"(?s)(\{.*\})", 1), schema)


def page_address(html: Column) -> Column:
    """Address of a page: JSON-LD, else the map block, else the first street address with a zip in its text."""
    ld = ld_json(html, "address struct<streetAddress:string,addressLocality:string,addressRegion:string,postalCode:string>")["address"]
    lines = F.concat_ws(", ", ld["streetAddress"], ld["addressLocality"], F.nullif(F.concat_ws(" ", ld["addressRegion"], ld["postalCode"]), F.lit("")))
    block = strip_tags(F.regexp_extract(html, r'(?is)<div[^>]*class="mapaddress"[^>]*>(.*?)</div>', 1))
    body = F.regexp_extract(strip_tags(html), r"(\d+ [A-Z][\w. ]+, [A-Z][\w ]+, [A-Z]{2} \d{5})", 1)
    return F.coalesce(F.when(ld["streetAddress"].isNotNull(), lines), F.nullif(block, F.lit("")), F.nullif(body, F.lit("")))


def zip_of(address: Column) -> Column:
    return F.nullif(F.regexp_extract(address, r"(\d{5})(?:-\d{4})?\s*$", 1), F.lit(""))


def manifest_run(manifest: DataFrame, scraped: DataFrame, key: str, url: str) -> DataFrame:
    """A row for every manifest entry: the scraped one, or a placeholder with why there is none."""
    got = scraped.withColumn("_ok", F.lit(True))
    status = F.when(F.coalesce("_ok", F.lit(False)), F.coalesce("status", F.lit("ok"))).when(F.coalesce(F.trim(url), F.lit("")) == "", "no_url").otherwise("fetch_error")
    j = manifest.join(got, key, "left")
    return j.select(*manifest.columns, *(c for c in scraped.columns if c not in (key, "status") and c not in manifest.columns), status.alias("status"))


def with_distance(df: DataFrame, lat: str, lon: str, centre: tuple[float, float]) -> DataFrame:
    """Miles from a centre, 2 places; NULL without coordinates."""
    return df.withColumn("distance_mi", F.round(haversine_miles(F.lit(centre[0]), F.lit(centre[1]), lat, lon), 2))


def quarters_until(df: DataFrame, first: Column, today: Column) -> DataFrame:
    """(year, quarter) of every row's start to the last quarter whose 28th of the last month has passed."""
    months = F.explode(F.sequence(F.trunc(first, "quarter"), F.trunc(today, "quarter"), F.expr("interval 3 months")))
    out = df.select("*", months.alias("_q")).where(F.date_add(F.add_months("_q", 2), 27) <= today)
    return out.withColumn("year", F.year("_q")).withColumn("quarter", F.quarter("_q")).drop("_q")


def evidence_rows(payload: Column, schema: str) -> Column:
    """Rows of evidence given as a JSON list, or as a JSON object with `rows`; none for anything else."""
    return F.coalesce(F.from_json(payload, f"array<{schema}>"), F.from_json(payload, f"rows array<{schema}>")["rows"], F.array().cast(f"array<{schema}>"))


def valid_evidence(rows: Column) -> Column:
    """There are rows and every one names its source."""
    return (F.size(rows) > 0) & F.forall(rows, lambda r: F.coalesce(F.trim(r["source"]), F.lit("")) != "")


def comps_status(df: DataFrame, group: str, comp: str, has_types: Column) -> DataFrame:
    """Per group: comps, and error for none, needs_analyst_input for fewer than 3 or none with unit types, else ok."""
    g = df.groupBy(group).agg(F.count_distinct(F.col(comp)).alias("comps"), F.bool_or(has_types).alias("_t"))
    return g.select(group, "comps", F.when(F.col("comps") == 0, "error").when((F.col("comps") < 3) | ~F.coalesce("_t", F.lit(False)), "needs_analyst_input").otherwise("ok").alias("status"))
