"""Comparable properties: flags on cohorts and comps, overview, extractions merged into a snapshot, catchment and payload
choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import slug

#: Comps that a cohort needs, and the evidence that a comp should not rest on alone (fixed values).
THIN, ALONE = 3, "om_floorplan"


def thin_cohorts(rows: DataFrame, cohort: str) -> DataFrame:
    """(cohort, n, flag) of cohorts with fewer than THIN rows."""
    g = rows.groupBy(cohort).agg(F.count("*").alias("n")).where(F.col("n") < THIN)
    return g.withColumn("flag", F.concat(F.lit("thin_cohort_"), F.col(cohort).cast("string"), F.lit("_only_"), F.col("n").cast("string"), F.lit("_comps")))


def single_evidence(unit_types: DataFrame, comp: str, quality: str, kind: str = ALONE) -> DataFrame:
    """Comps all of whose unit types rest on one kind of evidence; a missing kind is another one."""
    return unit_types.groupBy(comp).agg(F.bool_and(F.coalesce(F.col(quality), F.lit("")) == kind).alias("_all")).where("_all").select(comp, F.concat(F.lit("om_only_comp_"), F.coalesce(F.nullif(slug(F.col(comp).cast("string")), F.lit("")), F.lit("unknown_comp"))).alias("flag"))


def overview(units_available: Column, available: Column, low: Column, high: Column) -> Column:
    """Struct of a comp's available units (the given number, else the array's length) and its least and greatest rent (given, else
    of the units in the array; nulls in it don't count)."""
    rents = F.transform(available, lambda u: u["rent"])
    return F.struct(F.coalesce(units_available, F.size(available), F.lit(0)).alias("units"), F.coalesce(low, F.array_min(rents)).alias("min_rent"), F.coalesce(high, F.array_max(rents)).alias("max_rent"))


def merge_extractions(snapshot: DataFrame, extractions: DataFrame, key: str) -> DataFrame:
    """A snapshot's comps (key, floorplans, specials, platform) with the extractions of the same key that hold floorplans:
    those replace plans and platform, specials of both stay once, the snapshot's first. `extracted` tells which."""
    new = extractions.where(F.size("floorplans") > 0).select(F.col(key).alias("_slug"), F.struct("floorplans", "specials", "platform").alias("_new")).dropDuplicates(["_slug"])
    j = snapshot.join(new, F.col(key) == F.col("_slug"), "left")
    got = F.col("_new").isNotNull()
    empty = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    return j.select(
        *(c for c in snapshot.columns if c not in ("floorplans", "specials", "platform")), F.when(got, F.col("_new.floorplans")).otherwise(F.col("floorplans")).alias("floorplans"),
        F.when(got, F.array_distinct(F.concat(empty(F.col("specials")), empty(F.col("_new.specials"))))).otherwise(F.col("specials")).alias("specials"),
        F.when(got, F.coalesce(F.nullif("_new.platform", F.lit("")), F.lit("llm_extracted"))).otherwise(F.col("platform")).alias("platform"), got.alias("extracted"),
    )


def in_catchment(zip_code: Column, zips: list[str]) -> Column:
    """Rows of the zips, and those without one: theirs is found later."""
    return F.coalesce(zip_code, F.lit("")).isin("", *zips)


def largest_payload(payloads: DataFrame, keys: list[str], body: str, order: str) -> DataFrame:
    """The longest payload of each page, the first of equally long ones."""
    best = F.max_by(F.struct(order, body), F.struct(F.length(body), -F.col(order))).alias("b")
    return payloads.where(F.col(body).isNotNull()).groupBy(*keys).agg(best).select(*keys, f"b.{order}", f"b.{body}")


def places(observations: DataFrame, canonical: str) -> DataFrame:
    """The greatest latitude and longitude of the observations of each canonical that have both."""
    return observations.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy(canonical).agg(F.max("lat").alias("lat"), F.max("lon").alias("lon"))
