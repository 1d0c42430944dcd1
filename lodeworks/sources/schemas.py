"""Schemas of the listings tables, made as empty Parquet tables where absent; keys are checked, as Parquet enforces none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables with their columns and keys (fixed values).
TABLES = {
    "property_register": ("property_id string, address_raw string, address_normalized string, city string, zip string, county_fips string, lat double, lon double, units int, property_type string, size_class string, owner string, owner_normalized string, in_city boolean, source_of_truth string, updated_at timestamp", ["property_id"]),
    "raw_observations": ("observation_id string, run_id string, source string, source_listing_id string, scraped_at timestamp, url string, address_raw string, address_normalized string, zip string, lat double, lon double, beds double, baths double, sqft int, asking_rent double, listing_kind string, title string, description string, available_date string, processed boolean", ["observation_id"]),
    "canonical_listings": ("canonical_id string, property_id string, address_normalized string, beds double, baths double, sqft int, asking_rent double, min_rent double, max_rent double, listing_kind string, first_seen date, last_seen date, days_on_market int, status string, sources array<string>, observation_ids array<string>, confidence double, manual_override boolean", ["canonical_id"]),
    "run_log": ("run_id string, started_at timestamp, ended_at timestamp, sources_ok array<string>, sources_failed array<string>, n_observations int, n_new int, n_merged int, n_review int", ["run_id"]),
    "dedup_review": ("review_id string, observation_id string, candidate_canonical_id string, confidence double, tier string, decision string, decided_at timestamp", ["review_id"]),
    "rent_index": ("zip string, month date, home_type string, value double", ["zip", "month", "home_type"]),
    "schema_version": ("version int, applied_at timestamp", ["version"]),
}


def apply_schema(spark: SparkSession, path: str) -> list[str]:
    """Tables that were missing and are now there, empty. A second call makes none."""
    made = []
    for name, (ddl, _) in TABLES.items():
        at = f"{path}/{name}"
        where = spark._jvm.org.apache.hadoop.fs.Path(at)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            spark.createDataFrame([], ddl).write.parquet(at)
            made.append(name)
    return made


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name][0]).parquet(f"{path}/{name}")


def duplicate_keys(df: DataFrame, name: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*TABLES[name][1]).agg(F.count("*").alias("n")).where("n > 1")
