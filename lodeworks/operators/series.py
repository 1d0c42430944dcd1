"""Public series over landed rows (all-string columns), as records of (metric, value, as_of, geo_level, msa_code, source_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metrics of quarterly employment rows, with the fields they come from (fixed values).
EMPLOYMENT = {
    "qcew_employment_month3": "month3_emplvl",
    "qcew_avg_weekly_wage": "avg_wkly_wage",
    "qcew_total_quarterly_wages": "total_qtrly_wages",
    "qcew_qtrly_estabs": "qtrly_estabs",
}
#: Markers of missing values.
MISSING = ["", ".", "-", "NA", "N/A"]


def _record(metric: Column, value: Column, as_of: Column, msa: Column, source_id: str) -> list[Column]:
    return [metric.alias("metric"), value.alias("value"), as_of.alias("as_of"), F.lit("msa").alias("geo_level"), msa.alias("msa_code"), F.lit(source_id).alias("source_id")]


def employment(df: DataFrame, keys: list[str], msa: str, year: str, quarter: str, source_id: str) -> DataFrame:
    """Each row's metrics as records, as_of year-Qn; missing and unreadable values give none."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(c).cast("string").alias("raw")) for m, c in EMPLOYMENT.items())))
    rows = df.select(*keys, F.col(msa).cast("string").alias("_msa"), F.concat_ws("-Q", F.col(year).cast("string"), F.col(quarter).cast("string")).alias("_as_of"), each.alias("m"))
    value = F.when(~F.col("m.raw").isin("", "."), F.col("m.raw").try_cast("double"))
    return rows.select(*keys, *_record(F.col("m.metric"), value, F.col("_as_of"), F.col("_msa"), source_id)).where("value is not null")


def unemployment(df: DataFrame, keys: list[str], msa: str, source_id: str) -> DataFrame:
    """(year, periodName, value) rows as unemployment rates, as_of year-period; markers of missing values give none."""
    raw = F.trim(F.coalesce(F.col("value").cast("string"), F.lit("")))
    value = F.when(~raw.isin(MISSING), raw.try_cast("double"))
    as_of = F.concat_ws("-", F.col("year").cast("string"), "periodName")
    return df.select(*keys, *_record(F.lit("unemployment_rate"), value, as_of, F.col(msa).cast("string"), source_id)).where("value is not null")


def sale_prices(df: DataFrame, keys: list[str], region: str, source_id: str) -> DataFrame:
    """Rows of one region as median sale prices; a missing price is 0."""
    value = F.coalesce(F.col("median_sale_price").cast("string").try_cast("double"), F.lit(0.0))
    return df.where(F.col("region") == region).select(*keys, *_record(F.lit("median_sale_price"), value, F.col("period_end").cast("string"), F.col("region_code").cast("string"), source_id))


def permits(df: DataFrame, keys: list[str], msa: str, source_id: str) -> DataFrame:
    """Monthly permits as whole numbers (half to even), as_of year-mm."""
    value = F.rint(F.col("permit").cast("string").try_cast("double")).cast("bigint")
    as_of = F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return df.select(*keys, *_record(F.lit("permits_total"), value, as_of, F.col(msa).cast("string"), source_id)).where("value is not null")


def backfill_rents(plans: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Plans whose rent_min or rent_max is missing or not positive take the least or largest positive rent of their units."""
    rent = F.col("rent").cast("string").try_cast("double")
    g = units.where(rent > 0).groupBy(F.col(key).alias("_k")).agg(F.min(rent).alias("_lo"), F.max(rent).alias("_hi"))
    fill = lambda c, by: F.when(F.coalesce(F.col(c), F.lit(0.0)) <= 0, F.coalesce(F.col(by), F.col(c))).otherwise(F.col(c)).alias(c)
    return plans.join(g, F.col(key) == F.col("_k"), "left").select(*(fill(c, {"rent_min": "_lo", "rent_max": "_hi"}[c]) if c in ("rent_min", "rent_max") else F.col(c) for c in plans.columns))
