"""Which rows of a charge ledger are units: by text, by charge codes, by sections that end the list, by number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .diagnostics import beside


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))


def cell_number(c: Column) -> Column:
    """A cell as a number, `$` and `,` left out; NULL if it is none."""
    return F.nullif(F.trim(F.regexp_replace(c.cast("string"), r"[$,]", "")), F.lit("")).try_cast("double")


def ledger_unit(unit: Column, plan: Column, sqft: Column, rent: Column, skip: list[str], codes: list[str], patterns: list[str] = ()) -> Column:
    """A unit's row: its id holds none of the texts `skip`, is no charge code and begins as one of `patterns` (if any are given);
    it has a floorplan and numbers for size and market rent, which summary lines of charges have not."""
    low = F.lower(F.trim(unit))
    bad = _any([low.contains(s.lower()) for s in skip]) | low.isin(*(c.lower() for c in codes))
    fits = _any([F.trim(unit).rlike(f"(?i)^(?:{p})") for p in patterns]) if patterns else F.lit(True)
    physical = (F.trim(F.coalesce(plan, F.lit(""))) != "") & cell_number(sqft).isNotNull() & cell_number(rent).isNotNull()
    return F.coalesce(fits & ~bad & physical, F.lit(False))


def listed_units(sheets: DataFrame, keys: list[str], unit: str, pattern: str = r"[A-Za-z]?\d+", skip: list[str] = (), stop: list[str] = (), dash: bool = False) -> DataFrame:
    """Rows of each sheet (keys, row_idx, ...) whose unit begins as `pattern`, holds none of `skip` and, unless `dash`, no dash, up
    to the first row whose unit holds one of `stop`: what follows are other people's sections."""
    cell = F.trim(F.col(unit))
    low = F.lower(cell)
    ends = sheets.where(_any([low.contains(s.lower()) for s in stop])).groupBy(*keys).agg(F.min("row_idx").alias("_end"))
    rows = beside(sheets, ends, keys, "left").where("_end IS NULL OR row_idx < _end").drop("_end")
    fits = cell.rlike(f"(?i)^(?:{pattern})") & ~_any([low.contains(s.lower()) for s in skip])
    return rows.where(fits if dash else fits & ~cell.contains("-"))


def unit_number(c: Column, low: int = 100, high: int = 300) -> Column:
    """The whole part of a cell that is a number from `low` to `high`, else NULL."""
    n = F.trim(c.cast("string")).try_cast("double").try_cast("int")
    return F.when(n.between(low, high), n)
