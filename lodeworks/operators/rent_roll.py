"""Rent rolls given as rows of a sheet (row_idx and text cells): header detection, column aliases, row filters, the
canonical unit, keep-best deduplication, charge ledgers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.text import alias_of, blank_to_null, currency, iso_date, longest_prefix, whole

from . import windows as win
from .aggregates import charge_pivot

#: The canonical unit's columns (fixed values).
UNIT = ["property", "snapshot_date", "unit", "plan_code", "bed_type", "baths", "sqft", "status", "resident", "market_rent", "lease_rent", "lease_start", "lease_end", "move_in", "total_rent"]
MONEY, DATES = ("market_rent", "lease_rent", "total_rent"), ("lease_start", "lease_end", "move_in")
STATUS_RANK = {"Occupied": 0, "Notice": 1, "Vacant": 2}


def header_row(sheet: DataFrame, keywords: list[str], within: int = 20) -> DataFrame:
    """One row: the first of so many rows with a cell that is a keyword, else 0."""
    cells = F.transform("cells", lambda c: F.lower(F.trim(c)))
    hit = F.arrays_overlap(cells, F.array(*(F.lit(k.lower()) for k in keywords)))
    return sheet.where(F.col("row_idx") < within).agg(F.coalesce(F.min(F.when(hit, F.col("row_idx"))), F.lit(0)).alias("row_idx"))


def find_column(headers: list[str], aliases: list[str]) -> str | None:
    """The header that the first fitting alias names, case and spaces ignored."""
    plain = {re.sub(r"\s+", " ", h).strip().lower(): h for h in reversed(headers)}
    return next((plain[a.lower()] for a in aliases if a.lower() in plain), None)


def detect_config(headers: list[str], configs: dict[str, list[str]], least: int = 3) -> str | None:
    """The config most of whose aliases are among the headers, if at least `least`; the first wins ties."""
    plain = {h.strip().lower() for h in headers}
    score = {name: sum(a.lower() in plain for a in aliases) for name, aliases in configs.items()}
    best = max(score, key=lambda k: score[k], default=None)
    return best if best is not None and score[best] >= least else None


def from_sheet(sheet: DataFrame, keywords: list[str], within: int = 20) -> DataFrame:
    """Rows below the detected header as columns named by it. The header is one row of the sheet, read by the driver."""
    at = header_row(sheet, keywords, within).first()[0]
    head = sheet.where(F.col("row_idx") == at).select("cells").first()
    names = [n or f"c{i}" for i, n in enumerate(head[0])] if head else []
    return sheet.where(F.col("row_idx") > at).select("row_idx", *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)))


def canonical_units(rows: DataFrame, aliases: dict[str, list[str]], statuses: dict[str, list[str]], beds: dict[str, str], stop: str | None = None, skip: str | None = None) -> DataFrame:
    """Source rows to canonical units: aliased columns, blanks to NULL, money, dates, status and bed types cleaned; rows
    without a unit or that match `skip` go, and all from the first row whose unit matches `stop`."""
    col = {c: F.col(f"`{h}`") if (h := find_column(rows.columns, aliases.get(c, [c]))) else F.lit(None).cast("string") for c in UNIT}
    unit = blank_to_null(col["unit"])
    if stop:
        end = rows.agg(F.min(F.when(unit.rlike(f"^(?:{stop})"), F.col("row_idx"))).alias("end"))
        rows = rows.crossJoin(F.broadcast(end)).where(F.col("end").isNull() | (F.col("row_idx") < F.col("end")))  # one row
    rows = rows.where(unit.isNotNull() & (~unit.rlike(f"^(?:{skip})") if skip else F.lit(True)))

    def value(c: str) -> Column:
        x = blank_to_null(col[c].cast("string"))
        if c in MONEY:
            return currency(x)
        if c in DATES:
            return iso_date(x)
        if c == "sqft":
            return whole(x)
        if c == "baths":
            return currency(x)
        if c == "status":
            return alias_of(x, statuses)
        if c == "bed_type":
            return F.coalesce(x, longest_prefix(blank_to_null(col["plan_code"]), beds))
        return x

    return rows.select("row_idx", *(value(c).alias(c) for c in UNIT))


def keep_best_units(units: DataFrame) -> DataFrame:
    """One row a unit: best status, then the larger lease rent, then the first row."""
    rank = F.lit(len(STATUS_RANK))
    for s, i in STATUS_RANK.items():
        rank = F.when(F.col("status") == s, F.lit(i)).otherwise(rank)
    return win.keep_best(units, ["property", "unit"], [rank, F.desc(F.coalesce("lease_rent", F.lit(0.0))), F.col("row_idx")])


def ledger(rows: DataFrame, unit: str, text: str, amount: str, rules: list[tuple[str, str]], keys: list[str]) -> DataFrame:
    """Charge lines below unit rows: the unit is carried forward, then lines are pivoted into buckets."""
    lines = win.carry_forward(rows, keys, "row_idx", blank_to_null(unit), "_unit").where("_unit is not null")
    lines = lines.withColumn("_unit", F.concat_ws("|", *keys, "_unit")).withColumn("_amount", currency(amount))
    return charge_pivot(lines, "_unit", text, "_amount", rules)


def validate(units: DataFrame, expected: int) -> DataFrame:
    """One row: units, whether the count is within 2 of the expected, critical NULLs, zero rents on occupied units, and
    whether occupancy is between 50 and 100 %."""
    occ = F.col("status") == "Occupied"
    pct = 100.0 * F.count_if(occ) / F.nullif(F.count("*"), F.lit(0))
    return units.agg(
        F.count("*").alias("units"), (F.abs(F.count("*") - expected) <= 2).alias("count_ok"), F.count_if(F.col("plan_code").isNull() | F.col("sqft").isNull()).alias("critical_nulls"),
        F.count_if(occ & (F.coalesce("lease_rent", F.lit(0.0)) == 0)).alias("zero_rent"), pct.between(50, 100).alias("occupancy_ok"),
    )


def natural_order(df: DataFrame, column: str) -> DataFrame:
    from lodeworks.functions.text import natural_key

    return df.withColumn("_k", natural_key(column)).orderBy("_k", column).drop("_k")


def contiguous_prefix(sheet: DataFrame, cell: Column, pattern: str, start: int) -> DataFrame:
    """Rows from `start` until the first whose cell does not match."""
    rows = sheet.where(F.col("row_idx") >= start)
    w = win.running(Window.partitionBy(F.lit(0)).orderBy("row_idx"))  # a sheet is small
    return rows.withColumn("_bad", F.max((~F.coalesce(cell.rlike(pattern), F.lit(False))).cast("int")).over(w)).where("_bad = 0").drop("_bad")
