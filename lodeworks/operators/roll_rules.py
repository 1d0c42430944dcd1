"""Rent rolls by declarative rules: a mapping (column aliases, status and bed maps, filters, transformations) is checked and
compiled to one tree of built-in columns over the cells of a sheet.

Sheets are rows (keys of the sheet, row_idx, cells). Headers are data, too: each sheet's header row is found, lower-cased
and joined to its rows, and aliases look their column up in it, so one plan reads any number of sheets of any order of
columns. A sheet is small; its rows are windowed by its keys.

Defined cases: missing cells are empty; a header that comes twice stands for its last column; the first alias that a header
has wins; unknown statuses, beds and dates stay as they are, numbers that can't be read are NULL; a sheet with a section
terminator ends there and keeps repeated units, others keep the best row of a unit, the first of equal ones."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows as win
from .diagnostics import beside

#: The canonical columns (fixed values).
CANONICAL = ["unit_id", "floorplan_code", "bed_type", "bath_count", "sqft", "market_rent", "lease_rent", "status", "resident_name", "move_in_date", "lease_start", "lease_end"]
INCOME = ["base_rent", "pet_rent", "parking_rent", "storage_rent", "utility_reimbursement", "other_income", "concessions"]
#: Headers that tell a source system, tried in order (fixed values).
SIGNATURES = [
    ("yardi", {"unitcode", "floorplan", "marketrent"}), ("yardi", {"unit code", "floor plan", "market rent"}),
    ("realpage", {"apt", "floor plan", "actual rent"}), ("realpage", {"apt #", "sq. ft.", "asking rent"}),
    ("appfolio", {"unit name", "target rent", "tenant name"}), ("appfolio", {"listed rent", "move-in date", "lease end date"}),
    ("resman", {"floor plan name", "scheduled rent", "lease expiration"}), ("resman", {"fp code", "advertised rent", "occupancy status"}),
]
#: Parts of a mapping and what they may hold.
SECTIONS = {
    "source_system": str, "version": str, "description": str, "file_settings": dict, "column_mappings": dict, "income_columns": dict, "status_mappings": dict, "bed_type_mappings": dict, "row_filters": dict, "transformations": dict,
    "unit_type_mappings": dict, "floorplan_mappings": dict, "floorplan_bed_bath_patterns": list,
}
#: Date directives and the patterns that read them; one digit will do where two are usual.
DIRECTIVES = {"%m": "M", "%d": "d", "%Y": "yyyy", "%y": "yy", "%H": "H", "%M": "m", "%S": "s", "%b": "MMM", "%B": "MMMM", "%I": "h", "%p": "a"}


class RuleError(ValueError):
    """What is wrong with a mapping, all of it."""


def load(text: str) -> dict:
    """A mapping from YAML, checked."""
    import yaml

    config = yaml.safe_load(text)
    problems = check(config)
    if problems:
        raise RuleError("; ".join(problems))
    return config


def date_pattern(directives: str) -> str:
    """The pattern of a format in percent directives; KeyError for a directive that is not known."""
    parts = re.split(r"(%.)", directives)
    return "".join(DIRECTIVES[p] if p.startswith("%") else re.sub(r"([A-Za-z]+)", r"'\1'", p) for p in parts)


def check(config) -> list[str]:
    """Everything wrong with a mapping; none if it can be compiled."""
    if not isinstance(config, dict):
        return ["a mapping must be a dictionary"]
    out = [f"{k}: unknown section" for k in config if k not in SECTIONS]
    out += [f"{k}: must be a {t.__name__}" for k, t in SECTIONS.items() if k in config and config[k] is not None and not isinstance(config[k], t) and t is not str]
    part = lambda k: config.get(k) if isinstance(config.get(k), SECTIONS[k]) else SECTIONS[k]()
    for section, known in (("column_mappings", CANONICAL), ("income_columns", INCOME)):
        out += [f"{section}.{f}: unknown field" for f in part(section) if f not in known]
    for section in ("column_mappings", "income_columns", "status_mappings", "bed_type_mappings"):
        out += [f"{section}.{f}: must be a list of texts" for f, a in part(section).items() if not isinstance(a, list) or not all(isinstance(x, str | int) for x in a)]
    if "column_mappings" in config and not part("column_mappings").get("unit_id"):
        out.append("column_mappings.unit_id: needs an alias")
    filters, change = part("row_filters"), part("transformations")
    patterns = [(f"row_filters.{k}", p) for k in ("skip_patterns", "section_terminator_patterns") for p in filters.get(k) or []]
    patterns += [("floorplan_bed_bath_patterns", r.get("pattern", "")) for r in part("floorplan_bed_bath_patterns") if isinstance(r, dict)]
    for where, p in patterns:
        try:
            re.compile(p)
        except (re.error, TypeError):
            out.append(f"{where}: {p!r} is no pattern")
    for f in [change.get("date_format", "%m/%d/%Y"), *(change.get("alternate_date_formats") or [])]:
        try:
            date_pattern(f)
        except (KeyError, TypeError):
            out.append(f"transformations: {f!r} is no date format")
    at = part("file_settings").get("header_row", 0)
    if at != "auto" and (not isinstance(at, int) or isinstance(at, bool) or at < 0):
        out.append("file_settings.header_row: must be auto or a number from 0 on")
    return out


def detect(headers: list[str], configs: dict[str, dict], least: int = 3) -> str | None:
    """The source system whose signature the headers hold; else the mapping (by name) most of whose fields have an alias among
    them, if at least `least`."""
    plain = {h.lower().strip() for h in headers if h}
    for name, words in SIGNATURES:
        if words <= plain:
            return name
    score = {n: sum(any(str(a).lower() in plain for a in aliases) for aliases in (c.get("column_mappings") or {}).values()) for n, c in sorted(configs.items())}
    best = max(score, key=lambda n: score[n], default=None)
    return best if best is not None and score[best] >= least else None


# ----------------------------------------------------------------- cells to values


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))


def _number(c: Column, keep: str) -> Column:
    return F.regexp_replace(c, f"[^{keep}]", "").try_cast("double")


def money(c: Column) -> Column:
    """Digits, points and minus signs as a number; NULL if they are none."""
    return _number(c, r"\d.\-")


def alias(c: Column, names: dict[str, list]) -> Column:
    """The name one of whose aliases `c` is, case ignored, the first in order; else NULL."""
    low, out = F.lower(c), F.lit(None).cast("string")
    for name, aliases in reversed(list(names.items())):
        if aliases:
            out = F.when(low.isin(*(str(a).lower() for a in aliases)), str(name)).otherwise(out)
    return out


def dates(c: Column, formats: list[str]) -> Column:
    """ISO date by the first format that reads `c`, else `c`."""
    read = [F.date_format(F.try_to_timestamp(c, F.lit(date_pattern(f))), "yyyy-MM-dd") for f in formats]
    return F.when(c == "", "").otherwise(F.coalesce(*read, c))


class Compiled:
    """A mapping's columns over a sheet's `cells` and its header, lower-cased, in `head`."""

    def __init__(self, config: dict, cells: str = "cells", head: str = "_head"):
        problems = check(config)
        if problems:
            raise RuleError("; ".join(problems))
        self.config, self.cells, self.head = config, cells, head
        part = lambda k: config.get(k) or {}
        self.columns, self.income, self.filters, self.change = part("column_mappings"), part("income_columns"), part("row_filters"), part("transformations")

    def at(self, aliases: list) -> Column:
        """Index of the column that the first fitting alias names, NULL if none does."""
        head, none = F.col(self.head), F.lit(None).cast("int")
        names = [str(a).lower().strip() for a in aliases]
        return F.coalesce(*(F.when(F.array_contains(head, a), F.size(head) - F.array_position(F.reverse(head), a).cast("int")) for a in names), none)

    def text(self, field: str, income: bool = False) -> Column:
        aliases = (self.income if income else self.columns).get(field) or []
        return F.trim(F.coalesce(F.get(self.cells, self.at(aliases)), F.lit(""))) if aliases else F.lit("")

    def bed_bath(self) -> tuple[Column, Column]:
        bed, bath = self.text("bed_type"), self.text("bath_count")
        if self.change.get("parse_bed_bath_combined"):
            parts = F.split(bed, re.escape(self.change.get("bed_bath_separator", "/")))
            both = (bath == "") & (F.size(parts) == 2)
            beds, baths = F.regexp_replace(F.get(parts, F.lit(0)), r"\D", ""), F.regexp_replace(F.get(parts, F.lit(1)), r"[^\d.]", "")
            bed, bath = F.when(both & (beds != ""), beds).otherwise(bed), F.when(both & (baths != ""), baths).otherwise(bath)
        infer = bool(self.change.get("infer_bed_type_from_floorplan"))
        known = F.coalesce(alias(bed, self.config.get("bed_type_mappings") or {}), bed)
        if not infer:
            digits = F.regexp_extract(bed, r"(\d+)", 1).try_cast("int")
            by_number = F.when(digits == 0, "Studio").when(digits <= 4, F.concat(digits.cast("string"), F.lit("BR")))
            known = F.coalesce(alias(bed, self.config.get("bed_type_mappings") or {}), by_number, bed)
        else:
            code, out = F.upper(self.text("floorplan_code")), F.lit(None).cast("string")
            prefixes = self.change.get("floorplan_bed_prefix_map") or {}
            for prefix in sorted(prefixes, key=lambda p: len(str(p))):  # the longest is asked first
                out = F.when(code.startswith(str(prefix).upper()), str(prefixes[prefix])).otherwise(out)
            known = F.when(known == bed, F.coalesce(out, known)).otherwise(known)
        return known, _number(bath, r"\d.")

    def values(self) -> dict[str, Column]:
        """The canonical columns."""
        v = {c: self.text(c) for c in CANONICAL}
        status = F.coalesce(alias(v["status"], self.config.get("status_mappings") or {}), v["status"])
        bed, bath = self.bed_bath()
        sqft = F.regexp_replace(v["sqft"], r"[^\d.]", "").try_cast("double").cast("int") if self.change.get("clean_sqft", True) else F.lit(None).cast("int")
        rent = money if self.change.get("clean_currency", True) else lambda c: c.try_cast("double")
        market, lease = rent(v["market_rent"]), rent(v["lease_rent"])
        if self.change.get("derive_status_from_name"):
            name = F.lower(v["resident_name"])
            derived = F.when(name.isin("vacant", "vacancy"), "Vacant").when(name == "model", "Non-Revenue").when(lease <= 0, "Vacant").when(v["resident_name"] != "", "Occupied").otherwise("")
            status = F.when(status != "", status).otherwise(derived)
        mapped = self.config.get("unit_type_mappings") or self.config.get("floorplan_mappings") or {}
        for code, m in mapped.items():
            own = v["floorplan_code"] == str(code).strip()
            size = m.get("expected_sqft", m.get("sqft"))
            bed = F.when(own, str(m["bed_type"])).otherwise(bed) if m.get("bed_type") else bed
            bath = F.when(own, float(m["bath_count"])).otherwise(bath) if m.get("bath_count") is not None else bath
            sqft = F.when(own, int(size)).otherwise(sqft) if size is not None else sqft
        rules, by_bed, by_bath, asked = self.config.get("floorplan_bed_bath_patterns") or [], bed, bath, (bed == "") | bath.isNull()
        for r in reversed([r for r in rules if r.get("pattern")]):
            hit = v["floorplan_code"].rlike(f"(?i){r['pattern']}")
            by_bed = F.when(hit, F.lit(str(r["bed_type"])) if r.get("bed_type") else bed).otherwise(by_bed)
            by_bath = F.when(hit, F.lit(float(r["bath_count"])) if r.get("bath_count") is not None else bath).otherwise(by_bath)
        formats = [self.change.get("date_format", "%m/%d/%Y"), *(self.change.get("alternate_date_formats") or [])]
        money_in = {c: money(self.text(c, True)) for c in INCOME}
        total = lease
        if self.change.get("calculate_total_rent"):
            zero = {c: F.coalesce(x, F.lit(0.0)) for c, x in money_in.items()}
            whole = reduce(Column.__add__, (zero[c] for c in INCOME[:-1])) - F.abs(zero["concessions"])
            total = F.when(money_in["base_rent"].isNotNull(), whole).otherwise(lease)
        v |= {"status": status, "bed_type": F.when(asked, by_bed).otherwise(bed), "bath_count": F.when(asked, by_bath).otherwise(bath), "sqft": sqft, "market_rent": market, "lease_rent": lease}
        v |= {c: dates(v[c], formats) for c in ("move_in_date", "lease_start", "lease_end")}
        return v | money_in | {"total_rent": total}

    def ends(self) -> Column:
        """Does the sheet end at this row: its first cell that is not empty begins with a terminator."""
        first = F.get(F.filter(F.transform(self.cells, lambda c: F.trim(F.coalesce(c, F.lit("")))), lambda c: c != ""), F.lit(0))
        return _any([F.coalesce(first, F.lit("")).rlike(f"(?i)^(?:{p})") for p in self.filters.get("section_terminator_patterns") or []])

    def skips(self) -> Column:
        """Over the canonical columns: rows that are no units."""
        unit, status = F.col("unit_id"), F.col("status")
        tests = [unit == "", *(unit.rlike(f"(?i)^(?:{p})") for p in self.filters.get("skip_patterns") or [])]
        kept = self.filters.get("include_statuses") or []
        return _any([*tests, *([(status != "") & ~status.isin(*kept)] if kept else [])])


def headed(sheets: DataFrame, keys: list[str], settings: dict, within: int = 20) -> DataFrame:
    """Rows below each sheet's header, with the header's cells, lower-cased, as `_head`. The header is the row that the settings
    number, or with auto the first of `within` rows that has one of the keywords, else the first row."""
    at, low = settings.get("header_row", 0), F.transform("cells", lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    if at == "auto":
        words = [str(k).lower() for k in settings.get("detect_header_keywords") or ["Unit"]]
        hit = (F.col("row_idx") < within) & F.arrays_overlap(low, F.array(*map(F.lit, words)))
        best = F.min(F.when(hit, F.struct("row_idx", low.alias("head"))))
        head = F.coalesce(best, F.min(F.when(F.col("row_idx") == 0, F.struct("row_idx", low.alias("head")))))
    else:
        head = F.min(F.when(F.col("row_idx") == at, F.struct("row_idx", low.alias("head"))))
    heads = sheets.groupBy(*keys).agg(head.alias("_h")).where("_h IS NOT NULL").select(*keys, F.col("_h.row_idx").alias("_at"), F.col("_h.head").alias("_head"))
    skip = int(settings.get("skip_rows_after_header") or 0)
    return beside(sheets, heads, keys).where(F.col("row_idx") > F.col("_at") + skip).drop("_at")


def standardise(sheets: DataFrame, keys: list[str], config: dict) -> DataFrame:
    """(keys, row_idx, canonical columns) of the units of every sheet (keys, row_idx, cells)."""
    rules = Compiled(config)
    rows = headed(sheets, keys, config.get("file_settings") or {})
    ends = rows.where(rules.ends()).groupBy(*keys).agg(F.min("row_idx").alias("_end"))
    rows = beside(rows, ends, keys, "left").where(F.col("_end").isNull() | (F.col("row_idx") < F.col("_end")))
    v = rules.values()
    units = rows.select(*keys, "row_idx", "_end", *(x.alias(c) for c, x in v.items())).where(~rules.skips())
    status = F.lower("status")
    rank = F.when(status == "occupied", 5).when(status == "notice", 4).when(status == "model", 3).when(status.isin("vacant", "vacant-leased", "vacant leased"), 2).otherwise(1)
    rent = F.coalesce(F.nullif("total_rent", F.lit(0.0)), F.nullif("lease_rent", F.lit(0.0)), F.lit(0.0))
    order = [F.desc(rank), F.desc(F.col("move_in_date") != ""), F.desc(F.col("lease_start") == ""), F.desc(rent), F.col("row_idx")]
    best = win.keep_best(units.where("_end IS NULL"), [*keys, "unit_id"], order)
    return units.where("_end IS NOT NULL").unionByName(best).drop("_end")


def plan_summary(units: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, PlanCode, BedType, Units, SqFt, AvgMarketRent) by floorplan, the ones without a code as Unknown."""
    code = F.when(F.col("floorplan_code") == "", "Unknown").otherwise(F.col("floorplan_code"))
    g = units.groupBy(*keys, code.alias("PlanCode")).agg(F.coalesce(F.min(F.when(F.col("bed_type") != "", F.col("bed_type"))), F.lit("")).alias("BedType"), F.count("*").alias("Units"), F.avg("sqft").alias("s"), F.avg("market_rent").alias("r"))
    return g.select(*keys, "PlanCode", "BedType", "Units", F.bround(F.coalesce("s", F.lit(0.0)), 0).alias("SqFt"), F.round(F.coalesce("r", F.lit(0.0)), 2).alias("AvgMarketRent"))


def snapshot_month(name: Column, top: Column | None = None) -> Column:
    """YYYY-MM of a file's name (year first, year last, or eight digits in a row), else of an As Of date in the text of its
    top cells, else NULL."""
    found = [
        (name, r"(\d{4})[-_](\d{2})[-_]\d{2}", (1, 2)), (name, r"(\d{2})[-_]\d{2}[-_](\d{4})", (2, 1)), (name, r"(\d{2})\d{2}(\d{4})", (2, 1)),
        *([(top, r"As Of\s*=?\s*(\d{1,2})/\d{1,2}/(\d{4})", (2, 1))] if top is not None else []),
    ]
    return F.coalesce(*(F.when(c.rlike(p), F.concat_ws("-", F.regexp_extract(c, p, y), F.lpad(F.regexp_extract(c, p, m), 2, "0"))) for c, p, (y, m) in found))


def property_of(sheets: DataFrame, keys: list[str], names: dict[str, str], rows: int = 10, columns: int = 5) -> DataFrame:
    """(keys, property): the first name, in the order given, whose text stands in a cell of a sheet's top left corner."""
    corner = F.lower(F.array_join(F.transform(F.slice("cells", 1, columns), lambda c: F.coalesce(c, F.lit(""))), "\n"))
    g = sheets.where(F.col("row_idx") < rows).groupBy(*keys).agg(*(F.max(corner.contains(text.lower())).alias(f"_{i}") for i, text in enumerate(names)))
    return g.select(*keys, F.coalesce(*(F.when(F.col(f"_{i}"), n) for i, n in enumerate(names.values()))).alias("property"))
