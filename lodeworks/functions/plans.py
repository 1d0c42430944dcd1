"""Floorplan codes, residents and classifiers as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bed types by a plan code's first letter (fixed values).
BED_LETTERS = {"S": "Studio", "A": "1BR", "B": "2BR", "C": "3BR", "D": "4BR", "E": "4BR"}


def _text(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"\s+", " ")


def clean_plan(c: Column) -> Column:
    """Upper case, blanks as one, W/D taken out; a code written twice at the beginning stands for itself."""
    raw = F.trim(F.regexp_replace(F.upper(_text(c)), r",?\s*W/D\b", ""))
    parts = F.split(raw, " ")
    return F.when(F.get(parts, F.lit(0)) == F.get(parts, F.lit(1)), F.get(parts, F.lit(0))).otherwise(raw)


def resident_name(c: Column) -> Column:
    """A resident without account and date at the end; '' for vacant units."""
    raw = _text(c)
    return F.when(F.lower(raw).startswith("vacant unit"), "").otherwise(F.trim(F.regexp_replace(raw, r"\s+T\d+\s+\d{1,2}/\d{1,2}/\d{4}$", "")))


def bed_by_letter(c: Column) -> Column:
    """Bed type by the first letter of a code that begins with letters, else ''."""
    letter = F.upper(F.substring(F.regexp_extract(F.coalesce(c, F.lit("")), "^([A-Za-z]+)", 1), 1, 1))
    return reduce(lambda out, p: F.when(letter == p[0], p[1]).otherwise(out), BED_LETTERS.items(), F.lit(""))


def plan_rule(code: Column, rule: dict[str, str], result: str) -> Column:
    """What one rule (match_type prefix, suffix, contains or regex; pattern; result) gives for a code, -PL left out, else
    NULL; {1}, {2} ... of a regex rule's result stand for its groups."""
    pattern, given, kind = rule.get("pattern", ""), rule.get(result, ""), rule.get("match_type", "prefix")
    none = F.lit(None).cast("string")
    if not pattern or not given:
        return none
    clean = F.replace(F.upper(code), F.lit("-PL"), F.lit(""))
    if kind == "regex":
        out, k = F.lit(given), 1
        while f"{{{k}}}" in given:
            group = F.regexp_extract(clean, f"(?i){pattern}", k)
            out = F.when(group != "", F.replace(out, F.lit(f"{{{k}}}"), group)).otherwise(out)
            k += 1
        return F.when(clean.rlike(f"(?i){pattern}"), out)
    test = {"prefix": clean.startswith, "suffix": clean.endswith, "contains": clean.contains}.get(kind)
    return F.when(test(pattern.upper()), given) if test else none


def plan_rules(code: Column, rules: list[dict[str, str]], result: str) -> Column:
    """The first rule that matches gives the result, else ''."""
    return F.when(F.coalesce(code, F.lit("")) == "", "").otherwise(F.coalesce(*(plan_rule(code, r, result) for r in rules), F.lit("")))


def target_year(c: Column) -> Column:
    """The last four-digit part of a horizon like 2025-2030, else 2030."""
    parts = F.filter(F.transform(F.split(F.trim(c), "-"), lambda p: F.trim(p)), lambda p: p.rlike("^[0-9]{4}$"))
    return F.coalesce(F.when(F.size(parts) > 0, F.element_at(parts, -1)).cast("int"), F.lit(2030))


def _first(c: Column, rules: list[tuple[list[str], str]], otherwise: str) -> Column:
    s = F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    out = F.lit(otherwise)
    for words, name in reversed(rules):
        out = F.when(reduce(Column.__or__, (s.contains(w) for w in words)), name).otherwise(out)
    return F.when((s != "") & (s != "unknown"), out)


def ownership(c: Column) -> Column:
    """reit, private_equity, private or other; NULL for nothing or unknown."""
    return _first(c, [(["reit"], "reit"), (["equity"], "private_equity"), (["private"], "private")], "other")


def renovation(c: Column) -> Column:
    """renovated, partial, classic or unknown; NULL for nothing or unknown."""
    return _first(c, [(["full", "platinum", "renovat"], "renovated"), (["partial", "light"], "partial"), (["classic", "original"], "classic")], "unknown")
