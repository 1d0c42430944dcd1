"""Scalar functions over addresses, owners, money, dates, quarters, names and HTML, as built-in column expressions.

Every function takes and returns Columns, keeps NULL as NULL unless it says otherwise, and stays inside generated code
where Spark can (lambdas over arrays are the only interpreted parts, and those arrays hold a few tokens).
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: directionals, street types, place words, legal forms -------------------------------------------
DIRECTIONALS = {"n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
STREET_TYPES = {
    "st": "street", "str": "street", "street": "street", "ave": "avenue", "av": "avenue", "avenue": "avenue", "rd": "road", "road": "road",
    "blvd": "boulevard", "boulevard": "boulevard", "dr": "drive", "drive": "drive", "ln": "lane", "lane": "lane", "pl": "place", "place": "place",
    "ct": "court", "court": "court", "cir": "circle", "circle": "circle", "pkwy": "parkway", "parkway": "parkway", "hwy": "highway", "highway": "highway",
    "ter": "terrace", "terr": "terrace", "terrace": "terrace", "way": "way", "trl": "trail", "trail": "trail",
}
PLACE_WORDS = ["gainesville", "tx", "texas"]
LEGAL_FORMS = ["llc", "lc", "ltd", "lp", "llp", "inc", "incorporated", "corp", "corporation", "co", "company", "trust", "tr", "partners", "partnership", "&"]
UNIT = r"(?i)(?:apt|apartment|suite|ste|unit|#)\.?\s*([0-9a-z][0-9a-z\-]*)\b"
#: Five digits that open an address and stand before a word are its house number, not a zip.
HOUSE = r"^\d{5}\s+[^\s,]"
ZIP = rf"(?!{HOUSE})\b(\d{{5}})(?:-\d{{4}})?\b"
#: Lower-case letters with one combining mark and what they compose to: built by Unicode's own rule.
COMPOSED = {
    c + m: n
    for c in "abcdefghijklmnopqrstuvwxyz"
    for m in map(chr, range(0x300, 0x370))
    if len(n := unicodedata.normalize("NFC", c + m)) == 1
}


def _s(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' and blanks as NULL."""
    return F.nullif(F.trim(_s(c)), F.lit(""))


def nan_to_null(c: Column | str) -> Column:
    """NaN as NULL, once at the scan, so that SQL null rules hold from there on."""
    return F.when(~F.isnan(_s(c)), _s(c))


def sanitize(c: Column | str) -> Column:
    """Runs of whitespace as one space, ends trimmed."""
    return F.trim(F.regexp_replace(_s(c), r"\s+", " "))


def _mapped(token: Column, table: dict[str, str]) -> Column:
    known = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.element_at(known, token), token)


def composed(c: Column | str) -> Column:
    """Lower-cased letters and their combining marks as one letter each (NFC for one mark a letter)."""
    pairs = ", ".join(f"struct('{k}' as a, '{v}' as b)" for k, v in COMPOSED.items())
    return F.when(_s(c).rlike("[\\u0300-\\u036f]"), F.aggregate(F.expr(f"array({pairs})"), _s(c), lambda at, p: F.replace(at, p["a"], p["b"]))).otherwise(_s(c))


def zip_code(c: Column | str) -> Column:
    """The first zip of a text, not the house number that opens it; NULL for none."""
    return F.nullif(F.regexp_extract(F.trim(_s(c)), ZIP, 1), F.lit(""))


def _address_tokens(c: Column | str, house: Column | None = None) -> Column:
    """Tokens of an address; five digits go as a zip, the first token's not where `house` holds."""
    bare = F.regexp_replace(F.regexp_replace(composed(F.lower(_s(c))), UNIT, " "), r"[.,]", " ")
    tokens = F.filter(F.split(F.regexp_replace(bare, r"\bsuite\s+\d+", " "), r"\s+"), lambda t: t != "")
    tokens = F.transform(tokens, lambda t: _mapped(t, DIRECTIONALS | STREET_TYPES))
    word = lambda t: ~t.rlike(r"^\d{5}(-\d{4})?$") & ~t.rlike("^[a-z]{2}$") & ~t.isin(PLACE_WORDS)
    return F.filter(tokens, word) if house is None else F.filter(tokens, lambda t, i: word(t) | ((i == 0) & house))


def address_normalise(c: Column | str) -> Column:
    """Lower-cased address with directionals and street types written out, without unit, zip, two-letter tokens and
    place words; NULL if nothing is left. The unit's pattern has no left word boundary."""
    return F.nullif(F.array_join(_address_tokens(c), " "), F.lit(""))


def address_parts(c: Column | str) -> Column:
    """Struct: number (the normalised address's first token, if all digits), token (the first after it that is no
    directional), unit and zip (wherever they stand in the raw text)."""
    tokens = _address_tokens(c, F.trim(_s(c)).rlike(HOUSE))
    first = F.get(tokens, F.lit(0))
    numbered = first.rlike("^[0-9]+$")
    names = F.filter(F.slice(tokens, 2, F.greatest(F.lit(1), F.size(tokens))), lambda t: ~t.isin([*DIRECTIONALS.values()]))
    unit = F.lower(F.nullif(F.regexp_extract(_s(c), UNIT, 1), F.lit("")))
    return F.struct(F.when(numbered, first).alias("number"), F.when(numbered, F.get(names, F.lit(0))).alias("token"), unit.alias("unit"), zip_code(c).alias("zip"))


def owner_normalise(c: Column | str) -> Column:
    """Lower-cased owner without points, commas and legal forms; '' if nothing is left, and for NULL."""
    low = composed(F.lower(F.coalesce(_s(c), F.lit(""))))
    low = F.regexp_replace(F.regexp_replace(low, r"\b([a-z])\.([a-z])\.([a-z])\.", "$1$2$3"), r"\b([a-z])\.([a-z])\.", "$1$2")
    tokens = F.split(F.regexp_replace(low, r"[.,]", " "), r"\s+")
    return F.array_join(F.filter(tokens, lambda t: (t != "") & ~t.isin(LEGAL_FORMS)), " ")


def slug(c: Column | str, joint: str = "_") -> Column:
    """Lower case, other runs than a-z0-9 as one joint, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(_s(c)), "[^a-z0-9]+", joint), f"^{joint}+|{joint}+$", "")


def last_part(c: Column | str, separator: str) -> Column:
    """What stands after the last separator, trimmed."""
    return F.trim(F.element_at(F.split(_s(c), separator), -1))


def unslug(c: Column | str, fixes: dict[str, str] | None = None) -> Column:
    """A slug as a title, with word fixes."""
    out = F.initcap(F.replace(_s(c), F.lit("_"), F.lit(" ")))
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), (fixes or {}).items(), out)


def currency(c: Column | str) -> Column:
    """Digits, points and minus signs of a text as a number, else NULL: '(50)' is 50, '1-2' is NULL."""
    return F.regexp_replace(_s(c), r"[^\d.\-]", "").try_cast("double")


def whole(c: Column | str) -> Column:
    """A cleaned number cut to an int."""
    return currency(c).cast("int")


def number_or(c: Column | str, default: float, kind: str = "double") -> Column:
    """`$` and `,` stripped, cast, else the default (NULL too)."""
    x = F.regexp_replace(_s(c), r"[$,\s]", "").try_cast("double")
    return F.coalesce(x.cast(kind), F.lit(default).cast(kind))


def first_dollars(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_extract(_s(c), r"\$\s*([\d,]+(?:\.\d+)?)", 1), ",", "").try_cast("double")


def last_dollars(c: Column | str) -> Column:
    every = F.regexp_extract_all(_s(c), F.lit(r"\$\s*([\d,]+(?:\.\d+)?)"), F.lit(1))
    return F.regexp_replace(F.get(every, F.size(every) - 1), ",", "").try_cast("double")


def beds(c: Column | str) -> Column:
    """studio is 0, else the first digits."""
    low = F.lower(_s(c))
    return F.when(low.contains("studio"), F.lit(0)).otherwise(F.regexp_extract(low, r"(\d+)", 1).try_cast("int"))


def beds_label(c: Column | str) -> Column:
    return F.when(_s(c) == 0, F.lit("Studio")).otherwise(F.concat(_s(c).cast("string"), F.lit("BR")))


def first_match(c: Column | str, rules: list[tuple[str, str]], default: Column | None = None) -> Column:
    """Label of the first rule (label, regex) that fits; list order decides."""
    out = default if default is not None else F.lit(None).cast("string")
    for label, pattern in reversed(rules):
        out = F.when(_s(c).rlike(pattern), F.lit(label)).otherwise(out)
    return out


def alias_of(c: Column | str, aliases: dict[str, list[str]]) -> Column:
    """Canonical name of the first alias list that holds the text (case and ends ignored), else the text."""
    low = F.lower(F.trim(_s(c)))
    out = _s(c)
    for name, texts in reversed(aliases.items()):
        out = F.when(low.isin([t.lower() for t in texts]), F.lit(name)).otherwise(out)
    return out


def longest_prefix(c: Column | str, table: dict[str, str]) -> Column:
    """Value of the longest prefix in the table that the text starts with."""
    up = F.upper(F.trim(_s(c)))
    out = F.lit(None).cast("string")
    for prefix, value in sorted(table.items(), key=lambda p: (len(p[0]), p[0])):
        out = F.when(up.startswith(prefix.upper()), F.lit(value)).otherwise(out)
    return out


def bed_bath(c: Column | str, separator: str = "/") -> Column:
    """Struct beds, baths of '2/1.5'."""
    part = F.split(_s(c), separator)
    return F.struct(F.get(part, F.lit(0)).try_cast("double").cast("int").alias("beds"), F.get(part, F.lit(1)).try_cast("double").alias("baths"))


#: Formats of dates in order of preference (fixed values).
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "M/d/yy", "MMMM d, yyyy"]


def iso_date(c: Column | str, formats: list[str] = DATE_FORMATS, lenient: bool = False) -> Column:
    """ISO text of the first format that fits; else the text itself, or NULL if lenient."""
    text = F.trim(_s(c))
    found = [F.date_format(F.try_to_date(text, f) if hasattr(F, "try_to_date") else F.try_to_timestamp(text, F.lit(f)), "yyyy-MM-dd") for f in formats]
    return F.coalesce(*found) if lenient else F.coalesce(*found, text)


def quarter(c: Column | str) -> Column:
    """'2025 Q3', also with EST or QTD after it, as year * 4 + quarter - 1; else NULL."""
    year, q = (F.regexp_extract(_s(c), r"^\s*(\d{4})\s+Q([1-4])(?:\s+(?:EST|QTD))?\s*$", k) for k in (1, 2))
    return (year.try_cast("int") * 4 + q.try_cast("int") - 1).cast("int")


def quarter_kind(c: Column | str) -> Column:
    """forecast for EST, else actual; NULL for what is no quarter."""
    return F.when(quarter(c).isNotNull(), F.when(_s(c).contains("EST"), F.lit("forecast")).otherwise(F.lit("actual")))


def area_code(c: Column | str) -> Column:
    """'19100' and 'C1910' as C1910, else NULL."""
    up = F.upper(F.trim(_s(c)))
    return F.when(up.rlike(r"^\d{5}$"), F.concat(F.lit("C"), F.substring(up, 1, 4))).when(up.rlike(r"^C\d{4}$"), up)


def fips(state: Column | str, county: Column | str) -> Column:
    return F.concat(F.lpad(_s(state).try_cast("int").cast("string"), 2, "0"), F.lpad(_s(county).try_cast("int").cast("string"), 3, "0"))


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    a, b, c, d = (F.radians(_s(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * 3958.8 * F.asin(F.sqrt(h))


def hashed_id(*parts: Column | str, prefix: str = "p_", length: int = 12) -> Column:
    """Prefix and the first hex digits of sha1 over the parts joined by |."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *map(_s, parts))), 1, length))


def size_class(units: Column | str) -> Column:
    u = _s(units)
    return F.when(u >= 50, "mf-large").when(u >= 5, "mf-small").when(u == 4, "fourplex").when(u == 2, "duplex").otherwise("mf-small")


def free_months(c: Column | str) -> Column:
    """Months free in a text; weeks (over 4.33, 2 places) win over months; else 0."""
    low = F.lower(_s(c))
    weeks = F.regexp_extract(low, r"(\d+(?:\.\d+)?)\s*weeks?\s+free", 1).try_cast("double")
    months = F.regexp_extract(low, r"(\d+(?:\.\d+)?)\s*months?\s+free", 1).try_cast("double")
    return F.coalesce(F.round(weeks / 4.33, 2), months, F.lit(0.0))


def strip_tags(c: Column | str) -> Column:
    """HTML without scripts, styles, comments and tags, the common entities put back, spaces collapsed."""
    text = F.regexp_replace(_s(c), r"(?is)<(script|style)\b[^>]*>.*?</\1>|<!--.*?-->|<[^>]+>", " ")
    for entity, char in {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return sanitize(text)


def url_host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(_s(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)", 1))


def host_listed(host: Column, listed: list[str]) -> Column:
    """The host is one of `listed` or a subdomain of one."""
    return reduce(Column.__or__, ((host == h) | host.endswith("." + h) for h in listed))


def natural_key(c: Column | str) -> Column:
    """A text that sorts as people expect: runs of digits padded to 10."""
    parts = F.regexp_extract_all(_s(c), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 10, "0")).otherwise(F.lower(p))), "")


def dimension_score(value: Column, high: float, moderate: float, points: int, invert: bool = False) -> Column:
    """Piecewise-linear score of a risk dimension, cut to an int: from `high` on 0, short of `moderate` all points, between
    them in proportion but within 1 .. points - 1. With `invert` low values are the risk, and `moderate` itself gets all
    points. NULL gives half."""
    share = (value - high) / (moderate - high) if invert else 1 - (value - moderate) / (high - moderate)
    part = F.least(F.lit(points - 1), F.greatest(F.lit(1), (points * share).cast("int")))
    best, some = (value >= moderate, value > high) if invert else (value < moderate, value < high)
    return F.when(value.isNull(), points // 2).when(best, points).when(some, part).otherwise(F.lit(0))


def severity(category: Column, ordered: list[str], default: int = 3) -> Column:
    at = F.array_position(F.array(*map(F.lit, ordered)), category)
    return F.when(at > 0, at - 1).otherwise(F.lit(default)).cast("int")
