"""Rows out of landed HTML, JSON, XML and Markdown, by built-in expressions; nothing here fetches anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import first_dollars, last_dollars, sanitize, strip_tags

#: Fields of a floorplan that engines yield (fixed values).
PLAN = "name string, beds int, baths double, sqft double, rent_min double, rent_max double, available int"


def title(html: Column | str) -> Column:
    return sanitize(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, href, anchor) of every link."""
    whole = F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(0))
    rows = df.select(key, F.posexplode(whole).alias("pos", "_a"))
    return rows.select(key, "pos", F.regexp_extract("_a", r'(?i)href="([^"]*)"', 1).alias("href"), strip_tags("_a").alias("anchor"))


def paragraphs(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, text) of every <p>."""
    rows = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))).alias("pos", "_p"))
    return rows.select(key, "pos", strip_tags("_p").alias("text"))


def attribute(html: Column | str, name: str) -> Column:
    """Value of the first such attribute, in either kind of quotes."""
    return F.regexp_extract(html, rf"""(?i)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)


def ld_json(html: Column | str, schema: str) -> Column:
    """The first JSON-LD block by a schema, NULL if there is none or it does not parse."""
    return F.from_json(F.nullif(F.trim(F.regexp_extract(html, r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)), F.lit("")), schema)


def closed(tail: Column) -> Column:
    """The beginning of `tail`, which starts with a bracket, up to the bracket that closes it; NULL if none does. Brackets within
    double-quoted strings, and quotes behind a backslash, don't count. One pass over the text's tokens."""
    tokens = F.regexp_extract_all(tail, F.lit(r'(?s)\\.|["\[\]{}]|[^"\\\[\]{}]+'), F.lit(0))

    def step(s: Column, t: Column) -> Column:
        turn = F.when(s["inside"], 0).when(t.isin("[", "{"), 1).when(t.isin("]", "}"), -1).otherwise(0)
        done = (s["end"] == 0) & (turn < 0) & (s["depth"] + turn == 0)
        size = s["size"] + F.char_length(t)
        return F.struct((s["depth"] + turn).alias("depth"), (s["inside"] != (t == '"')).alias("inside"), size.alias("size"), F.when(done, size).otherwise(s["end"]).alias("end"))

    first = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("inside"), F.lit(0).alias("size"), F.lit(0).alias("end"))
    end = F.aggregate(tokens, first, step, lambda s: s["end"])
    # A one-element array names the end, so that the text is read once.
    return F.get(F.transform(F.array(end), lambda e: F.when(e > 0, F.substring(tail, F.lit(1), e))), F.lit(0))


def behind(text: Column, marker: str, within: int = 50) -> Column:
    """The bracketed value that begins at most `within` characters behind the first match of the pattern `marker`, NULL if there
    is none or it is cut off."""
    tail = F.nullif(F.regexp_extract(text, rf"(?s){marker}[^\[{{]{{0,{within}}}?([\[{{].*)", 1), F.lit(""))
    return closed(tail)


def around(text: Column, marker: str, schema: str, holds, back: int = 5000) -> Column:
    """The JSON array nearest around the first match of `marker` that can be read by `schema` and of which `holds` is true; at most
    `back` characters before it are searched for its beginning."""
    at = F.instr(text, F.lit(marker))
    before = F.substring(text, F.greatest(F.lit(1), at - back), F.least(at - 1, F.lit(back)))
    sizes = F.transform(F.split(before, r"\["), lambda x: F.char_length(x))
    starts = F.transform(F.sequence(F.size(sizes) - 1, F.lit(1)), lambda k: F.aggregate(F.slice(sizes, 1, k), F.lit(0), lambda a, x: a + x) + k)
    tail = lambda i: F.substring(text, F.greatest(F.lit(1), at - back) + i - 1, F.lit(2147483647))
    read = F.transform(F.when(F.size(sizes) > 1, starts), lambda i: F.from_json(closed(tail(i)), schema))
    return F.when(at > 0, F.get(F.filter(read, lambda x: x.isNotNull() & holds(x)), F.lit(0)))


def script_variable(html: Column | str, name: str, schema: str) -> Column:
    """A JSON array or object that a script assigns to a variable."""
    text = F.col(html) if isinstance(html, str) else html
    return F.from_json(behind(text, rf"(?i)\b{name}\s*=", 10), schema)


def plans(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, plan columns) of an array of floorplan structs."""
    return df.select(key, F.explode(column).alias("_p")).select(key, "_p.*")


def cards(df: DataFrame, key: str, html: str, card: str, fields: dict[str, str]) -> DataFrame:
    """One row a card: `card` is a regex with one group, each field a regex with one group within it."""
    rows = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(card), F.lit(1))).alias("pos", "_c"))
    got = [F.nullif(strip_tags(F.regexp_extract("_c", pattern, 1)), F.lit("")).alias(name) for name, pattern in fields.items()]
    return rows.select(key, "pos", *got)


def price_range(text: Column | str) -> Column:
    return F.struct(first_dollars(text).alias("rent_min"), last_dollars(text).alias("rent_max"))


def specials(text: Column | str, most: int = 8) -> Column:
    """The first distinct sentences that offer something."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)([^.!?\n]*\b(?:free|special|off|waived?|concession)\b[^.!?\n]*[.!?]?)"), F.lit(1))
    return F.slice(F.array_distinct(F.transform(found, sanitize)), 1, most)


def unit_plan_join(doc: Column, units: str, floorplans: str, unit_id: str, plan_id: str) -> Column:
    """Units of a document with the plan of theirs, inside the document: no join."""
    known = F.map_from_entries(F.transform(doc[floorplans], lambda p: F.struct(p[plan_id], p)))
    return F.transform(doc[units], lambda u: F.struct(u.alias("unit"), F.element_at(known, u[unit_id]).alias("plan")))


def rss(df: DataFrame, key: str, xml: str) -> DataFrame:
    """(key, pos, title, link, description) of a feed's items."""
    item = F.regexp_extract_all(xml, F.lit(r"(?is)<item\b[^>]*>(.*?)</item>"), F.lit(1))
    rows = df.select(key, F.posexplode(item).alias("pos", "_i"))
    tag = lambda n: strip_tags(F.regexp_replace(F.regexp_extract("_i", rf"(?is)<{n}\b[^>]*>(.*?)</{n}>", 1), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))
    return rows.select(key, "pos", *(tag(n).alias(n) for n in ("title", "link", "description")))


def markdown_tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, heading, start, line, cells) of the body rows of pipe tables, with the heading above and the table's first
    line. Lines of one text are windowed by its key."""
    from pyspark.sql import Window

    from .windows import running

    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("line", "_l"))
    w = Window.partitionBy(key).orderBy("line")
    pipe = F.col("_l").rlike(r"^\s*\|.*\|\s*$")
    lines = lines.withColumn("_t", pipe).withColumn("heading", F.last(F.when(F.col("_l").rlike(r"^#+\s"), F.regexp_replace("_l", r"^#+\s*", "")), ignorenulls=True).over(running(w)))
    lines = lines.withColumn("start", F.when(F.col("_t"), F.last(F.when(F.col("_t") & ~F.coalesce(F.lag("_t").over(w), F.lit(False)), F.col("line")), ignorenulls=True).over(running(w))))
    body = lines.where("_t").where((F.col("line") > F.col("start")) & ~F.col("_l").rlike(r"^[\s|:\-]+$"))
    cells = F.transform(F.split(F.regexp_replace("_l", r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.regexp_replace(F.trim(c), r"[*`_]", ""))
    return body.select(key, "heading", "start", "line", cells.alias("cells"))


def merge_partials(df: DataFrame, key: str, order: str) -> DataFrame:
    """Documents that several pages yield in part: specials distinct in order of pages, first platform."""
    g = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "platform", "specials"))).alias("_p"))
    return g.select(key, F.get("_p", F.lit(0))["platform"].alias("platform"), F.array_distinct(F.flatten(F.transform("_p", lambda p: p["specials"]))).alias("specials"))
