"""Secret scans in built-in functions only: three patterns, and beside them sliding-window Shannon entropy over
candidate strings, by incremental counts, with a bound for each character class and an allow-list.

One pass, no shuffle. Texts without a candidate cost one regex scan a kind: everything else stands behind a CASE. The work
on one text is linear in its length and its matches.

Positions are code points, ends exclusive. Regex matches alternate with what `split` leaves between them, so summed
lengths give their places. Of a candidate that overlaps spans of the three patterns, what stands between and beside them
is judged piece by piece. Defined cases: a null text is empty; repeated rows are scanned alike; an empty table gives
an empty result; whole texts are scanned whatever their length; extra columns pass by, but one named as the result is
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, redact, running

__all__ = ["listed", "masked", "redact", "scan"]

#: Kinds in the order in which ties are listed, with their patterns.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "entropy": r"[A-Za-z0-9+/_=-]{20,}",
}
KINDS = list(PATTERNS)
#: Characters a window holds, and the least entropy (bits) of one by the class of its candidate's characters: hexadecimal,
#: letters of one case with digits, and all others.
WINDOW, HEX_BITS, CASE_BITS, OTHER_BITS = 20, 3.0, 3.5, 3.6
CLASSES = [("^[0-9a-fA-F]+$", HEX_BITS), ("^(?:[0-9a-z]+|[0-9A-Z]+)$", CASE_BITS)]
#: Candidates that are never secrets: too few kinds of characters, identifiers of other sorts, placeholders, paths.
ALLOWED = (
    r"^[^0-9]*$|^[^A-Za-z]*$"  # no digit or no letter
    r"|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"  # UUID
    r"|(?i:example|sample|placeholder|dummy|changeme|xxxx|lorem|abcdef)"
    r"|^(?i:sha(?:1|224|256|384|512)-)"  # integrity digests
    r"|^[A-Za-z]*[0-9]{0,4}(?:[-_/=][A-Za-z]*[0-9]{0,4})+$"  # words and small numbers joined by - _ / =
)
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,body:string>>"


def _matches(text: Column, kind: str) -> tuple[Column, Column, Column]:
    """Whole matches, what counts in them, and the pieces between; empty where nothing matches."""
    pattern = F.lit(PATTERNS[kind])
    found = text.rlike(PATTERNS[kind])
    take = lambda c: F.when(found, c).otherwise(F.array().cast("array<string>"))
    group = 2 if kind == "assign" else 0
    return take(F.regexp_extract_all(text, pattern, F.lit(0))), take(F.regexp_extract_all(text, pattern, F.lit(group))), take(F.split(text, PATTERNS[kind], -1))


def _placed(kind: str, whole: str, body: str, between: str) -> str:
    """Spans of the matches, from the lengths of matches and pieces."""
    steps = f"zip_with({whole}, slice({between}, 2, greatest(0, size({between}) - 1)), (w, p) -> cast(char_length(w) + char_length(p) as bigint))"
    first = f"char_length(get({between}, 0))"
    rank = KINDS.index(kind)
    one = let(f"y.at + {first}", "a", f"struct(a as start, {rank} as rank, a + char_length(y.whole) as end, y.body as body)")
    rows = f"zip_with({running(steps, '{a} + {x}')}, arrays_zip({whole}, {body}), (p, q) -> struct(p as at, q.{whole} as whole, q.{body} as body))"
    return f"if(size({whole}) > 0, cast(transform({rows}, y -> {one}) as {_SPAN}), cast(array() as {_SPAN}))"


def _windows(text: str) -> str:
    """Struct (low, high): from the first to the last window of `text` whose entropy reaches its class's bound, or
    nulls. Each step takes the entering character's and the leaving one's counts within the window, and changes the sum of
    c log2 c by those two only."""
    classes = " ".join(f"when rlike({text}, '{pattern}') then {bits}D" for pattern, bits in CLASSES)
    weigh = lambda c: f"if({c} > 0, ({c}) * log2(cast({c} as double)), 0D)"
    count = lambda c: f"size(filter(slice(v.chars, greatest(1, i - {WINDOW} + 1), least({WINDOW}, i)), y -> y = {c}))"
    enters, leaves = "get(v.chars, i)", f"if(i >= {WINDOW}, get(v.chars, i - {WINDOW}), null)"
    counts = f"struct({enters} as e, {leaves} as l, {count(enters)} as up, if(i >= {WINDOW}, {count(f'get(v.chars, i - {WINDOW})')}, 0) as down)"
    change = f"{weigh('n.up + 1')} - {weigh('n.up')} + if(n.down > 0, {weigh('n.down - 1')} - {weigh('n.down')}, 0D)"
    total = let(counts, "n", f"at.total + if(n.e <=> n.l, 0D, {change})")
    high = f"(i >= {WINDOW - 1} and {math.log2(WINDOW)!r}D - t / {WINDOW} >= v.least)"
    step = let(total, "t", f"struct(t as total, coalesce(at.low, if({high}, i - {WINDOW - 1}, null)) as low, if({high}, i + 1, at.last) as last)")
    first = "struct(0D as total, cast(null as int) as low, cast(null as int) as last)"
    found = f"aggregate(sequence(0, size(v.chars) - 1), {first}, (at, i) -> {step}, at -> struct(at.low as low, at.last as high))"
    return let(f"struct(split({text}, '') as chars, case {classes} else {OTHER_BITS}D end as least)", "v", found)


def _pieces(base: str) -> str:
    """What of the candidate `s` lies outside the spans `base`: (start, body) of the pieces of at least WINDOW characters."""
    kind = "array<struct<start:bigint,end:bigint>>"
    add = lambda end: f"cast(if({end} - at.at >= {WINDOW}, array_append(at.out, struct(at.at as start, {end} as end)), at.out) as {kind})"
    over = f"array_sort(filter({base}, b -> b.start < s.end and b.end > s.start))"
    step = f"struct(greatest(at.at, b.end) as at, {add('b.start')} as out)"
    left = f"aggregate({over}, struct(s.start as at, cast(array() as {kind}) as out), (at, b) -> {step}, at -> {add('s.end')})"
    return f"transform({left}, p -> struct(p.start as start, substring(s.body, cast(p.start - s.start + 1 as int), cast(p.end - p.start as int)) as body))"


#: Candidates that look for the spans near them together.
NEAR = 128


def _all_pieces(candidates: str, base: str) -> str:
    """The pieces of all candidates (ascending, apart): a block of them first picks the spans that overlap it."""
    blocks = f"transform(sequence(0, cast(floor((size({candidates}) - 1) / {NEAR}) as int)), i -> slice({candidates}, i * {NEAR} + 1, {NEAR}))"
    near = f"filter({base}, b -> b.start < get(block, size(block) - 1).end and b.end > get(block, 0).start)"
    of_block = let(near, "n", f"flatten(transform(block, s -> {_pieces('n')}))")
    return f"if(size({candidates}) > 0, flatten(transform({blocks}, block -> {of_block})), cast(array() as array<struct<start:bigint,body:string>>))"


def scan(df: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """`df` with a column `out`: array of (start, rank, end, kind), ascending by start and then by the kinds' order.
    The spans of kind entropy overlap none of the others."""
    columns = [F.col(c) for c in df.columns if c.lower() != out.lower()]
    tmp = free_name(df, "_scan_")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.select("*", *(c.alias(f"{tmp}{kind}{i}") for kind in KINDS for i, c in enumerate(_matches(text, kind))))
    df = df.select("*", *(F.expr(_placed(kind, *(f"{tmp}{kind}{i}" for i in range(3)))).alias(f"{tmp}{kind}") for kind in KINDS))
    base = f"concat(filter({tmp}assign, s -> char_length(s.body) >= 6), {tmp}access, {tmp}hex)"
    df = df.select("*", F.expr(base).alias(f"{tmp}base"))
    pieces = F.expr(_all_pieces(f"{tmp}entropy", f"{tmp}base"))
    df = df.select("*", F.filter(pieces, lambda s: ~s["body"].rlike(ALLOWED)).alias(f"{tmp}fresh"))
    # The windows are found once a candidate, then shifted to the text's places.
    df = df.select("*", F.expr(f"transform({tmp}fresh, s -> struct(s.start as start, {_windows('s.body')} as w))").alias(f"{tmp}judged"))
    more = f"transform(filter({tmp}judged, s -> s.w.low is not null), s -> struct(s.start + s.w.low as start, {KINDS.index('entropy')} as rank, s.start + s.w.high as end))"
    bare = f"transform({tmp}base, s -> struct(s.start as start, s.rank as rank, s.end as end))"
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    named = f"transform(array_sort(concat({bare}, {more})), s -> struct(s.start as start, s.rank as rank, s.end as end, get({kinds}, s.rank) as kind))"
    return df.select(*columns, F.expr(named).alias(out))


#: What stands for a secret in masked texts.
MASK = "<secret>"


def masked(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """`docs` with every secret masked, and the length of a changed text in `n_chars_col`; all else unchanged."""
    spans, new = free_name(docs, "_spans_"), free_name(docs, "_new_")
    found = F.size(spans) > 0
    df = scan(docs, text_col, spans).withColumn(new, redact(text_col, spans, MASK))
    n_chars = F.when(found, F.char_length(new)).otherwise(F.col(n_chars_col)) if n_chars_col in docs.columns else None
    changed = {text_col: F.col(new), n_chars_col: None if n_chars is None else n_chars.cast(dict(docs.dtypes)[n_chars_col])}
    return df.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = lambda s: s["kind"] != "entropy"
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in ("assign", "access", "hex")), F.sha2(listed(F.filter("spans", base)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
