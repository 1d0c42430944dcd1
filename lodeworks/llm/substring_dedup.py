"""Substring dedup by unit hashing: texts are cut into units, normalised units are grouped by digest over the whole
corpus, the earliest ranked occurrence stays, and all others are removed with their original offsets retained.

Units are whole lines of at least LINE_WORDS words and, since repeated passages also stand in the middle of lines or run
over several short ones, runs of RUN consecutive words of a text. Of the runs only those are units whose digest is the
least of some SPREAD consecutive ones (winnowing), so a passage has the same units wherever it stands. That settles what
goes: nothing but whole repeated lines and words of a repeated run of RUN words; and of every passage of at least
RUN + SPREAD - 1 words that stands earlier too, all but at most SPREAD - 1 words at either end. Normalised: words
`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` lower-cased in A-Z, so spacing and punctuation don't matter. Rank: id (nulls last),
then a hash of the text, then place in the text. A later occurrence that overlaps the earliest one in the same text
(one word over and over) loses what lies beyond that.

Skew: within a mapper's block all but the earliest occurrence of a digest are surely removed; those go on by document,
made one where they touch, and only the earliest goes to the digest's bucket. A line that a third of all documents
hold costs its bucket one posting a block. No text is shuffled.

Defined cases: null, empty and short texts have no units; rows equal in id and text are one document and get equal results;
very long texts are cut whole; empty tables give empty results; extra columns pass by unread, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, alnum_words, byte_codes, mix, redact, runs_of_text, table

#: Least words of a line, words of a run, and consecutive runs of which the least digest is a unit.
LINE_WORDS, RUN, SPREAD = 16, 24, 8
#: Units that a mapper holds at a time, and that a dealt bucket holds on average; characters of text for a unit; least number
#: of buckets.
FLUSH, BUCKET, PER_UNIT, LEAST_BUCKETS = 400_000, 1_500_000, 28, 32


def _runs(w: Words) -> np.ndarray:
    """First words of the runs that are units, and (all) digests of runs."""
    g = w.long_grams(RUN)
    n = len(g)
    if not n:
        return np.zeros(0, np.int64), g
    inside = w.doc[:n] == w.doc[RUN - 1 :]
    most = np.iinfo(np.uint64).max
    h = np.concatenate([np.where(inside, g, most), np.full(SPREAD, most, np.uint64)])
    least = h[:n]
    for d in range(1, SPREAD):
        least = np.minimum(least, h[d : d + n])
    unit = np.zeros(n, bool)
    for d in range(SPREAD):  # of the SPREAD runs from i - d on, run i has the least digest
        unit[d:] |= inside[: n - d] & (least[: n - d] == h[d:n])
    return np.flatnonzero(unit & inside), g


def _lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, sizes and digests of lines of at least LINE_WORDS words."""
    n = len(w.hash)
    breaks = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
    new = np.ones(n, bool)
    new[1:] = (breaks[w.start[1:]] > breaks[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    within = np.arange(n) - np.repeat(first, size)
    digest = mix(np.add.reduceat(mix(w.hash + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first) + size.astype(np.uint64))
    long = size >= LINE_WORDS
    return first[long], size[long], digest[long]


def units(texts: pa.Array):
    """(digests, starts, ends) of each text's units, in code points; a unit ends where the next word begins."""
    inside = alnum_words()
    codes = byte_codes(True, inside)
    for low, high, data, offsets in runs_of_text(texts):
        w = Words(data, offsets, inside, codes)
        if not len(w.hash):
            yield from ((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(high - low))
            continue
        run, grams = _runs(w)
        line, size, digest = _lines(w)
        first, after = np.concatenate([run, line]), np.concatenate([run + RUN, line + size])
        digest = np.concatenate([grams[run], digest])
        order = np.argsort(first, kind="stable")
        first, after, digest = first[order], after[order], digest[order]
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        doc = w.doc[first]
        origin = point[offsets[:-1]][doc]
        starts = point[w.start[first]] - origin
        ends = point[np.minimum(np.append(w.start, len(data))[after], offsets[1:][doc])] - origin
        bounds = np.searchsorted(first, w.first)
        for i in range(high - low):
            part = slice(bounds[i], bounds[i + 1])
            yield digest[part], starts[part], ends[part]


_KINDS = {"lens": np.int32, "nulls": np.uint8, "ids": np.int64, "ths": np.int64, "digests": np.uint64, "starts": np.int32, "ends": np.int32}
_ROWS = "bucket int, sure boolean, " + ", ".join(f"{k} binary" for k in _KINDS)


def _rank(nulls: np.ndarray, ids: np.ndarray, ths: np.ndarray) -> np.ndarray:
    """Rank of each document: ids ascending with nulls last, then hashes of texts; equal ones share it."""
    order = np.lexsort((ths, ids, nulls))
    n, i, t = nulls[order], ids[order], ths[order]
    new = np.ones(len(order), bool)
    new[1:] = (n[1:] != n[:-1]) | (i[1:] != i[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _later(digests: np.ndarray, rank: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which postings have an earlier one with the same digest, and where what goes of each begins."""
    order = np.lexsort((starts, rank, digests))
    d, r, s = digests[order], rank[order], starts[order]
    head = np.concatenate([[True], d[1:] != d[:-1]]) if len(d) else np.zeros(0, bool)
    at = np.flatnonzero(head)[np.cumsum(head) - 1] if len(d) else np.zeros(0, np.int64)
    later, begin = np.zeros(len(d), bool), starts.copy()
    later[order] = (r != r[at]) | (s != s[at])
    begin[order] = np.where(r == r[at], np.maximum(s, np.minimum(ends[order][at], ends[order])), s)
    return later, np.where(later, begin, starts)


def _union(owner: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans made one where they overlap or touch, by ascending owner and start."""
    order = np.lexsort((s, owner))
    owner, s, e = owner[order], s[order].astype(np.int64), e[order].astype(np.int64)
    if not len(s):
        return owner, s, e
    base = owner.astype(np.int64) << 32  # the running end starts anew with each owner
    reach = np.maximum.accumulate(base + e)
    new = np.ones(len(s), bool)
    new[1:] = base[1:] + s[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return owner[first], s[first], (reach - base)[last]


def _pack(bucket: np.ndarray, sure: bool, owner: np.ndarray, of: dict[str, np.ndarray], by_unit: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket: runs of documents over their units."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])])) if len(owner) else np.zeros(0, np.int64)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(owner) else np.zeros(0, np.int64)
    runs, ends = np.append(np.searchsorted(edge, cut), len(edge)), np.append(cut, len(bucket))
    by_run = {"lens": np.diff(np.append(edge, len(owner)))} | {k: v[owner[edge]] for k, v in of.items()}
    out: dict[str, pa.Array] = {"bucket": pa.array(bucket[cut].astype(np.int32)), "sure": pa.array(np.full(len(cut), sure))}
    for columns, at in ((by_run, runs), ({k: v[order] for k, v in by_unit.items()}, ends)):
        for k, v in columns.items():
            v = v.astype(_KINDS[k])
            out[k] = pa.array([v[at[i] : at[i + 1]].tobytes() for i in range(len(cut))], pa.binary())
    return pa.RecordBatch.from_arrays([out.get(k, pa.nulls(len(cut), pa.binary())) for k in ("bucket", "sure", *_KINDS)], ["bucket", "sure", *_KINDS])


def _deal(buckets: int):
    """Units packed by buckets of their digests. Those that have an earlier equal one in the block are sure to go: they take
    no part in a bucket's contest and are dealt by document."""

    def deal(batches):
        who, parts, held = [], [], 0

        def flush():
            d, s, e = (np.concatenate([p[k] for p in parts]) for k in range(3))
            doc = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            of = {"nulls": np.array([w[0] is None for w in who], np.uint8), "ids": np.array([w[0] or 0 for w in who], np.int64), "ths": np.array([w[1] for w in who], np.int64)}
            later, begin = _later(d, _rank(of["nulls"], of["ids"], of["ths"])[doc], s, e)
            first = ~later
            yield _pack((mix(d[first]) % np.uint64(buckets)).astype(np.int32), False, doc[first], of, {"digests": d[first], "starts": s[first], "ends": e[first]})
            gone, a, b = _union(doc[later], begin[later], e[later])
            if len(gone):
                at = mix(of["ids"].view(np.uint64) + mix(of["ths"].view(np.uint64)))[gone]
                yield _pack((at % np.uint64(buckets)).astype(np.int32), True, gone, of, {"starts": a, "ends": b})
            who.clear(), parts.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            ids, ths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, part in enumerate(units(batch.column(2))):
                if len(part[0]):
                    who.append((ids[k], ths[k]))
                    parts.append(part)
                    held += len(part[0])
                    if held >= FLUSH:
                        yield from flush()
                        held = 0
        if parts:
            yield from flush()

    return deal


_GONE = "id long, th long, starts binary, ends binary"


def _removed(rows: pa.Table) -> pa.Table:
    """Of a bucket, what goes, by document."""
    sure = rows.column("sure").to_numpy()
    held = {}
    for k, t in _KINDS.items():
        held[k] = [np.frombuffer(v, t) if v is not None else np.zeros(0, t) for v in rows.column(k).to_pylist()]
    x = {k: np.concatenate(v) for k, v in held.items() if k != "digests"}
    certain = np.repeat(np.repeat(sure, [len(v) for v in held["lens"]]), x["lens"])
    run = np.repeat(np.arange(len(x["lens"])), x["lens"])
    who = _rank(x["nulls"], x["ids"], x["ths"])
    open_ = np.flatnonzero(~certain)
    later, begin = _later(np.concatenate(held["digests"]), who[run[open_]], x["starts"][open_], x["ends"][open_])
    gone = np.concatenate([np.flatnonzero(certain), open_[later]])
    a = np.concatenate([x["starts"][certain], begin[later]])
    owner, s, e = _union(who[run[gone]], a, x["ends"][gone])
    edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(owner)) if len(owner) else edge
    first = np.zeros(len(edge), np.int64)
    if len(edge):
        ranks, at = np.unique(who, return_index=True)
        first = at[np.searchsorted(ranks, owner[edge])]
    pack = lambda v: pa.array([v[i:j].astype(np.int32).tobytes() for i, j in zip(edge, ends, strict=True)], pa.binary())
    ids = pa.array(x["ids"][first], pa.int64(), mask=x["nulls"][first].astype(bool))
    return pa.Table.from_arrays([ids, pa.array(x["ths"][first], pa.int64()), pack(s), pack(e)], names=["id", "th", "starts", "ends"])


_SPANS = "array<struct<start:int,end:int>>"


def _merged(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Each document's packed spans as ascending spans that don't touch."""
    lists, s, e = [0], [], []
    for a, b in zip(starts.to_pylist(), ends.to_pylist(), strict=True):
        a, b = (np.frombuffer(b"".join(v), np.int32) for v in (a, b))
        _, a, b = _union(np.zeros(len(a), np.int64), a, b)
        s.append(a), e.append(b)
        lists.append(lists[-1] + len(a))
    flat = [np.concatenate(v).astype(np.int32) if v else np.zeros(0, np.int32) for v in (s, e)]
    return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays([pa.array(v) for v in flat], ["start", "end"]))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document of which something is removed: id, th (a hash of the text), spans (start, end; ascending, apart)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    chars = docs.agg(F.coalesce(F.sum(F.char_length(text_col)), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, chars // (BUCKET * PER_UNIT) + 1)
    dealt = rows.mapInArrow(_deal(buckets), _ROWS)
    gone = dealt.groupBy("bucket").applyInArrow(_removed, _GONE)
    gone = gone.groupBy("id", "th").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))

    @F.arrow_udf(_SPANS)
    def merged(starts: pa.Array, ends: pa.Array) -> pa.Array:
        return _merged(starts, ends)

    return gone.select("id", "th", merged("starts", "ends").alias("spans"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: id, n_chars, n_removed (passages), spans (those, which don't touch) and, if asked, the text left."""
    gone = table(repeats(docs, id_col, text_col), "repeats").select(F.col("id").alias("_id"), F.col("th").alias("_th"), "spans")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.coalesce(F.char_length(text_col), F.lit(0)).alias("n_chars"), *([F.col(text_col).alias("text")] if with_text else []))
    out = rows.join(gone, F.expr("id <=> _id and th = _th"), "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))
    left = [redact("text", "spans").alias("text")] if with_text else []
    return out.select("id", F.col("n_chars").cast("long").alias("n_chars"), F.size("spans").cast("long").alias("n_removed"), "spans", *left)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select(F.col("id").alias("doc_id"), "n_chars", "n_removed", gone.alias("removed_chars"), listed.alias("removed_spans"))
