"""Ranked lexical search: a query item's terms against the texts of all rows, by integer scores of term weight, frequency
and length.

Postings are a DataFrame of one row a term and text, bucketed by term within blocks of texts: a term that every text holds
is spread over all blocks, a block meets all its terms. They are joined with the statistics of their terms, scored in
integers (a posting's score is the same for every item), dealt out by block, joined with the terms of the items and summed
by item and text; as no text lies in two blocks, sums and each block's best rows of every item need no second shuffle, and
only those best rows meet by item. Terms no item has are left out when postings are made, while the items' terms are few
enough to send along (MOST_TERMS, MOST_BYTES); beyond that all words become postings, which meet the items' terms in a
join. Results are the same.

Defined cases: a null or empty text, or one without terms, is no match and does not count in N; rows of one item_id (null
being one) are one item with the terms of all its texts; rows of equal doc_id are documents of their own; equal scores
rank by ascending doc_id, null first; no items or no documents give no rows; texts are read whole; other columns play no
part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, alnum_words, byte_codes, lower_ascii, runs_of_text, table

#: Maximal runs of these are terms, once A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct terms of the items, their bytes, and pairs of item and term that are broadcast.
MOST_TERMS, MOST_BYTES, MOST_PAIRS = 500_000, 8_000_000, 500_000
#: Texts of a block, as a power of two, and buckets of terms.
BLOCK_BITS, BUCKETS = 10, 64
#: Fixed values of the score: in thousandths, the length's share, the rest, and the weight of the length.
SCALE, LENGTH_SHARE, LENGTH_WEIGHT = 1000, 90, 8

_POSTING = "block long, row long, doc long, bucket int, n long, tf long"


class _Terms:
    """The number of each word that is one of `terms`, equal byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = b"\n".join(terms)
        raw = np.frombuffer(data, np.uint8)
        words = Words(raw, np.array([0, len(raw)]), alnum_words(), byte_codes(True, alnum_words()))
        order = np.argsort(words.hash)
        self.hash, self.order = words.hash[order], order
        self.raw, self.start, self.size = raw, words.start, words.end - words.start

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(places in `words`, numbers of their terms)."""
        if not len(self.hash) or not len(words.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        which = np.flatnonzero(self.hash[at] == words.hash)
        term = self.order[at[which]]
        size = words.end[which] - words.start[which]
        same = size == self.size[term]
        which, term, size = which[same], term[same], size[same]
        if not len(which):
            return which, term
        begin = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(begin, size)
        have = words.data[np.repeat(words.start[which], size) + step]
        have = np.where((have >= 0x41) & (have <= 0x5A), have | 0x20, have)
        equal = np.minimum.reduceat(have == self.raw[np.repeat(self.start[term], size) + step], begin)
        return which[equal], term[equal]


def _known(terms: list[str], numbers: list[int]):
    """Postings of some terms, and for every run of texts one row without a term: its texts that have terms as `n`, and
    all their terms as `tf`."""
    found, number = _Terms([t.encode() for t in terms]), np.array(numbers, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, codes = alnum_words(), byte_codes(True, alnum_words())
        for b in batches:
            rows, docs = b.column("row").to_numpy(), b.column("doc")
            for low, high, data, offsets in runs_of_text(b.column("text")):
                words = Words(data, offsets, inside, codes)
                n = np.diff(words.first)
                place, term = found.find(words)
                # One posting for equal text and term; by bucket and term, then text.
                key, tf = np.unique((term % BUCKETS * len(terms) + term) * (high - low) + words.doc[place], return_counts=True)
                doc, term = key % (high - low), key // (high - low) % len(terms)
                row = rows[low:high][doc]
                cols = [row >> BLOCK_BITS, row, docs.take(pa.array(doc + low)), (term % BUCKETS).astype(np.int32), n[doc], tf, number[term]]
                stats = [np.array([0]), np.array([0]), pa.nulls(1, pa.int64()), np.array([0], np.int32), np.array([(n > 0).sum()]), np.array([n.sum()]), pa.nulls(1, pa.int64())]
                for part in (cols, stats):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in part], names=["block", "row", "doc", "bucket", "n", "tf", "t"])

    return run


def terms_of(items: DataFrame, key: str, text: str) -> DataFrame:
    """The distinct (item, term) of `items`, item being a struct of the key, never null itself."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM), F.lit(0))
    return items.select(F.struct(F.col(key).alias("id")).alias("item"), F.explode(words).alias("term")).distinct()


def postings(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (block, row, doc, bucket, n terms of the text, tf, t) of the `terms` (term, t) in `docs`, and rows without
    t that hold counts: texts with terms as `n`, all terms as `tf`."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    size = terms.agg(F.count("*"), F.sum(F.octet_length("term"))).first()
    if size[0] <= MOST_TERMS and (size[1] or 0) <= MOST_BYTES:
        some = terms.collect()
        return rows.mapInArrow(_known([r.term for r in some], [r.t for r in some]), f"{_POSTING}, t long")
    words = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(TERM), F.lit(0))
    cut = rows.select("row", "doc", words.alias("w")).where(F.size("w") > 0).select("row", "doc", F.size("w").cast("long").alias("n"), "w")
    every = cut.select("row", "doc", "n", F.explode("w").alias("term")).groupBy("row", "doc", "n", "term").agg(F.count("*").alias("tf"))
    met = every.join(terms, "term").select(
        F.shiftright("row", BLOCK_BITS).alias("block"), "row", "doc", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("bucket"), "n", "tf", "t"
    )
    zero = F.lit(0).cast("long")
    counts = cut.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), zero).alias("tf")).select(
        zero.alias("block"), zero.alias("row"), F.lit(None).cast("long").alias("doc"), F.lit(0).alias("bucket"), "n", "tf", F.lit(None).cast("long").alias("t")
    )
    return met.unionByName(counts)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """The k best rows of `docs` for each item: (item_id, rank, doc_id, score)."""
    wanted = table(terms_of(items, item_key, text), "wanted")
    terms = table(wanted.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "terms")
    posted = table(postings(docs, terms, doc_key, text), "postings")
    n, total = posted.where("t IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("tf"), F.lit(0))).first()
    posted = posted.where("t IS NOT NULL")
    # floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles.
    weight = posted.groupBy("t").agg(F.floor(F.lit(float(SCALE)) * F.ln(F.lit(2.0 * n + 2) / (2 * F.count("*") + 1))).cast("long").alias("w"))
    if terms.count() <= MOST_TERMS:  # two numbers a term
        weight = F.broadcast(weight)
    # A product of three counts may pass 64 bits on its way: decimals carry it.
    share = F.expr(f"cast(cast({LENGTH_SHARE} as decimal(3,0)) * cast(n as decimal(15,0)) * cast({n} as decimal(15,0)) div {max(total, 1)} as bigint)")
    m = SCALE // 10 - LENGTH_SHARE + share
    scored = posted.join(weight, "t").withColumn("d", SCALE * F.col("tf") + LENGTH_WEIGHT * m).select("block", "row", "doc", "t", (F.col("w") * F.expr("1000000000 * tf div d")).alias("s"))
    numbered = table(wanted.select("item").distinct().withColumn("i", F.monotonically_increasing_id()), "items")
    pairs = wanted.join(numbered, "item").join(terms, "term").select("i", "t")
    if pairs.count() <= MOST_PAIRS:
        pairs = F.broadcast(pairs)
    sums = scored.repartition("block").join(pairs, "t").groupBy("block", "row", "doc", "i").agg(F.sum("s").alias("score")).where("score > 0")
    order = [F.desc("score"), F.asc_nulls_first("doc"), F.asc("row")]
    best = sums.withColumn("r", F.row_number().over(Window.partitionBy("block", "i").orderBy(*order))).where(F.col("r") <= k)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(numbered, "i").select(F.col("item.id").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all for each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
