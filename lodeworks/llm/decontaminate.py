"""Benchmark decontamination by winnowing [Schleimer et al., SIGMOD 2003] in built-in functions only.

Of every SPREAD consecutive K-grams the smallest hash is kept, so a shared run of K + SPREAD - 1 = 10 words leaves at
least one common fingerprint. Training fingerprints are joined with the test ones, each hit is extended to the
10-word windows around it, and those are compared word for word. An item of fewer than 10 words is a window of its
own length, found by its whole-length hash.

How it scales: one plan for every size of benchmark. A Bloom filter of its fingerprints (two bits each, 32 bits a print up
to 2^MOST_BITS bits, built by aggregation) goes into the scan as a constant. What passes it is carried on as the windows
around it, which are joined with the benchmark's windows word for word; so texts are read and split once and never
shuffled, nor kept. The larger the benchmark beyond that, the more windows pass for nothing; none is lost. Nothing depends
on how often a passage or a source occurs, as rows are joined with benchmark windows only and never with each other.

Defined cases: null texts have no words; null item ids are ignored, repeated items count once; rows that repeat an id
are judged each by its own text; very long texts are read whole; empty tables give empty or clean results; extra columns
pass by unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, lower_ascii, table

#: Window (words), hashed k-gram, and hashes of which the smallest is kept: WINDOW = K + SPREAD - 1.
WINDOW, K = 10, 4
#: Bits of a Bloom filter as a power of two, at least and at most, and most windows of the benchmark that are broadcast.
LEAST_BITS, MOST_BITS, BROADCAST = 12, 26, 500_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _upto(n: Column) -> Column:
    """0 .. n-1; empty if n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def grams(w: Column, k: int) -> Column:
    """A hash for each k consecutive words."""
    return F.transform(_upto(F.size(w) - (k - 1)), lambda i: F.xxhash64(F.lit(k), *(F.get(w, i + j) for j in range(k))))


def winnow(g: Column, spread: int) -> Column:
    """The distinct least hashes of all runs of `spread` k-grams."""
    if spread == 1:
        return F.array_distinct(g)
    return F.array_distinct(F.transform(_upto(F.size(g) - (spread - 1)), lambda i: F.array_min(F.slice(g, i + 1, spread))))


class Benchmark:
    """The windows of a benchmark and their fingerprints, for each length in which windows occur."""

    def __init__(self, items: DataFrame, id_col: str = "item_id", text_col: str = "text"):
        w = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
        length = F.least(F.size("w"), F.lit(WINDOW))
        starts = w.select("item", "w", length.alias("len"), F.explode(F.sequence(F.lit(0), F.size("w") - length)).alias("at"))
        windows = starts.select("len", F.array_join(F.slice("w", F.col("at") + 1, F.col("len")), " ").alias("window"), "item")
        self.windows = table(windows.groupBy("len", "window").agg(F.collect_set("item").alias("items")), "benchmark")
        by_length = {r["len"]: r["n"] for r in self.windows.groupBy("len").agg(F.count("*").alias("n")).collect()}  # at most WINDOW rows
        self.specs = [(n, *((K, n - K + 1) if n == WINDOW else (n, 1))) for n in sorted(by_length, reverse=True)]
        self.size = sum(by_length.values())

    def prints(self, spec: tuple[int, int, int]) -> DataFrame:
        length, k, spread = spec
        w = self.windows.where(F.col("len") == length).select(F.split("window", " ").alias("w"))
        return w.select(grams(F.col("w"), k).alias("g")).select(F.explode(winnow(F.col("g"), spread)).alias("print")).distinct()


def _places(h: str, bits: int) -> list[tuple[str, str]]:
    """The two bits that stand for a hash: which long of the filter, and which bit of that."""
    mask = (1 << (bits - 6)) - 1
    return [
        (f"cast(shiftrightunsigned({h}, {64 - (bits - 6)}) as int)", f"cast({h} & 63 as int)"),
        (f"cast(shiftrightunsigned({h}, 6) & {mask} as int)", f"cast(shiftrightunsigned({h}, 32) & 63 as int)"),
    ]


def bloom(prints: DataFrame) -> str:
    """SQL text that tells whether the hash `h` may be one of `prints` (column print)."""
    bits = min(MOST_BITS, max(LEAST_BITS, (32 * prints.count()).bit_length()))
    both = ", ".join(f"struct({at} as at, {bit} as bit)" for at, bit in _places("print", bits))
    longs = prints.select(F.expr(f"explode(array({both})) as b")).groupBy("b.at").agg(F.expr("bit_or(shiftleft(1L, b.bit)) as x"))
    held = {r["at"]: r["x"] for r in longs.collect()}  # at most 2^(MOST_BITS - 6) rows
    text = ",".join(str(held.get(i, 0)) for i in range(1 << (bits - 6)))
    # Folded into one literal when the query is planned.
    return " and ".join(f"(shiftrightunsigned(get(cast(split('{text}', ',') as array<bigint>), {at}), {bit}) & 1) = 1" for at, bit in _places("h", bits))


def _around(places: Column, n: int, spread: int) -> Column:
    """The n-word windows (len, start, window) of `w` that hold one of the places of k-grams."""
    last = F.greatest(F.lit(0), F.size("w") - n)
    each = F.transform(places, lambda p: F.sequence(F.least(last, F.greatest(F.lit(0), p - (spread - 1))), F.least(p, last)))
    starts = F.array_distinct(F.flatten(each))
    return F.transform(starts, lambda s: F.struct(F.lit(n).alias("len"), s.alias("start"), F.array_join(F.slice("w", s + 1, n), " ").alias("window")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, th (a hash of the text), n_words, n_hit, items (those that occur, as ascending strings)."""
    bench = Benchmark(benchmark)
    df = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), words(F.col(text_col)).alias("w"))
    none = F.array().cast("array<string>")
    if not bench.specs:
        return df.select("id", "th", F.size("w").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    df = df.select("*", *(grams(F.col("w"), k).alias(f"g{n}") for n, k, _ in bench.specs))
    df = df.select("*", *(winnow(F.col(f"g{n}"), spread).alias(f"f{n}") for n, _, spread in bench.specs))
    df = df.select("*", *(F.expr(f"filter(f{spec[0]}, h -> {bloom(bench.prints(spec))})").alias(f"m{spec[0]}") for spec in bench.specs))
    near = []
    for n, _, spread in bench.specs:
        at = F.expr(f"filter(transform(g{n}, (h, i) -> if(array_contains(m{n}, h), i, null)), i -> i is not null)")
        near.append(F.when(F.size(f"m{n}") > 0, _around(at, n, spread)).otherwise(F.array().cast("array<struct<len:int,start:int,window:string>>")))
    found = table(df.select("id", "th", F.size("w").cast("long").alias("n_words"), F.concat(*near).alias("near")), "prints")

    windows = bench.windows if bench.size > BROADCAST else F.broadcast(bench.windows)
    spans = (
        found.select("id", "th", F.explode("near").alias("x"))
        .select("id", "th", "x.*")
        .join(windows, ["len", "window"])
        .groupBy("id", "th")
        .agg(F.collect_set(F.struct("start", "len")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
        .select(
            F.col("id").alias("_id"), F.col("th").alias("_th"),
            F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))).cast("long").alias("n_hit"),
            F.sort_array(F.array_distinct(F.transform("items", lambda i: i.cast("string")))).alias("items"),
        )
    )
    return found.select("id", "th", "n_words").join(spans, F.expr("id <=> _id and th = _th"), "left").select(
        "id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns unchanged, without a word in a benchmark window."""
    t = free_name(docs, "_bad_")
    bad = contamination(docs, benchmark, id_col, text_col).where("n_hit > 0").select(F.col("id").alias(f"{t}id"), F.col("th").alias(f"{t}th"))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(f"{t}id")) & (F.xxhash64(text_col) == F.col(f"{t}th")), "left_anti")


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
