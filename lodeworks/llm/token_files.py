"""Token ids of texts in binary files, packed by Simple-8b [Anh and Moffat 2010].

A 64-bit word holds a selector in its top four bits and as many values as fit in the other 60: selector s of 1 to 14 packs
60 values of 1 bit, 30 of 2, ... or 1 of 60, always the most values of the next ones that fit. Selector 0 is an escape: a
value of more than 60 bits takes two such words with 32 bits each. Every BLOCK values begin a new word, and the place of
that word is kept, so that blocks are found, packed and unpacked independently, all of a record's at once in numpy.

The files are Parquet, whose columns are a record's parts, so any store that Spark writes to will do, and a task that is
lost writes its file again: `words` (little-endian 64-bit words), `blocks` (where each block begins in them), the
documents of the record with their `lengths`, and its `start` in the shard. A record holds whole documents, some RECORD ids of them or one longer one.
Records of a task form a shard; documents ascend by id within a shard and from shard to shard, and a small table gives
each shard's first place, so the files read one after another are one sequence of ids.

Defined cases: a null or empty text is the end id alone; rows of equal id come in the order of a hash of their texts, so
repeated rows give the same rows in any order; a null id comes first; an empty table gives empty files and no rows; a text
of any length is encoded whole; strings of special tokens in a text are text; other columns play no part. Equal ids are
dealt to any number of tasks.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.operators import shared

#: Values a word packs, by selector from 1 on, and their bits.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
BLOCK, RECORD = 1024, 1 << 20
END = 2
#: Distinct pieces of text whose ids a Python worker keeps; then those go that it has met fewer than OFTEN times since.
KNOWN, OFTEN = 1 << 19, 2
#: New pieces that are encoded as one text.
TOGETHER = 64

_RECORD = "shard int, start long, docs array<long>, lengths array<long>, n_ids long, blocks array<int>, words binary"

# ----------------------------------------------------------------- the code


#: Bit lengths, 1 at least, of values below 65,536.
_SHORT = np.maximum(np.frexp(np.arange(1 << 16, dtype=float))[1], 1).astype(np.int8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths, 1 at least."""
    if values.max(initial=0) < len(_SHORT):
        return _SHORT[values]
    out = np.ones(len(values), np.int8)
    for b in (32, 16, 8, 4, 2, 1):
        high = values >> np.uint64(b)
        more = high > 0
        out += more.astype(np.int8) * np.int8(b)
        values = np.where(more, high, values)
    return out


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, place of each block's first word) of unsigned 64-bit `values`."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # The most values from each place on that fit in a word: widest value of 1, 2, ... values against their width.
    widest = _bits(values)
    bits, best, fits = widest.copy(), np.ones(n, np.int8), {int(c): int(w) for c, w in zip(COUNTS, WIDTHS, strict=True)}
    for c in range(2, 61):
        widest = np.maximum(widest[:-1], bits[c - 1 :]) if len(widest) > 1 else widest[:0]
        if not len(widest) or int(widest.min()) * c > 60:
            break
        if c in fits:
            best[: len(widest)][widest <= fits[c]] = c
    # Words of all blocks, one step at a time: a block's tail takes the most values that are left.
    floor = np.zeros(61, np.int64)
    floor[COUNTS] = COUNTS
    floor = np.maximum.accumulate(floor)
    at, stop = np.arange(0, n, BLOCK), np.minimum(np.arange(BLOCK, n + BLOCK, BLOCK), n)
    live, starts, takes, owner = np.arange(len(at)), [], [], []
    while len(live):
        p = at[live]
        take = np.minimum(best[p], floor[np.minimum(stop[live] - p, 60)])
        starts.append(p)
        takes.append(take)
        owner.append(live)
        at[live] = p + take
        live = live[at[live] < stop[live]]
    start, take = np.concatenate(starts), np.concatenate(takes)
    order = np.argsort(start, kind="stable")
    start, take, owner = start[order], take[order], np.concatenate(owner)[order]
    escape = bits[start] > 60
    place = np.cumsum(1 + escape) - (1 + escape)
    words = np.zeros(int(place[-1]) + 1 + int(escape[-1]), np.uint64)
    for s, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True), 1):
        own = np.flatnonzero((take == c) & ~escape)
        word = np.full(len(own), s << 60, np.uint64)
        for j in range(c):
            word |= values[start[own] + j] << np.uint64(j * w)
        words[place[own]] = word
    low = np.uint64(0xFFFFFFFF)
    words[place[escape]] = values[start[escape]] & low
    words[place[escape] + 1] = values[start[escape]] >> np.uint64(32)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    return words, place[first]


def unpack(words: np.ndarray, blocks: np.ndarray | None = None, block: int | None = None) -> np.ndarray:
    """The values of all `words`, or of one block by the places of `blocks`."""
    if block is not None:
        words = words[blocks[block] : blocks[block + 1] if block + 1 < len(blocks) else len(words)]
    selector = (words >> np.uint64(60)).astype(np.int64)
    held = np.concatenate([[1], COUNTS, [0]])[selector]
    second = np.flatnonzero(selector == 0)[1::2]  # the upper half of an escaped value
    held[second] = 0
    place = np.cumsum(held) - held
    out = np.zeros(int(held.sum()), np.uint64)
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        if s == 0:
            out[place[own[::2]]] = words[own[::2]] | (words[own[1::2]] << np.uint64(32))
            continue
        w, mask = int(WIDTHS[s - 1]), np.uint64((1 << int(WIDTHS[s - 1])) - 1)
        for j in range(int(COUNTS[s - 1])):
            out[place[own] + j] = (words[own] >> np.uint64(j * w)) & mask
    return out


# ----------------------------------------------------------------- texts to ids

#: A piece of text ends where no token of the byte-level pattern goes on: before white space, and before marks that end a
#: word of letters of Latin script. Other white space than these three may join tokens, so such texts are encoded whole.
_PIECE = re.compile(r"\s*[A-Za-zÀ-ÖØ-öø-ɏ]++(?=[.,;:!?]+(?:\s|$))|\s*\S+|\s+$")
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n"]


class Encoder:
    """Ids of texts by a byte-level tokenizer of the tokenizers library. Equal pieces of text are encoded once: pieces are
    numbered, and a text's ids are gathered from those of its pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # a character of the byte-level alphabet is a byte
        self.number: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.size, self.met = (np.zeros(1 << 14, np.int32) for _ in range(3))

    def forget(self) -> None:
        kept = np.flatnonzero(self.met[: len(self.number)] >= OFTEN)
        pieces = list(self.number)
        self.number = {pieces[k]: i for i, k in enumerate(kept.tolist())}
        first, size = self.first[kept], self.size[kept]
        ends = np.cumsum(size)
        self.used = int(size.sum())
        self.ids[: self.used] = self.ids[np.repeat(first - ends + size, size) + np.arange(self.used)]
        self.first[: len(kept)], self.size[: len(kept)] = ends - size, size
        self.met[:] = 0

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of pieces that begin with one space and end with none: put together, no token goes from one
        to the next, and each one's ids are those that cover its bytes."""
        runs = ["".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        flat = np.fromiter((i for f in found for i in f), np.uint32, sum(map(len, found)))
        ends = np.searchsorted(np.cumsum(self.bytes[flat]), np.cumsum(np.fromiter((len(p.encode()) for p in pieces), np.int64, len(pieces)))) + 1
        return flat, np.diff(ends, prepend=0)

    def _add(self, pieces: list[str]) -> None:
        some = [p for p in pieces if p[0] == " " and not p[1:2].isspace() and not p[-1].isspace()]
        kept = set(some)
        pieces = some + [p for p in pieces if p not in kept]
        first, sizes = self._joined(some) if some else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[len(some) :], add_special_tokens=False)]
        size = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found))])
        flat = np.concatenate([first, np.fromiter((i for f in found for i in f), np.uint32, sum(map(len, found)))])
        n, m = len(self.number), len(pieces)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + m > len(self.first):
            self.first, self.size, self.met = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.size, self.met))
        self.ids[self.used : self.used + len(flat)] = flat
        self.first[n : n + m], self.size[n : n + m] = self.used + np.cumsum(size) - size, size
        self.used += len(flat)
        self.number.update(zip(pieces, range(n, n + m), strict=True))

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by `end`, and how many each text has."""
        if len(self.number) > KNOWN:
            self.forget()
        pieces, ends = [], []
        for t in texts:
            if t:
                if any(c in t for c in _OTHER_SPACES):
                    pieces.append(t)
                else:
                    pieces += _PIECE.findall(t)
            ends.append(len(pieces))
        found = list(map(self.number.get, pieces))
        if None in found:
            self._add(list(dict.fromkeys(p for p, k in zip(pieces, found, strict=True) if k is None)))
            found = list(map(self.number.get, pieces))
        which = np.array(found, np.int32)
        self.met[: len(self.number)] += np.bincount(which, minlength=len(self.number)).astype(np.int32)
        size = self.size[which]
        stop = np.cumsum(size)
        at = np.repeat(self.first[which] - stop + size, size)
        at += np.arange(len(at), dtype=np.int32)
        last = np.concatenate([[0], stop])[np.array(ends, np.int64)]
        return np.insert(self.ids[at], last, np.uint32(end)), np.diff(last, prepend=0) + 1


def _encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which outlives its tasks."""
    kept = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if path not in kept.by_path:
        kept.by_path[path] = Encoder(path)
    return kept.by_path[path]


# ----------------------------------------------------------------- files


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Encode `text` of all rows by the tokenizer file, and write the ids in ascending order of `key` under `path`: records
    in `ids`, the shards' places in `shards`."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("nth"))
    order = [F.col("doc").asc_nulls_first(), F.col("h"), F.col("nth")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, start, encoder = TaskContext.get().partitionId(), 0, _encoder(tokenizer)
        docs, lengths, ids, held = [], [], [], 0

        def record() -> pa.RecordBatch:
            words, blocks = pack(np.concatenate(ids))
            cols = [[shard], [start], [docs], [lengths], [held], [blocks.astype(np.int32)], [words.astype("<u8").tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["shard", "start", "docs", "lengths", "n_ids", "blocks", "words"])

        for b in batches:
            which, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high] or "") <= 1 << 20):
                    size += len(texts[high] or "")
                    high += 1
                some, sizes = encoder.encode(texts[low:high], end)
                stops = np.cumsum(sizes)
                first = 0
                while first < len(sizes):
                    room = max(1, RECORD - held)
                    last = max(first + 1, int(np.searchsorted(stops, (stops[first - 1] if first else 0) + room, "right")))
                    a, z = int(stops[first - 1]) if first else 0, int(stops[last - 1])
                    docs += which[low + first : low + last]
                    lengths += sizes[first:last].tolist()
                    ids.append(some[a:z])
                    held += z - a
                    first = last
                    if held >= RECORD:
                        yield record()
                        docs, lengths, ids, held, start = [], [], [], 0, start + held
                low = high
        if docs:
            yield record()

    dealt.mapInArrow(run, _RECORD).write.parquet(f"{path}/ids")
    spark = docs.sparkSession
    shards = spark.read.parquet(f"{path}/ids").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("docs")).alias("n_docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as tasks wrote
    shards.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The documents of the files under `path`: (doc_id, start, n_tokens) and `ids`, or their crc32 (`ids_crc32`, of
    little-endian 32-bit ids) if `digest`."""
    shards = F.broadcast(spark.read.parquet(f"{path}/shards").select("shard", "first_id"))  # as many rows as tasks wrote
    placed = spark.read.parquet(f"{path}/ids").join(shards, "shard").select((F.col("first_id") + F.col("start")).alias("start"), "docs", "lengths", "words")
    last = "ids_crc32 long" if digest else "ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, docs, lengths, words in zip(*(b.column(c) for c in ("start", "docs", "lengths", "words")), strict=True):
                ids = unpack(np.frombuffer(words.as_buffer(), "<u8")).astype("<u4")
                sizes = np.asarray(lengths.values, np.int64)
                stops = np.cumsum(sizes)
                begins = stops - sizes
                if digest:
                    raw = ids.tobytes()
                    out = pa.array([zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(begins.tolist(), stops.tolist(), strict=True)], pa.int64())
                else:
                    out = pa.ListArray.from_arrays(pa.array(np.append(begins, len(ids)), pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(begins + start.as_py()), pa.array(sizes), out], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the 50k byte-level vocabulary, written and read back."""
    import public_tokenizers

    path = f"{shared.shared_dir(spark)}/lodeworks-tokens-{uuid.uuid4().hex}"
    shared.delete_at_end(spark, path)
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path, digest=True)
