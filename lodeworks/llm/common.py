"""What the training-data operators share: byte-level numpy tokenising and hashing. Tables in the shared folder and
connected components are those of the other operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.operators.shared import components, table

__all__ = ["Words", "alnum_words", "byte_codes", "components", "free_name", "let", "lower_ascii", "mix", "redact", "running", "runs_of_text", "space_words", "table"]

# ----------------------------------------------------------------- byte tables

_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def space_words() -> np.ndarray:
    """Which bytes belong to words `[^\\x20\\x09-\\x0D]+`."""
    inside = np.ones(256, bool)
    inside[_SPACES] = False
    return inside


def alnum_words() -> np.ndarray:
    """Which bytes belong to words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` once A-Z are lower-cased."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x41:0x5B] = inside[0x80:] = True
    return inside


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P, _Q = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_POWERS = np.array([1], np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        _POWERS = np.multiply.accumulate(np.concatenate([np.array([1], np.uint64), np.full(size - 1, _P)]))
    return _POWERS


def byte_codes(lower: bool, inside: np.ndarray) -> np.ndarray:
    """Random 64-bit code of each byte, 0 outside words; A-Z as a-z if `lower`."""
    codes = _BYTE.copy()
    if lower:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    return np.where(inside, codes, np.uint64(0))


class Words:
    """The words of a run of texts: `hash` (64 bits), `start`/`end` (bytes in `data`), `doc` (row in the run), and
    `first`, where each row's words begin (one more at the end)."""

    __slots__ = ("data", "doc", "end", "first", "hash", "offsets", "start")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, codes: np.ndarray | None):
        self.data, self.offsets = data, offsets
        n = len(data)
        flag = np.zeros(n + 1, np.int8)
        flag[:n] = inside[data]
        begin = np.empty(n + 1, bool)
        begin[0] = n > 0 and flag[0]
        begin[1:] = (flag[1:] == 1) & (flag[:-1] == 0)
        cut = offsets[1:-1]
        cut = cut[cut < n]
        begin[cut] = flag[cut] == 1  # a text's end also ends a word
        self.start = np.flatnonzero(begin)
        stop = np.empty(n + 1, bool)
        stop[0] = False
        stop[1:] = (flag[:-1] == 1) & ((flag[1:] == 0) | begin[1:])
        self.end = np.flatnonzero(stop)
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = np.zeros(len(self.start), np.uint64)
        if codes is not None and len(self.start):
            lengths = np.diff(np.append(self.start, n))
            at = np.arange(self.start[0], n) - np.repeat(self.start, lengths)
            within = np.minimum(at, np.repeat(self.end - self.start, lengths))
            part = codes[data[self.start[0] :]] * _powers(int(within.max()) + 2)[within]
            self.hash = mix(np.add.reduceat(part, self.start - self.start[0]) + (self.end - self.start).astype(np.uint64) * _Q)

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; only those within one row mean anything."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, k, np.uint64)
        for j in range(k):
            out = out * _Q + self.hash[j : j + n]
        return mix(out)

    def long_grams(self, k: int) -> np.ndarray:
        """As `grams`, in about 2 log2 k passes: hashes of 1, 2, 4, ... words are put together."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        part, size, out, at = self.hash, 1, np.full(n, k, np.uint64), 0
        while True:
            if k & size:
                out = mix(out * _Q + part[at : at + n])
                at += size
            if 2 * size > k:
                return out
            part = mix(part[:-size] * _P + part[size:])
            size *= 2


def runs_of_text(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after, bytes, offsets) of runs of whole texts of about `most` bytes; nulls are empty. A longer
    text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        high = min(high, n)
        yield low, high, raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


# ----------------------------------------------------------------- columns


def lower_ascii(c: Column | str) -> Column:
    """A-Z to a-z, nothing else (lower() also changes other letters)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# SQL text: one call parses a large expression, while each function call on columns costs a trip to the JVM.


def let(x: str, name: str, body: str) -> str:
    """`body` with `name` for x, which is evaluated once, however often `body` names it."""
    return f"get(transform(array({x}), {name} -> {body}), 0)"


#: Elements that `running` adds up at a time: appending to an array copies it, so arrays grow within blocks only.
RUN = 128


def running(values: str, op: str) -> str:
    """For each of the longs `values`, `op` (of {a} and {x}) over all before it, from 0: blocks are reduced, their results
    run up, and each block is then run up from where it begins."""
    of = lambda a, x: f"cast({op.format(a=a, x=x)} as bigint)"

    def up(xs: str, start: str) -> str:
        first = f"struct(cast({start} as bigint) as now, cast(array() as array<bigint>) as out)"
        return f"aggregate({xs}, {first}, (at, x) -> struct({of('at.now', 'x')} as now, array_append(at.out, at.now) as out), at -> at.out)"

    blocks = f"transform(sequence(0, cast(floor((size(xs) - 1) / {RUN}) as int)), b -> slice(xs, b * {RUN} + 1, {RUN}))"
    totals = f"transform(bs, b -> aggregate(b, cast(0 as bigint), (a, x) -> {of('a', 'x')}))"
    placed = f"flatten(zip_with(bs, {up(totals, '0')}, (b, s) -> {up('b', 's')}))"
    return let(values, "xs", f"if(size(xs) > 0, {let(blocks, 'bs', placed)}, cast(array() as array<bigint>))")


#: Code points of a piece of text from which spans are cut: finding a place in a string walks there from its beginning.
PIECE = 2048


def redact(text: str, spans: str, mask: str = "") -> Column:
    """The column `text` with every span of the column `spans` (start, end; ascending by start) replaced by `mask`;
    overlapping spans become one mask. The work is linear in text and spans."""

    def cut(a: str, b: str) -> str:
        low = f"cast(floor({a} / {PIECE}) as int)"
        some = f"array_join(slice(ps, {low} + 1, cast(floor(({b} - 1) / {PIECE}) as int) - {low} + 1), '')"
        return f"if({b} > {a}, substring({some}, cast({a} - {low} * {PIECE} + 1 as int), cast({b} - {a} as int)), '')"

    before = running(f"transform({spans}, s -> cast(s.end as bigint))", "greatest({a}, {x})")
    apart = f"filter(zip_with({spans}, {before}, (s, m) -> struct(m as a, cast(s.start as bigint) as b)), y -> y.b >= y.a)"
    kept = f"array_join(transform({apart}, y -> concat({cut('y.a', 'y.b')}, '{mask}')), '')"
    rest = let(f"array_max(transform({spans}, s -> cast(s.end as bigint)))", "z", cut("z", f"cast(char_length({text}) as bigint)"))
    pieces = f"regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0)"
    return F.expr(f"if(size({spans}) > 0, {let(pieces, 'ps', f'concat({kept}, {rest})')}, {text})")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it or begins with it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name
