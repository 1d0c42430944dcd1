"""Merkle manifests, token files and ranked search against brute force, and their defined cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeworks.llm import merkle, search, token_files

from . import brute

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sorted_rows(rows):
    return sorted(map(str, map(tuple, rows)))


# ------------------------------------------------------------------ op11


def proofs(spark, rows, schema=DOCS):
    df = spark.createDataFrame(rows, schema)
    tampered = merkle.digest_of([F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c == "text" else F.col(c) for c in merkle.FIELDS])
    return merkle.manifest(df, forged=F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered)).checked()


def test_op11_driver_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*merkle.FIELDS).collect()
    got = merkle.op11_merkle_manifest(spark, sf).collect()
    assert sorted_rows(got) == sorted_rows(brute.merkle([tuple(r) for r in docs]))
    assert any(not r.verified for r in got) and any(r.verified for r in got)


@pytest.mark.parametrize("pending", [1 << 16, 5])
def test_op11_tree_shapes(spark, monkeypatch, pending):
    """Sources of every size around a full level, hundreds of sources, and folds that flush early."""
    monkeypatch.setattr(merkle, "PENDING", pending)
    rng = random.Random(3)
    sizes = {None: 5, "": 1, "a": 16, "b": 17, "é": 255, "c": 257, "d": 1, "z": 1100} | {f"s{i}": 1 + i % 2 for i in range(280)}
    rows = [(i * 1000 + k, s, "en", i, f"Text {rng.random()}") for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rng.shuffle(rows)
    assert sorted_rows(proofs(spark, rows).collect()) == sorted_rows(brute.merkle(rows))


def test_op11_odd(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (7, "a", None, 3, ""), (7, "a", "en", 3, "X"), (8, "A", "en", 3, "é ß 漢字 \U0001f600"), (5, "a", "en", 10, "Word " * 200_000)]
    rows += [(9, "a", "en", 1, "Same")] * 40
    got = proofs(spark, [(*r, 1, 2) for r in rows], DOCS + ", tree int, size int")
    assert sorted_rows(got.collect()) == sorted_rows(brute.merkle(rows))
    assert proofs(spark, []).count() == 0
    lone = proofs(spark, [(1, "a", "en", 1, "x")]).first()
    assert lone.leaf == lone.subroot == lone.root == lone.folded_root and lone.verified


# ------------------------------------------------------------------ op12


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1), st.integers(2**59, 2**61)), max_size=400), st.integers(1, 90))
def test_op12_round_trip(values, block):
    old, token_files.BLOCK = token_files.BLOCK, block
    try:
        words, blocks = token_files.pack(np.array(values, np.uint64))
        assert token_files.unpack(words).tolist() == values
        assert len(blocks) == -(-len(values) // block)
        for k in range(len(blocks)):
            assert token_files.unpack(words, blocks, k).tolist() == values[k * block : (k + 1) * block]
    finally:
        token_files.BLOCK = old


def test_op12_packs_the_most_that_fit():
    words, _ = token_files.pack(np.array([1] * 60 + [5] * 20 + [40_000] * 3 + [2**62, 7], np.uint64))
    assert [int(w >> np.uint64(60)) for w in words] == [1, 3, 12, 0, 0, 14]
    assert len(token_files.pack(np.zeros(6000, np.uint64))[0]) == 5 * 18 + 16  # blocks end with words of fewer values


def plain(rows):
    """The same by the library alone, text by text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def tokens(spark, rows, path, digest=True, schema="doc_id long, text string"):
    import public_tokenizers

    token_files.write(spark.createDataFrame(rows, schema), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path, digest)


def test_op12_driver_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted_rows(token_files.op12_token_files(spark, sf).collect()) == sorted_rows(plain([tuple(r) for r in docs]))


def test_op12_pieces_as_whole_texts(monkeypatch):
    """Texts of any marks, spaces and scripts: ids of pieces put together are those of the whole text."""
    import public_tokenizers

    rng = random.Random(5)
    signs = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\x1c", "'s", "'", "don't", "a", "Wort", "é", "e\u0301", "漢字", "1", "²", "12.5", ".", "...", "!?", ",", "\U0001f600", "_", "$", "<|endoftext|>", "ʰ", "ɏa", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    e = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(token_files, "KNOWN", 500)
    parts = [e.encode(texts[i : i + 100], 2) for i in range(0, len(texts), 100)]
    ids, sizes = (np.concatenate(p) for p in zip(*parts, strict=True))
    whole = [[*x.ids, 2] for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in whole] and ids.tolist() == [i for w in whole for i in w]


def test_op12_odd(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RECORD", 50)
    rows = [(None, "first of all"), (3, None), (2, ""), (2, ""), (9, "Wort " * 100_000), (9, "Wort " * 100_000), (-4, " \n "), (7, "é ß 漢字 \U0001f600 <|endoftext|> it's")] + [(10 + i, f"row {i}") for i in range(500)]
    random.Random(1).shuffle(rows)
    got = tokens(spark, [(*r, 1, "x") for r in rows], str(tmp_path / "a"), schema="doc_id long, text string, start int, words string").collect()
    assert sorted_rows(got) == sorted_rows(plain(rows))
    assert tokens(spark, [], str(tmp_path / "b")).count() == 0
    ids = tokens(spark, [(5, "one two"), (4, None)], str(tmp_path / "c"), digest=False).orderBy("doc_id").collect()
    assert [len(r.ids) for r in ids] == [1, 3] and all(r.ids[-1] == 2 for r in ids)


# ------------------------------------------------------------------ op13


def ranked(docs, items, k=10):
    """(item_id, rank, doc_id, score) by counting every text for every item."""
    cut = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
    texts = [(i, cut(t)) for i, t in docs]
    n_docs, total, df = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts), Counter(t for _, w in texts for t in set(w))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(cut(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for i, w in texts:
            tf, m = Counter(w), 10 + (90 * len(w) * n_docs // total if total else 0)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            scores += [(-score, i is not None, i or 0)] if score else []
        out += [(item, r, i if known else None, -score) for r, (score, known, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_op13_driver_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted_rows(search.op13_lexical_search(spark, sf).collect()) == sorted_rows(ranked(docs, items))


@pytest.mark.parametrize(("terms", "pairs", "bits"), [(500_000, 500_000, 10), (500_000, 0, 1), (0, 0, 3)])
def test_op13_odd(spark, monkeypatch, terms, pairs, bits):
    """Nulls, equal ids, ties, repeated rows, long texts and clashing columns, within the bounds and beyond."""
    monkeypatch.setattr(search, "MOST_TERMS", terms)
    monkeypatch.setattr(search, "MOST_PAIRS", pairs)
    monkeypatch.setattr(search, "BLOCK_BITS", bits)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "漢字", "A1", "a_b", "x\u00a0y"]
    docs = [(None, None), (1, ""), (2, " .,; "), (None, "w1 w2"), (None, "w1 w2"), (3, "w1 " * 200_000), (4, "W1-w2 é É"), (4, "w1 w2 é É")]
    docs += [(10 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(200)] + [(300 + i, "w1 w2 w3") for i in range(30)]
    items = [(None, "w1"), ("a", "W1 w2 w2"), ("a", "w39"), ("b", None), ("c", "nowhere 漢字 x"), ("d", "w1 w2 w3")]
    d = spark.createDataFrame([(*r, 1, 2, "z") for r in docs], "doc_id long, text string, row int, t int, term string")
    q = spark.createDataFrame([(*r, 3, 4) for r in items], "item_id string, text string, i int, item int")
    assert sorted_rows(search.search(d, q).collect()) == sorted_rows(ranked(docs, items))
    assert search.search(d.limit(0), q).count() == search.search(d, q.limit(0)).count() == 0
