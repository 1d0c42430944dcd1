"""N-gram Jaccard join: a size-aware heavy-light set similarity join [Deng, Tao, Li, SIGMOD 2018] of word 5-gram sets,
and the components of its links.

1. Every text becomes a set of 64-bit shingle hashes and a 64-bit key of that set; texts with equal sets share a key
   and are one node from here on, so copies never meet each other.
2. Postings (hash, key) are dealt by hash in packed blocks. A hash that only one node has can be in no intersection and
   is dropped there; the others get their document frequency.
3. Per node the shared hashes are ordered by (frequency, hash), rarest first. Two sets of Jaccard >= 3/4 share a hash
   among the first n - ceil(3n/4) + 1, and two among one more (if they differ, they share at least three). Nodes whose
   first hashes are all their own can link with nothing and are left out.
4. Light nodes (n <= boundary) enumerate all 2-subsets of their extended prefix and meet under equal subsets; a heavy
   node scans the inverted lists of its prefix, which hold light and heavy nodes. The boundary is the one of least
   cost in rows: subsets enumerated, and members of lists scanned.
5. Members meet only if the hashes from their common one on suffice for the similarity. Meeting is done in two rounds. First
   each subset or list links its members to the one that can share the largest part of itself (of a group of near copies,
   one with hardly any hashes of its own), which joins large groups in linear work. Then only members of different
   components are paired, which are few where texts are alike, since those are in one component already; and of those only
   ones whose sizes can go together: a member looks for smaller ones in bins of sizes, between 3/4 of its own and what
   the hashes left to it allow. Pages of one template that share too little find no bin of each other at all. Every
   candidate is decided by 4 * intersection >= 3 * union over the whole sets, so the components are exact up to hash
   collisions.

Defined cases: null, empty or wordless texts have no shingles and form components of their own; texts of fewer than 5
words have one shingle, the whole sequence; very long texts are read whole; repeated rows and ids are each returned; a null
id takes part in links but never names a component (a component of null ids only is null); empty tables give empty
results; extra columns pass by unread, whatever their names.

What a task holds: a block of FLUSH postings and the keys of its partition's distinct sets; or one dealt bucket of about
BUCKET postings, of which no hash has more than 1 in SHARE of all nodes. Rows of one key or component are dealt over SALTS
tasks where keys and components meet their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, byte_codes, components, free_name, mix, runs_of_text, space_words, table

#: Words of a shingle; links need OVER * intersection >= UNDER * union.
SHINGLE, OVER, UNDER = 5, 4, 3
#: Postings that a mapper packs at a time, and that a dealt bucket holds on average.
FLUSH, BUCKET = 500_000, 1_000_000
#: A hash is hot if at least HOT nodes and 1 in SHARE of all have it; a partition reports those that 1 in LOCAL of its have.
HOT, SHARE, LOCAL = 50_000, 1_024, 4_096
#: Boundaries between light and heavy sets of which the cheapest is taken.
BOUNDARIES = (0, 4, 8, 12, 16, 24, 32, 48, *(2**k for k in range(6, 25)))
#: Tasks over which the rows of one key or component are dealt, and bins of sizes for each doubling.
SALTS, BINS = 64, 8


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's ascending distinct shingle hashes."""
    inside = space_words()
    codes = byte_codes(True, inside)
    for low, high, data, offsets in runs_of_text(texts):
        w = Words(data, offsets, inside, codes)
        grams = w.grams(SHINGLE)
        for i in range(high - low):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if b - a >= SHINGLE:
                s = np.sort(grams[a : b - SHINGLE + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for j in range(a, b):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w.hash[j : j + 1])
                yield h
            else:
                yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


_KEYED = "id long, n long, key long, hot array<long>, times array<long>"


def _keyed(batches):
    """Each row's size and key; last, of the partition's distinct sets, the hashes that at least 1 in LOCAL of them have,
    by lossy counting [Manku and Motwani 2002]."""
    seen: set[int] = set()
    sets: list[np.ndarray] = []
    hashes, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held = 0

    def count() -> None:
        nonlocal hashes, times, held
        u, n = np.unique(np.concatenate(sets), return_counts=True)
        often = n > 1
        both, back = np.unique(np.concatenate([hashes, u[often]]), return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([times, n[often]]), minlength=len(both)).astype(np.int64)
        keep = n * LOCAL >= len(seen)
        hashes, times = both[keep], n[keep]
        sets.clear()
        held = 0

    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("hot", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
    for batch in batches:
        n, keys = [], []
        for s in shingle_sets(batch.column(1)):
            n.append(len(s))
            keys.append(set_key(s) if len(s) else None)
            if len(s) and keys[-1] not in seen:
                seen.add(keys[-1])
                sets.append(s)
                held += len(s)
                if held >= FLUSH:
                    count()
        none = pa.nulls(len(n), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), none, none], schema=schema)
    if sets:
        count()
    if len(hashes):
        null = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([null, null, null, pa.array([hashes.view(np.int64)], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))], schema=schema)


def hot_hashes(rows: DataFrame) -> np.ndarray:
    """Hashes that at least HOT nodes and 1 in SHARE of them have: at most SHARE times the mean size of a set, so they go to
    all tasks. Their postings are dealt by hash and node, not by hash alone."""
    nodes_ = rows.where("key is not null").agg(F.approx_count_distinct("key")).first()[0]
    pairs = rows.where("n is null").select(F.explode(F.arrays_zip("hot", "times")).alias("p")).select("p.hot", "p.times")
    often = pairs.groupBy("hot").agg(F.sum("times").alias("n")).where(F.col("n") >= max(HOT, nodes_ // SHARE))
    return np.sort(np.array([r.hot for r in often.select("hot").collect()], np.int64).view(np.uint64))


def _among(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(hashes), bool)
    return hot[np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)] == hashes


def _packed(bucket: np.ndarray, owner: np.ndarray, columns: dict[str, np.ndarray], per_owner: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket: runs of equal owners (with what `per_owner` has of each) over the postings' columns."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])]))
    lengths = np.diff(np.append(edge, len(owner))).astype(np.int32)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends, runs = np.append(cut, len(bucket)), np.append(np.searchsorted(edge, cut), len(edge))
    runs_of = {"lens": lengths} | {k: v[owner[edge]] for k, v in per_owner.items()}
    dealt = {k: v[order] for k, v in columns.items()}
    out: dict[str, list] = {"bucket": bucket[cut].astype(np.int32).tolist()}
    for k, v in runs_of.items():
        out[k] = [v[runs[i] : runs[i + 1]].tobytes() for i in range(len(cut))]
    for k, v in dealt.items():
        out[k] = [v[ends[i] : ends[i + 1]].tobytes() for i in range(len(cut))]
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in out.items()], list(out))


def _joined(rows: pa.Table, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The packed columns of several rows in one array each."""
    return {k: np.concatenate([np.frombuffer(x, t) for x in rows.column(k).to_pylist()]) for k, t in kinds.items()}


_POSTINGS = "bucket int, lens binary, keys binary, sizes binary, hashes binary"
_SHARED = "bucket int, lens binary, keys binary, sizes binary, hashes binary, dfs binary"


def _post(buckets: int, hot: np.ndarray):
    """Postings of the distinct sets of a partition, packed by buckets of hashes (hot ones: of hashes and nodes)."""

    def post(batches):
        seen: set[int] = set()
        keys: list[int] = []
        sets: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            h = np.concatenate(sets)
            sizes = np.array([len(s) for s in sets], np.int32)
            owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
            dealt = mix(h + np.where(_among(h, hot), np.array(keys, np.int64).view(np.uint64)[owner], np.uint64(0)))
            out = _packed((dealt % np.uint64(buckets)).astype(np.int32), owner, {"hashes": h}, {"keys": np.array(keys, np.int64), "sizes": sizes})
            keys.clear(), sets.clear()
            held = 0
            pa.default_memory_pool().release_unused()
            return out

        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                key = set_key(s) if len(s) else 0
                if len(s) and key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(s)
                    held += len(s)
                    if held >= FLUSH:
                        yield flush()
        if sets:
            yield flush()

    return post


def _share(buckets: int, hot: np.ndarray):
    """Of a bucket of hashes, the postings of hashes that several nodes have, with the number of those, by node; hot hashes
    count as more frequent than all others."""

    def share(rows: pa.Table) -> pa.Table:
        x = _joined(rows, {"lens": np.int32, "keys": np.int64, "sizes": np.int32, "hashes": np.uint64})
        key, size = np.repeat(x["keys"], x["lens"]), np.repeat(x["sizes"], x["lens"])
        order = np.argsort(x["hashes"], kind="stable")
        h = x["hashes"][order]
        twice = np.zeros(len(h), bool)
        twice[1:] = h[1:] == h[:-1]
        twice[:-1] |= twice[1:]
        twice |= _among(h, hot)
        order = order[twice]
        h, key, size = x["hashes"][order], key[order], size[order]
        order = np.lexsort((key, h))  # one posting for each node and hash: a node may come from several partitions
        h, key, size = h[order], key[order], size[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
        h, key, size = h[once], key[once], size[once]
        _, back, df = np.unique(h, return_inverse=True, return_counts=True)
        df = np.where(_among(h, hot), np.iinfo(np.int32).max, df[back])
        h, key, size, df = h[df > 1], key[df > 1], size[df > 1], df[df > 1].astype(np.int32)
        if not len(h):
            return pa.Table.from_batches([], _arrow_schema(_SHARED))
        nodes, first, owner = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        dealt = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        return pa.Table.from_batches([_packed(dealt[order], owner[order], {"hashes": h[order], "dfs": df[order]}, {"keys": nodes, "sizes": size[first]})]).select([c.split()[0] for c in _SHARED.split(", ")])

    return share


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


_NODES = "key long, n int, own int, hashes array<long>"


def _gather(rows: pa.Table) -> pa.Table:
    """The nodes of a bucket that can link: size, number of hashes of their own, shared hashes by (frequency, hash)."""
    x = _joined(rows, {"lens": np.int32, "keys": np.int64, "sizes": np.int32, "hashes": np.uint64, "dfs": np.int32})
    key, size = np.repeat(x["keys"], x["lens"]), np.repeat(x["sizes"], x["lens"])
    order = np.lexsort((x["hashes"], x["dfs"], key))
    key, size, h = key[order], size[order], x["hashes"][order].view(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    shared = np.diff(np.append(edge, len(key)))
    n = size[edge]
    own = n - shared
    can = n - (UNDER * n + OVER - 1) // OVER + 1 > own
    picked = np.repeat(can, shared)
    offsets = np.concatenate([[0], np.cumsum(shared[can])])
    return pa.Table.from_arrays(
        [pa.array(key[edge][can]), pa.array(n[can].astype(np.int32)), pa.array(own[can].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h[picked]))],
        schema=_arrow_schema(_NODES),
    )


def nodes(sets: DataFrame, total: int, hot: np.ndarray) -> DataFrame:
    """(key, n, own, hashes) of the nodes that can link; `sets` has one text column, `total` is its number of shingles."""
    buckets = max(8, total // BUCKET + 1)
    gathered = max(8, buckets // 4)
    posted = sets.mapInArrow(_post(buckets, hot), _POSTINGS)
    shared = posted.groupBy("bucket").applyInArrow(_share(gathered, hot), _SHARED)
    return shared.groupBy("bucket").applyInArrow(_gather, _NODES)


def _verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    of = lambda k: found.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("hashes").alias(f"h{k}"))
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(OVER * both >= UNDER * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _can_link(na: str, nb: str, most_a: str, most_b: str) -> Column:
    """Whether sets of these sizes can reach the similarity with at most so many hashes in common (the positional filter
    of prefix joins): lossless, since a linked pair passes at the first hashes that it shares."""
    return (OVER + UNDER) * F.least(most_a, most_b) >= UNDER * (F.col(na) + F.col(nb))


def boundary(found: DataFrame) -> int:
    """The cheapest of BOUNDARIES, by the rows that meet: subsets that light nodes enumerate, and members of lists that hold a
    heavy node (a list meets its centre, so its members count once each, not in pairs)."""
    lists = found.select("n", F.explode("p1").alias("h")).groupBy("h").agg(F.count("*").alias("m"), F.max("n").alias("most"))
    scans = lists.agg(*(F.expr(f"sum(if(most > {b}, m, 0)) AS s{b}") for b in BOUNDARIES)).first()
    found = found.select("n", F.expr("size(p2) * (size(p2) - 1) / 2 AS k"))
    subsets = found.agg(*(F.expr(f"sum(if(n <= {b}, k, 0D)) AS u{b}") for b in BOUNDARIES)).first()
    return min(BOUNDARIES, key=lambda b: ((subsets[f"u{b}"] or 0) + (scans[f"s{b}"] or 0), b))


def _salted(big: DataFrame, small: DataFrame, key: str, salt: Column, only: Column, names: list[str]) -> DataFrame:
    """`big` left joined with `small` (one row for each `key`, with n, the number of rows of `big` that it meets): rows of
    one key are dealt by `salt` over SALTS tasks. Where only one row meets a key, `only` is that row's salt."""
    dealt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS))
    salts = F.when(F.col("n") == 1, F.array(dealt(only))).otherwise(F.expr(f"sequence(0L, {SALTS - 1}L)"))
    copies = small.select(F.col(key), *names, F.explode(salts).alias("_salt"))
    return big.withColumn("_salt", dealt(salt)).join(copies, [key, "_salt"], "left").drop("_salt")


def _bin(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double")) * BINS).cast("int")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id."""
    keyed = table(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_keyed, _KEYED), "sets")
    hot = hot_hashes(keyed)
    rows = keyed.where("n is not null").select("id", "n", "key")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = table(nodes(docs.select(F.col(text_col)), total, hot), "nodes")
    n, own = F.col("n"), F.col("own")
    first = n - F.ceil(UNDER * n / OVER).cast("int") + 1 - own
    prefix = found.select("key", "n", "own", F.slice("hashes", F.lit(1), first).alias("p1"), F.slice("hashes", F.lit(1), F.least(first + 1, F.size("hashes"))).alias("p2"))
    limit = boundary(prefix)
    light = F.col("n") <= limit
    # `most`: how many hashes two sets can share if those that they met by are the first that they share.
    subset = lambda x, y, at: F.struct(F.xxhash64(F.least(x, y), F.greatest(x, y)).alias("h"), (n - own - at + 1).alias("most"))
    pairs_of = F.flatten(F.transform("p2", lambda x, i: F.transform(F.slice("p2", i + 2, F.size("p2")), lambda y, j: subset(x, y, i + 1 + j))))
    each = F.transform("p1", lambda x, i: F.struct(x.alias("h"), (n - own - i).alias("most")))
    post = lambda df, c, *more: df.select("key", "n", F.explode(c).alias("_p"), *more).select("key", "n", "_p.h", "_p.most", *(m for m in ("sub", "light")))
    subsets = post(prefix.where(light), pairs_of, F.lit(True).alias("sub"), F.lit(True).alias("light"))
    lists = post(prefix, each, F.lit(False).alias("sub"), light.alias("light"))
    met = table(subsets.union(lists), "lists")
    # Round 1: each subset's most central node, and each list's most central heavy one, meets the others.
    hubs = met.where(F.col("sub") | ~F.col("light")).groupBy("sub", "h").agg(F.max(F.struct((F.col("most") / F.col("n")).alias("share"), "key", "n", "most")).alias("hub"))
    hubs = hubs.select("sub", "h", F.col("hub.key").alias("a"), F.col("hub.n").alias("na"), F.col("hub.most").alias("ma"))
    star = met.join(hubs, ["sub", "h"]).where("key != a").where(_can_link("n", "na", "most", "ma"))
    star = star.select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct()
    links = table(_verified(star, found), "links")
    comp = components(links, label="first")
    # Round 2: members of different components.
    placed = met.join(comp, met["key"] == comp["id"], "left").select("sub", "h", "key", "n", "most", "light", F.coalesce("comp", "key").alias("comp"))
    open_ = placed.groupBy("sub", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("sub", "h")
    placed = placed.join(open_, ["sub", "h"], "left_semi")
    of = lambda k, *more: placed.select("sub", "h", *(F.col(c).alias(f"{c}_{k}") for c in ("key", "n", "most", "light", "comp")), *more)
    # a looks for b no larger than itself: 4 n_b >= 3 n_a, and 3 n_b <= 7 most_a - 3 n_a.
    most = F.least(F.col("n"), F.floor(((OVER + UNDER) * F.col("most") - UNDER * F.col("n")) / UNDER))
    least = F.greatest(F.lit(1), F.ceil(UNDER * F.col("n") / OVER))
    bins = F.when(most >= least, F.sequence(_bin(least), _bin(F.greatest(most, least)))).otherwise(F.array().cast("array<int>"))
    smaller = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("key_b") < F.col("key_a")))
    rest = of("a", F.explode(bins).alias("bin")).join(of("b", _bin(F.col("n")).alias("bin")), ["sub", "h", "bin"]).where(smaller & (F.col("comp_a") != F.col("comp_b")))
    rest = rest.where(_can_link("n_a", "n_b", "most_a", "most_b")).where(F.col("sub") | ~F.col("light_a") | ~F.col("light_b"))
    rest = rest.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = table(_verified(rest, found), "links")
    if not more.isEmpty():
        comp = components(links.union(more), label="second")
    # Names: least ids are aggregated map-side; where many rows meet one name, they are dealt over several tasks.
    worded = rows.where("key is not null")
    named = worded.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    named = named.join(comp.withColumnRenamed("id", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    named = table(named, "named")
    of_comp = named.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    keys = _salted(named.select("key", "least", F.col("n").alias("rows"), "comp"), of_comp, "comp", F.col("key"), F.col("comp"), ["component_id"])
    keys = keys.select("key", "least", F.col("rows").alias("n"), "component_id")
    out = _salted(worded.withColumnRenamed("n", "n_shingles"), keys, "key", F.col("id"), F.col("least"), ["component_id"])
    alone = rows.where("key is null").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.select("id", "n_shingles", "component_id").union(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns unchanged, that stay: of each component the one with the smallest id, of rows
    equal in id and text one. Rows with a null id stay, as nothing names them."""
    t = free_name(docs, "_stay_")
    stay = join(docs, id_col, text_col).where("id = component_id").select(F.col("id").alias(f"{t}id")).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(stay, F.col(id_col) == F.col(f"{t}id"), "left_semi")
    same = Window.partitionBy(id_col, f"{t}th").orderBy(f"{t}th")
    named = named.withColumn(f"{t}th", F.xxhash64(text_col)).withColumn(f"{t}n", F.row_number().over(same)).where(F.col(f"{t}n") == 1)
    return named.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).withColumnRenamed("id", "doc_id")
