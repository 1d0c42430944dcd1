"""Merkle manifest of a dataset: a tree of digests over the rows of each source, a tree over the sources' subroots, a
proof for every row.

Leaves get their place by a range sort and sums of counts, so no source needs one task. Every task then folds the leaves
it holds as events come: a partial parent keeps its children by place until as many are there as the tree's size says it
has; then it is a node, leaves a record of its children (the reverse link) and is itself an event one level up. What a
task can't complete is its frontier, a few children at either end of its runs: those partial parents are combined by key,
level by level. Reverse links are then followed from the root down: a group of 16 leaves receives the groups above it, one
of each level, from which its rows' proofs are read.

Defined cases: rows of equal source and doc_id come in the order of their leaves, so repeated rows prove the same tree in
any order; a null source is a tree of its own before all others, a null doc_id comes first in its source and is never
tampered with; a lone leaf is its own subroot and a lone subroot the root, without hashing; an empty table has no rows
(and the root None); texts of any length are digested whole; columns besides the named ones play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, table

#: Children of a node.
ARITY = 16
#: Children of partial parents that a task holds; beyond it they join the frontier early.
PENDING = 1 << 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PART = "tree string, size long, level int, parent long, at array<int>, digests array<string>, docs array<long>, forged array<string>, names array<string>, digest string"


def digest_of(columns: list[Column]) -> Column:
    """Digest of a row: each column as `-` if null, else its length in bytes, a colon and its value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def depth(size: int) -> int:
    """Levels of groups over `size` leaves; 0 for a lone leaf."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def _depth(size: Column, deepest: int) -> Column:
    """As `depth`, for sizes of at most ARITY ** deepest."""
    out = F.lit(0)
    for d in range(deepest):
        out = out + (size > ARITY**d).cast("int")
    return out


def placed(leaves: DataFrame) -> DataFrame:
    """`leaves` (tree, order columns o1 and o2, digest, doc, forged, name) with `i`, the place in its tree by o1, o2 and
    digest, and `size`, the tree's leaves. A range sort deals equal trees and equal rows to any number of tasks."""
    keys = ["tree", "o1", "o2", "digest", "nth"]
    kept = table(leaves.withColumn("nth", F.monotonically_increasing_id()), "leaves")
    dealt = kept.repartitionByRange(*(F.col(c).asc_nulls_first() for c in keys)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in keys))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            at = []
            for t in b.column("tree").to_pylist():
                n = n + 1 if t == last else 0
                last = t
                at.append(n)
            cols = {c: b.column(c) for c in ("tree", "digest", "doc", "forged", "name")}
            yield pa.RecordBatch.from_pydict(cols | {"task": pa.array([task] * len(at), pa.int32()), "local": pa.array(at, pa.int64())})

    numbered = table(dealt.mapInArrow(number, "tree string, digest string, doc long, forged string, name string, task int, local long"), "places")
    runs = numbered.groupBy("tree", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "task", F.coalesce(before, F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    return numbered.join(runs, ["tree", "task"]).select("tree", "size", (F.col("base") + F.col("local")).alias("i"), "digest", "doc", "forged", "name")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The leaves of a task as events: nodes with their digest, then the frontier with none."""
    schema = pa.schema([
        ("tree", pa.string()), ("size", pa.int64()), ("level", pa.int32()), ("parent", pa.int64()), ("at", pa.list_(pa.int32())), ("digests", pa.list_(pa.string())),
        ("docs", pa.list_(pa.int64())), ("forged", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("digest", pa.string()),
    ])
    pending: dict[tuple, list] = {}
    held, rows = 0, []

    def record(key: tuple, size: int, children: list, digest: str | None) -> None:
        children.sort(key=lambda c: c[0])
        more = [[c[j] for c in children] for j in (2, 3, 4)] if key[1] == 0 else [[], [], []]
        rows.append((key[0], size, key[1], key[2], [c[0] for c in children], [c[1] for c in children], *more, digest))

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        rows.clear()
        return b

    for b in batches:
        for tree, size, i, digest, doc, forged, name in zip(*(b.column(c).to_pylist() for c in ("tree", "size", "i", "digest", "doc", "forged", "name")), strict=True):
            if size == 1:
                record((tree, 0, 0), 1, [(0, digest, doc, forged, name)], digest)
                continue
            level, nodes, event = 0, size, (digest, doc, forged, name)
            while True:
                key = (tree, level, i // ARITY)
                children = pending.setdefault(key, (size, []))[1]
                children.append((i % ARITY, *event))
                held += 1
                if len(children) < min(ARITY, nodes - key[2] * ARITY):
                    break
                del pending[key]
                held -= len(children)
                children.sort(key=lambda c: c[0])
                digest = hashlib.sha256("".join(c[1] for c in children).encode()).hexdigest()
                record(key, size, children, digest)
                level, nodes, i, event = level + 1, -(-nodes // ARITY), key[2], (digest, None, None, None)
                if nodes == 1:
                    break
            if held > PENDING:
                for key, (whole, children) in pending.items():
                    record(key, whole, children, None)
                pending.clear()
                held = 0
            if len(rows) >= 4096:
                yield out()
    for key, (whole, children) in pending.items():
        record(key, whole, children, None)
    if rows:
        yield out()


def _combined(part: DataFrame) -> DataFrame:
    """The partial parents of one level, put together by key: at most ARITY children each."""
    child = F.arrays_zip("at", "digests", "docs", "forged", "names")
    g = part.groupBy("tree", "size", "level", "parent").agg(F.array_sort(F.flatten(F.collect_list(child))).alias("c"))
    return g.select(
        "tree", "size", "level", "parent", F.col("c.at").alias("at"), F.col("c.digests").alias("digests"), F.col("c.docs").alias("docs"), F.col("c.forged").alias("forged"),
        F.col("c.names").alias("names"), F.sha2(F.array_join("c.digests", ""), 256).alias("digest"),
    )


def grown(leaves: DataFrame) -> tuple[DataFrame, int]:
    """All groups of children of the trees over `leaves` (as `placed` takes them), with the digest of each group's parent,
    and the levels of the largest tree."""
    folded = table(placed(leaves).sortWithinPartitions("tree", "i").mapInArrow(_fold, _PART), "folded")
    deepest = depth(folded.agg(F.max("size")).first()[0] or 0)
    out, events = folded.where("digest IS NOT NULL"), None
    for level in range(deepest):
        part = folded.where(F.col("digest").isNull() & (F.col("level") == level))
        if events is not None:
            part = part.unionByName(events)
        nodes = table(_combined(part), "frontier")
        out = out.unionByName(nodes)
        none = {c: F.array(F.lit(None).cast(t)).alias(c) for c, t in (("docs", "long"), ("forged", "string"), ("names", "string"))}
        # Nodes of the frontier are events one level up, where they meet what tasks have folded so far.
        events = nodes.where(_depth(F.col("size"), deepest) > level + 1).select(
            "tree", "size", F.lit(level + 1).alias("level"), F.floor(F.col("parent") / ARITY).alias("parent"), F.array((F.col("parent") % ARITY).cast("int")).alias("at"), F.array("digest").alias("digests"),
            *none.values(), F.lit(None).cast("string").alias("digest"),
        )
    return out, deepest


def linked(groups: DataFrame, deepest: int, above: DataFrame) -> DataFrame:
    """Reverse links followed from the roots down: the lowest groups with the tree's root as `subroot` and `chain`, for
    each level above them the place in it and its digests, and then what `above` (tree, chain) has for the tree."""
    top = F.greatest(_depth(F.col("size"), deepest), F.lit(1)) - 1
    lower = None
    for level in range(max(deepest, 1) - 1, -1, -1):
        now = groups.where(F.col("level") == level)
        here = now.where(top == level).join(above, "tree").select(*now.columns, F.col("digest").alias("subroot"), "chain")
        if lower is not None:
            link = F.array(F.struct((F.col("parent") % ARITY).cast("int").alias("pos"), F.col("_nodes").alias("nodes")))
            up = lower.select("tree", F.col("parent").alias("_up"), F.array_join("digests", "").alias("_nodes"), "subroot", F.col("chain").alias("_chain"))
            inner = now.where(top > level).withColumn("_up", F.floor(F.col("parent") / ARITY)).join(up, ["tree", "_up"])
            here = here.unionByName(inner.select(*now.columns, "subroot", F.concat(link, "_chain").alias("chain")))
        lower = table(here, "links") if level else here
    return lower


_CHAIN = "array<struct<pos:int,nodes:string>>"


def _proved(root: str | None):
    """Every row of a lowest group with its proof, checked from the forged leaf where there is one."""
    wide = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for b in batches:
            out = []
            for size, digests, docs, forged, subroot, chain in zip(*(b.column(c).to_pylist() for c in ("size", "digests", "docs", "forged", "subroot", "chain")), strict=True):
                nodes = "".join(digests)
                levels = [(e["nodes"][: wide * e["pos"]], e["nodes"][wide * (e["pos"] + 1) :]) for e in chain]
                rest = "".join(x + y for x, y in levels)
                for j, (leaf, doc, other) in enumerate(zip(digests, docs, forged, strict=True)):
                    left, right = nodes[: wide * j], nodes[wide * (j + 1) :]
                    folded = leaf if other is None else other
                    if size > 1:
                        folded = sha(left + folded + right)
                    for x, y in levels:
                        folded = sha(x + folded + y)
                    out.append((doc, leaf, subroot, root, sha(left + right + rest), folded, folded == root))
                if len(out) >= 4096:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


@dataclass
class Manifest:
    """`groups`: all groups of children of the trees of the sources (tree, size, level, parent, at, digests, docs, forged,
    digest of the parent), `sources`: the same of the tree over their subroots, `root`, and the levels of either."""

    groups: DataFrame
    sources: DataFrame
    root: str | None
    levels: int
    top_levels: int

    def links(self) -> DataFrame:
        """The lowest groups of leaves with the groups above each, up to the root: the proofs of their leaves."""
        nothing = self.sources.select("tree").distinct().select("tree", F.array().cast(_CHAIN).alias("chain"))
        top = linked(self.sources, self.top_levels, nothing)
        place = F.struct("pos", F.array_join("digests", "").alias("nodes"))
        above = top.select("size", "digests", "chain", F.posexplode("names").alias("pos", "tree")).select(
            "tree", F.when(F.col("size") > 1, F.concat(F.array(place), "chain")).otherwise(F.col("chain")).cast(_CHAIN).alias("chain")
        )
        return linked(self.groups, self.levels, above)

    def checked(self) -> DataFrame:
        """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the root folded from its leaf
        and the siblings of its proof, from the forged leaf where the manifest was given one."""
        kinds = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return self.links().select("size", "digests", "docs", "forged", "subroot", "chain").mapInArrow(_proved(self.root), kinds)


def manifest(rows: DataFrame, source: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, forged: Column | None = None) -> Manifest:
    """The manifest of `rows`: leaves of `fields` by `source` and ascending `key`. `forged`, if given, is a digest that
    takes the leaf's place when proofs are checked (null: the leaf itself)."""
    # A tree's name sorts as its source does: null, the empty name, before all others.
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    other = F.lit(None).cast("string") if forged is None else forged
    leaves = rows.select(
        tree.alias("tree"), F.col(key).cast("long").alias("o1"), F.lit(None).cast("string").alias("o2"), digest_of([F.col(c) for c in fields]).alias("digest"),
        F.col(key).cast("long").alias("doc"), other.alias("forged"), F.lit(None).cast("string").alias("name"),
    )
    groups, levels = grown(leaves)
    roots = groups.where(F.col("level") == F.greatest(_depth(F.col("size"), levels), F.lit(1)) - 1)
    over = roots.select(
        F.lit("").alias("tree"), F.lit(None).cast("long").alias("o1"), F.col("tree").alias("o2"), "digest", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("string").alias("forged"),
        F.col("tree").alias("name"),
    )
    sources, top_levels = grown(over)
    root = sources.where(F.col("level") == max(top_levels, 1) - 1).select("digest").first()
    return Manifest(groups, sources, root and root[0], levels, top_levels)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents and the check of every proof; rows whose id's crc32 5 divides are checked with A-Z of
    the text lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = digest_of([lower_ascii(c) if c == "text" else F.col(c) for c in FIELDS])
    forged = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered)
    return manifest(docs, forged=forged).checked()
