"""Merkle dataset manifest: checkpoint and recompute.

Every row is a leaf, every source a tree of runs of FAN nodes, and the trees' tops are the leaves of
one more tree, whose top is the root. Only every STEP-th level is stored, as blocks: all nodes of that
level below one node of the next stored one, at most FAN ** STEP of them. A proof walks the stored
levels from the root down. Of each block the levels in between are made again from its stored
nodes, give the siblings of the block's nodes, and are dropped.

Blocks are cut by a leaf's number within its source (``number_rows``), so a source that holds most
rows is as many blocks as it needs. A block, and the path from it to the root, are the largest
things a task holds. Stored levels are tables in the shared folder; lost executors don't undo them.

Defined cases: fields that are NULL count as ``-``; a NULL source is a tree of its own, the first; rows
of equal id are ordered by their leaf, and equal rows are leaves of their own, each with its proof; a
NULL id comes first. A single row's leaf is the root, with an empty proof. An empty table has no
rows and no root. Other columns of the table are not part of a leaf, and don't matter.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lexigraph.llm.common import let, written
from lexigraph.operators.ordering import number_rows

FAN = 16
STEP = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

TREE = ["has", "name"]  # a source: whether it is there, and what it is called


def field(value: Column) -> Column:
    """A field with its length in bytes, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def tampered_text(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _hash_of(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _runs(nodes: Column) -> Column:
    """The next level: a hash of every FAN nodes."""
    last = F.floor((F.size(nodes) - 1) / FAN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: _hash_of(F.slice(nodes, i * FAN + 1, FAN)))


def _levels(nodes: Column, n: Column, use) -> Column:
    """``use(levels)`` with the STEP levels of a block made from its stored nodes: arrays of hashes,
    the stored ones first. A level is NULL if its tree has ended: ``n`` nodes are stored in all."""
    def above(done: list[Column], height: int) -> Column:
        if height == STEP:
            return use(done)
        more = F.when(n > FAN**height, _runs(done[-1]))
        return let(more, lambda level: above([*done, level], height + 1))

    return let(nodes, lambda stored: above([stored], 0))


def _top(nodes: Column, n: Column) -> Column:
    """The node above a block."""
    return _levels(nodes, n, lambda levels: F.get(F.coalesce(*reversed(levels)), F.lit(0)))


def _siblings(nodes: Column, n: Column, use) -> Column:
    """``use(path_of)`` with a function that gives the path of the block's node ``j`` (from 0) up to
    the node above the block: the hashes to its left and right in each run, bottom up."""
    def path_of(levels: list[Column]):
        def step(j: Column, height: int) -> Column:
            at = F.floor(j / FAN**height).cast("int")
            first = F.floor(at / FAN).cast("int") * FAN
            level = levels[height]
            return F.when(levels[height + 1].isNotNull(), F.struct(
                F.array_join(F.slice(level, first + 1, at - first), "").alias("left"),
                F.array_join(F.slice(level, at + 2, first + FAN - 1 - at), "").alias("right"),
            ))

        return lambda j: F.filter(F.array(*[step(j, h) for h in range(STEP)]), lambda p: p.isNotNull())

    return _levels(nodes, n, lambda levels: use(path_of(levels)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p.left, h, p.right), 256))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p.left, p.right)), "")


@dataclass
class Manifest:
    """Stored levels of all trees, and of the tree above them.

    A table has the blocks of one level: (has, name, block, n, nodes), ``n`` being the number of
    the tree's nodes of that level and ``nodes`` (pos, hash, kept) in order.
    """

    levels: list[DataFrame]
    upper: list[DataFrame]


def _stored_levels(nodes: DataFrame, keys: list[str], name: str) -> list[DataFrame]:
    """Tables of blocks, bottom up, of (keys, pos, n, hash, kept) rows; ``kept`` is what a leaf
    carries along. A tree that has ended goes on as a single node."""
    size = FAN**STEP
    kept = nodes.schema["kept"].dataType
    tables = []
    while True:
        block = F.floor((F.col("pos") - 1) / size).alias("block")
        # at most ``size`` nodes each
        blocks = nodes.groupBy(*keys, block, "n").agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash", "kept"))).alias("nodes")
        )
        blocks = written(blocks, f"{name}-level-{STEP * len(tables)}")
        tables.append(blocks)
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= size:
            return tables
        hashes = F.transform("nodes", lambda x: x.hash)
        nodes = blocks.select(
            *keys, (F.col("block") + 1).alias("pos"), "n", _top(hashes, F.col("n")).alias("hash"),
            F.lit(None).cast(kept).alias("kept"),
        ).withColumn("n", F.ceil(F.col("n") / size))  # not in the select: a lambda would see the new n


def build_manifest(docs: DataFrame, kept: Column | None = None) -> Manifest:
    """Hash all rows and store every STEP-th level. ``kept`` is a column that leaves carry along."""
    leaves = docs.select(
        F.col("source").isNotNull().alias("has"), F.coalesce("source", F.lit("")).alias("name"),
        F.col("doc_id").alias("id"), leaf_hash([F.col(c) for c in FIELDS]).alias("hash"),
        F.struct(F.col("doc_id"), F.lit(None).alias("made") if kept is None else kept.alias("made")).alias("kept"),
    )
    numbered = number_rows(leaves, ["id", "hash"], "pos", TREE, total="n")
    levels = _stored_levels(numbered, TREE, "merkle")
    hashes = F.transform("nodes", lambda x: x.hash)
    tops = written(levels[-1].select(*TREE, _top(hashes, F.col("n")).alias("hash")), "subroots")
    everything = F.lit(0).alias("all")
    subroots = number_rows(tops.select(everything, *TREE, "hash"), TREE, "pos", ["all"], total="n")
    upper = _stored_levels(subroots.select("all", "pos", "n", "hash", F.struct(*TREE).alias("kept")), ["all"], "merkle-top")
    return Manifest(levels, upper)


def _paths(table: DataFrame, above: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, hash, kept, path, seen) of the nodes of a stored level, of its blocks' paths
    ``above``: (keys, block, path, seen)."""
    found = table.join(above, [*keys, "block"])
    nodes = F.col("nodes")
    hashes = F.transform(nodes, lambda x: x.hash)
    rows = _siblings(hashes, F.col("n"), lambda path_of: F.transform(nodes, lambda x, j: F.struct(
        x.pos.alias("pos"), x.hash.alias("hash"), x.kept.alias("kept"),
        F.concat(path_of(j), F.col("path")).alias("path"),
    )))
    return found.select(*keys, "seen", F.explode(rows).alias("r")).select(*keys, "r.*", "seen")


def _descend(tables: list[DataFrame], top: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Paths of the leaves, from the paths ``top`` of the trees' tops: (keys, block 0, path, seen)."""
    above = top
    for table in reversed(tables[1:]):
        nodes = _paths(table, above, keys)
        above = written(nodes.select(*keys, (F.col("pos") - 1).alias("block"), "path", "seen"), name)
    return _paths(tables[0], above, keys)


def proofs(manifest: Manifest) -> DataFrame:
    """A row per leaf: doc_id, made (what it carries along), leaf, subroot, root, and ``path``, the
    siblings from the leaf up to the root, bottom up. Subroot and root are those of the stored trees."""
    no_path = F.array().cast("array<struct<left: string, right: string>>")
    hashes = F.transform("nodes", lambda x: x.hash)
    start = manifest.upper[-1].select("all", "block", no_path.alias("path"), _top(hashes, F.col("n")).alias("seen"))
    sources = _descend(manifest.upper, start, ["all"], "merkle-top-paths")
    seen = F.struct(F.col("hash").alias("subroot"), F.col("seen").alias("root"))
    top = written(sources.select("kept.*", F.lit(0).cast("bigint").alias("block"), "path", seen.alias("seen")), "source-paths")
    leaves = _descend(manifest.levels, top, TREE, "merkle-paths")
    return leaves.select("kept.doc_id", "kept.made", F.col("hash").alias("leaf"), "seen.subroot", "seen.root", "path")


def check_proofs(proved: DataFrame) -> DataFrame:
    """Each leaf's proof against the manifest: ``folded_root`` is recomputed from what the leaf carries
    along, else the leaf, and ``verified`` if that is the root of the stored trees."""
    folded = fold(F.coalesce("made", "leaf"), F.col("path"))
    return proved.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
