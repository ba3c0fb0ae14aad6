"""Merkle manifest of a dataset: a persistent tree of digests whose versions copy only the path above a changed leaf.

Every row of the data is a leaf.  Leaves of one group (a source) ascend by key and are hashed 16 at a time, level by level, to
the group's root; the group roots, in order of their group, are hashed likewise to the root of the dataset.

The tree is cut into aligned blocks of 4,096 leaves, three levels high.  A block is one row with the digests below it, so
the stored manifest is a table of blocks for each tier, and no task ever holds more than one block of nodes.  A hot group is
as many blocks as it needs.  Ranks come from a range partitioning and a count per partition and group; blocks are
dealt by group and number.

A *version* is what the tree becomes when a leaf changes.  ``copy_path`` makes it inside the block: the ancestors of the leaf
are new nodes, everything else is shared with the stored block.  Above the block the version goes on with the
``path`` of the block, which the tiers above have sent down: left and right siblings for each level up to the root.  So a version
costs a digest for each level, is verified where its block lies, and never travels.

Null groups are a group of their own, the first one.  Null keys come first and count as the empty text where a key is hashed;
rows that repeat are leaves of their own, ties ordered by digest.  Empty texts are hashed like any other.  An empty
table gives an empty manifest.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.projection import materialise
from .columns import ascii_lower

FANOUT, HEIGHT = 16, 3
BLOCK = FANOUT**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---- leaves ---------------------------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """A value with its UTF-8 length in front, so that neighbouring fields cannot be confused; ``-`` for null."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(field(f) for f in fields)).cast("binary"), 256)


def lowered_fifth(key: Column, text: Column) -> Column:
    """The text with A-Z in lower case where five divides the CRC-32 of the key, else null: how the query tampers."""
    chosen = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return F.when(chosen, F.coalesce(ascii_lower(text), F.lit("")))


def leaves(docs: DataFrame, *, key: str = "doc_id", group: str = "source", text: str = "text", fields: Sequence[str] = FIELDS,
           tamper=lowered_fifth) -> DataFrame:
    """``tree, key, digest, changed``: ``changed`` is the digest after ``tamper(key, text)``, null where that is null."""
    given = {f: F.col(f) for f in fields}
    altered = tamper(F.col(key), F.col(text).cast("string"))
    after = leaf_digest([F.when(F.col(text).isNotNull(), altered) if f == text else c for f, c in given.items()])
    tree = F.col(group).cast("string")
    return docs.select(
        F.when(tree.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), tree)).alias("tree"), F.col(key).alias("key"),
        leaf_digest(list(given.values())).alias("digest"), F.when(altered.isNotNull(), after).alias("changed"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank`` (from 0, in ``order`` within ``tree``) and ``total`` of their tree.

    Rows are dealt by range and stored, so each partition of the store is a stretch of the order; what a window sees is one row
    for each partition that a tree reaches into.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    held = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    runs = held.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("_n").over(by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"_before": F.coalesce(before, F.lit(0)), "total": F.sum("_n").over(by_tree)})
    found = held.withColumn("_part", part).join(runs, ["tree", "_part"])
    return found.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_n", "_before")


# ---- nodes of one block -----------------------------------------------------------------------------------------------


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(digests: list[str], total: int) -> list[list[str]]:
    """All levels of a block, leaves first.  In a tree of several blocks each of them is full height, however few its leaves."""
    levels = [digests]
    while len(levels[-1]) > 1 if total <= BLOCK else len(levels) <= HEIGHT:
        below = levels[-1]
        levels.append([digest_of("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def siblings(level: list[str], i: int) -> tuple[str, str]:
    """What stands left and right of a node among its up to sixteen."""
    first = i - i % FANOUT
    return "".join(level[first:i]), "".join(level[i + 1 : first + FANOUT])


def steps_of(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """The siblings above leaf ``i``, level by level, up to the block's root."""
    steps = []
    for level in levels[:-1]:
        steps.append(siblings(level, i))
        i //= FANOUT
    return steps


def copy_path(digest: str, steps: list[tuple[str, str]]) -> list[str]:
    """The new nodes of a version: the changed leaf and a copy of each ancestor; all other nodes stay shared."""
    nodes = [digest]
    for left, right in steps:
        nodes.append(digest_of(left + nodes[-1] + right))
    return nodes


# ---- tiers --------------------------------------------------------------------------------------------------------------


def _blocks_from(batches, extra: list[str]):
    """Rows sorted by tree, block and rank, gathered to one tuple a block."""
    now, rows, total = None, [], 0
    for b in batches:
        columns = [b.column(n).to_pylist() for n in ("tree", "block", "total", "digest", *extra)]
        for tree, block, n, *values in zip(*columns, strict=True):
            if (tree, block) != now:
                if rows:
                    yield (*now, total, *map(list, zip(*rows, strict=True)))
                now, rows, total = (tree, block), [], n
            rows.append(values)
    if rows:
        yield (*now, total, *map(list, zip(*rows, strict=True)))


def _flushed(rows, schema: pa.Schema, weight=lambda row: 1, limit: int = 2 * BLOCK):
    """Record batches of as many rows as weigh ``limit`` together."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def blocks_of(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``tree, block, total, root, digests`` and a list for each extra column, one row a block, stored."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rows.select(*extra).schema) if extra else ""
    schema = f"tree string, block bigint, total bigint, root string, digests array<string>{', ' + kinds if kinds else ''}"
    names = list(extra)
    dealt = rows.select("tree", F.expr(f"rank div {BLOCK}").alias("block"), "rank", "total", "digest", *extra)
    dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        made = ((t, b, n, levels_of(d, n)[-1][0], d, *rest) for t, b, n, d, *rest in _blocks_from(batches, names))
        yield from _flushed(made, arrow, lambda row: len(row[4]))

    return materialise(dealt.mapInArrow(run, schema))


@dataclass(frozen=True)
class Tree:
    """The tiers of blocks, leaves first, and the root of each tree with the tier it stands in."""

    tiers: list[DataFrame]
    roots: DataFrame  # tree, root, tier


def grow(rows: DataFrame, extra: Sequence[str] = ()) -> Tree:
    """Blocks over ``tree, rank, total, digest``, then blocks over their roots, until each tree has one root."""
    tiers, roots = [blocks_of(rows, extra)], None
    while True:
        top = tiers[-1]
        done = top.where(F.col("total") <= BLOCK).select("tree", "root", F.lit(len(tiers) - 1).alias("tier"))
        roots = done if roots is None else roots.unionByName(done)
        more = top.where(F.col("total") > BLOCK)
        if more.isEmpty():  # one row is looked at, a scalar decision on the height
            return Tree(tiers, materialise(roots))
        above = more.select("tree", F.col("block").alias("rank"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"), F.col("root").alias("digest"))
        tiers.append(blocks_of(above))


@dataclass(frozen=True)
class Manifest:
    """The tree of every group, and the tree of their roots."""

    groups: Tree
    top: Tree


def build(rows: DataFrame) -> Manifest:
    """The manifest of leaves as ``leaves`` gives them."""
    groups = grow(ranked(rows, ["key", "digest"]), ["key", "changed"])
    named = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"))
    return Manifest(groups, grow(ranked(named, ["key"]), ["key"]))


# ---- paths from the root down ---------------------------------------------------------------------------------------------

_PATH = "subroot string, root string, lefts array<string>, rights array<string>"


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    return blocks.join(paths.withColumnRenamed("root", "whole"), ["tree", "block"])


def _rows(batches):
    """Rows of Arrow batches as dicts, one block at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _below(blocks: DataFrame, paths: DataFrame, named: bool) -> DataFrame:
    """The path of every node under the blocks: ``tree`` and ``block`` of the child, or its ``key`` as the tree where ``named``."""
    schema = f"tree string, block bigint, {_PATH}"
    texts = pa.list_(pa.string())
    arrow = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("lefts", texts), ("rights", texts)])

    def run(batches):
        def made():
            for r in _rows(batches):
                levels = levels_of(r["digests"], r["total"])
                for i, digest in enumerate(r["digests"]):
                    steps = steps_of(levels, i)
                    lefts, rights = [a for a, _ in steps] + r["lefts"], [b for _, b in steps] + r["rights"]
                    if named:
                        yield r["key"][i], 0, digest, r["whole"], lefts, rights
                    else:
                        yield r["tree"], r["block"] * BLOCK + i, r["subroot"], r["whole"], lefts, rights
        yield from _flushed(made(), arrow)

    return materialise(_with_paths(blocks, paths).mapInArrow(run, schema))


def _descend(tree: Tree, base: DataFrame, named: bool) -> DataFrame:
    """Paths of all blocks of the lowest tier, or, where ``named``, of its leaves.  ``base``: the path of each tree's root."""
    base = base.join(tree.roots.select("tree", "tier"), "tree")
    paths = None
    for tier in range(len(tree.tiers) - 1, -1, -1):
        here = base.where(F.col("tier") == tier).drop("tier")
        paths = here if paths is None else here.unionByName(paths)
        if tier or named:
            paths = _below(tree.tiers[tier], paths, named and not tier)
    return paths


def block_paths(manifest: Manifest) -> DataFrame:
    """``tree, block, subroot, root, lefts, rights``: how each lowest block hangs below the root of the dataset."""
    none = F.array().cast("array<string>")
    base = manifest.top.roots.select("tree", F.lit(0).cast("long").alias("block"), F.lit(None).cast("string").alias("subroot"), "root", none.alias("lefts"), none.alias("rights"))
    return _descend(manifest.groups, _descend(manifest.top, base, named=True), named=False)


def _key_type(manifest: Manifest) -> str:
    return manifest.groups.tiers[0].schema["key"].dataType.elementType.simpleString()


def verify(manifest: Manifest) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified``, for every leaf.

    The proof is the siblings of the untampered tree.  The folded root is the root of the leaf's version: of its changed digest
    where it has one, else of its own.
    """
    hung = _with_paths(manifest.groups.tiers[0], block_paths(manifest))
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = f"key {_key_type(manifest)}, {', '.join(f'{n} string' for n in names)}, verified boolean"
    kind = hung.select(F.explode("key"))

    from pyspark.sql.pandas.types import to_arrow_schema

    key_arrow = to_arrow_schema(kind.schema).field(0).type
    arrow = pa.schema([("key", key_arrow), *((n, pa.string()) for n in names), ("verified", pa.bool_())])

    def run(batches):
        def made():
            for r in _rows(batches):
                levels = levels_of(r["digests"], r["total"])
                upper = list(zip(r["lefts"], r["rights"], strict=True))
                parent, rest, tail = None, [], b""
                for i, (key, leaf, changed) in enumerate(zip(r["key"], r["digests"], r["changed"], strict=True)):
                    if len(levels) > 1:
                        if parent != i // FANOUT:  # shared by sixteen leaves
                            parent = i // FANOUT
                            rest = steps_of(levels[1:], parent) + upper
                            tail = "".join(a + b for a, b in rest).encode()
                        own = [siblings(levels[0], i)]
                    else:
                        rest, own = upper, []
                        tail = "".join(a + b for a, b in rest).encode()
                    proof = hashlib.sha256("".join(a + b for a, b in own).encode() + tail).hexdigest()
                    folded = copy_path(leaf if changed is None else changed, own + rest)[-1]
                    yield key, leaf, r["subroot"], r["whole"], proof, folded, folded == r["whole"]
        yield from _flushed(made(), arrow)

    return hung.mapInArrow(run, schema)


def versions(manifest: Manifest) -> DataFrame:
    """``key, height, digest``: the nodes that each changed leaf's version does not share, leaf first, root last."""
    hung = _with_paths(manifest.groups.tiers[0], block_paths(manifest))
    schema = f"key {_key_type(manifest)}, height int, digest string"

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(hung.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        def made():
            for r in _rows(batches):
                levels = levels_of(r["digests"], r["total"])
                upper = list(zip(r["lefts"], r["rights"], strict=True))
                for i, (key, changed) in enumerate(zip(r["key"], r["changed"], strict=True)):
                    if changed is not None:
                        for height, digest in enumerate(copy_path(changed, steps_of(levels, i) + upper)):
                            yield key, height, digest
        yield from _flushed(made(), arrow)

    return hung.mapInArrow(run, schema)
