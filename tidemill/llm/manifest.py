"""Merkle manifest of a dataset: a persistent tree of digests in which every tampered row is a version of its own.

1. A row's leaf is the SHA-256 of its columns, worked out in the scan; the text goes no further.
2. Rows are sorted by key and id across the cluster and get their place within their key from one number per partition.
3. The tree is built in aligned blocks of 2**BITS nodes: a block becomes one node, the nodes of a tier are the children of the
   next, until every key has one node, its subroot. The subroots, in order, are the leaves of one more such tree.
4. Paths go down again, one row a block: the siblings from the block's node up to the root.
5. Each tampered leaf is a version: within its block it copies only its ancestors and shares every other node, and it goes on
   along the block's path through the tiers above. No version ever copies a block, and no task holds more than one block.

H joins hex digests and writes hex. A node alone in its pair becomes the H of itself; a key's only leaf is its subroot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import in_arrow, kept

BITS = 10

#: How a path names its steps: a sibling to the left, one to the right, none.
LEFT, RIGHT, ALONE = "L", "R", ""


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# --- places --------------------------------------------------------------------------------------------------------

def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place``: 0, 1, 2... within ``key``, in ascending order (NULL first), whatever a key's share of the rows.

    Rows are sorted over the whole cluster, so only the first key of a partition can have begun before it: one number per
    partition reaches the driver, and one goes back.
    """
    names = rows.columns
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())  # rows equal in all else may part
    dealt = spread.repartitionByRange(F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_spread"))
    runs = kept(dealt.sortWithinPartitions(F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], "_spread")
                .drop("_spread").withColumn("_part", F.spark_partition_id()))
    # per partition: its first and last key (NULL first) and how many rows these have there
    sizes = runs.groupBy("_part", key).count()
    rank = F.struct(F.col(key).isNotNull(), F.col(key))
    ends = sizes.groupBy("_part").agg(F.min_by(F.struct(key, "count"), rank).alias("first"), F.max_by(F.struct(key, "count"), rank).alias("last"))
    before: dict[int, int] = {}
    open_key, so_far = object(), 0
    for part, first, last in sorted(tuple(r) for r in ends.select("_part", "first", "last").collect()):
        before[part] = so_far if first[0] == open_key else 0
        so_far = last[1] + (before[part] if first[0] == last[0] else 0)
        open_key = last[0]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        part, at, current = None, 0, None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            parts = batch.column(batch.schema.get_field_index("_part")).to_pylist()
            places = np.empty(len(keys), np.int64)
            for i, (p, k) in enumerate(zip(parts, keys)):
                if p != part:
                    part, current, at = p, k, before[p]
                elif k != current:
                    current, at = k, 0
                places[i] = at
                at += 1
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(places)], [*names, "place"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return in_arrow(runs, number, f"{schema}, place long")


# --- blocks --------------------------------------------------------------------------------------------------------

def _levels(nodes: list[str], alone: bool) -> list[list[str]]:
    """A block's levels from its nodes up to one node: BITS steps, or where the block is its key's only one as few as lead to one."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= BITS:
        below = out[-1]
        out.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def _siblings(levels: list[list[str]], at: int) -> list[str]:
    path = []
    for row in levels[:-1]:
        other = at ^ 1
        path.append(ALONE if other >= len(row) else (LEFT if other < at else RIGHT) + row[other])
        at >>= 1
    return path


def _ancestors(node: str, path: list[str]) -> list[str]:
    """The nodes that a version with ``node`` in this place copies, lowest first."""
    copies = []
    for step in path:
        node = digest(step[1:] + node if step[:1] == LEFT else node + step[1:])
        copies.append(node)
    return copies


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[str | None, int, list[tuple]]]:
    """Whole blocks (key, number, rows) of rows that come in order; rows hold ``columns``, key and place first."""
    rows = (row for b in batches for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in columns]))
    for (key, number), block in groupby(rows, key=lambda r: (r[0], r[1] >> BITS)):
        yield key, number, list(block)


def _dealt(rows: DataFrame, *then: str) -> DataFrame:
    """Each block in one task, in order; a block has at most 2**BITS + 1 rows."""
    block = F.shiftright("place", BITS)
    return rows.withColumn("_block", block).repartition("key", "_block").sortWithinPartitions("key", "_block", *then, "place").drop("_block")


def _parents(nodes: DataFrame) -> DataFrame:
    """(key, place, node) of the next tier."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, number, rows in _blocks(batches, ["key", "place", "node"]):
            top = _levels([r[2] for r in rows], alone=number == 0 and len(rows) < 1 << BITS)[-1][0]
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([number], pa.int64()), pa.array([top], pa.string())], ["key", "place", "node"])

    return kept(in_arrow(_dealt(nodes.select("key", "place", "node")), build, "key string, place long, node string"))


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """The nodes at the top of blocks, tier by tier, the last with one node a key: a tier has 2**BITS times fewer rows than the one below."""
    tiers = [_parents(leaves)]
    while (tiers[-1].agg(F.max("place")).first()[0] or 0) > 0:
        tiers.append(_parents(tiers[-1]))
    return tiers


PATHS = "key string, place long, below array<string>, above array<string>"


def _with_paths(nodes: DataFrame, paths: DataFrame, extra: list[str]) -> DataFrame:
    """A tier's nodes and the paths of their blocks' nodes, each block's path before its nodes."""
    children = nodes.select("key", "place", "node", F.lit(None).cast("array<string>").alias("below"), F.lit(None).cast("array<string>").alias("above"), F.lit(1).alias("turn"), *extra)
    handed = paths.select("key", F.shiftleft("place", BITS).alias("place"), F.lit(None).cast("string").alias("node"), "below", "above", F.lit(0).alias("turn"),
                          *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra])
    return _dealt(children.unionByName(handed), "turn")


def _handed_down(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The path of every node of a tier, from the paths of the tier above: ``below`` its subroot and ``above`` it."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, number, (head, *rows) in _blocks(batches, ["key", "place", "node", "below", "above"]):
            levels = _levels([r[2] for r in rows], alone=number == 0 and len(rows) < 1 << BITS)
            found = [_siblings(levels, i) + head[3] for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(rows), pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array(found, pa.list_(pa.string())), pa.array([head[4]] * len(rows), pa.list_(pa.string()))], ["key", "place", "below", "above"])

    return in_arrow(_with_paths(nodes, paths, []), down, PATHS)


def _block_paths(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the lowest tier's nodes, from those of the last."""
    paths = top
    for nodes in reversed(tiers[:-1]):
        paths = kept(_handed_down(nodes, paths))
    return paths


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _subroot_paths(subroots: DataFrame) -> DataFrame:
    """(key, place 0, below empty, above): the siblings from each subroot to the root."""
    row = subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), "node")
    leaves = kept(placed(row, "key", ["name"]))
    tiers = _tiers(leaves)
    paths = _block_paths(tiers, tiers[-1].select("key", "place", _nothing().alias("below"), _nothing().alias("above")))
    found = _handed_down(leaves, paths)
    return kept(leaves.join(found, ["key", "place"]).select(F.col("name").alias("key"), F.lit(0).cast("long").alias("place"), _nothing().alias("below"), F.col("below").alias("above")))


# --- what users call -----------------------------------------------------------------------------------------------

def _versions(docs: DataFrame, changed: Column, change: str, key: str, doc_id: str, fields: list[str], step, schema: str) -> DataFrame:
    named = {"_id": doc_id, "_key": key, **{f"_{n}": c for n, c in enumerate(fields)}}
    source = docs.select(*[docs[f"`{old}`"].alias(new) for new, old in named.items()], changed.alias("_changed"))
    whole = [F.col(f"_{n}") for n in range(len(fields))]
    other = [c + 1 if name == change else c for c, name in zip(whole, fields)]
    rows = source.select(F.col("_key").cast("string").alias("key"), F.col("_id").alias("doc_id"), leaf(*whole).alias("node"), F.when(F.col("_changed"), leaf(*other)).alias("tampered"))
    leaves = kept(placed(rows, "key", ["doc_id", "node", "tampered"]))
    tiers = _tiers(leaves)
    paths = _block_paths(tiers, _subroot_paths(tiers[-1]))
    return in_arrow(_with_paths(leaves, paths, ["doc_id", "tampered"]), step, schema.format(id=leaves.schema["doc_id"].dataType.simpleString()))


def _batch(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], list(types))


def manifest(docs: DataFrame, changed: Column, change: str = "n_chars", key: str = "lang", doc_id: str = "doc_id",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof (the siblings, level by level, left to right), folded_root, verified.

    Where ``changed`` holds, the row is tampered with: the whole number ``change`` grows by one (NULL stays), a version of the
    tree is made, and ``folded_root`` is that version's root; elsewhere it is folded from the leaf itself. ``verified`` says
    whether it equals the root.

    NULL columns have their own mark in a leaf. Rows with a NULL id come first in their key, a NULL ``key`` is a key and comes
    first. Rows with one id are ordered by their leaf; repeated rows are leaves of their own and share all but their proofs. A
    NULL ``changed`` is no change. Texts of any length are read once and not kept; empty texts are values. An empty table gives
    no rows. Columns not named are not read, so their names cannot clash.
    """
    id_type = pa.string() if docs.schema[doc_id].dataType.typeName() == "string" else pa.int64()
    types = {"doc_id": id_type, "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof": pa.list_(pa.string()), "folded_root": pa.string(), "verified": pa.bool_()}

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, number, (head, *rows) in _blocks(batches, ["key", "place", "node", "below", "above", "doc_id", "tampered"]):
            levels = _levels([r[2] for r in rows], alone=number == 0 and len(rows) < 1 << BITS)
            up = head[3] + head[4]
            shared = [levels[-1][0], *_ancestors(levels[-1][0], up)]
            subroot, root = shared[len(head[3])], shared[-1]
            out: dict[str, list] = {c: [] for c in types}
            for i, row in enumerate(rows):
                inside = _siblings(levels, i)
                path = inside + up
                node = row[6] if row[6] is not None else row[2]
                # a version's copies: its ancestors in the block, then those of the tiers above
                top = [node, *_ancestors(node, path)][-1]
                for c, v in zip(types, (row[5], row[2], subroot, root, [s[1:] for s in path if s], top, top == root)):
                    out[c].append(v)
            yield _batch(out, types)

    return _versions(docs, changed, change, key, doc_id, list(fields), prove,
                     "doc_id {id}, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean")


def copied_nodes(docs: DataFrame, changed: Column, change: str = "n_chars", key: str = "lang", doc_id: str = "doc_id",
                 fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """The nodes that the version of each tampered row does not share with the untampered tree: doc_id, level (0 is the leaf,
    the last the root), node. Cases as in ``manifest``."""
    id_type = pa.string() if docs.schema[doc_id].dataType.typeName() == "string" else pa.int64()
    types = {"doc_id": id_type, "level": pa.int32(), "node": pa.string()}

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, number, (head, *rows) in _blocks(batches, ["key", "place", "node", "below", "above", "doc_id", "tampered"]):
            levels = _levels([r[2] for r in rows], alone=number == 0 and len(rows) < 1 << BITS)
            out: dict[str, list] = {c: [] for c in types}
            for i, row in enumerate(rows):
                if row[6] is not None and row[6] != row[2]:
                    for level, node in enumerate([row[6], *_ancestors(row[6], _siblings(levels, i) + head[3] + head[4])]):
                        for c, v in zip(types, (row[5], level, node)):
                            out[c].append(v)
            yield _batch(out, types)

    return _versions(docs, changed, change, key, doc_id, list(fields), copy, "doc_id {id}, level int, node string")
