"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are put into partitions by the power of two their number of shingles lies under. A partition's upper bound u
sets the length of its items' MinHash sketches, the u - ceil(t u) + 1 smallest shingle hashes: a document that holds a
share t of an item's shingles can miss at most u - ceil(t u) of them, so it holds at least one of the sketch, however
long the document is. Every shingle of every document is looked up in the sketches; documents with a hit are candidates
and are verified by counting the item's shingles themselves.

Items are a query set: they are worked off in blocks of bounded size, each a pass over the documents in which nothing is
shuffled and no document leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import in_arrow, kept, pick, text_slices
from tidemill.llm.words import runs, shingle_texts, shingles

BLOCK_BYTES = 8_000_000


def _needed(n: int, share: float) -> int:
    """Fewest shared shingles of n that reach the share."""
    return int(np.ceil(share * n - 1e-9))


class Sketches:
    """The sketches of a block of items."""

    def __init__(self, items: list[tuple[object, str]], share: float):
        self.share = share
        self.items = [(key, shingle_texts(text)) for key, text in items]
        hashes, owner = [], []
        for i, own in enumerate(shingles(pa.array([text for _, text in items], pa.large_string()))):
            if len(own):
                bound = 1 << (len(own) - 1).bit_length()
                own = own[: bound - _needed(bound, share) + 1]
                hashes.append(own)
                owner.append(np.full(len(own), i))
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> np.uint64(44)] = True

    def candidates(self, texts: pa.Array) -> set[tuple[int, int]]:
        """(place of the text, place of the item) where the text holds a shingle of the item's sketch."""
        h, first = runs(texts)
        at = np.flatnonzero(self.seen[h >> np.uint64(44)])
        low = np.searchsorted(self.hashes, h[at], side="left")
        n = np.searchsorted(self.hashes, h[at], side="right") - low
        rows = np.repeat(np.searchsorted(first, at, side="right") - 1, n)
        entries = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return set(zip(rows.tolist(), self.owner[entries].tolist()))

    def verified(self, texts: pa.Array):
        """(place of the text, item key, shingles of the item, those of them the text holds)."""
        row, own = -1, set()
        for i, k in sorted(self.candidates(texts)):
            if i != row:
                row, own = i, shingle_texts(texts[i].as_py())
            key, item = self.items[k]
            shared = len(item & own)
            if shared >= _needed(len(item), self.share):
                yield i, key, len(item), shared


def _search(sketches: Sketches, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            ids = batch.column(0)
            found = [(ids[i].as_py(), *rest) for i, *rest in sketches.verified(batch.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * 4, schema)], schema=schema)

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """Distinct (id, text) in blocks of about BLOCK_BYTES, dealt by their hash; one block at a time is on the driver."""
    items = kept(items.where("text is not null").distinct())
    size = items.agg(F.sum(F.octet_length("text") + F.lit(100)).cast("long")).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for n in range(blocks if size else 0):
        found = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == n).toArrow()
        if found.num_rows:
            yield list(zip(*(c.to_pylist() for c in found.columns)))


def contained_items(docs: DataFrame, items: DataFrame, share: float = 0.75, doc_id: str = "doc_id", item_id: str = "item_id",
                    text: str = "text", item_text: str = "text") -> DataFrame:
    """Per document row and test item of which it holds at least ``share`` of the distinct five-word shingles:
    doc_id, item_id, n_shingles (of the item), n_shared, containment.

    NULL and wordless texts hold nothing and are held by nothing; an item of fewer than five words is one shingle, which
    only a document of just these words has. NULL ids are returned as NULL; repeated documents give repeated rows, repeated
    equal items count once, one id with different texts as different items; empty tables give no rows; texts are whole and
    of any length; other columns are not read.
    """
    source = pick(docs, doc_id=doc_id, text=text)
    kinds = {"doc_id": source.schema["doc_id"].dataType, "item_id": items.schema[item_id].dataType}
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(n, arrow[k.simpleString()]) for n, k in kinds.items()] + [("n_shingles", pa.int64()), ("n_shared", pa.int64())])
    ddl = ", ".join(f"{n} {k.simpleString()}" for n, k in kinds.items()) + ", n_shingles long, n_shared long"
    parts = [kept(in_arrow(source, _search(Sketches(block, share), schema), ddl)) for block in _blocks(pick(items, key=item_id, text=item_text))]
    found = reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], ddl)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def decontaminated(docs: DataFrame, items: DataFrame, share: float = 0.75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a test item. NULL ids compare as equal."""
    found = contained_items(docs, items, share, doc_id=doc_id, text=text)
    hit = found.select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs[f"`{doc_id}`"].eqNullSafe(hit["_hit"]), "left_anti")
