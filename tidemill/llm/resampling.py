"""Importance resampling towards a target: documents whose word runs look like the target's are drawn more often.

1. Runs of words fall into buckets. Each task counts its buckets in one array; the JVM adds the counts per bucket.
2. A bucket's gain is the log ratio of its smoothed shares in target and corpus; a document's weight is the sum of its gains,
   taken from an array. Gumbel noise made from the id turns the largest scores into a draw without replacement.
3. The draw needs exact ranks: parallel sorting by regular sampling. Every task sorts its run; samples in regular distance
   over all runs give the splitters; runs are cut at the splitters and the segments exchanged; each segment is merged in its
   task; the counts of the segments before it make its places ranks. No key or score can make a segment large, as run and
   place within it settle ties.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import in_arrow, kept, pick, text_slices

#: Rows of a segment where the session's shuffle partitions would make larger ones, and samples taken for each segment.
SEGMENT_ROWS = 1 << 18
SAMPLES = 16
BLOCK = 4_000_000

#: Bytes as they count: digits, letters in lower case and all beyond ASCII; every other byte parts words.
_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text in pieces of bounded size."""
    rest = b""
    for at in range(0, len(text), BLOCK):
        piece = rest + text[at : at + BLOCK].encode("utf-8").translate(_WORD)
        cut = piece.rfind(b" ") + 1
        yield piece[:cut].split()
        rest = piece[cut:]
    yield rest.split()


def feature_buckets(text: str, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, bucket of every run of 1 to ``longest`` words) in pieces of bounded size."""
    tail: list[bytes] = []
    for words in word_blocks(text):
        found = [np.fromiter(map(zlib.crc32, words), np.int64, len(words))]
        both = tail + words
        for n in range(2, longest + 1):
            runs = [b" ".join(both[i : i + n]) for i in range(max(0, len(tail) - n + 1), len(both) - n + 1)]
            found.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
        tail = both[len(both) - longest + 1 :] if longest > 1 else []
        yield len(words), np.concatenate(found) % buckets


def bucket_counts(texts: DataFrame, buckets: int, longest: int = 1) -> np.ndarray:
    """How many features of all texts (one column ``text``) fall into each bucket; ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in text_slices(batches, "text"):
            for text in batch.column(batch.schema.get_field_index("text")):
                for _, found in feature_buckets(text.as_py(), buckets, longest):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    sums = in_arrow(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the buckets' shares in target and corpus, each count one larger)."""
    size, whole, wanted = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(whole + size) / (float(s + 1) * float(wanted + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the id: the same for every run and every task."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighted(docs: DataFrame, target: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs`` (doc_id, text)."""
    gain = gains(bucket_counts(docs.select("text"), buckets, longest), bucket_counts(target, buckets, longest))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sums = []
            for text in batch.column(batch.schema.get_field_index("text")):
                words = features = weight = 0
                for n, found in feature_buckets(text.as_py(), buckets, longest):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                sums.append((words, features, weight))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), *[pa.array(c, pa.int64()) for c in zip(*sums)]],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return in_arrow(docs, weigh, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


# --- exact ranks ---------------------------------------------------------------------------------------------------

_RANKED = ["score", "no_id", "doc_id", "n_features", "run", "at"]


def _keys(batch: pa.RecordBatch, blank) -> list[tuple]:
    """Rows as tuples in the order of ranks: high scores first, then small ids, NULL ids last."""
    columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _RANKED if c != "no_id"}
    return [(-s, d is None, blank if d is None else d, n, r, a) for s, d, n, r, a in zip(*[columns[c] for c in ("score", "doc_id", "n_features", "run", "at")])]


def _appended(batch: pa.RecordBatch, name: str, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, name])


def ranked(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (doc_id, score, n_features and others) with ``rank`` 1, 2, 3... by falling score, ties to the smaller id; and
    the number of rows."""
    spark = rows.sparkSession
    columns = rows.columns
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    blank = "" if rows.schema["doc_id"].dataType.typeName() == "string" else 0
    order = [F.col("score").desc(), F.col("doc_id").isNull(), "doc_id", "n_features"]
    runs = kept(rows.sortWithinPartitions(*order).withColumns({"run": F.spark_partition_id().cast("long"), "at": F.monotonically_increasing_id()}))

    sizes = dict(sorted(tuple(r) for r in runs.groupBy("run").count().collect()))
    total = sum(sizes.values())
    if not total:
        return rows.withColumn("rank", F.lit(None).cast("long")), 0
    starts = dict(zip(sizes, np.concatenate([[0], np.cumsum(list(sizes.values()))])[:-1].tolist()))
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / SEGMENT_ROWS))
    gap = max(1, total // (segments * SAMPLES))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in regular distance, counted on from run to run."""
        run, seen = None, 0
        for batch in batches:
            for part in _one_run(batch):
                number = part.column(part.schema.get_field_index("run"))[0].as_py()
                run, seen = (run, seen) if number == run else (number, starts[number])
                first = -seen % gap
                seen += part.num_rows
                if first < part.num_rows:
                    yield part.take(pa.array(range(first, part.num_rows, gap), pa.int64()))

    runs_schema = f"{plain}, run long, at long"
    taken = sorted(key for batch in in_arrow(runs, sample, runs_schema).toArrow().to_batches() for key in _keys(batch, blank))
    splitters = [taken[len(taken) * i // segments] for i in range(1, segments)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _appended(batch, "segment", [bisect_right(splitters, key) for key in _keys(batch, blank)])

    cut_runs = in_arrow(runs, cut, f"{runs_schema}, segment long")
    counts = dict(tuple(r) for r in cut_runs.groupBy("segment").count().collect())
    ahead = np.concatenate([[0], np.cumsum([counts.get(i, 0) for i in range(segments)])]).tolist()
    merged = cut_runs.repartitionById(segments, F.col("segment").cast("int")).sortWithinPartitions("segment", *order, "run", "at")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, at = None, 0
        for batch in batches:
            ranks = []
            for s in batch.column(batch.schema.get_field_index("segment")).to_pylist():
                if s != segment:
                    segment, at = s, ahead[s]
                at += 1
                ranks.append(at)
            yield _appended(batch, "rank", ranks)

    return in_arrow(merged, number, f"{runs_schema}, segment long, rank long").select(*columns, "rank"), total


def _one_run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    runs = batch.column(batch.schema.get_field_index("run")).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
    for begin, end in zip(cuts[:-1], cuts[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


# --- what users call -----------------------------------------------------------------------------------------------

def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, buckets: int = 10_000, longest: int = 1,
              seed: int = 2024, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank: 1, 2, 3... for the rows drawn, NULL for all others.

    Drawn are floor(percent * N / 100) of the N rows with ``min_words`` words or more. Features are all runs of 1 to
    ``longest`` words, repeats counted.

    A NULL text has no words; an empty one too: weight 0, never drawn unless ``min_words`` is 0. Very long texts are read in
    pieces. Every row is a document of its own, repeated rows too: they have equal scores and follow one another. NULL ids share
    one noise and come after other ids of their score. An empty table gives no rows; an empty target leaves equal counts of 1.
    Columns not named are not read, so their names cannot clash.
    """
    source = pick(docs, doc_id=doc_id, text=text)
    scored = weighted(source, pick(target, text=target_text), buckets, longest)
    scored = kept(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    inside, total = ranked(scored.where(F.col("n_words") >= min_words))
    drawn = percent * total // 100
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    outside = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return inside.unionByName(outside).select("doc_id", "n_features", "weight", "score", "rank")
