"""Toxic passages: maximum-scoring segments over word log-odds, weighed by extreme-value statistics.

1. Words (runs of letters, A-Z lower-cased) and their beginnings of four and six bytes, which stand for the stem in languages
   that inflect or compound, are counted by class in the labelled documents, and in all documents for the prior: once a
   document, since texts repeat their own words. Counts lie in a table of fixed size (a word's hash modulo BUCKETS), so
   nothing grows with the vocabulary.
2. A word's score is its log-odds between the classes under an informative Dirichlet prior (the corpus' own word shares),
   pulled to zero by ERRORS standard errors, less a drift; the best of the word's own and its stems'. Unknown and ordinary
   words cost the drift, toxic ones gain.
3. One linear scan per document finds all maximal scoring segments: those that cannot gain by being longer or shorter. A
   passage is a segment, whether or not its words stood before.
4. Segment scores of harmless text follow an extreme-value law; its parameters give each segment its expected number of
   equals in a harmless document of the same length. Repeats are no new evidence: of each word's places only the one in its
   best segment counts, the others are nothing, and a second scan over these scores, which have a law of their own, gives the
   document's evidence, the sum over its segments, in which significant ones count in full.
5. Evidence becomes a probability by isotonic calibration. Evidence and law are taken from labelled documents with word
   scores that their own fold had no part in.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.bits import PACKED, bit_table, count_tables, id_number, in_table, packed
from tidemill.llm.calibration import Isotonic, binned
from tidemill.llm.shared import fold, in_arrow, kept, pick, text_slices
from tidemill.llm.words import NOT_LETTERS, spans

BUCKETS = 1 << 19
FOLDS = (0, 1, 3)
DRIFT = 0.5
PRIOR = 0.01
ERRORS = 1.5
LARGEST = 20.0
SIGNIFICANT = 0.01
STEMS = (4, 6)
AROUND = 10


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word and of its stems (one row per word), its begin and end, the first word of each text."""
    h, begins, ends, first = spans(texts, NOT_LETTERS, STEMS)
    return (h % np.uint64(BUCKETS)).astype(np.int64), begins, ends, first


def _words_of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in text_slices(batches, "text"):
        b, _, _, first = _buckets(batch.column("text"))
        for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
            total[np.unique(b[i:j])] += 1
    yield from packed(-1, total)


def _short(buckets: np.ndarray) -> bytes:
    """Ascending buckets in few bytes, for the shuffle to the labels."""
    return zlib.compress(np.diff(buckets, prepend=0).astype("<i4").tobytes(), 1)


def _words_of_labelled(labelled: np.ndarray):
    """The buckets of documents that perhaps have a label, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_table(labelled, batch.column("number").to_numpy(zero_copy_only=False).view(np.uint64))
            for part in text_slices([batch.filter(pa.array(hit))] if hit.any() else [], "text"):
                b, _, _, first = _buckets(part.column("text"))
                rows = [_short(np.unique(b[i:j])) for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "buckets"])

    return run


def _by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for f, y, c in zip(batch.column("fold").to_pylist(), batch.column("y").to_pylist(), batch.column("buckets")):
            own = np.cumsum(np.frombuffer(zlib.decompress(c.as_py()), "<i4"))
            total.setdefault(2 * f + y, np.zeros(BUCKETS, np.int64))[own] += 1
    for kind, counts in total.items():
        yield from packed(kind, counts)


def word_scores(toxic: np.ndarray, other: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Score of each bucket; all ``-DRIFT`` where a class has no words."""
    n1, n0, n = toxic.sum(), other.sum(), prior.sum()
    if not (n1 and n0):
        return np.full(BUCKETS, -DRIFT, np.float32)
    mass = PRIOR * (n1 + n0)
    a = np.maximum(prior, toxic + other) / max(n, n1 + n0) * mass
    a = np.maximum(a, 1e-9)
    odds = np.log((toxic + a) / (n1 + mass - toxic - a + 1e-9)) - np.log((other + a) / (n0 + mass - other - a + 1e-9))
    error = np.sqrt(1 / (toxic + a) + 1 / (other + a))
    pulled = np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * error, 0)
    return np.clip(pulled - DRIFT, -LARGEST, LARGEST).astype(np.float32)


def decay(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p exp(l s) = 1 for harmless words; 1 if there is none."""
    p = counts / max(counts.sum(), 1)
    used = p > 0
    p, s = p[used], scores[used].astype(float)
    if not len(p) or p @ s >= 0 or s.max() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while p @ np.exp(np.minimum(high * s, 700)) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(np.minimum(mid * s, 700)) < 1 else (low, mid)
    return (low + high) / 2


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) in linear time, by the method of Ruzzo and Tompa.

    Only the words with a positive score are visited; the cost of those between comes from running sums. Each segment keeps a
    link to the last one before it with a smaller sum before it; a search that follows links passes every segment once.
    """
    total = np.cumsum(scores, dtype=float)
    at = np.flatnonzero(scores > 0)
    begins, ends, lefts, rights, links = [], [], [], [], []
    for i, left, right in zip(at.tolist(), (total[at] - scores[at]).tolist(), total[at].tolist()):
        begin, j = i, len(begins) - 1
        while True:
            while j >= 0 and lefts[j] >= left:
                j = links[j]
            if j < 0 or rights[j] >= right:
                break
            begin, left = begins[j], lefts[j]
            before = links[j]
            for column in (begins, ends, lefts, rights, links):
                del column[j:]
            j = before
        for column, value in zip((begins, ends, lefts, rights, links), (begin, i + 1, left, right, j)):
            column.append(value)
    return [(b, e, r - l) for b, e, l, r in zip(begins, ends, lefts, rights)]


_SEGMENTS = "array<struct<begin:int,end:int,score:double>>"
_SCORES = pa.list_(pa.float64())
_SEGMENT_TYPE = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _once(value: np.ndarray, words: np.ndarray, found: list[tuple[int, int, float]]) -> np.ndarray:
    """Scores of one document's words where each positive word counts at one place only: in the segment of ``found`` that has
    the greatest score with each of its words once; of places in one segment, where the score of the words around is greatest."""
    at = np.flatnonzero(value > 0)
    kinds, kind = np.unique(words[at], return_inverse=True)
    if len(kinds) == len(at):
        return value
    gain = value[at].astype(float)
    segment = np.searchsorted([begin for begin, _, _ in found], at, side="right") - 1
    first = np.unique(segment * len(kinds) + kind, return_index=True)[1]
    repeats = np.bincount(segment, gain, len(found)) - np.bincount(segment[first], gain[first], len(found))
    own = np.array([score for _, _, score in found]) - repeats
    total = np.concatenate([[0.0], np.cumsum(value, dtype=float)])
    around = total[np.minimum(at + AROUND + 1, len(value))] - total[np.maximum(at - AROUND, 0)]
    order = np.lexsort((at, -around, -own[segment], kind))
    others = np.ones(len(order), bool)
    others[np.unique(kind[order], return_index=True)[1]] = False
    value = value.copy()
    value[at[order[others]]] = 0.0
    return value


def _both(value: np.ndarray, words: np.ndarray) -> tuple[list[tuple[int, int, float]], list[float]]:
    """A document's segments, and the scores of its segments when each word counts once."""
    found = segments(value)
    once = _once(value, words, found)
    return found, [s for _, _, s in (found if once is value else segments(once))]


def _scanned(scores: dict[int, np.ndarray], fit: np.ndarray):
    """Per document: words, segments with the final word scores and their scores with each word once; the same scores, and the
    best segment's, with those its own fold had no part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            texts = batch.column("text")
            b, begins, ends, first = _buckets(texts)
            starts = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
            final, once, other, best = [], [], [], []
            value = fit[b].max(axis=1, initial=-LARGEST)
            for i, f in enumerate(batch.column("fold").to_pylist()):
                lo, hi = int(first[i]), int(first[i + 1])
                at, to = begins[lo:hi] - starts[i], ends[lo:hi] - starts[i]
                found, counted = _both(value[lo:hi], b[lo:hi, 0])
                final.append([{"begin": int(at[x]), "end": int(to[y - 1]), "score": s} for x, y, s in found])
                once.append(counted)
                left, counted = _both(scores[f][b[lo:hi]].max(axis=1, initial=-LARGEST), b[lo:hi, 0]) if f in scores else ([], [])
                other.append(counted)
                best.append(max((s for _, _, s in left), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), pa.array(np.diff(first), pa.int64()), pa.array(final, _SEGMENT_TYPE),
                                              pa.array(once, _SCORES), pa.array(other, _SCORES), pa.array(best, pa.float64())],
                                             ["doc_id", "fold", "n", "segments", "once", "left_out", "left_out_best"])

    return run


def _evidence(column: str, rate: float, size: float):
    """Sum over the scores of segments of x, the log of 1 / (expected number of equals in harmless text of this length); segments that are
    not significant count with their x times (x / least significant x) to the fourth power, so that many weak ones stay weak."""
    least = -math.log(SIGNIFICANT)
    x = f"greatest(0D, {rate!r}D * s - ln({size!r}D * greatest(n, 1)))"
    return F.expr(f"aggregate({column}, 0D, (a, s) -> a + {x} * pow(least(1D, {x} / {least!r}D), 4))")


class ToxicityModel:
    """Word scores and calibration learnt from the labelled documents that are not held out, applied to every document."""

    def __init__(self, docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str):
        source = pick(docs, doc_id=doc_id, text=text)
        kind = source.schema["doc_id"].dataType.simpleString()
        taught = pick(labels, doc_id=doc_id, y=label).where("doc_id is not null and y is not null").groupBy("doc_id").agg(
            (F.avg("y") >= 0.5).cast("long").alias("y")).withColumn("fold", fold(F.col("doc_id")).cast("long")).where("fold <> 2")
        taught = kept(taught)
        labelled = bit_table(taught.select(id_number(F.col("doc_id")).alias("number")), "number", 24)
        prior = count_tables(in_arrow(source.select("text"), _words_of_all, PACKED), BUCKETS).get(-1, np.zeros(BUCKETS, np.int64))
        counted = in_arrow(source.where("doc_id is not null").select("doc_id", id_number(F.col("doc_id")).alias("number"), "text"),
                           _words_of_labelled(labelled), f"doc_id {kind}, buckets binary")
        # labels grow with the documents: a sort-merge join at every size
        rows = counted.join(taught.hint("merge"), "doc_id").select("fold", "y", "buckets")
        counts = count_tables(in_arrow(rows, _by_class, PACKED), BUCKETS)
        none = np.zeros(BUCKETS, np.int64)

        def fit(folds) -> np.ndarray:
            return word_scores(sum((counts.get(2 * f + 1, none) for f in folds), none), sum((counts.get(2 * f, none) for f in folds), none), prior)

        self.scores = fit(FOLDS)
        harmless = sum((counts.get(2 * f, none) for f in FOLDS), none)
        self.rate = decay(self.scores, harmless)
        left = {f: fit([k for k in FOLDS if k != f]) for f in FOLDS}
        folded = source.select("doc_id", fold(F.col("doc_id")).cast("long").alias("fold"), "text")
        self.scanned = kept(in_arrow(folded, _scanned(left, self.scores), f"doc_id {kind}, fold long, n long, segments {_SEGMENTS}, once array<double>, left_out array<double>, left_out_best double"))
        train = self.scanned.join(taught.select("doc_id", "y").hint("merge"), "doc_id")
        best = {"once": F.coalesce(F.array_max("left_out"), F.lit(0.0)), "all": F.col("left_out_best")}
        law = train.where("y = 0").agg(F.count("*").alias("n"), *[F.sum(F.greatest("n", F.lit(1)) * F.exp(-self.rate * b)).alias(k) for k, b in best.items()]).first()
        # the extreme-value laws' size parameters of greatest likelihood, given the decay
        self.size, self.size_of_all = (float(law["n"] / law[k]) if law["n"] and law[k] else 1.0 for k in best)
        self.curve = Isotonic(*binned(train, F.log1p(_evidence("left_out", self.rate, self.size)), F.col("y"), 0.0, 12.0))

    def documents(self) -> DataFrame:
        """doc_id, evidence, score, passages (begin and end in bytes, score, expected number of equals), significant ones only."""
        rate, size, curve = self.rate, self.size_of_all, self.curve

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.log1p(batch.column("evidence").to_numpy())
                yield batch.append_column("score", pa.array(curve(x), pa.float64()))

        passages = F.expr(f"""filter(transform(segments, s -> struct(s.begin as begin, s.end as end, s.score as score,
            {size!r}D * greatest(n, 1) * exp(-{rate!r}D * s.score) as expected)), s -> s.expected < {SIGNIFICANT!r}D)""")
        rows = self.scanned.select("doc_id", _evidence("once", rate, self.size).alias("evidence"), passages.alias("passages"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return in_arrow(rows, run, schema + ", score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "toxic", doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id modulo 4 is 2), score in [0, 1], predicted (1 if score >= ``threshold``),
    passages (the significant segments: begin and end as byte places in the text, score, expected).

    Learns from labelled rows that are not held out; a document labelled more than once counts with its majority (ties:
    toxic); NULL labels and labels without a document are left out. Only the text decides a score: repeated rows are scored
    each, NULL reads as empty, texts without letters have no passage and get the score of no evidence; texts are whole. A NULL
    id is scored, never learnt from, and not held out. Without labels every score is 0.5. Empty tables give no rows; other
    columns are not read.
    """
    found = ToxicityModel(docs, labels, label, doc_id, text).documents()
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "toxic", doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``docs`` with all columns, without rows whose text is predicted toxic. Rows that share an id go together; NULL ids
    compare as equal."""
    hit = toxicity_scores(docs, labels, threshold, label, doc_id, text).where("predicted = 1").select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs[f"`{doc_id}`"].eqNullSafe(hit["_hit"]), "left_anti")
