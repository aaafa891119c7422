"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Each document becomes a short vector of statistics of its whole text. Random cosines of the standardised vector stand for
a Gaussian kernel. Every partition adds up its share of the normal equations, per fold; their sums, of a fixed size, are
solved on the driver. The ridge weight and the calibration come from predictions for folds left out of the fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.bits import added_in_turns
from tidemill.llm.calibration import Isotonic, binned
from tidemill.llm.shared import fold, in_arrow, kept, pick, text_slices, utf8
from tidemill.llm.words import runs, words

FEATURES = 128
RIDGES = (0.01, 0.1, 1.0, 10.0, 100.0)
FOLDS = (0, 1, 3)

_GROUPS = {  # statistics that are counts of bytes, by word
    "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "sign": b"#$%&*+=@^~", "bracket": b"()[]{}<>", "quote": b"\"'`", "dash": b"-_/\\",
    "line": b"\n", "blank": b" \t", "digit": b"0123456789",
}
STATISTICS = ["bytes", "words", "word_length", "upper", "letters", "beyond_ascii", "entropy", *_GROUPS, "distinct", "spread", "top", "top_5",
              "repeated_runs", "adjacent"]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each whole text; all finite, for empty texts too."""
    raw, offsets = utf8(texts)
    n = len(texts)
    size = np.diff(offsets).astype(float)
    bytes_ = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * 256 + raw, minlength=n * 256).reshape(n, 256).astype(float)
    h, first = words(texts)
    count = np.diff(first).astype(float)
    length, many = np.maximum(size, 1), np.maximum(count, 1)
    upper, lower, beyond = bytes_[:, 65:91].sum(1), bytes_[:, 97:123].sum(1), bytes_[:, 128:].sum(1)
    share = bytes_ / length[:, None]
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(1)
    solid = size - bytes_[:, [32, *range(9, 14)]].sum(1)
    cols = [np.log1p(size), np.log1p(count), np.log1p(solid / many), upper / np.maximum(upper + lower, 1), (upper + lower) / length, beyond / length, entropy]
    cols += [np.log1p(bytes_[:, list(group)].sum(1) / many) for group in _GROUPS.values()]
    rest = np.zeros((n, 6))
    every, at = runs(texts)
    for i in np.flatnonzero(count > 0).tolist():
        own = h[first[i] : first[i + 1]]
        times = np.sort(np.unique(own, return_counts=True)[1])
        lines = every[at[i] : at[i + 1]]
        w = len(own)
        rest[i] = (len(times) / w, len(times) / w**0.8, times[-1] / w, times[-5:].sum() / w, 1 - len(np.unique(lines)) / len(lines),
                   (own[1:] == own[:-1]).sum() / w)
    return np.column_stack([*cols, rest])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(statistics(batch.column(1))), pa.list_(pa.float64()))], ["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


class Fourier:
    """Random cosines, the standardised statistics themselves, and 1."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        d = len(mean)
        self.directions = rng.normal(size=(d, FEATURES)) / np.sqrt(2 * d)
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases), z / np.sqrt(z.shape[1]), np.ones(len(z))])


def _sums(fourier: Fourier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            f, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            z = fourier(_matrix(batch.column("x")))
            both = np.column_stack([z, y])
            for k in np.unique(f).tolist():
                own = f == k
                total[k] = total.get(k, 0) + both[own].T @ both[own]
        for k, matrix in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(matrix), pa.int64()), pa.array(range(len(matrix)), pa.int64()),
                                              pa.array(list(matrix), pa.list_(pa.float64()))], ["fold", "row", "v"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    v = np.array(rows.column("v").to_pylist()).sum(0)
    return pa.table({"fold": rows.column("fold")[:1], "row": rows.column("row")[:1], "v": pa.array([v], pa.list_(pa.float64()))})


def _fitted(by_fold: dict[int, np.ndarray], ridge: float) -> np.ndarray:
    total = sum(by_fold.values())
    d = total.shape[0] - 1
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-9  # the constant is free
    return np.linalg.solve(total[:d, :d] + np.diag(penalty), total[:d, d])


def _left_out_error(by_fold: dict[int, np.ndarray], ridge: float) -> float:
    """Squared error on each fold of the fit to the others, from the sums alone."""
    error = 0.0
    for k, own in by_fold.items():
        d = own.shape[0] - 1
        w = _fitted({i: m for i, m in by_fold.items() if i != k}, ridge)
        error += own[d, d] - 2 * w @ own[:d, d] + w @ own[:d, :d] @ w
    return error


def _predicted(fourier: Fourier, models: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, f = fourier(_matrix(batch.column("x"))), batch.column("fold").to_numpy()
            raw = np.select([f == k for k in models], [z @ w for w in models.values()], 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("y")], ["raw", "y"])

    return run


def _scored(fourier: Fourier, weights: np.ndarray | None, curve: Isotonic):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            raw = fourier(x) @ weights if weights is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(curve(raw))], ["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label: str = "quality", doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id modulo 4 is 2), score in [0, 1], predicted (1 if score >= ``threshold``).

    Learns from labelled rows that are not held out; a document labelled more than once counts with the mean of its labels;
    NULL labels and labels without a document are left out. Only the text decides a score: equal texts get equal scores,
    repeated rows are scored each, NULL reads as empty, empty texts are scored by their (zero) statistics, texts are whole.
    A NULL id is scored, never learnt from, and not held out. Without any label to learn from every score is 0.5. Empty
    tables give no rows; other columns are not read.
    """
    source = pick(docs, doc_id=doc_id, text=text)
    kind = source.schema["doc_id"].dataType.simpleString()
    measured = kept(in_arrow(source, _measured, f"doc_id {kind}, x array<double>"))
    moments = measured.agg(*[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(len(STATISTICS))]).first()
    moments = np.array([v if v is not None else 0.0 for v in moments])
    fourier = Fourier(*moments.reshape(2, -1))
    taught = pick(labels, doc_id=doc_id, y=label).where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.avg("y").alias("y"))
    train = kept(measured.join(taught, "doc_id").withColumn("fold", fold(F.col("doc_id")).cast("long")).where("fold <> 2").select("fold", "x", "y"))
    rows = "fold long, row long, v array<double>"
    sums = added_in_turns(in_arrow(train, _sums(fourier), rows), ["fold", "row"], _added, rows)
    by_fold: dict[int, list] = {}
    for r in sums.orderBy("fold", "row").collect():  # folds x features rows, whatever the data's size
        by_fold.setdefault(r["fold"], []).append(r["v"])
    equations = {k: np.array(v) for k, v in by_fold.items()}
    if not equations:
        weights, curve = None, Isotonic(np.zeros(0), np.zeros(0), np.zeros(0))
    elif len(equations) < 2:  # nothing to leave out: every fit is to the one fold
        weights = _fitted(equations, 10.0)
        curve = Isotonic(*binned(in_arrow(train, _predicted(fourier, {k: weights for k in equations}), "raw double, y double"), F.col("raw"), F.col("y"), -1, 2))
    else:
        ridge = min(RIDGES, key=lambda r: _left_out_error(equations, r))
        weights = _fitted(equations, ridge)
        models = {k: _fitted({i: m for i, m in equations.items() if i != k}, ridge) for k in equations}
        curve = Isotonic(*binned(in_arrow(train, _predicted(fourier, models), "raw double, y double"), F.col("raw"), F.col("y"), -1, 2))
    scored = in_arrow(measured, _scored(fourier, weights, curve), f"doc_id {kind}, score double")
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
