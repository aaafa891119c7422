"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; values that a target does not name are one cell value, OTHER, so
the number of cells is bounded by the targets, whatever the data. The cells' token weights are raked to the targets'
marginals, no cell beyond the tokens it has, and at the largest size of the sample that this allows. A cell's raked weight
over its own is the probability with which each of its documents is drawn, so the expected token shares of the sample equal
the targets.

Targets conflict where cells are empty: a source of German texts only cannot give more of the sample than German may. No
sample of any size meets such targets. They are told from targets that only need a smaller sample by raking without the
cells' bounds; the nearest shares that can be met then take their place, and a warning names wanted and drawn shares.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import in_arrow, kept, pick, text_slices
from tidemill.llm.words import NOT_LETTERS, spans

OTHER = "(other)"
TOPICS = 8
TOPIC_BYTES = 5
TOLD = 1e-4
SMALL = 0.01


@dataclass(frozen=True)
class Targets:
    """Token shares wanted. A mapping names values and shares; OTHER takes the values not named. A number a instead of a
    mapping for topics tempers the shares found: share ** a, scaled to 1."""

    source: Mapping[str, float]
    lang: Mapping[str, float]
    topic: Mapping[str, float] | float = 0.7


def _topics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each whole text, and its topic: the lexical group that most of its longer words fall into; the first of equals,
    and for texts without such words."""
    for batch in text_slices(batches, "text"):
        h, begins, ends, first = spans(batch.column("text"), NOT_LETTERS)
        n = batch.num_rows
        long = ends - begins >= TOPIC_BYTES
        owner = np.repeat(np.arange(n), np.diff(first))
        votes = np.bincount(owner[long] * TOPICS + (h[long] % np.uint64(TOPICS)).astype(np.int64), minlength=n * TOPICS).reshape(n, TOPICS)
        names = votes.argmax(1).astype(str)
        out = batch.drop_columns(["text"])
        yield out.append_column("n_words", pa.array(np.diff(first), pa.int64())).append_column("topic", pa.array(names.tolist(), pa.string()))


def _along(shape: tuple[int, ...]) -> list[tuple[int, ...]]:
    """For each axis the others, to sum over."""
    return [tuple(a for a in range(len(shape)) if a != axis) for axis in range(len(shape))]


def _factor(wanted: np.ndarray, now: np.ndarray) -> np.ndarray:
    return np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)


def reached(mass: np.ndarray, margins: list[np.ndarray], rounds: int = 5000, precision: float = 1e-9) -> tuple[np.ndarray, bool]:
    """Shares of the cells, in proportion to ``mass`` but for one factor per value of each axis, whose marginals are ``margins``
    (each sums to 1, nothing for values without mass), and True. If cells without mass make the margins conflict, no shares
    meet them: then the shares with the nearest marginals, those of the least summed Kullback-Leibler divergence from
    ``margins``, and False. How much there is of each cell plays no part."""
    sums = _along(mass.shape)
    cells = mass / mass.sum()
    for _ in range(rounds):
        for others, margin in zip(sums, margins):
            cells = cells * np.expand_dims(_factor(margin, cells.sum(axis=others)), others)
        if max(np.abs(cells.sum(axis=others) - margin).max() for others, margin in zip(sums, margins)) <= precision:
            return cells / cells.sum(), True
    cells = mass / mass.sum()
    for _ in range(4 * rounds):  # all axes at once, the geometric mean of their factors (SMART): converges where they conflict too
        factors = [np.expand_dims(_factor(margin, cells.sum(axis=others)), others) for others, margin in zip(sums, margins)]
        step = np.ones_like(cells)
        for factor in factors:
            step = step * factor
        cells = cells * step ** (1 / len(factors))
    if cells.sum() <= 0:  # the values wanted have no cell in common
        return mass / mass.sum(), False
    return cells / cells.sum(), False


def wanted(mass: np.ndarray, margins: list[np.ndarray]) -> list[np.ndarray]:
    """``margins`` scaled to 1, where a value without mass gives up its share to the others of its axis."""
    out = []
    for others, margin in zip(_along(mass.shape), margins):
        have = mass.sum(axis=others)
        margin = np.where(have > 0, margin, 0.0)
        out.append(margin / margin.sum() if margin.sum() > 0 else have / have.sum())
    return out


def raked(mass: np.ndarray, margins: list[np.ndarray], rounds: int = 500, precision: float = 1e-9) -> np.ndarray:
    """The part of ``mass`` to draw: scaled along each axis in turn, never beyond what is there, until its marginal shares are
    ``margins``; of the sizes at which that is reached about the largest. A value without mass gives up its share to the
    others of its axis. Margins that no sample of any size can meet, since cells are empty, are first replaced by the nearest
    that can be met (see ``reached``); margins that can be met are met, however small the sample."""
    if mass.sum() <= 0:
        return mass.astype(float)
    margins = wanted(mass, margins)
    sums = _along(mass.shape)
    shares, met = reached(mass, margins)
    if not met:
        margins = [shares.sum(axis=others) for others in sums]
    low = 1 / float(np.divide(shares, mass, out=np.zeros_like(shares), where=mass > 0).max())  # at this size the shares themselves fit
    best = np.minimum(mass, shares * low)

    def bounded(size: float) -> np.ndarray | None:
        drawn = np.minimum(mass, shares * size)
        for _ in range(rounds):
            for others, margin in zip(sums, margins):
                drawn = np.minimum(mass, drawn * np.expand_dims(_factor(size * margin, drawn.sum(axis=others)), others))
            if max(np.abs(drawn.sum(axis=others) - size * margin).max() for others, margin in zip(sums, margins)) <= precision * size:
                return drawn
        return None

    high = min(float((mass.sum(axis=others)[margin > 0] / margin[margin > 0]).min()) for others, margin in zip(sums, margins))
    size = high
    while size > low * 1.01:
        drawn = bounded(size)
        if drawn is None:
            high = size
        else:
            low, best = size, drawn
            if size == high:
                break
        size = math.sqrt(low * high)
    return best


def _category(column: Column, named: Mapping[str, float]) -> Column:
    return F.when(column.isin([k for k in named if k != OTHER]), column).otherwise(F.lit(OTHER))


def _chance(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone, the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(doc_id.cast("string"), F.lit(seed)), 11) / F.lit(float(2**53))


def _tell(mass: np.ndarray, drawn: np.ndarray, margins: list[np.ndarray], keys: list[str], values: list[list[str]]) -> None:
    """A warning with the shares of all values that miss their target, and with the size of a sample that is hardly one."""
    if drawn.sum() <= 0:
        return
    missed = [f"{key} {v}: {b:.4f} instead of {a:.4f}" for others, key, named, margin in zip(_along(mass.shape), keys, values, wanted(mass, margins))
              for v, a, b in zip(named, margin, drawn.sum(axis=others) / drawn.sum()) if abs(a - b) > TOLD]
    if missed:
        warnings.warn(f"no sample can meet the targets, cells of them are empty; the nearest shares are drawn: {'; '.join(missed)}", stacklevel=3)
    if drawn.sum() < SMALL * mass.sum():
        warnings.warn(f"the targets allow a sample of only {drawn.sum() / mass.sum():.2%} of the tokens", stacklevel=3)


def mixed(docs: DataFrame, targets: Targets, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          lang: str = "lang") -> DataFrame:
    """Per row: doc_id, n_words (its token weight), cell_source, cell_lang, cell_topic, weight (tokens wanted per token found),
    probability, sampled.

    NULL and unnamed sources and languages are OTHER. Texts without words weigh nothing; in a cell of nothing else the
    probability is 1. A value without documents gives up its share to the others. Targets that conflict, since cells have no
    tokens, are replaced by the nearest shares that can be met; a warning tells them, and samples under SMALL of the tokens. Rows that share an id are drawn together,
    all rows with NULL as their id too. Repeated rows weigh each. Whole texts of any length; an empty table gives no rows;
    other columns are not read.
    """
    own = pick(docs, doc_id=doc_id, source=source, lang=lang, text=text)
    cells_of = own.select("doc_id", _category(F.col("source"), targets.source).alias("cell_source"), _category(F.col("lang"), targets.lang).alias("cell_lang"), "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    counted = kept(in_arrow(cells_of, _topics, f"doc_id {kind}, cell_source string, cell_lang string, n_words long, topic string"))
    counted = counted.withColumnRenamed("topic", "cell_topic")
    keys = ["cell_source", "cell_lang", "cell_topic"]
    cells = counted.groupBy(*keys).agg(F.sum("n_words").alias("mass")).orderBy(*keys).collect()  # at most the cells of the targets
    if not cells:
        return counted.withColumns({"weight": F.lit(1.0), "probability": F.lit(1.0), "sampled": F.lit(True)})
    values = [sorted({c[k] for c in cells}) for k in keys]
    mass = np.zeros([len(v) for v in values])
    for c in cells:
        mass[tuple(v.index(c[k]) for v, k in zip(values, keys))] = c["mass"]
    margins = []
    for axis, (named, wanted) in enumerate(zip(values, (targets.source, targets.lang, targets.topic))):
        if isinstance(wanted, Mapping):
            margins.append(np.array([wanted.get(v, 0.0) for v in named]))
        else:
            found = mass.sum(axis=tuple(a for a in range(3) if a != axis))
            margins.append(np.where(found > 0, found / max(found.sum(), 1), 0) ** wanted)
    drawn = raked(mass, margins)
    _tell(mass, drawn, margins, keys, values)
    chance = np.divide(drawn, mass, out=np.ones_like(mass), where=mass > 0)
    level = drawn.sum() / mass.sum() if drawn.sum() > 0 else 1.0
    rows = [(*[v[i] for v, i in zip(values, at)], float(chance[at] / level), float(chance[at])) for at in np.ndindex(*mass.shape)]
    table = docs.sparkSession.createDataFrame(rows, "cell_source string, cell_lang string, cell_topic string, weight double, probability double")
    drawn = F.when(F.col("doc_id").isNull(), F.lit(0.5)).otherwise(_chance(F.col("doc_id"), seed))
    return counted.join(F.broadcast(table), keys).select("doc_id", "n_words", *keys, "weight", "probability", (drawn < F.col("probability")).alias("sampled"))


def sampled(docs: DataFrame, targets: Targets, seed: int = 17, doc_id: str = "doc_id", **columns: str) -> DataFrame:
    """``docs`` with all columns, the drawn documents only."""
    drawn = mixed(docs, targets, seed, doc_id, **columns).where("sampled").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, docs[f"`{doc_id}`"].eqNullSafe(drawn["_drawn"]), "left_semi")
