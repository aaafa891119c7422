"""Fitted operators by held-out accuracy and brute force, the pipeline stage by stage, and the registry."""

import os
import random
import time
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemill.llm import jaccard, mixing, quality, queries, toxicity, words
from tidemill.llm.calibration import Isotonic
from tidemill.llm.shared import table

SMALL = "/root/testdata/sf0.001"
PLAIN = "the of and in house garden river water stone tree light morning evening people walk slowly under open sky".split()
BAD = "scum moron idiot".split()


def corpus(n=600):
    """(id, text, quality, toxic): junk shouts or repeats itself, toxic texts hold passages of bad words."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        w = [rng.choice(PLAIN) + str(rng.randint(0, 5)) for _ in range(rng.randint(20, 200))]
        toxic, junk = rng.random() < 0.2, rng.random() < 0.3
        if junk:
            w = [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [w[0]] * len(w)
        if toxic:
            at = rng.randrange(len(w))
            w[at:at] = [rng.choice(BAD) + rng.choice(["", "s", "ish"]) for _ in range(rng.randint(2, 6))]
        rows.append((i, " ".join(w), int(not junk), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus()
    odd = [(None, "scum moron idiot scum", 1, 1), (700, None, 1, 0), (701, "", 1, 0), (5, rows[5][1], 1, 0), (702, "stone " * 60_000 + "moron idiot scum", 1, 1)]
    docs = spark.createDataFrame([(i, t, 0.5, 1, "x", 3) for i, t, _, _ in rows + odd], "doc_id long, text string, score double, fold int, x string, y int").repartition(3)
    marks = [(i, q, t, "own") for i, _, q, t in rows] + [(None, 1, 1, "n"), (9, None, None, "n"), (99_999, 1, 0, "no document"), (8, rows[8][2], rows[8][3], "again")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")
    return rows, odd, docs, labels


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("label, score, threshold", [("quality", quality.quality_scores, 0.7), ("toxic", toxicity.toxicity_scores, 0.3)])
def test_held_out_accuracy_and_odd_rows(labelled, label, score, threshold):
    rows, odd, docs, labels = labelled
    got = score(docs, labels).toPandas()
    assert len(got) == len(rows) + len(odd) and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= threshold)).all()
    ids = [None if np.isnan(x) else int(x) for x in got["doc_id"]]
    assert got["held_out"].tolist() == [held_out(i) for i in ids]
    truth = {i: {"quality": q, "toxic": t}[label] for i, _, q, t in rows}
    judged = [(truth[i], p) for i, p, h in zip(ids, got["predicted"], got["held_out"]) if h and i in truth]
    assert len(judged) > 100 and sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert got[got["doc_id"] == 5]["score"].nunique() == 1
    if label == "toxic":
        assert got[got["doc_id"].isna()]["predicted"].tolist() == [1] and got[got["doc_id"] == 702]["predicted"].tolist() == [1]
        assert got[got["doc_id"].isin([700, 701])]["predicted"].eq(0).all()


def test_without_labels_or_documents(labelled):
    _, _, docs, labels = labelled
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        assert score(docs.limit(0), labels).count() == 0
        assert {r.score for r in score(docs.limit(5), labels.limit(0)).select("score").distinct().collect()} <= {0.4995, 0.5, 0.5005}


def test_passages_are_the_bad_words(labelled):
    rows, _, docs, labels = labelled
    text = {i: t.encode() for i, t, _, _ in rows}
    found = toxicity.toxicity_scores(docs, labels).where("size(passages) > 0 and doc_id < 600 and doc_id <> 5").collect()
    hit = sum(any(b.encode() in text[r.doc_id][p.begin : p.end] for b in BAD) for r in found for p in r.passages)
    assert hit > 80 and hit >= 0.95 * sum(len(r.passages) for r in found)


def brute_segments(s):
    """Maximal scoring segments by their definition: take the best (the shortest of equals), then both sides."""
    def split(a, b):
        best = max(((sum(s[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return [*split(a, i), (i, j, best[0]), *split(j, b)]

    return split(0, len(s))


def test_segments_are_the_maximal_ones():
    rng = random.Random(7)
    for _ in range(300):
        s = np.array([rng.choice([-1.0, -0.5, 1.0, 2.25, -3.0, 0.75]) + rng.random() / 1000 for _ in range(rng.randint(0, 18))])
        got = toxicity.segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(s.tolist())]
        assert np.allclose([x for *_, x in got], [s[a:b].sum() for a, b, _ in got])


def test_long_nested_segments_are_the_maximal_ones():
    rng = random.Random(11)
    for n in (60, 150, 250):
        for rise in (0.5, 1.0, 2.0):
            s = np.array([rng.choice([rise, -1.0, -0.25]) + rng.random() / 1000 for _ in range(n)])
            assert [(a, b) for a, b, _ in toxicity.segments(s)] == [(a, b) for a, b, _ in brute_segments_fast(s)]


def brute_segments_fast(s):
    """As ``brute_segments``, with running sums."""
    total = np.concatenate([[0.0], np.cumsum(s)])

    def split(a, b):
        sums = np.triu(total[a : b + 1][None, :] - total[a : b + 1][:, None], 1)
        if b <= a or sums.max() <= 0:
            return []
        i, j = min(np.argwhere(sums == sums.max()).tolist(), key=lambda p: (p[1] - p[0], p[0]))
        return [*split(a, a + i), (a + i, a + j, 0.0), *split(a + j, b)]

    return split(0, len(s))


def test_scan_is_linear():
    """A million words in the shapes that need most steps: single positives between long falls, rising steps, falling steps."""
    n = 1_000_000
    noise = np.random.default_rng(3).normal(-0.2, 1, n)
    for s in (np.tile([1.0, -2.0], n // 2), np.tile([2.0, -1.0], n // 2), np.tile([1.0, -1.0], n // 2), noise):
        start = time.perf_counter()
        found = toxicity.segments(s)
        assert time.perf_counter() - start < 6 and found
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_decay_solves_its_equation():
    s, p = np.array([-0.5, 3.0, -2.0]), np.array([90, 1, 9])
    rate = toxicity.decay(s, p)
    assert rate > 0 and abs((p / 100) @ np.exp(rate * s) - 1) < 1e-6
    assert toxicity.decay(np.array([1.0]), np.array([5])) == 1.0


def test_normal_equations_sum_to_one_fit():
    rng = np.random.default_rng(0)
    z = np.column_stack([rng.normal(size=(90, 5)), np.ones(90)])
    y = z @ np.array([1.0, -2, 0, 3, 0.5, 4]) + 0.01 * rng.normal(size=90)
    both = np.column_stack([z, y])
    sums = {k: both[k::3].T @ both[k::3] for k in range(3)}
    assert np.allclose(quality._fitted(sums, 1e-9), np.linalg.lstsq(z, y, rcond=None)[0], atol=1e-5)
    direct = 0.0
    for k in range(3):
        rest = np.concatenate([both[i::3] for i in range(3) if i != k])
        w = np.linalg.lstsq(rest[:, :-1], rest[:, -1], rcond=None)[0]
        direct += ((both[k::3, :-1] @ w - both[k::3, -1]) ** 2).sum()
    assert abs(quality._left_out_error(sums, 1e-9) - direct) < 1e-5


def test_isotonic_curve_rises_and_keeps_means():
    rng = np.random.default_rng(1)
    x = np.sort(rng.uniform(0, 1, 200))
    n = rng.integers(1, 9, 200).astype(float)
    y = rng.binomial(n.astype(int), x).astype(float)
    curve = Isotonic(x, y, n)
    assert (np.diff(curve.y) > 0).all() and (np.diff(curve(np.linspace(-1, 2, 500))) >= 0).all()


def test_pipeline_stages_against_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]

    def step(name, before):
        out = stages[name](spark, before, SMALL).cache()
        return out, {r.doc_id for r in out.select("doc_id").collect()}

    clean, kept = step("toxicity", docs)
    rejected = {r.doc_id for r in toxicity.toxicity_scores(docs, table(spark, SMALL, "labels")).where("predicted = 1").collect()}
    assert clean.columns == columns and kept == set(text) - rejected

    single, now = step("near_duplicates", clean)
    sets = {i: words.shingle_texts(text[i]) for i in kept}
    group = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if v == old else v for k, v in group.items()}
    assert single.columns == columns and now == {i for i in kept if group[i] == i} and now < kept

    free, rest = step("decontamination", single)
    items = [words.shingle_texts(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    leaks = {i for i in now if any(4 * len(x & sets[i]) >= 3 * len(x) for x in items)}
    assert free.columns == columns and rest == now - leaks and leaks

    sample, drawn = step("mixing", free)
    expected = {r.doc_id for r in mixing.mixed(free, queries.TARGETS).where("sampled").collect()}
    assert sample.columns == columns and drawn == expected and drawn <= rest

    from tokenizers import Tokenizer

    library, start, rows = Tokenizer.from_file(queries.vocabulary_path()), 0, []
    for i in sorted(drawn):
        ids = library.encode(text[i], add_special_tokens=False).ids + [2]
        rows.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, stages["token_output"](spark, sample, SMALL).collect())) == rows


def test_registry():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    from check import compare, duck

    problem, n, _ = compare(spark, duck(SMALL), name, queries.QUERIES[name], queries.ORACLES[name], SMALL)
    assert problem is None and n, problem


def test_nothing_outside_imports_the_subpackage():
    top = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(top):
        if not any(x in folder for x in ("/llm", "/.git")):
            for f in files:
                if f.endswith(".py") and f not in ("__spark_entry__.py", "corpus_pipeline.py"):
                    assert "tidemill.llm" not in open(os.path.join(folder, f)).read(), f
