"""Cases in which a bound of an operator is reached: targets that conflict, probes that do not suffice, repeated words."""

import random
import warnings

import numpy as np
import pytest

from tidemill.llm import jaccard, mixing, nearest, toxicity


def shares(drawn, axis):
    return drawn.sum(axis=tuple(a for a in range(drawn.ndim) if a != axis)) / drawn.sum()


def test_raking_of_a_source_with_one_language():
    rng = np.random.default_rng(0)
    mass = rng.uniform(1000, 2000, (2, 5, 8))
    mass[0] = 0
    mass[0, 0] = mass[1].sum() * 53 / 47 / 8  # the hot source is German only, but wanted 0.25 of German's 0.15
    margins = [np.array([0.25, 0.75]), np.array([0.15, 0.55, 0.14, 0.15, 0.01]), np.full(8, 1 / 8)]
    drawn = mixing.raked(mass, margins)
    assert (drawn <= mass + 1e-9).all() and drawn.sum() > 0.1 * mass.sum()
    p, q = shares(drawn, 0)[0], shares(drawn, 1)[0]
    # of the shares that can be met, p <= q, the least p log(p/.25) + (1-p) log((1-p)/.75) + q log(q/.15) + (1-q) log((1-q)/.85) has p = q
    best = min((x * np.log(x * x / 0.25 / 0.15) + (1 - x) * np.log((1 - x) ** 2 / 0.75 / 0.85), x) for x in np.arange(0.15, 0.25, 1e-4))[1]
    assert abs(p - best) < 1e-3 and abs(q - best) < 1e-3
    assert np.allclose(shares(drawn, 1)[1:] / (1 - q), margins[1][1:] / 0.85, atol=1e-3) and np.allclose(shares(drawn, 2), 1 / 8, atol=1e-6)


def test_raking_to_margins_that_only_a_small_sample_meets():
    mass = np.array([[1000.0, 0.1], [10.0, 1000.0]])
    margins = [np.array([0.25, 0.75]), np.array([0.1, 0.9])]
    drawn = mixing.raked(mass, margins)
    assert (drawn <= mass + 1e-9).all() and all(np.allclose(shares(drawn, a), m, atol=1e-6) for a, m in enumerate(margins))


def test_mixing_tells_targets_that_conflict(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("alpha bravos charlie deltas echoes foxtrot golfing hotels".split()) for _ in range(rng.randint(5, 30))),
             "s0" if i % 2 else "s1", "de" if i % 2 else rng.choice(["en", "en", "de"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = mixing.Targets(source={"s0": 0.25, mixing.OTHER: 0.75}, lang={"en": 0.85, "de": 0.15})
    with pytest.warns(UserWarning, match="cell_source s0: 0.19.* instead of 0.2500"):
        got = mixing.mixed(docs, targets).toPandas()
    mass = got["n_words"] * got["probability"]
    assert 0.15 < mass[got["cell_source"] == "s0"].sum() / mass.sum() < 0.25 and mass.sum() > 0.1 * got["n_words"].sum()
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        mixing.mixed(docs, mixing.Targets(source={"s0": 0.5, mixing.OTHER: 0.5}, lang={"en": 0.3, "de": 0.7}))


def test_nearest_where_the_most_probes_do_not_suffice(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BUCKET", 0.05)  # as many projections as 6 million rows get
    v = np.random.default_rng(4).normal(size=(3000, 64))
    u = nearest.unit(v)
    near = u[::50] @ u.T
    near[np.arange(60), np.arange(0, 3000, 50)] = -2
    true = np.argsort(-near, axis=1)[:, :5]
    found = {}
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    for r in nearest.nearest(df).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(found[50 * q] & set(t.tolist())) for q, t in enumerate(true)) >= 0.9 * true.size
    hashing = nearest.fitted(64, 3000, v, 5)
    assert 0 < hashing.m < 7 and hashing.probes < nearest.MOST_PROBES
    monkeypatch.setattr(nearest, "MOST_PROBES", 1)  # no projection does
    assert nearest.fitted(64, 3000, v, 5).m == 0


def test_toxic_passages_of_words_that_stood_before(spark):
    rng = random.Random(5)
    plain = [a + str(i) for a in "garden river water stone tree light morning evening people".split() for i in range(6)]
    bad = "scum moron idiot vermin filth".split()
    rows, marks = [], []
    for i in range(400):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        if i % 4 == 0:
            at = rng.randrange(len(w))
            w[at:at] = rng.sample(bad, 4)
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    passage = " ".join(bad)
    gap = " ".join(rng.choice(plain) for _ in range(300))
    scattered = " ".join(x + " " + " ".join(rng.choice(plain) for _ in range(4000)) for x in bad)
    rows += [(1000, f"{gap} {passage} {gap} {passage} {gap}"), (1001, f"{scattered} {passage} {gap}"), (1002, scattered), (1003, f"{gap} {passage} {gap}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.toxicity_scores(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).where("doc_id >= 1000").collect()}
    taken = {i: [dict(rows)[i].encode()[p.begin : p.end].decode() for p in r.passages] for i, r in found.items()}
    assert taken[1000] == [passage, passage] and taken[1003] == [passage] and passage in taken[1001]
    assert found[1000].predicted == found[1001].predicted == found[1003].predicted == 1
    assert found[1000].score == pytest.approx(found[1003].score, abs=0.05)  # repeats are no new evidence


def test_a_word_counts_in_its_best_segment():
    value = np.array([3.0, -9, 2, -9, 3, 2, 1, -9, 1, -0.5, 1])
    words = np.array([7, 0, 8, 0, 7, 8, 9, 0, 9, 0, 9])
    found = toxicity.segments(value)
    assert toxicity._once(value, words, found).tolist() == [0, -9, 0, -9, 3, 2, 1, -9, 0, -0.5, 0]
    assert toxicity._both(value, words)[1] == [6.0]


def test_links_far_below_75_percent(spark):
    rows, n = [], iter(range(10**9))
    for i in range(100):
        both = [f"w{next(n)}" for _ in range(600)]
        rows += [(2 * i + k, " ".join(both + [f"w{next(n)}" for _ in range(690)])) for k in (0, 1)]  # 596 shared of 1976
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=30).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, i - i % 2) for i in range(200)]


def test_windows_and_sketches_follow_the_percent():
    assert jaccard.sketch_difference(75) == jaccard.sketch_difference(100) == jaccard.SKETCH_DIFFERENCE
    assert len(jaccard.Sets(75).window(np.arange(1, 5001, dtype=np.uint64))[0]) == jaccard.WINDOW
    rng, sets = np.random.default_rng(6), jaccard.Sets(10)
    for _ in range(300):
        both, a, b = np.split(rng.integers(1, 2**63, 5500).astype(np.uint64), [550, 3025])  # 550 shared of 5500
        x, y = (sets.window(np.sort(np.concatenate([both, own])))[0] for own in (a, b))
        assert len(np.intersect1d(x, y))
