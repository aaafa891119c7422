"""Row order within a key, a hot and a NULL one among them, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import ordered


def sample(spark, seed=1, n=600, parts=5):
    rng = random.Random(seed)
    # key 0 holds more than a third of all rows, one key is NULL
    keys = [0 if rng.random() < 0.4 else rng.choice([1, 2, 3, None]) for _ in range(n)]
    data = [(k, i, rng.randrange(1000)) for i, k in enumerate(keys)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k int, at int, v int").repartition(parts)


def grouped(data):
    groups = {}
    for k, at, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((at, v))
    return groups


@pytest.mark.parametrize("parts", [1, 5])
def test_row_numbers(spark, as_rows, parts):
    data, df = sample(spark, 1, parts=parts)
    want = sorted(((k, at, n + 1) for k, g in grouped(data).items() for n, (at, _) in enumerate(g)), key=repr)
    assert as_rows(ordered.row_numbers(df, ["k"], ["at"], "rn"), "k", "at", "rn") == want


@pytest.mark.parametrize("parts", [1, 5])
def test_row_numbers_of_everything(spark, as_rows, parts):
    data, df = sample(spark, 2, parts=parts)
    want = sorted(((at, n + 1) for n, (at, _) in enumerate(sorted(((a, v) for _, a, v in data), key=lambda r: (-r[1], r[0])))), key=repr)
    assert as_rows(ordered.row_numbers(df, [], [F.col("v").desc(), "at"], "rn"), "at", "rn") == want


@pytest.mark.parametrize("parts", [1, 5])
def test_next_values(spark, as_rows, parts):
    data, df = sample(spark, 3, parts=parts)
    want = []
    for k, g in grouped(data).items():
        for n, (at, _) in enumerate(g):
            want.append((k, at, g[n + 1][1] if n + 1 < len(g) else None, n + 1))
    got = ordered.next_values(df, ["k"], ["at"], {"nxt": "v"}, number="rn")
    assert as_rows(got, "k", "at", "nxt", "rn") == sorted(want, key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_new_maxima(spark, as_rows, parts):
    data, df = sample(spark, 4, parts=parts)
    want = []
    for k, g in grouped(data).items():
        top = None
        for at, v in g:
            if top is None or v > top:
                want.append((k, at, v))
                top = v
    assert as_rows(ordered.new_maxima(df, ["k"], ["at"], "v"), "k", "at", "v") == sorted(want, key=repr)
