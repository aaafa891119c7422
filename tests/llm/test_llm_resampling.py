"""Importance resampling against a brute-force version: buckets, gains, exact ranks, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest=1):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, min_words, buckets, longest=1, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest)[1])
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets)))) for k in s}
    rows = []
    for i, text in docs:
        words, found = features(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = able[: percent * len(able) // 100]
    rest = able[len(drawn) :] + [r for r in rows if r[1] < min_words]
    return sorted([(*r[:1], *r[2:], n) for n, r in enumerate(drawn, 1)] + [(*r[:1], *r[2:], None) for r in rest], key=repr)


def documents(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(parts)


def prose(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(90)}" for _ in range(n))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_rows_equal_brute_force(spark, longest):
    rng = random.Random(longest)
    rows = [(i, prose(rng, rng.randrange(0, 60))) for i in range(400)]
    rows += [(None, prose(rng, 30)), (None, prose(rng, 40)), (900, ""), (901, None), (902, "É-É x2Y_z \x00a"), (903, prose(rng, 40_000)), (7, prose(rng, 30))]
    rows += [(77, "one text that is here very often " * 4)] * 150
    target = [prose(rng, 50) for _ in range(8)] + [None, ""]
    got = resampling.resampled(documents(spark, rows), spark.createDataFrame([(t, 0) for t in target], "text string, bucket int"), 30, 20, 1_000, longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, target, 30, 20, 1_000, longest)


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = prose(rng, 700) + " ümlaut" + "z" * 300 + " " + prose(rng, 50)
    whole = [list(b) for _, b in resampling.feature_buckets(text, 997, 3)]
    monkeypatch.setattr(resampling, "BLOCK", 64)
    parts = list(resampling.feature_buckets(text, 997, 3))
    assert len(parts) > 10 and sum(n for n, _ in parts) == len(features(text)[0])
    assert Counter(x for p in whole for x in p) == Counter(x for _, b in parts for x in b.tolist()) == Counter(zlib.crc32(f.encode()) % 997 for f in features(text, 3)[1])


def test_ranks_are_exact_and_segments_even(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(50), rng.choice([5, 5, 5, rng.randrange(1_000)]), 1) for _ in range(20_000)] + [(None, 5, 1)] * 10
    found, total = resampling.ranked(spark.createDataFrame(rows, "doc_id long, score long, n_features long").repartition(9))
    got = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in found.collect())
    assert total == len(rows) and [g[0] for g in got] == list(range(1, total + 1))
    assert [g[1:] for g in got] == sorted((-s, i is None, i or 0) for i, s, _ in rows)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.5 * total / 4  # half of all rows have one score and few ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resampled(none, none).count() == 0
    rows = [(1, "a b c"), (2, "b c d")]
    assert sorted(map(tuple, resampling.resampled(documents(spark, rows), none, 50, 1, 10).collect()), key=repr) == brute(rows, [], 50, 1, 10)
    ids = spark.createDataFrame([("x", "a b c"), (None, "b")], "doc_id string, text string")
    assert resampling.resampled(ids, none, 100, 1).where("rank is not null").count() == 2


def test_the_weight_prefers_the_target(spark):
    rng = random.Random(8)
    like, other = [f"like{i}" for i in range(30)], [f"other{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(like if i % 4 == 0 else other, k=40))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(rng.choices(like, k=200)),)], "text string")
    drawn = [r["doc_id"] for r in resampling.resampled(documents(spark, rows), target, 20).where("rank is not null").collect()]
    assert len(drawn) == 80 and all(i % 4 == 0 for i in drawn)
