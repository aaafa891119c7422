"""Near pairs against all pairs in Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tidemill.operators.near import near_pair_counts
from tidemill.plans.linkage import related_actions


def sample(n=300, seed=5):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        user = 0 if rng.random() < 0.5 else rng.randrange(1, 6)
        # exact window ends are likely: times on a coarse grid, a few with microseconds
        at = start + timedelta(seconds=rng.randrange(0, 40) * 30, microseconds=rng.choice([0, 0, 1, 999999]))
        rows.append((user, at, rng.randrange(6), rng.choice(["click", "cart", "pay"])))
    return rows


def brute(rows, main, seconds):
    count = Counter()
    for u, t, s, _ in rows:
        if s not in main:
            continue
        for u2, t2, s2, a2 in rows:
            if u == u2 and s != s2 and abs((t2 - t) / timedelta(microseconds=1)) <= seconds * 1_000_000:
                count[(s, s2, a2)] += 1
    return sorted((*k, n) for k, n in count.items())


@pytest.mark.parametrize("seconds", [60, 300, 1])
def test_pairs(spark, seconds):
    rows = sample()
    df = spark.createDataFrame(rows, "user_id int, at timestamp, sku int, kind string")
    left = df.where("sku in (0, 1)").selectExpr("user_id", "at", "sku as main")
    right = df.selectExpr("user_id", "at", "sku as related", "kind")
    got = near_pair_counts(left, right, "user_id", "at", "main", ["related", "kind"], seconds)
    assert sorted(tuple(r) for r in got.select("main", "related", "kind", "pairs").collect()) == brute(rows, {0, 1}, seconds)


def test_related_actions_of_the_last_days_only(spark):
    t = datetime(2024, 1, 20, 12)
    rows = [(1, t, 5, "view"), (1, t + timedelta(minutes=30), 6, "cart"), (1, t + timedelta(minutes=31), 7, "cart"),
            (1, t - timedelta(days=15), 5, "view"), (1, t - timedelta(days=15), 8, "pay"),
            (2, t - timedelta(days=7), 5, "view"), (2, t - timedelta(days=7), 9, "pay"),  # one day before the first of seven
            (3, t + timedelta(days=1), 5, "view"), (3, t + timedelta(days=1), 9, "pay")]  # after the day
    df = spark.createDataFrame(rows, "user_id int, action_time timestamp, sku_id int, action_type string")
    got = related_actions(df, [5], "2024-01-20").collect()
    assert [tuple(r) for r in got] == [(5, 6, "cart", 1)]


def test_spread_rows_are_not_broadcast(spark):
    """Sizes known before the rows are spread over their bits say nothing about the rows that are joined."""
    df = spark.createDataFrame(sample(), "user_id int, at timestamp, sku int, kind string")
    left, right = df.selectExpr("user_id", "at", "sku as main"), df.selectExpr("user_id", "at", "sku as related", "kind")
    got = near_pair_counts(left, right, "user_id", "at", "main", ["related", "kind"], 60)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in text
