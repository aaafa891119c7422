"""Day-window operators: last 1/7/30 days, to-date roll-forward, N-day columns to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, day, days_back, within_days, zero_if_null


def recent_days(df: DataFrame, as_of: Day, days: Sequence[int] = (1, 7, 30), date: str = "dt") -> DataFrame:
    """One copy of each row per window it falls into, tagged ``recent_days``.

    The scan is cut to the longest window first, and rows are only copied for windows that hold them.
    """
    windows = F.array(*[F.when(F.col(date) >= days_back(as_of, n), F.lit(n)) for n in days])
    return df.where(within_days(date, as_of, max(days))).withColumn(
        "recent_days", F.explode(F.array_compact(windows))
    )


def sum_last_days(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    as_of: Day,
    days: Sequence[int] = (7, 30),
    date: str = "dt",
) -> DataFrame:
    """``<measure>_<n>d`` columns per key; ``measures`` maps output stem to input column."""
    sums = [
        F.sum(F.when(F.col(date) >= days_back(as_of, n), F.col(source)).otherwise(F.lit(0))).alias(f"{stem}_{n}d")
        for n in days
        for stem, source in measures.items()
    ]
    return df.where(within_days(date, as_of, max(days))).groupBy(*keys).agg(*sums)


def last_days_to_rows(
    df: DataFrame, keep: Sequence[str | Column], stems: Sequence[str], days: Sequence[int] = (7, 30)
) -> DataFrame:
    """Turn ``<stem>_<n>d`` columns into one row per window with plain ``<stem>`` columns."""
    rows = [
        F.struct(F.lit(n).alias("recent_days"), *[F.col(f"{stem}_{n}d").alias(stem) for stem in stems])
        for n in days
    ]
    return df.select(*keep, F.explode(F.array(*rows)).alias("_w")).select(
        *[k if isinstance(k, str) else k for k in keep], "_w.*"
    )


def roll_forward(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    as_of: Day,
    first: str,
    last: str,
) -> DataFrame:
    """Yesterday's to-date table plus one day's summary.

    ``sums`` maps a to-date total to the day's column. A key seen that day gets ``last = as_of``; a key
    seen for the first time gets ``first = as_of``. A key whose ``last`` is ``as_of`` or later holds that day already and
    stays as it is, so a rerun on its own output changes nothing.
    """
    o = old.select(*keys, first, last, *sums)
    n = new.select(*keys, *[F.col(source).alias(f"_day_{total}") for total, source in sums.items()],
                   F.lit(True).alias("_seen"))
    both = o.join(n, list(keys), "full")
    known = F.coalesce(F.col(last) >= day(as_of), F.lit(False))
    return both.select(
        *keys,
        F.coalesce(F.col(first), day(as_of)).alias(first),
        F.when(F.col("_seen") & ~known, day(as_of)).otherwise(F.col(last)).alias(last),
        *[F.when(known, F.col(t)).otherwise(zero_if_null(t) + zero_if_null(f"_day_{t}")).alias(t) for t in sums],
    )
