"""URL filters: a temporal join of captures with dated list entries, with DataFrame functions only.

A list's entries are dated changes: from its day on, a pattern (a host, a domain above it, or a host with the beginning of a
path) is blocked, allowed or dropped. Changes become validity intervals, one behind the other. A capture is held against the
entries that were active on the day it was fetched: every pattern that could match its URL is looked up among the intervals,
by pattern and by period of PERIOD days, so that long histories and popular hosts both stay equi joins that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import pick

PERIOD = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case; empty for what is no URL with a host."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, action, valid_from, valid_to): what holds of a pattern from the day of a change to that of the next.

    Of changes to a list's pattern on one day the greatest action in the order block, drop, allow counts; afterwards a
    pattern has at most one row a day, so its history is short whatever the number of entries. ``valid_to`` is open (NULL)
    for the last. Entries without list, pattern, day or known action are left out.
    """
    rank = F.array_position(F.array(F.lit("block"), F.lit("drop"), F.lit("allow")), F.col("action"))
    days = entries.withColumn("rank", rank).where("rank > 0 and list is not null and pattern is not null and listed_on is not null") \
        .groupBy("list", "pattern", "listed_on").agg(F.max(F.struct("rank", "action")).alias("a"))
    history = Window.partitionBy("list", "pattern").orderBy("listed_on")
    spans = days.select("list", "pattern", F.col("a.action").alias("action"), F.col("listed_on").alias("valid_from"),
                        F.lead("listed_on").over(history).alias("valid_to"))
    return spans.where("action <> 'drop'")


def _patterns(url: Column, deepest: int) -> Column:
    """All patterns that match: the host and the domains above it, and the host with up to ``deepest`` parts of the path."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    depth = F.least(F.size(parts), F.lit(deepest))
    paths = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))))
    return F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>"))))


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD)


def filtered_urls(captures: DataFrame, entries: DataFrame, page_id: str = "page_id", url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """Per capture (page_id, url, fetched_on): n_active (entries that were active and match), the deciding list, pattern and
    action, and blocked.

    The longest matching pattern decides; of equally long ones "allow" before "block", then the greatest list and pattern.
    Captures without match, without URL, host or day are not blocked and have NULL there. Equal rows are one capture and give
    one row; an empty table of captures gives no rows, one of entries blocks nothing; other columns are not read.
    """
    own = pick(captures, page_id=page_id, url=url, fetched_on=fetched_on).distinct()
    spans = intervals(pick(entries, list="list", pattern="pattern", action="action", listed_on="listed_on"))
    last = own.agg(F.max("fetched_on")).first()[0]
    deepest = spans.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    ends = F.coalesce(F.date_sub("valid_to", 1), F.lit(last).cast("date"))
    ends = F.least(ends, F.lit(last).cast("date"))
    spans = spans.withColumn("ends", ends).where("ends >= valid_from").withColumn(
        "period", F.explode(F.sequence(_period(F.col("valid_from")), _period(F.col("ends")))))
    asked = own.where("url is not null and fetched_on is not null").withColumn("pattern", F.explode(_patterns(F.col("url"), deepest))) \
        .withColumn("period", _period(F.col("fetched_on")))
    met = asked.join(spans, ["pattern", "period"]).where("fetched_on between valid_from and ends")
    best = F.max(F.struct(F.length("pattern").alias("length"), (F.col("action") == "allow").alias("allow"), "list", "pattern", "action"))
    decided = met.groupBy("page_id", "url", "fetched_on").agg(F.count("*").alias("n_active"), best.alias("b"))
    keys = ["page_id", "url", "fetched_on"]
    left, right = own.alias("l"), decided.alias("r")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, same, "left").select(
        *[F.col(f"l.{k}") for k in keys], F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("b.list").alias("list"),
        F.col("b.pattern").alias("pattern"), F.col("b.action").alias("action"), F.coalesce(F.col("b.action") == "block", F.lit(False)).alias("blocked"))
