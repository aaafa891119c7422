"""Application log: split, route, flatten, repair. All but ``fix_is_new`` work on streams and batches alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.sources.schemas import ACTION, APP_LOG, COMMON, DISPLAY, ERROR, PAGE, START
from tidemill.sources.streams import parse


_FIELDS = {"common": COMMON, "page": PAGE, "start": START, "display": DISPLAY, "action": ACTION, "err": ERROR}
_KEPT = {  # part -> the fields it keeps
    "dirty": ["value"], "err": ["err"], "start": ["common", "page", "start", "ts"], "display": ["common", "page", "display", "ts"],
    "action": ["common", "page", "action", "ts"], "page": ["common", "page", "ts"],
}


def log_parts(raw: DataFrame) -> DataFrame:
    """Every part of every record as a row, from one scan and one parse: part, common, page, start, display, action, err, ts, value.

    An error part is ``err`` and the rest of the record the others. A start record is ``start``; any other record gives its
    displays, its actions and itself without them as ``page``. What does not parse is ``dirty``, with its text as ``value``.
    """
    def part(name: str, **fields: Column) -> Column:
        kept = {f: F.col(f"record.{f}") for f in _KEPT[name] if f in ("common", "page", "start", "err", "ts")} | fields
        columns = [kept.get(f, F.lit(None).cast(kind)).alias(f) for f, kind in [*_FIELDS.items(), ("ts", "bigint"), ("value", "string")]]
        return F.struct(F.lit(name).alias("part"), *columns)

    def one(condition: Column, entry: Column) -> Column:
        return F.when(condition, F.array(entry))

    good, starts = F.col("bad").isNull(), F.col("record.start").isNotNull()
    entries = [
        one(~good, part("dirty", value=F.col("bad"))), one(good & F.col("record.err").isNotNull(), part("err")),
        one(good & starts, part("start")), one(good & ~starts, part("page")),
        F.when(good & ~starts, F.transform("record.displays", lambda d: part("display", display=d))),
        F.when(good & ~starts, F.transform("record.actions", lambda a: part("action", action=a))),
    ]
    rows = F.flatten(F.filter(F.array(*entries), lambda e: e.isNotNull()))
    return parse(raw, APP_LOG).select(F.explode(rows).alias("p")).select("p.*")


def split_app_log(raw: DataFrame) -> dict[str, DataFrame]:
    """The parts of ``log_parts`` as outputs of their own. A job that needs several reads ``log_parts`` once instead."""
    parts = log_parts(raw)
    outputs = {name: parts.where(F.col("part") == name).select(*kept) for name, kept in _KEPT.items()}
    return outputs | {"err": outputs["err"].select("err.*")}


ROUTES = {"start": "start", "page": "page", "display": "displays", "action": "actions", "error": "err"}


def routed_records(raw: DataFrame) -> DataFrame:
    """(topic, value): records by the keys they hold, unchanged, from one parse; several keys give several rows."""
    topics = F.filter(F.array(*[F.when(F.col(f"record.{key}").isNotNull(), F.lit(name)) for name, key in ROUTES.items()]), lambda t: t.isNotNull())
    return parse(raw, APP_LOG).where(F.col("bad").isNull()).select(F.explode(topics).alias("topic"), "value")


def route_log_by_type(raw: DataFrame) -> dict[str, DataFrame]:
    """The topics of ``routed_records`` as outputs of their own."""
    routed = routed_records(raw)
    return {name: routed.where(F.col("topic") == name).select("value") for name in ROUTES}


def flatten_actions(log: DataFrame) -> DataFrame:
    return log.select("common", "page", F.explode("actions").alias("action"), "ts")


def flatten_displays(log: DataFrame) -> DataFrame:
    return log.select("common", "page", F.explode("displays").alias("display"), "ts")


def page_facts(log: DataFrame) -> DataFrame:
    return log.where(F.col("common").isNotNull() & F.col("page").isNotNull())


def start_facts(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNotNull())


def error_facts(log: DataFrame) -> DataFrame:
    return log.where(F.col("err").isNotNull())


def _visit_day(ts: str | Column) -> Column:
    return F.to_date(F.timestamp_millis(ts))


def first_visits(log: DataFrame) -> DataFrame:
    """mid -> the day its new flag is good for: the day of its first record, or the day before if that one is not new."""
    first = log.groupBy(F.col("common.mid").alias("mid")).agg(
        F.min(F.struct("ts", F.col("common.is_new").alias("is_new"))).alias("first")
    )
    seen = _visit_day("first.ts")
    return first.select(
        "mid", F.when(F.col("first.is_new") == "1", seen).otherwise(F.date_sub(seen, 1)).alias("first_day"),
        F.col("first.ts").alias("first_ts"),
    )


def fix_is_new(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Clear the new flag on every day after a device's first. ``known`` holds devices seen before (mid, first_day).

    First days come from an aggregate and are joined back, so a device with very many records is not gathered
    in one task.
    """
    first = first_visits(log).select("mid", "first_day")
    if known is not None:
        before = known.select("mid", F.col("first_day").alias("known_day"))
        first = first.join(before, "mid", "left").select("mid", F.coalesce("known_day", "first_day").alias("first_day"))
    first = first.withColumnRenamed("mid", "_mid")
    joined = log.join(first, F.col("common.mid") == F.col("_mid"), "left")
    stale = (F.col("common.is_new") == "1") & (_visit_day("ts") != F.col("first_day"))
    fixed = F.when(stale, F.lit("0")).otherwise(F.col("common.is_new"))
    return joined.withColumn("common", F.col("common").withField("is_new", fixed)).select(*log.columns)


def unify_user_actions(parts: DataFrame) -> DataFrame:
    """The four typed logs among ``log_parts`` as one: event type, device and event time added. An action carries its own time."""
    known = parts.where(F.col("part").isin("start", "page", "display", "action"))
    at = F.when(F.col("part") == "action", F.col("action.ts")).otherwise(F.col("ts"))
    return known.withColumns({"mid": F.col("common.mid"), "event_ts": at}).withColumnRenamed("part", "event_type").drop("err", "value")
