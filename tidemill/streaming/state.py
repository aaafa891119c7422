"""Streaming operators that keep their state per key in Spark's state store.

State lies in RocksDB, partitioned by key and versioned with the checkpoint, so a lost executor or a batch run again finds the
state it had. Processors take rows one key at a time and keep fixed-size values or maps with point reads; what an earlier step can
throw away is thrown away before the shuffle. Operators that forget keys (``keep``) use processing time and run under
``streams.run_until_idle``; the others end by themselves under ``availableNow``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemill.sources.schemas import ORDER_ROW
from tidemill.streaming import cdc, users

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: T.StructType | str, forgets: bool = False) -> DataFrame:
    """``transformWithState`` over the rows of each key, in append mode."""
    stream.sparkSession.conf.set(PROVIDER, ROCKS_DB)
    return stream.groupBy(*keys).transformWithState(processor, schema, "Append", "ProcessingTime" if forgets else "None")


def milliseconds(spark: SparkSession, duration: str) -> int:
    """``1 day``, ``90 seconds``... in ms."""
    end = F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {duration}")
    return spark.range(1).select(F.unix_millis(end)).first()[0]


class _Plain(StatefulProcessor):
    def close(self) -> None:
        pass


def in_order(*values):
    """A key that sorts None first."""
    return tuple((v is not None, v) if not isinstance(v, tuple) else (True, in_order(*v)) for v in values)


# --- de-duplication with a time to live ----------------------------------------------------------------------------

class NewerOnly(_Plain):
    """Lets a record pass if it is newer than all before it of its key; the newest time is forgotten ``keep_ms`` after it was set."""

    def __init__(self, arrival: Sequence[str], ts: str, keep_ms: int):
        self.arrival, self.ts, self.keep_ms = list(arrival), ts, keep_ms

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "ts long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues):
        state = self.newest.get()
        before = newest = state[0] if state else None
        for row in sorted(rows, key=lambda r: in_order(*[r[c] for c in self.arrival])):
            if row[self.ts] is not None and (newest is None or row[self.ts] > newest):
                newest = row[self.ts]
                yield row
        if newest != before:
            self.newest.update((newest,))


def _may_pass(keys: Sequence[str], arrival: Sequence[str], ts: str):
    """Rows of an Arrow batch that are newer than all of their key before them in the batch: no other row can pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in {*keys, *arrival, ts}}
            top: dict[tuple, int] = {}
            stays = []
            for n in sorted(range(batch.num_rows), key=lambda n: in_order(*[columns[c][n] for c in arrival])):
                key, at = tuple(columns[k][n] for k in keys), columns[ts][n]
                if at is not None and (key not in top or at > top[key]):
                    top[key] = at
                    stays.append(n)
            if stays:
                yield batch.take(pa.array(sorted(stays), pa.int64()))

    return run


def newer_only(stream: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str = "ts_ms", keep: str = "1 day") -> DataFrame:
    """Records newer than everything before them of their key, in order of ``arrival``, as ``dedup.dedup_newer_only`` does on a
    batch. A key's newest time is kept for ``keep`` after it was last set; a record that comes later is taken as the first.

    Each task first drops what an earlier row of its own batch already rules out, so a hot key sends few rows.
    """
    slim = stream.mapInArrow(_may_pass(keys, arrival, ts), stream.schema)
    return stateful(slim, keys, NewerOnly(arrival, ts, milliseconds(stream.sparkSession, keep)), stream.schema, forgets=True)


def exactly_once(stream: DataFrame, columns: Sequence[str] | None = None, keep: str = "1 day") -> DataFrame:
    """Whole records once (or once per ``columns``) within ``keep`` of the first.

    The time of a batch is the records' event time: a key lies in the state store with the time it runs out, without a call into
    Python, and goes with the end of the next batch after that time. A copy that comes later than ``keep`` passes from then on. A stream with a
    watermark of its own would hold keys until that has passed as well.
    """
    stream.sparkSession.conf.set(PROVIDER, ROCKS_DB)
    half = milliseconds(stream.sparkSession, keep) // 2  # a key stays for the delay, and the watermark follows by the delay
    seen = stream.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", f"{half} milliseconds")
    return seen.dropDuplicatesWithinWatermark(list(columns or stream.columns)).drop("_seen")


# --- wide order rows -----------------------------------------------------------------------------------------------

# A state entry is the newest row of a table: its time and its ``after``, kept as JSON text.

def _entry(text: str | None) -> tuple | None:
    return None if text is None else tuple(json.loads(text))


def _text(entry: tuple | None) -> str | None:
    return None if entry is None else json.dumps(entry, ensure_ascii=False)


def _newest(old: tuple | None, row: Row, by_refund_time: bool = False) -> tuple[tuple, bool]:
    """The later of a state entry and a row; of equal times the greater row. True if it is the row."""
    def at(entry):
        ts_ms, after = entry
        return in_order(*([after["refund_create_time"]] if by_refund_time else []), ts_ms, tuple(after.values()))

    new = (row["ts_ms"], row["after"])
    return (old, False) if old is not None and at(old) >= at(new) else (new, True)


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_DETAIL_FIELDS = ["order_detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "order_detail_create_time", "ts", "activity_id", "coupon_id"]
DETAIL = T.StructType([T.StructField(n, T.LongType() if n == "ts" else T.StringType()) for n in _DETAIL_FIELDS])
_MORE = ["user_id", "province_id", "order_create_time", "payment_type", "payment_time", "pay_amount", "refund_amount", "refund_reason_type", "refund_create_time", "event_type"]
WIDE = T.StructType([*DETAIL.fields, *[T.StructField(n, T.StringType()) for n in _MORE], T.StructField("version", T.LongType())])
_DETAIL_TABLES = ("order_detail", "order_detail_activity", "order_detail_coupon")
_ORDER_TABLES = ("order_info", "payment_info", "order_refund_info")
_ORDER_INPUT = T.StructType([T.StructField("order_key", T.StringType()), T.StructField("table", T.StringType()), T.StructField("after", ORDER_ROW),
                             T.StructField("ts_ms", T.LongType()), T.StructField("detail", DETAIL)])


class DetailParts(_Plain):
    """The newest rows of an order detail, its promotion and its coupon; emits the three as one row when one has changed."""

    def init(self, handle) -> None:
        self.parts = handle.getValueState("parts", _texts(*_DETAIL_TABLES))

    def handleInputRows(self, key, rows, timerValues):
        state = self.parts.get()
        parts = [_entry(p) for p in state] if state else [None] * 3
        changed = False
        for row in rows:
            at = _DETAIL_TABLES.index(row["table"])
            parts[at], new = _newest(parts[at], row)
            changed |= new
        if changed:
            self.parts.update(tuple(_text(p) for p in parts))
            if parts[0] is not None:
                ts, d = parts[0]
                activity, coupon = (p[1] if p else None for p in parts[1:])
                detail = Row(*_DETAIL_FIELDS)(key[0], d["order_id"], d["sku_id"], d["sku_name"], d["order_price"], d["sku_num"], d["create_time"], ts,
                                              activity["activity_id"] if activity else None, coupon["coupon_id"] if coupon else None)
                yield Row(*_ORDER_INPUT.names)(d["order_id"], "detail", None, None, detail)


class WideOrder(_Plain):
    """An order's details in a map, its newest order, payment and refund in one value; emits the wide rows that a batch changed,
    each with the number of the order's change."""

    def init(self, handle) -> None:
        head = T.StructType([*_texts(*_ORDER_TABLES).fields, T.StructField("version", T.LongType())])
        self.head = handle.getValueState("head", head)
        self.details = handle.getMapState("details", T.StructType([T.StructField("id", T.StringType())]), DETAIL)

    def handleInputRows(self, key, rows, timerValues):
        state = self.head.get()
        head = [_entry(p) for p in state[:3]] if state else [None] * 3
        version = (state[3] if state else 0) + 1
        touched, all_of_them = {}, False
        for row in rows:
            if row["table"] == "detail":
                touched[row["detail"]["order_detail_id"]] = tuple(row["detail"][c] for c in _DETAIL_FIELDS)
            else:
                at = _ORDER_TABLES.index(row["table"])
                head[at], new = _newest(head[at], row, by_refund_time=at == 2)
                all_of_them |= new
        for name, detail in touched.items():
            self.details.updateValue((name,), detail)
        self.head.update((*[_text(p) for p in head], version))
        info, payment, refund = (e[1] if e else None for e in head)
        if info is None or info["user_id"] is None:
            return
        shown = (tuple(d) for _, d in self.details.iterator()) if all_of_them else iter(touched.values())
        pay, back = payment["total_amount"] if payment else None, refund["refund_amount"] if refund else None
        more = (info["user_id"], info["province_id"], info["create_time"], payment["payment_type"] if payment else None, payment["callback_time"] if payment else None, pay,
                back, refund["refund_reason_type"] if refund else None, refund["refund_create_time"] if refund else None,
                "refund" if back is not None else "payment" if pay is not None else "order", version)
        for detail in shown:
            yield Row(*WIDE.names)(*detail, *more)


def order_wide_changes(envelopes: DataFrame) -> DataFrame:
    """Change records of the six order tables -> the wide rows they change, with ``version``; ``current`` keeps each detail's last.

    Rows keyed by detail are joined first, so promotions and coupons need not name their order; details and the rows keyed by
    order then meet per order. A batch reads the state of the orders it touches and nothing else. A detail stays with its order.
    """
    rows = cdc.order_rows(envelopes)
    detail_key = F.when(F.col("table") == "order_detail", F.col("after.id")).otherwise(F.col("after.order_detail_id"))
    order_key = F.when(F.col("table") == "order_info", F.col("after.id")).otherwise(F.col("after.order_id"))
    parts = rows.where(F.col("table").isin(*_DETAIL_TABLES)).select(detail_key.alias("detail_key"), "table", "after", "ts_ms").where(F.col("detail_key").isNotNull())
    details = stateful(parts, ["detail_key"], DetailParts(), _ORDER_INPUT)
    orders = rows.where(F.col("table").isin(*_ORDER_TABLES)).select(order_key.alias("order_key"), "table", "after", "ts_ms", F.lit(None).cast(DETAIL).alias("detail"))
    return stateful(details.unionByName(orders).where(F.col("order_key").isNotNull()), ["order_key"], WideOrder(), WIDE)


def current(changes: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """The last row of each key in a log of changes."""
    names = [c for c in changes.columns if c not in (*keys, version)]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*names), version).alias("row")).select(*keys, "row.*")


# --- preferences with withdrawn rows -------------------------------------------------------------------------------

PREFERENCES = (*users.BRAND_KINDS, "place")
_TOP = ", ".join(f"{p}_name string, {p}_platform string, {p}_n long" for p in PREFERENCES)


class Preference(_Plain):
    """Counts of a user's brands and places in a map, the four leaders in one value. Counts only grow, so a leader is the old one
    or one that the batch has counted: no batch reads the whole map. A changed row is withdrawn (-1) and sent anew (+1)."""

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", "what string, name string, platform string", "n long")
        self.top = handle.getValueState("top", _TOP)

    def handleInputRows(self, key, rows, timerValues):
        added: dict[tuple, int] = {}
        for r in rows:
            name = (r["what"], r["name"], r["platform"])
            added[name] = added.get(name, 0) + r["n"]
        state = self.top.get()
        old = [tuple(state[k : k + 3]) if state[k] is not None else None for k in range(0, len(state), 3)] if state else [None] * len(PREFERENCES)
        new = list(old)
        for (what, name, platform), n in added.items():
            item = (what, name, platform or "")
            before = self.counts.getValue(item) if self.counts.containsKey(item) else None
            n += before[0] if before else 0
            self.counts.updateValue(item, (n,))
            at = PREFERENCES.index(what)
            # the old leader's own count may have grown as well; ties go to the smaller name
            if new[at] is None or new[at][:2] == (name, platform) or (-n, name, platform or "") < (-new[at][2], new[at][0], new[at][1] or ""):
                new[at] = (name, platform, n)
        if new != old:
            self.top.update(tuple(v for t in new for v in t or (None, None, None)))
        was, now = ([t[:2] if t else None for t in tops] for tops in (old, new))
        if was != now:
            for change, tops in ((-1, was), (1, now)):
                if any(tops):
                    names = [t[0] if t else None for t in tops]
                    yield Row("user_id", *[f"top_{p}_brand" for p in PREFERENCES[:3]], "prefer_category3", "prefer_platform", "change")(
                        key[0], *names, tops[3][1] if tops[3] else None, change)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["user_id", "what", "name", "platform"]).aggregate([("n", "sum")])
        yield from table.rename_columns(["user_id", "what", "name", "platform", "n"]).to_batches()


def preference_changes(behaviour: DataFrame) -> DataFrame:
    """Each user's most viewed, carted and paid brand and most frequent category with platform, as a log: user_id, top_view_brand,
    top_cart_brand, top_pay_brand, prefer_category3, prefer_platform, change (+1 a row that holds from here, -1 one that holds no
    more). ``standing`` gives the rows that hold. Ties go to the smaller name, as in ``users.user_preference``."""
    items = users.preference_items(behaviour).withColumn("n", F.lit(1).cast("long"))
    user = items.schema["user_id"].dataType.simpleString()
    counted = items.mapInArrow(_counted, f"user_id {user}, what string, name string, platform string, n long")
    return stateful(counted, ["user_id"], Preference(),
                    f"user_id {user}, top_view_brand string, top_cart_brand string, top_pay_brand string, prefer_category3 string, prefer_platform string, change int")


def standing(changes: DataFrame) -> DataFrame:
    """The rows of a log that were sent more often than withdrawn."""
    names = [c for c in changes.columns if c != "change"]
    return changes.groupBy(*names).agg(F.sum("change").alias("change")).where("change > 0").select(*names)
