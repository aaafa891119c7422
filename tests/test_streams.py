"""Streams fed in several files against their batch counterparts, with late, doubled and broken input."""

import glob
import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.session import scratch
from tidemill.sources import schemas, streams
from tidemill.sources.keyed import KeyedTable
from tidemill.streaming import cdc, dedup, jobs, logs, state, users, windows

START = 1704067200000  # 2024-01-01 in ms


def feed(tmp_path, files):
    """One text file per batch, in order of modification."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n, lines in enumerate(files):
        f = folder / f"{n:03}.txt"
        f.write_text("".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines))
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def live(spark, folder):
    return streams.text_stream(spark, "text", folder, files_per_batch=1)


def batch(spark, folder):
    return spark.read.text(folder)


def visit(uid, ts, is_new="1", **more):
    return {"common": {"uid": uid, "mid": f"m{uid}", "is_new": is_new, "vc": "v1", "ch": "c1", "ar": "a1"}, "ts": ts, **more}


def test_split_log(spark, tmp_path, as_rows):
    lines = [
        visit("1", START, page={"page_id": "p"}, displays=[{"item": "a"}, {"item": "b"}], actions=[{"action_id": "x", "ts": START + 1}], err={"error_code": 7}),
        visit("2", START, start={"entry": "icon"}, err={"error_code": 8}), '{"common": {"uid": "3"', "", "[1]",
        visit("4", START, page={"page_id": "q"}),
    ]
    parts = logs.split_app_log(batch(spark, feed(tmp_path, [lines[:3], lines[3:]])))
    assert {k: v.count() for k, v in parts.items()} == {"dirty": 3, "err": 2, "start": 1, "display": 2, "action": 1, "page": 2}
    assert as_rows(parts["display"], "display.item", "page.page_id", "ts") == [("a", "p", START), ("b", "p", START)]
    routed = logs.route_log_by_type(batch(spark, str(tmp_path / "in")))
    assert {k: v.count() for k, v in routed.items()} == {"start": 1, "page": 2, "display": 1, "action": 1, "error": 2}


def test_fix_is_new_stream_equals_batch(spark, tmp_path, as_rows):
    rng = random.Random(3)
    day = 24 * 3600 * 1000
    rows = [visit(str(rng.randrange(6)), START + n * day // 10 + rng.randrange(1000), rng.choice("01")) for n in range(60)]
    folder = feed(tmp_path, [rows[:15], rows[15:16], rows[16:40], rows[40:]])
    fixed = jobs.fix_is_new_job(streams.parsed(live(spark, folder), schemas.APP_LOG), scratch(spark, "t"), buckets=3)
    want = logs.fix_is_new(streams.parsed(batch(spark, folder), schemas.APP_LOG))
    columns = ["common.mid", "ts", "common.is_new"]
    got = as_rows(fixed, *columns)
    assert got == as_rows(want, *columns)
    assert any(r["common"]["is_new"] == "1" for r in rows) and {r[2] for r in got} == {"0", "1"}


def change(table, op, ts, **after):
    return {"op": op, "after": {k: str(v) for k, v in after.items()}, "source": {"db": "d", "table": table, "snapshot": "false"}, "ts_ms": ts}


def order_changes():
    out = []
    for o in range(8):
        out.append(change("order_info", "r", 10 + o, id=o, user_id=100 + o, province_id=o % 3))
        for d in range(2):
            out.append(change("order_detail", "c", 20 + o, id=f"{o}-{d}", order_id=o, sku_id=d, order_price="1.50"))
            if d:  # promotion rows that do not name their order
                out.append(change("order_detail_activity", "c", 30, order_detail_id=f"{o}-{d}", activity_id=5))
        if o % 2:
            out.append(change("payment_info", "c", 40, id=f"p{o}", order_id=o, total_amount="9.00", callback_time="2024-01-01 00:00:01"))
        if o % 3 == 0:
            out += [change("order_refund_info", "c", 50 + n, id=f"r{o}{n}", order_id=o, refund_amount=n, refund_create_time=f"2024-01-0{3 - n}") for n in (1, 2)]
        if o == 5:
            out.append(change("order_info", "u", 99, id=o, user_id=777, province_id=1))
    out.append(change("order_detail", "c", 20, id="lost", order_id=999, sku_id=1))
    return out


def test_wide_orders_stream_equals_batch(spark, tmp_path, as_rows):
    rng = random.Random(9)
    rows = order_changes()
    rng.shuffle(rows)
    rows.append(rows[0])
    folder = feed(tmp_path, [rows[:7], rows[7:20], rows[20:21], rows[21:]])
    want = cdc.cdc_order_wide(streams.parsed(batch(spark, folder), schemas.ENVELOPE))
    got = jobs.order_wide_job(streams.parsed(live(spark, folder), schemas.ENVELOPE))
    columns = sorted(want.columns)
    assert as_rows(got, *columns) == as_rows(want, *columns)
    kinds = {r["order_id"]: r["event_type"] for r in want.collect()}
    assert kinds["0"] == "refund" and kinds["5"] == "payment" and kinds["2"] == "order" and "999" not in kinds
    assert {r["refund_amount"] for r in want.where("order_id = '0'").collect()} == {"1"}
    assert {r["user_id"] for r in want.where("order_id = '5'").collect()} == {"777"}


def test_dims_follow_changed_rules(spark, tmp_path, as_rows):
    rows = [change("t", "r", 1, id=1, name="a", x="x"), change("t", "d", 2, id=1, name="gone"), change("u", "r", 1, id=9, name="b")]
    folder = feed(tmp_path, [rows[:2], rows[2:]])
    asked = []

    def rules():
        asked.append(1)
        more = [("u", "dim_u", "id", "id")] if len(asked) > 1 else []
        return spark.createDataFrame([("t", "dim_t", "id,name", "id"), *more], "source_table string, sink_table string, sink_columns string, sink_row_key string")

    table = jobs.dim_upsert_job(streams.parsed(live(spark, folder), schemas.ENVELOPE), rules, scratch(spark, "t"), buckets=2)
    assert as_rows(table.read().select("sink_table", "row_key", F.to_json("columns"))) == [("dim_t", "1", '{"id":"1","name":"a"}'), ("dim_u", "9", '{"id":"9"}')]
    changes = spark.createDataFrame([("c", "t", "dim_t", "id", "id", 1), ("d", "t", "dim_t", "id", "id", 2), ("c", "u", "old", "id", "id", 1), ("u", "u", "dim_u", "id", "id", 2)],
                                    "op string, source_table string, sink_table string, sink_columns string, sink_row_key string, ts_ms int")
    live_rules = cdc.current_config(changes)
    assert as_rows(live_rules, "source_table", "sink_table") == [("u", "dim_u")]
    assert as_rows(jobs.live_dims(table, live_rules), "sink_table") == [("dim_u",)]


def test_cdc_flatten_and_route(spark, tmp_path, as_rows):
    rows = [change("order_info", op, 1, id=n) for n, op in enumerate("crud")] + [{"op": "d", "before": {"id": "7"}, "after": None, "source": {"db": "d", "table": "x"}, "ts_ms": 1}, "{broken"]
    env = streams.parsed(batch(spark, feed(tmp_path, [rows])), schemas.ENVELOPE)
    assert as_rows(cdc.cdc_flatten(env), "type", "before", "after") == sorted([
        ("insert", "{}", '{"id":"0"}'), ("read", "{}", '{"id":"1"}'), ("update", "{}", '{"id":"2"}'), ("delete", "{}", '{"id":"3"}'), ("delete", '{"id":"7"}', "{}")], key=repr)
    routed = as_rows(cdc.cdc_route(env, cdc.fact_routes(spark)))
    assert routed == sorted([("dwd_trade_order_detail", '{"id":"0"}'), ("dwd_trade_order_detail", '{"id":"1"}'), ("dwd_trade_order_pay", '{"id":"2"}'),
                             ("dwd_dynamic_fallback", '{"id":"3"}')], key=repr)


def test_windows_drop_only_rows_behind_the_watermark(spark, tmp_path, as_rows):
    def row(sec, user=1, amount=1.0):
        return {"event_type": "order", "sku_id": 1, "user_id": user, "order_id": sec, "order_amount": amount, "ts": START + sec * 1000}

    # the third file closes the first windows; the last two bring a row for a closed window and move time on
    files = [[row(1), row(2, 2), row(2, 2)], [row(12), row(4, 3)], [row(60)], [row(61)], [row(3, 9), row(62)], [row(200)], [row(201)]]
    schema = "event_type string, sku_id int, user_id int, order_id int, order_amount double, ts bigint"
    source = live(spark, feed(tmp_path, files)).select(F.from_json("value", schema).alias("r")).select("r.*")
    got = streams.run_to_parquet(windows.order_stats(windows.event_timed(source)), "w")
    assert as_rows(got, "stt", "order_ct", "order_user_ct", "order_amount") == [
        ("2024-01-01 00:00:00", 4, 3, 4.0), ("2024-01-01 00:00:10", 1, 1, 1.0), ("2024-01-01 00:01:00", 3, 1, 3.0)]


def test_late_rows_go_to_their_own_output(spark, tmp_path, as_rows):
    def row(kind, sec):
        return {"kind": kind, "at": (datetime(2024, 1, 1) + timedelta(seconds=sec)).isoformat(sep=" ")}

    files = [[row("a", 100), row("b", 0)], [row("a", 95), row("a", 94), row("b", 0), row("c", 1)], [row("a", 300), row("a", 96)], [row("a", 100), row("c", 1)]]
    folder = feed(tmp_path, files)
    schema = "kind string, at timestamp"
    source = live(spark, folder).select(F.from_json("value", schema).alias("r")).select("r.*")
    timely = []
    on_time, late = jobs.late_split_job(source, 5, "kind", "at", scratch(spark, "late"), on_time=lambda rows, n: timely.append((n, rows.count())))
    got = on_time.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))
    n = F.regexp_extract(F.input_file_name(), r"(\d+)\.txt", 1).cast("int").alias("batch")
    whole = batch(spark, folder).select(n, F.from_json("value", schema).alias("r")).select("batch", "r.*")
    want = dedup.late_rows(whole, 5, "kind", "at", "batch")
    assert as_rows(got, "kind", "at", "is_late") == as_rows(want, "kind", "at", "is_late")
    assert late.count() == 2 and timely == [(0, 2), (1, 3), (2, 2), (3, 1)]


def test_newer_only_stream_equals_batch(spark, tmp_path, as_rows):
    rng = random.Random(4)
    rows = [{"id": rng.randrange(4), "seq": n, "ts_ms": rng.randrange(200)} for n in range(80)]
    folder = feed(tmp_path, [rows[:30], rows[30:31], rows[31:60], rows[60:]])
    schema = "id int, seq int, ts_ms bigint"
    got = jobs.newer_only_job(live(spark, folder).select(F.from_json("value", schema).alias("r")).select("r.*"), ["id"], ["seq"])
    whole = batch(spark, folder).select(F.from_json("value", schema).alias("r")).select("r.*")
    assert as_rows(got) == as_rows(dedup.dedup_newer_only(whole, ["id"], ["seq"]))


def test_running_statistics(spark, tmp_path, as_rows):
    rng = random.Random(6)
    kinds = ["view", "click", "cart", "pay"]
    rows = [{"user_id": rng.randrange(5), "session_id": f"s{rng.randrange(9)}", "behavior_type": rng.choice(kinds), "behavior_time": START + rng.randrange(10**6)} for _ in range(60)]
    folder = feed(tmp_path, [rows[:20], rows[20:40], rows[40:]])
    schema = "user_id bigint, session_id string, behavior_type string, behavior_time bigint"
    def parse(df):
        return df.select(F.from_json("value", schema).alias("r")).select("r.*")
    got = jobs.behaviour_stats_job(parse(live(spark, folder)))
    assert as_rows(got) == as_rows(users.user_behaviour_stats(parse(batch(spark, folder))))


def test_keyed_table_repeats_a_batch_without_change(spark, as_rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "n", 1)], "id int, v string, ts int")
    table = KeyedTable(spark, scratch(spark, "keyed"), df.schema, ["id"], ["ts"], buckets=3)
    assert table.read().count() == 0
    table.upsert(df, 0)
    table.upsert(spark.createDataFrame([(2, "d", 5)], df.schema), 1)
    for _ in range(2):
        table.upsert(spark.createDataFrame([(3, "e", 1), (1, "old", 0)], df.schema), 2)
    want = sorted([(1, "b", 2), (2, "d", 5), (3, "e", 1), (None, "n", 1)], key=repr)
    assert as_rows(table.read()) == want
    assert as_rows(table.read(spark.createDataFrame([(2,)], "id int"))) == [(2, "d", 5)]
    assert as_rows(table.read(before=1)) == sorted([(1, "b", 2), (2, "c", 1), (None, "n", 1)], key=repr)
    assert as_rows(table.compact(scratch(spark, "packed"), 2).read()) == want


@pytest.mark.parametrize("keep, again", [("1 hour", []), ("1 second", [(1, 3, 40), (1, 5, 45)])])
def test_a_forgotten_key_is_taken_again(spark, tmp_path, keep, again):
    """Two runs of one query, three seconds apart: what is too old while its key is remembered is new once it is forgotten."""
    schema = "id int, seq int, ts_ms bigint"
    folder, out, checkpoint = feed(tmp_path, [[{"id": 1, "seq": 1, "ts_ms": 50}, {"id": 2, "seq": 2, "ts_ms": 50}]]), scratch(spark, "out"), scratch(spark, "cp")

    def run():
        source = live(spark, folder).select(F.from_json("value", schema).alias("r")).select("r.*")
        return sorted(tuple(r) for r in streams.run_until_idle(state.newer_only(source, ["id"], ["seq"], keep=keep), "ttl", checkpoint=checkpoint, out=out).collect())

    assert run() == [(1, 1, 50), (2, 2, 50)]
    time.sleep(3)
    more = [{"id": 1, "seq": 3, "ts_ms": 40}, {"id": 1, "seq": 4, "ts_ms": 30}, {"id": 1, "seq": 5, "ts_ms": 45}, {"id": 2, "seq": 6, "ts_ms": 60}]
    (tmp_path / "in" / "more.txt").write_text("".join(json.dumps(r) + "\n" for r in more))
    assert run() == sorted([(1, 1, 50), (2, 2, 50), (2, 6, 60), *again])


def test_exact_copies_pass_once_while_remembered(spark, tmp_path, as_rows):
    schema = "id int, v string"
    folder = feed(tmp_path, [[{"id": 1, "v": "a"}, {"id": 1, "v": "a"}, {"id": 1, "v": "b"}], [{"id": 1, "v": "a"}, {"id": None, "v": None}], [{"id": None, "v": None}, {"id": 2, "v": "a"}]])
    source = live(spark, folder).select(F.from_json("value", schema).alias("r")).select("r.*")
    got = streams.run_until_idle(state.exactly_once(source), "exact")
    assert as_rows(got) == sorted([(1, "a"), (1, "b"), (None, None), (2, "a")], key=repr)


def test_wide_order_state_does_not_grow_the_batches(spark, tmp_path):
    """Twenty batches of one order each: every batch updates and emits its own order's rows only."""
    files = [[change("order_info", "c", n, id=n, user_id=n), change("order_detail", "c", n, id=f"d{n}", order_id=n, sku_id=1), change("order_detail_coupon", "c", n, order_detail_id=f"d{n}", coupon_id=n)]
             for n in range(20)]
    files[19].append(change("payment_info", "c", 60, id="p", order_id=7, total_amount=5))
    changes = state.order_wide_changes(streams.parsed(live(spark, feed(tmp_path, files)), schemas.ENVELOPE))
    checkpoint, out = scratch(spark, "wide-cp"), scratch(spark, "wide")
    query = changes.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) == 20
    updated = [sum(o["numRowsUpdated"] for o in p["stateOperators"]) for p in progress]
    assert max(updated[:19]) == min(updated[:19]) and updated[19] > updated[18]
    log = spark.read.parquet(out)
    assert log.count() == 21 and state.current(log, ["order_detail_id"]).where("event_type = 'payment'").select("order_id", "coupon_id").collect() == [("7", "7")]


def test_preferences_are_withdrawn_and_sent_anew(spark, tmp_path, as_rows):
    rng = random.Random(12)
    rows = [{"user_id": rng.choice([1, 2, 3, None]), "behavior_type": rng.choice(["view", "cart", "pay", "search"]), "brand_id": rng.choice(["a", "b", "c", None]),
             "category3_id": rng.choice(["x", "y"]), "platform": rng.choice(["p", "q", None])} for _ in range(300)]
    folder = feed(tmp_path, [rows[:20], rows[20:21], rows[21:150], rows[150:]])
    schema = "user_id bigint, behavior_type string, brand_id string, category3_id string, platform string"
    def parse(df):
        return df.select(F.from_json("value", schema).alias("r")).select("r.*")
    log = streams.run_to_parquet(state.preference_changes(parse(live(spark, folder))), "preference")
    want = users.user_preference(parse(batch(spark, folder)), "full")
    assert as_rows(state.standing(log), *sorted(want.columns)) == as_rows(want, *sorted(want.columns))
    assert log.where("change = -1").count() > 0 and {r[0] for r in log.groupBy("user_id").agg(F.sum("change")).select("sum(change)").collect()} == {1}


RULES = "id bigint, field_name string, operator string, threshold double, description string, status int"
ALERTS = "rule_id bigint, alert_type string, message string, alert_time string"


def test_rules_change_between_batches(spark, tmp_path, as_rows):
    """A rule is switched on before the second batch, one added before the third, one changed before the fourth."""
    files = [[{"stt": "a", "edt": f"t{n}", "sku_id": n, "order_amount": 10.0, "refund_amount": 4.0, "order_ct": 2}] for n in range(4)]
    schema = "stt string, edt string, sku_id int, order_amount double, refund_amount double, order_ct bigint, sku_num bigint, order_user_ct bigint, refund_user_ct bigint"
    source = live(spark, feed(tmp_path, files)).select(F.from_json("value", schema).alias("r")).select("r.*")
    book = jobs.RuleBook(spark, scratch(spark, "book"), RULES)
    versions = [[(1, "refund_rate", ">", 0.3, "high", 1), (3, "order_ct", "<", 9.0, "off", 0)]]
    versions.append([versions[0][0], (3, "order_ct", "==", 2.0, "on", 1)])
    versions.append([*versions[1], (2, "refund_rate", ">=", 0.4, "high too", 1)])
    versions.append([(1, "refund_rate", ">", 0.9, "high", 1), *versions[2][1:]])
    got = jobs.alert_job(source, book, windows.metric_alerts, scratch(spark, "alerts"), ALERTS, before=lambda n: book.publish(spark.createDataFrame(versions[n], RULES), n))
    assert as_rows(got, "rule_id", "alert_time") == [(1, "t0"), (1, "t1"), (1, "t2"), (2, "t2"), (2, "t3"), (3, "t1"), (3, "t2"), (3, "t3")]
    # a batch run again uses the rules it had, whatever has been published since
    assert as_rows(book.at_batch(0), "id", "status") == [(1, 1), (3, 0)] and book.at_batch(1).count() == 2
    book.publish(spark.createDataFrame([], RULES), 0)
    assert book.at_batch(0).count() == 2 and book.at_batch(9).count() == 3


def test_no_rules_no_alerts(spark):
    assert jobs.RuleBook(spark, scratch(spark, "book"), RULES).at_batch(0).count() == 0


def test_lifecycle_keeps_newest_known_values(spark, as_rows):
    schema = "order_detail_id string, order_id int, user_id int, sku_id int, total_amount double, ts int"
    orders = spark.createDataFrame([("d", 1, 2, 3, 10.0, 1), (None, 9, 9, 9, 1.0, 1)], schema)
    pays = spark.createDataFrame([("d", 1, 2, None, 8.0, 5), ("d", 1, None, None, 9.0, 4)], schema)
    refunds = spark.createDataFrame([("d", 1, None, 4, None, 6)], schema)
    got = as_rows(cdc.order_lifecycle_merge(cdc.lifecycle_events(orders, pays, refunds)))
    assert got == [("d", 1, 2, 4, 10.0, 8.0, None, 6)]


def test_interval_join_stream(spark, tmp_path, as_rows):
    def at(sec):
        return (datetime(2024, 1, 1) + timedelta(seconds=sec)).isoformat(sep=" ")

    a, b = tmp_path / "o", tmp_path / "r"
    a.mkdir(), b.mkdir()
    orders = feed(a, [[{"order_id": 1, "order_time": at(0)}], [{"order_id": 2, "order_time": at(60)}, {"order_id": 3, "order_time": at(60)}]])
    refunds = feed(b, [[{"order_id": 1, "refund_id": "x", "refund_time": at(300)}], [{"order_id": 2, "refund_id": "y", "refund_time": at(361)}, {"order_id": 3, "refund_id": "z", "refund_time": at(10)}]])
    def parse(df, schema):
        return df.select(F.from_json("value", schema).alias("r")).select("r.*")
    for source in (live, batch):
        joined = cdc.order_refund_interval_join(parse(source(spark, orders), "order_id int, order_time timestamp"), parse(source(spark, refunds), "order_id int, refund_id string, refund_time timestamp"))
        got = streams.run_to_parquet(joined, "join") if source is live else joined
        assert as_rows(got, "order_id", "refund_id") == [(1, "x"), (3, "z")]


def watched(spark, stream, name, seconds=40):
    """Rows of a stream with timers. Such a stream has always one more batch to run, so it is watched and stopped."""
    q = (stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(processingTime="1 second")
         .option("checkpointLocation", scratch(spark, name)).start())
    try:
        end = time.time() + seconds
        while time.time() < end and not spark.table(name).count():
            assert q.isActive, q.exception()
            time.sleep(0.5)
        time.sleep(3)
        return sorted(tuple(r) for r in spark.table(name).collect())
    finally:
        q.stop()


def test_snapshot_completion_by_first_change(spark, tmp_path, as_rows):
    files = [[change("t", "r", 1, id=1), change("t", "r", 2, id=2)], [change("t", "u", 7, id=1), change("t", "c", 5, id=3)], [change("t", "u", 9, id=1), change("s", "r", 3, id=1)]]
    folder = feed(tmp_path, files)
    done = watched(spark, dedup.snapshot_completion_stream(streams.parsed(live(spark, folder), schemas.ENVELOPE), quiet_seconds=3600), "by_change")
    whole = streams.parsed(batch(spark, folder), schemas.ENVELOPE)
    assert done == [("t", 5, "change")]
    assert as_rows(cdc.snapshot_completion(whole)) == [("t", 5)]
    assert cdc.snapshot_phase_filter(whole).count() == 3


def test_snapshot_completion_after_quiet_time(spark, tmp_path):
    folder = feed(tmp_path, [[change("t", "r", 1, id=1)]])
    done = watched(spark, dedup.snapshot_completion_stream(streams.parsed(live(spark, folder), schemas.ENVELOPE), quiet_seconds=1), "by_quiet")
    assert [(table, reason) for table, _, reason in done] == [("t", "quiet")]


def test_snapshot_state_has_few_tasks(spark, monkeypatch):
    """Every task of the state starts a Python worker in every batch; there is one row a table."""
    from bindings import changes
    from bindings.catalog import QUERIES

    kept, run = scratch(spark, "few-tasks"), streams.run_until_idle
    monkeypatch.setattr(changes.streams, "run_until_idle", lambda *a, **b: run(*a, checkpoint=kept, **b))
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        done = QUERIES["stream_snapshot_completion"](spark, "/root/testdata/sf0.001").collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    assert sorted((r["table"], r["reason"]) for r in done) == [("base_supplier", "quiet"), ("order_info", "change")]
    assert len([n for n in os.listdir(f"{kept}/state/0") if n.isdigit()]) <= 8


def test_closed_windows_pass_one_state_store(spark):
    """All parts of a window come with the batch that closes it, so adding them up needs no state of its own."""
    from bindings.catalog import QUERIES

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/*-checkpoint-*/state/*"))
    assert QUERIES["stream_user_order_window"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(set(glob.glob(f"{root}/*-checkpoint-*/state/*")) - before) == 1


def test_running_aggregate_is_upserted(spark, tmp_path, as_rows):
    rng = random.Random(8)
    rows = [{"order_detail_id": f"d{rng.randrange(5)}", "order_id": 1, "user_id": 2, "sku_id": None, "order_amount": rng.choice([None, 1.0 * n]), "pay_amount": None,
             "refund_amount": rng.choice([None, 2.0 * n]), "ts": n} for n in range(40)]
    folder = feed(tmp_path, [rows[:10], rows[10:11], rows[11:]])
    schema = "order_detail_id string, order_id int, user_id int, sku_id int, order_amount double, pay_amount double, refund_amount double, ts bigint"
    def merged(df):
        return cdc.order_lifecycle_merge(df.select(F.from_json("value", schema).alias("r")).select("r.*"))
    got = jobs.upsert_updates_job(merged(live(spark, folder)), ["order_detail_id"])
    assert as_rows(got) == as_rows(merged(batch(spark, folder)))


def test_first_rows_of_a_stream(spark, tmp_path):
    folder = feed(tmp_path, [["a", "b", "c"], ["d"], ["e"]])
    assert streams.run_to_parquet(streams.first_rows(live(spark, folder), 4), "first").count() == 4


def test_topic_rows(spark, as_rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, sink string")
    got = as_rows(streams.topic_rows(df, F.col("sink"), key="id"))
    assert got == [("a", '{"id":1,"sink":"a"}', "1"), ("b", '{"id":2,"sink":"b"}', "2")]


def test_empty_input(spark, tmp_path):
    folder = feed(tmp_path, [[]])
    parts = logs.split_app_log(batch(spark, folder))
    assert all(df.count() == 0 for df in parts.values())
    assert streams.run_to_parquet(logs.split_app_log(live(spark, folder))["page"], "empty").count() == 0


@pytest.mark.parametrize("missing", ["user_id", "brand_id"])
def test_preference_without_values(spark, missing):
    row = {"user_id": 1, "behavior_type": "view", "brand_id": "b", "category3_id": "c", "platform": "p", missing: None}
    df = spark.createDataFrame([row], "user_id int, behavior_type string, brand_id string, category3_id string, platform string")
    assert users.user_preference(df, "left").count() == 0
    assert users.user_preference(df, "full").count() == (0 if missing == "user_id" else 1)


def test_equal_times_have_one_answer(spark, as_rows):
    rows = [("d", "o", "u", 1.0, 5), ("d", "o", "u", 3.0, 5), ("d", "o", "u", 2.0, 5)]
    df = spark.createDataFrame(rows, "order_detail_id string, order_id string, user_id string, pay_amount double, ts bigint").selectExpr(
        "*", "cast(null as string) as sku_id", "cast(null as double) as order_amount", "cast(null as double) as refund_amount")
    for parts in (1, 3):
        assert as_rows(cdc.order_lifecycle_merge(df.repartition(parts)), "order_detail_id", "pay_amount") == [("d", 3.0)]


def test_first_rows_are_those_of_the_file(spark):
    """A file cut into several tasks is read from its start."""
    folder = scratch(spark, "long")
    spark.range(200000, 0, -1).selectExpr("concat(id, '-', repeat('x', 100)) AS value").coalesce(1).write.text(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got = streams.run_to_parquet(streams.first_rows(streams.text_stream(spark, "text", folder, files_per_batch=1), 100), "first")
        assert sorted(int(r.value.split("-")[0]) for r in got.collect()) == list(range(199901, 200001))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wide_orders_job_makes_no_call_a_key(spark, tmp_path, monkeypatch):
    """Every key of a processor costs calls into Python; the job needs none."""
    def refused(*_, **__):
        raise AssertionError("a processor")

    monkeypatch.setattr(state, "stateful", refused)
    folder = feed(tmp_path, [order_changes()])
    assert jobs.order_wide_job(streams.parsed(live(spark, folder), schemas.ENVELOPE)).count() > 0


def test_wide_orders_job_keeps_no_state(spark, tmp_path, monkeypatch):
    """A state store holds all rows a second time, and its checkpoint a third time."""
    made = []
    monkeypatch.setattr(streams, "scratch", lambda s, name: made.append(scratch(s, name)) or made[-1])
    folder = feed(tmp_path, [order_changes()])
    assert jobs.order_wide_job(streams.parsed(live(spark, folder), schemas.ENVELOPE)).count() == 16
    assert made and all(os.path.exists(path) for path in made) and not any(os.path.exists(f"{path}/state") for path in made)


@pytest.fixture
def few_bytes(spark, monkeypatch):
    """Any records are many; four buckets."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    monkeypatch.setattr(cdc, "LOG_BYTES", -1)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def odd_changes():
    """Equal times, equal rows, keys that are missing, tables that are not wanted, rows without ``after``."""
    rng, out = random.Random(21), []
    for _ in range(400):
        o, d, t = rng.randrange(12), rng.randrange(30), rng.randrange(3)
        some = {"order_id": o, "sku_id": rng.randrange(4), "sku_name": rng.choice("ab"), "activity_id": rng.randrange(3), "coupon_id": rng.randrange(3),
                "user_id": rng.randrange(5), "total_amount": rng.randrange(3), "refund_amount": rng.randrange(3), "refund_create_time": rng.randrange(2)}
        after = {k: v for k, v in some.items() if rng.random() < 0.8}
        table = rng.choice([*cdc.WIDE_TABLES, "user_info"])
        key = {"order_detail": {"id": d}, "order_info": {"id": o}, "order_detail_activity": {"order_detail_id": d}, "order_detail_coupon": {"order_detail_id": d}}.get(table, {"id": d})
        out.append(change(table, "u", t, **after, **({} if rng.random() < 0.05 else key)))
    return [*out, *out[:50], {"op": "d", "source": {"db": "d", "table": "order_detail"}, "ts_ms": 9}]


@pytest.mark.parametrize("changes", [order_changes, odd_changes])
def test_wide_orders_of_many_records(spark, tmp_path, as_rows, few_bytes, changes):
    """Many records are reduced from files by key, and the same rows come out; nothing is shuffled, and what was reduced is gone."""
    rows = changes()
    folder = feed(tmp_path, [rows[:7], rows[7:20], rows[20:]])
    envelopes = streams.parsed(batch(spark, folder), schemas.ENVELOPE)
    want = cdc.wide_of_rows(cdc.order_rows(envelopes))
    got = cdc.cdc_order_wide(envelopes)
    assert got.columns == want.columns and as_rows(got) == as_rows(want) and got.count() > 10
    assert "Exchange hashpartitioning" in want._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    streamed = jobs.order_wide_job(streams.parsed(live(spark, folder), schemas.ENVELOPE))
    assert as_rows(streamed, *want.columns) == as_rows(want)
    kept = spark.conf.get("spark.checkpoint.dir")
    assert glob.glob(f"{kept}/wide_rows-*/side=order") and not glob.glob(f"{kept}/wide_rows-*/side=detail-*")


def test_lifecycle_events_in_one_pass(spark, as_rows):
    lines = spark.createDataFrame([("a", 1, 5, 3, True, True), ("b", 2, 6, 4, False, False), (None, 3, 7, 4, True, True)],
                                  "order_detail_id string, order_id int, user_id int, sku_id int, paid boolean, back boolean")
    sku, order = F.col("sku_id"), F.col("order_id")
    got = cdc.lifecycle_events_of(lines, {"order_amount": (None, order + 10, order * 100), "pay_amount": (F.col("paid"), order, order * 100 + 1),
                                          "refund_amount": (F.col("back"), sku, order * 100 + 2)})
    parts = [lines.where(where).withColumns({"total_amount": F.expr(amount), "ts": F.expr(ts)})
             for where, amount, ts in (("true", "order_id + 10", "order_id * 100"), ("paid", "order_id", "order_id * 100 + 1"), ("back", "sku_id", "order_id * 100 + 2"))]
    want = cdc.lifecycle_events(*parts)
    assert as_rows(got, *want.columns) == as_rows(want)


def test_lifecycle_joins_its_orders_once(spark):
    from bindings.catalog import QUERIES

    plan = QUERIES["order_lifecycle_merge"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def refuse_processors(monkeypatch):
    def refused(*_, **__):
        raise AssertionError("a processor")

    monkeypatch.setattr(state, "stateful", refused)


@pytest.mark.parametrize("keep, times", [("1 hour", 1), ("1 second", 2)])
def test_exact_copies_make_no_call_a_key_and_are_forgotten(spark, tmp_path, monkeypatch, keep, times):
    """Three runs of one query: a copy of the first record comes once another batch has told that time went on."""
    refuse_processors(monkeypatch)
    folder, out, checkpoint = feed(tmp_path, [['{"id": 1}', '{"id": 1}']]), scratch(spark, "out"), scratch(spark, "cp")
    for n, line in enumerate([None, '{"id": 2}', '{"id": 1}']):
        if line:
            time.sleep(2 if n == 1 else 0)
            (tmp_path / "in" / f"more{n}.txt").write_text(f"{line}\n{line}\n")
        once = state.exactly_once(live(spark, folder).select(F.from_json("value", "id int").alias("r")).select("r.*"), keep=keep)
        (once.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1] * times + [2]


def test_preference_job_makes_no_call_a_key(spark, tmp_path, as_rows, monkeypatch):
    refuse_processors(monkeypatch)
    rng = random.Random(21)
    rows = [{"user_id": rng.choice([1, 2, None]), "behavior_type": rng.choice(["view", "cart", "pay", "search"]), "brand_id": rng.choice(["a", "b", None]),
             "category3_id": rng.choice(["x", "y"]), "platform": rng.choice(["p", "q", None])} for _ in range(200)]
    folder = feed(tmp_path, [rows[:20], rows[20:21], rows[21:]])
    schema = "user_id bigint, behavior_type string, brand_id string, category3_id string, platform string"
    def parse(df):
        return df.select(F.from_json("value", schema).alias("r")).select("r.*")
    want = users.user_preference(parse(batch(spark, folder)), "full")
    assert as_rows(jobs.preference_job(parse(live(spark, folder))), *want.columns) == as_rows(want, *want.columns)
