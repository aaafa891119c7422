"""Small hand-worked cases of batch operators."""

from collections import Counter

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemill.functions import columns as c
from tidemill.functions import text
from tidemill.operators.joins import full_join, lookup_within, region_chain
from tidemill.operators.latest import dim_upsert_latest, latest_by_key, scd2_merge
from tidemill.operators.recent import recent_days, roll_forward
from tidemill.plans import dims, facts, pages, products, reports, summaries, transport, visits
from tidemill.streaming.dedup import dedup_bounded


def test_first_purchase_in_month(spark, as_rows):
    df = spark.createDataFrame([("a", "2020-10-03", 5), ("a", "2020-10-04", 6), ("b", "2020-09-01", 7), ("b", "2020-10-09", 8),
                                ("c", "2020-10-07", 1), ("c", "2020-10-07", 2)], "user_id string, t string, money int")
    df = df.select("user_id", F.to_date("t").alias("pay_time"), "money")
    assert as_rows(visits.first_purchase_in_month(df, 10), "user_id", "money") == [("a", 5), ("c", 1), ("c", 2)]


def test_monthly_visits(spark, as_rows):
    df = spark.createDataFrame([("x", "2020-01-05", 2), ("x", "2020-01-09", 3), ("x", "2020-03-01", 4), ("y", "2020-02-01", 7)],
                               "user_id string, d string, visit_count int").select("user_id", F.to_date("d").alias("visit_date"), "visit_count")
    assert as_rows(visits.monthly_visits(df)) == [("x", "2020-01", 5, 5), ("x", "2020-03", 4, 9), ("y", "2020-02", 7, 7)]


def test_shop_top_visitors_keeps_ties(spark, as_rows):
    df = spark.createDataFrame([("s", u) for u in "aaabbccdde"], "shop string, user_id string")
    got = as_rows(visits.shop_top_visitors(df, 3))
    assert got == [("s", "a", 3, 1), ("s", "b", 2, 2), ("s", "c", 2, 2), ("s", "d", 2, 2)]


def test_two_day_active(spark):
    d = [("u1", 20, "2020-01-01"), ("u1", 20, "2020-01-02"), ("u2", 30, "2020-01-01"), ("u2", 30, "2020-01-03"), ("u3", 20, "2020-01-09")]
    df = spark.createDataFrame(d, "user_id string, age int, d string").select("user_id", "age", F.to_date("d").alias("visit_date"))
    assert tuple(visits.two_day_active(df).first()) == (3, 1, 25.0, 20.0)


def test_totals_with_share(spark, as_rows):
    df = spark.createDataFrame([("p", 10), ("q", 30), ("p", 20), ("r", 40)], "name string, amount int")
    want = [("p", 30, 2, "30.00%"), ("q", 30, 3, "30.00%"), ("r", 40, 1, "40.00%")]
    assert as_rows(visits.totals_with_share(df)) == want


def test_daily_new_returning_counts_users_once(spark, as_rows):
    df = spark.createDataFrame([("a", "2020-01-01"), ("a", "2020-01-01"), ("a", "2020-01-02"), ("b", "2020-01-02")], "user_id string, d string")
    df = df.select("user_id", F.to_date("d").alias("login_date"))
    assert as_rows(visits.daily_new_returning(df)) == [(date(2020, 1, 1), 1, 0), (date(2020, 1, 2), 1, 1)]


def test_masks(spark):
    df = spark.createDataFrame([("Anna", "13812345678", "a.b@x.org"), (None, "12812345678", "no mail"), ("Bo", "19912345678", "ab@mail.x.org")],
                               "name string, phone_num string, email string")
    first = [tuple(r) for r in dims.mask_pii(df).collect()]
    assert first == [("A*", "138*", None), (None, None, None), ("B*", "199*", "*@mail.x.org")]
    daily = [tuple(r) for r in dims.mask_pii(df, daily=True).collect()]
    assert daily == [("A*", "138****5678", "***@x.org"), (None, None, None), ("B*", "199****5678", "***@mail.x.org")]


def test_scd2_merge(spark, as_rows):
    open_end = date(9999, 12, 31)
    history = spark.createDataFrame([(1, "old", date(2020, 1, 1), open_end), (2, "same", date(2020, 2, 1), open_end),
                                     (3, "closed", date(2019, 1, 1), date(2019, 6, 1)), (3, "now", date(2019, 6, 2), open_end)],
                                    "id int, name string, start_date date, end_date date")
    changes = spark.createDataFrame([(1, "new", 1), (1, "newer", 2), (4, "first", 1)], "id int, name string, ts int")
    got = as_rows(scd2_merge(history, changes, "id", "2020-03-01", ["ts"]))
    assert got == sorted([
        (1, "old", date(2020, 1, 1), date(2020, 2, 29)), (1, "newer", date(2020, 3, 1), open_end), (2, "same", date(2020, 2, 1), open_end),
        (3, "closed", date(2019, 1, 1), date(2019, 6, 1)), (3, "now", date(2019, 6, 2), open_end), (4, "first", date(2020, 3, 1), open_end)], key=repr)


def test_latest_skips_deletes(spark, as_rows):
    df = spark.createDataFrame([(1, "c", "a", 1), (1, "u", "b", 2), (1, "d", None, 3), (2, "d", "x", 1)], "id int, op string, v string, ts int")
    assert as_rows(dim_upsert_latest(df, ["id"], ["ts"])) == [(1, "b", 2)]
    assert as_rows(latest_by_key(df, ["id"], ["ts"]), "id", "op") == [(1, "d"), (2, "d")]


def test_recent_days_takes_both_ends(spark, as_rows):
    df = spark.createDataFrame([(date(2020, 1, d),) for d in (1, 2, 3, 24, 25, 30, 31)], "dt date")
    got = recent_days(df, "2020-01-30").groupBy("recent_days").count()
    assert as_rows(got) == [(1, 1), (30, 6), (7, 3)]


def test_weekend_and_week(spark):
    cal = {str(r["date"]): r for r in dims.dim_date(spark, "2024-01-05", "2024-01-08", ["2024-01-08"]).collect()}
    assert [cal[d]["is_weekend"] for d in sorted(cal)] == ["N", "Y", "Y", "N"]
    assert cal["2024-01-08"]["is_holiday"] == "Y" and cal["2024-01-07"]["week"] == 1


def test_user_order_td_roll_forward_equals_full_build(spark, as_rows):
    days = [(date(2020, 1, d), u, 1, d, 1, 1, 1, 1) for d in range(1, 6) for u in (1, 2, 3) if (d + u) % 3]
    df = spark.createDataFrame(days, "dt date, user_id int, order_count_1d long, order_num_1d long, order_original_amount_1d long, "
                                     "activity_reduce_amount_1d long, coupon_reduce_amount_1d long, order_total_amount_1d long")
    rolled = summaries.user_order_td(df, "2020-01-01")
    for d in range(2, 6):
        rolled = summaries.user_order_td_forward(rolled, df, f"2020-01-0{d}")
    assert as_rows(rolled) == as_rows(summaries.user_order_td(df, "2020-01-05"))


def test_consecutive_days_need_three_in_a_row(spark):
    def days(user, *ds):
        return [(user, date(2020, 1, d)) for d in ds]

    df = spark.createDataFrame(days(1, 2, 3, 4) + days(2, 4, 6) + days(3, 5, 6) + days(4, 1, 2, 3, 5, 6, 7), "user_id int, dt date")
    assert reports.consecutive_order_users(df, "2020-01-07").first()["order_continuously_user_count"] == 2


def test_full_join_of_three_keeps_one_row_per_key(spark, as_rows):
    a = spark.createDataFrame([(1, 10)], "k int, a int")
    b = spark.createDataFrame([(2, 20)], "k int, b int")
    d = spark.createDataFrame([(2, 30), (3, 31)], "k int, d int")
    assert as_rows(full_join([a, b, d], ["k"]), "k", "a", "b", "d") == [(1, 10, None, None), (2, None, 20, 30), (3, None, None, 31)]


def test_driver_rows_with_equal_numbers_all_count(spark, as_rows):
    cols = "recent_days int, driver1_emp_id int, driver1_name string, driver2_emp_id int, driver2_name string, trans_finish_count long, " \
           "trans_finish_distance decimal(16,2), trans_finish_dur_sec long, trans_finish_delay_count long"
    from decimal import Decimal
    r = (7, 1, "a", None, None, 1, Decimal(10), 100, 0)
    both = (7, 1, "a", 2, "b", 3, Decimal(5), 31, 1)
    got = as_rows(transport.driver_stats(spark.createDataFrame([r, r, both], cols), "2020-01-01"),
                  "driver_id", "trans_finish_count", F.col("trans_finish_distance").cast("double"), F.col("trans_finish_dur_sec").cast("double"), "trans_finish_late_count")
    assert got == [(1, 5, 22.5, 215.5, 1), (2, 3, 2.5, 15.5, 1)]


def test_region_chain(spark, as_rows):
    df = spark.createDataFrame([("d", "D", "c"), ("c", "C", "p"), ("p", "P", None)], "id string, name string, parent_id string")
    assert as_rows(region_chain(df), "region_id", "up1_id", "up2_id") == [("c", "p", None), ("d", "c", "p"), ("p", None, None)]


def test_entry_conversion_counts_orders_once(spark, as_rows):
    entry = spark.createDataFrame([(1, "home"), (1, "home"), (1, "detail"), (2, "home")], "user_id int, entry_page string")
    orders = spark.createDataFrame([(1, 10, "paid"), (1, 11, "created"), (2, 12, "created"), (3, 13, "paid")], "user_id int, order_id int, order_status string")
    assert as_rows(pages.entry_conversion(entry, orders), "page_id", "order_cnt", "pay_cnt") == [("detail", 2, 1), ("home", 3, 1)]


def test_path_text_is_in_order_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(pages, "CHAIN_CHUNK", 3)
    steps = [(1, "s", f"p{n}", n // 2, n) for n in range(12)]  # two visits at each time
    log = spark.createDataFrame(steps, "user_id int, session_id string, page_id string, event_time int, log_id int").repartition(3)
    stay = spark.createDataFrame([(1, 4)], "user_id int, duration int")
    for moves in (pages.page_transitions(log), pages.page_transitions(log, number="rn")):
        row = pages.user_flow_path(moves, stay, "2020-01-01").first()
        assert row["session_id"] == "s" and row["path_chain"] == "->".join(f"p{n}->p{n + 1}" for n in range(11))


def test_page_path_hot_session(spark, as_rows):
    log = spark.createDataFrame([("s", n, f"p{n % 3}") for n in range(50)] + [("t", 1, "p0")], "session_id string, view_time int, page_id string")
    steps = Counter((f"step-{n + 1}:p{n % 3}", f"step-{n + 2}:p{(n + 1) % 3}" if n < 49 else "null") for n in range(50))
    steps[("step-1:p0", "null")] += 1
    assert as_rows(reports.page_path(log)) == sorted(((*k, n) for k, n in steps.items()), key=repr)


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (None, 3.0), (1.0, None)], "a double, b double")
    got = [tuple(r) for r in df.select(c.ratio("a", "b"), c.ratio_over_one("a", "b"), c.ratio_or_null("a", "b")).collect()]
    assert got == [(0.0, 1.0, None), (0.3333, 0.3333, 0.3333), (None, None, None), (0.0, None, None)]


def test_amount_per_rounds_halves_up(spark):
    df = spark.sql("select cast(a as decimal(16,2)) a, n from values (7.35, 6), (270.59, 2), (1, 0) t(a, n)")
    assert [float(r[0]) for r in df.select(c.amount_per("a", "n")).collect()] == [1.23, 135.3, 0.0]


def test_last_part(spark):
    texts = ["a,b", "a,b,,", ",", "", "x", "a,b\n", "a,\n"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text.last_part("t")).collect()]
    assert got == ["b", "b", "", "", "x", "b\n", "\n"]


def test_words(spark):
    df = spark.createDataFrame([("Été 2024: l'ÉTÉ, x_y",)], "t string")
    assert df.select(text.words("t")).first()[0] == ["été", "2024", "l", "été", "x", "y"]


def test_sensitive_words_match_whole_last_part(spark, as_rows):
    messages = spark.createDataFrame([(1, "fine,bad"), (2, "bad,fine"), (3, "badly")], "user_id int, msg string")
    listed = spark.createDataFrame([("bad",), ("bad",)], "word string")
    got = as_rows(text.flag_sensitive_messages(messages, listed), "user_id", "is_violation", "violation_grade", "violation_msg")
    assert got == [(1, 1, "P0", "bad"), (2, 0, "", ""), (3, 0, "", "")]


def test_timestamps_keep_one_zone(spark):
    at = spark.range(1).select(c.event_time(F.lit(1704067200123)).alias("t")).select("t", c.epoch_ms("t"), c.date_id("t")).first()
    assert at[0] == datetime(2024, 1, 1, 0, 0, 0, 123000) and at[1] == 1704067200123 and at[2] == "2024-01-01"


def test_module_styles_do_not_change_between_runs(spark, as_rows):
    df = spark.range(40).select(F.col("id").alias("module_id"))
    first = as_rows(pages.dim_page_module(df))
    assert first == as_rows(pages.dim_page_module(df.repartition(3))) and {s for _, s in first} == {"Card", "Banner", "Slider", "List"}


def test_saved_table_is_replaced(spark, as_rows):
    from tidemill.sources import tables

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, dt string")
    for _ in range(2):
        tables.save_table(df, "saved_rows", partition_by=["dt"])
    assert as_rows(spark.table("saved_rows")) == [(1, "a"), (2, "b")]
    spark.sql("drop table saved_rows")


def test_calendar_and_masks_accept_nulls(spark):
    df = spark.createDataFrame([(None,)], "phone_num string")
    assert dims.mask_pii(df, name=None, email=None).first()[0] is None


def test_scd2_merge_twice_is_merge_once(spark, as_rows):
    history = spark.createDataFrame([(1, "a", "2020-01-01", "9999-12-31"), (2, "b", "2020-01-01", "9999-12-31"), (1, "z", "2019-01-01", "2019-12-31")],
                                    "id int, v string, s string, e string").selectExpr("id", "v", "cast(s as date) as start_date", "cast(e as date) as end_date")
    changes = spark.createDataFrame([(1, "c"), (3, "d")], "id int, v string")
    once = scd2_merge(history, changes, "id", "2020-03-01")
    assert as_rows(scd2_merge(once, changes, "id", "2020-03-01")) == as_rows(once)
    assert once.where("start_date > end_date").count() == 0 and once.count() == 5


def test_roll_forward_twice_is_once(spark, as_rows):
    old = spark.createDataFrame([(1, "2020-01-01", "2020-02-01", 5), (2, "2020-01-02", "2020-02-02", 7)], "u int, f string, l string, n int").selectExpr(
        "u", "cast(f as date) as f", "cast(l as date) as l", "cast(n as bigint) as n")
    new = spark.createDataFrame([(1, 2), (3, 4)], "u int, d int")
    once = roll_forward(old, new, ["u"], {"n": "d"}, "2020-03-01", "f", "l")
    assert as_rows(roll_forward(once, new, ["u"], {"n": "d"}, "2020-03-01", "f", "l")) == as_rows(once)
    assert as_rows(once, "u", "n") == [(1, 7), (2, 7), (3, 4)]


def test_bounded_copies_further_apart_both_stay(spark, as_rows):
    rows = [("a", "2020-01-01 00:00:00"), ("a", "2020-01-01 00:30:00"), ("a", "2020-01-01 00:30:00"), ("a", "2020-01-08 00:00:00"), ("b", "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "k string, t string").selectExpr("k", "cast(t as timestamp) as t")
    assert as_rows(dedup_bounded(df, ["k"], "t", "1 hour").selectExpr("k", "day(t)")) == [("a", 1), ("a", 8), ("b", 1)]


def test_efficiency_over_days_weighs_by_visitors(spark, as_rows):
    keys = [("p", "s", "2024-06-01"), ("p", "s", "2024-06-02"), ("p", "s", "2024-06-03"), ("q", "s", "2024-06-01")]
    seen = [(10, 8, 2.0, 0.5, 3), (40, 2, 12.0, 0.25, None), (0, 0, None, None, 0), (0, 0, None, None, 0)]
    visit = spark.createDataFrame([k + v for k, v in zip(keys, seen)],
                                  "product_id string, store_id string, dt string, pv long, uv long, avg_stay_time double, bounce_rate double, micro_detail_uv long")
    fav = spark.createDataFrame([keys[0] + (4,)], "product_id string, store_id string, dt string, fav_user_cnt long")
    cart = spark.createDataFrame([keys[1] + (1, 2)], "product_id string, store_id string, dt string, cart_user_cnt long, cart_total_qty long")
    orders = spark.createDataFrame([keys[0] + (2, 3, 30.0, 2, 2, 25.0, 1.0)], "product_id string, store_id string, dt string, order_user_cnt long, "
                                   "order_total_qty long, order_total_amt double, pay_user_cnt long, pay_total_qty long, pay_total_amt double, refund_amt double")
    daily = products.product_efficiency_overview(visit, fav, cart, orders)
    assert as_rows(daily, "dt", "avg_stay_time", "bounce_rate", "fav_user_cnt", "pay_rate") == sorted([
        ("2024-06-01", 2.0, 0.5, 4, 0.25), ("2024-06-02", 12.0, 0.25, None, None), ("2024-06-03", None, None, None, 0.0), ("2024-06-01", None, None, None, 0.0)], key=repr)
    added = products.efficiency_over_days(daily, ["product_id"])
    got = as_rows(added, "product_id", "days", "pv", "uv", "avg_stay_time", "bounce_rate", "fav_user_cnt", "cart_total_qty", "pay_rate")
    # (8 * 2 + 2 * 12) / 10 and (10 * 0.5 + 40 * 0.25) / 50, not the plain means 7 and 0.375
    assert got == [("p", 3, 50, 10, 4.0, 0.3, 4, 2, 0.2), ("q", 1, 0, 0, None, None, 0, 0, 0.0)]


def test_order_to_pay_is_rounded(spark):
    """(1 + 2 + 2) / 3 and (1 + 2) / 2 seconds are two; a payment of another day and none at all."""
    for gaps, want in (([1, 2, 2], 2), ([1, 2], 2), ([2, 3], 2), ([], None)):
        flow = [("2020-01-02", f"2020-01-02 00:00:0{g}") for g in gaps] + [("2020-01-03", "2020-01-02 00:00:09")]
        df = spark.createDataFrame(flow, "payment_date_id string, t string").select(
            "payment_date_id", F.col("t").cast("timestamp").alias("payment_time"), F.lit("2020-01-02").cast("timestamp").alias("order_time"))
        assert tuple(reports.order_to_pay_avg_seconds(df, "2020-01-02").first()) == (date(2020, 1, 2), want)


def test_lookup_within_gives_what_a_left_join_gives(spark, as_rows):
    """Two matches, two equal rows, no match, the key of another order, no key, no order."""
    lines = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (1, "b", 7), (2, "c", 8), (2, None, 9), (None, "a", 0)], "order_id long, id string, n int")
    cuts = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", "z"), (2, "c", None), (2, None, "v"), (None, "a", "w")],
                                 "order_id long, line string, cut string")
    got = lookup_within(lines, cuts, "order_id", "id", "line", ["cut"])
    same = lines.join(cuts.withColumnRenamed("line", "id"), ["order_id", "id"], "left")
    assert got.columns == ["order_id", "id", "n", "cut"] and as_rows(got) == as_rows(same) and got.count() == 8


def test_benefits_without_an_order_are_met_by_line(spark, as_rows):
    detail = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, order_id long")
    activity = spark.createDataFrame([(1, "a", 3, 4), (2, "c", 5, 6)], "order_id long, order_detail_id string, activity_id int, activity_rule_id int")
    coupon = spark.createDataFrame([(1, "b", 7)], "order_id long, order_detail_id string, coupon_id int")
    want = [("a", 3, 4, None), ("b", None, None, 7), ("c", 5, 6, None)]
    for a, b in ((activity, coupon), (activity.drop("order_id"), coupon), (activity.drop("order_id"), coupon.drop("order_id"))):
        assert as_rows(facts._with_benefits(detail, a, b), "id", "activity_id", "activity_rule_id", "coupon_id") == want
