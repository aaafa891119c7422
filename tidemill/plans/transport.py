"""Logistics: summaries per organisation, shift and truck, and the results drawn from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, count_where, day, mean
from tidemill.operators.joins import lookup, region_chain
from tidemill.operators.recent import recent_days

PLACE = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]
CITY, ORG, PROVINCE = ["city_id", "city_name"], ["org_id", "org_name"], ["province_id", "province_name"]
TRIP_SUMS = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
ND = (7, 30)


# summaries

def _org_of_district(org: DataFrame) -> DataFrame:
    return org.select(F.col("region_id").alias("_district"), F.col("id").alias("org_id"), "org_name")


def _district_places(org: DataFrame, region: DataFrame) -> DataFrame:
    """Organisations with the city and province above their district."""
    chain = region_chain(region)
    return org.join(chain, "region_id", "left").select(
        F.col("id").alias("org_id"), "org_name", F.col("up1_id").alias("city_id"), F.col("up1_name").alias("city_name"),
        F.col("up2_id").alias("province_id"), F.col("up2_name").alias("province_name"),
    )


def _level_places(org: DataFrame, region: DataFrame) -> DataFrame:
    """City and province by organisation level: a level-1 organisation sits in a city, any other in a district."""
    chain = region_chain(region.select("id", "name", "parent_id"))
    at_city = F.col("org_level") == 1

    def pick(city_level: str, below: str):
        return F.when(at_city, F.col(city_level)).otherwise(F.col(below))

    return org.select("id", "org_name", "org_level", "region_id").join(chain, "region_id", "left").select(
        F.col("id").alias("org_id"), "org_name",
        pick("region_id", "up1_id").alias("city_id"), pick("region_name", "up1_name").alias("city_name"),
        pick("up1_id", "up2_id").alias("province_id"), pick("up1_name", "up2_name").alias("province_name"),
    )


def _place_sums(rows: DataFrame, places: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Attach places to a small aggregate, then merge rows that share a place."""
    named = lookup(rows, places, key, "org_id", keep_key=False) if key != "org_id" else rows.join(places, "org_id", "left")
    return named.groupBy("dt", *PLACE).agg(*[F.sum(m).alias(m) for m in measures])


def org_cargo_order_1d(order_detail: DataFrame, org: DataFrame, region: DataFrame) -> DataFrame:
    """Orders and amount per origin organisation, city and cargo; an order counts once with its largest amount."""
    per_order = order_detail.groupBy(
        "dt", "order_id", "cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id"
    ).agg(F.max("amount").alias("amount"))
    per_district = per_order.groupBy("dt", "cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount")
    )
    orgs = _org_of_district(org)
    by_org = per_district.join(orgs, F.col("sender_district_id") == F.col("_district"), "left").groupBy(
        "dt", *ORG, F.col("sender_city_id").alias("city_id"), "cargo_type", "cargo_type_name"
    ).agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))
    city = region.select("id", F.col("name").alias("city_name"))
    return lookup(by_org, city, "city_id", "id").select(
        "dt", *ORG, *CITY, "cargo_type", "cargo_type_name", "order_count", "order_amount"
    )


def _last_days(daily: DataFrame, as_of: Day, measures: Sequence[str]) -> DataFrame:
    keys = [c for c in daily.columns if c not in ("dt", *measures)]
    return recent_days(daily, as_of, ND).groupBy("recent_days", *keys).agg(*[F.sum(m).alias(m) for m in measures])


def org_cargo_order_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return _last_days(daily, as_of, ["order_count", "order_amount"])


def dispatch_1d(dispatch: DataFrame) -> DataFrame:
    per_order = dispatch.groupBy("dt", "order_id").agg(F.max("amount").alias("amount"))
    return per_order.groupBy("dt").agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def dispatch_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return _last_days(daily, as_of, ["order_count", "order_amount"])


def dispatch_td(daily: DataFrame, as_of: Day) -> DataFrame:
    return daily.where(F.col("dt") <= day(as_of)).agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount")
    )


def bound_finish_td(bound_finish: DataFrame, as_of: Day) -> DataFrame:
    per_order = bound_finish.where(F.col("dt") <= day(as_of)).groupBy("order_id").agg(F.max("amount").alias("amount"))
    return per_order.agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def org_deliver_suc_1d(deliver: DataFrame, org: DataFrame, region: DataFrame) -> DataFrame:
    """Delivered orders per organisation of the receiving district."""
    per_district = deliver.groupBy("dt", "order_id", "receiver_district_id").agg(F.lit(1).alias("_one")).groupBy(
        "dt", "receiver_district_id"
    ).agg(F.count("order_id").alias("order_count"))
    orgs = _org_of_district(org).select("_district", "org_id")
    rows = per_district.join(orgs, F.col("receiver_district_id") == F.col("_district"), "left")
    return _place_sums(rows, _district_places(org, region), "org_id", ["order_count"])


def org_receive_1d(receive: DataFrame, org: DataFrame, region: DataFrame) -> DataFrame:
    """Collected orders and amount; an order counts once per organisation."""
    orgs = _org_of_district(org).select("_district", "org_id")
    tagged = receive.join(orgs, F.col("sender_district_id") == F.col("_district"), "left")
    per_order = tagged.groupBy("dt", "order_id", "org_id").agg(F.max("amount").alias("amount"))
    per_org = per_order.groupBy("dt", "org_id").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount")
    )
    return _place_sums(per_org, _district_places(org, region), "org_id", ["order_count", "order_amount"])


def org_sort_1d(sort: DataFrame, org: DataFrame, region: DataFrame) -> DataFrame:
    per_org = sort.groupBy("dt", "org_id").agg(F.count(F.lit(1)).alias("sort_count"))
    return per_org.join(_level_places(org, region), "org_id", "left").select("dt", *PLACE, "sort_count")


def org_deliver_suc_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return _last_days(daily, as_of, ["order_count"])


def org_receive_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return _last_days(daily, as_of, ["order_count", "order_amount"])


def org_sort_nd(daily: DataFrame, as_of: Day) -> DataFrame:
    return _last_days(daily, as_of, ["sort_count"])


def _truck_models(truck: DataFrame) -> DataFrame:
    return truck.select(F.col("id").alias("truck_id"), "truck_model_type", "truck_model_type_name")


def org_truck_finish_1d(trip: DataFrame, truck: DataFrame) -> DataFrame:
    """Finished trips, distance and seconds per organisation and truck model."""
    per_truck = trip.groupBy("dt", F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_id").agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
    )
    return per_truck.join(_truck_models(truck), "truck_id", "left").groupBy(
        "dt", *ORG, "truck_model_type", "truck_model_type_name"
    ).agg(*[F.sum(m).alias(m) for m in TRIP_SUMS])


def shift_finish_nd(
    trip: DataFrame, org: DataFrame, region: DataFrame, shift: DataFrame, truck: DataFrame, as_of: Day
) -> DataFrame:
    """Trips, distance, time, orders and late trips per shift, crew and truck over 7 and 30 days."""
    keys = ["shift_id", "line_id", "org_id", "org_name", "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name", "truck_id"]
    trips = trip.withColumnsRenamed({"start_org_id": "org_id", "start_org_name": "org_name"})
    totals = recent_days(trips, as_of, ND).groupBy("recent_days", *keys).agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"), F.sum("order_num").alias("trans_finish_order_count"),
        count_where(F.col("actual_end_time") > F.col("estimate_end_time")).alias("trans_finish_delay_count"),
    )
    places = _level_places(org, region).select("org_id", *CITY)
    wide = totals.join(places, "org_id", "left")
    wide = lookup(wide, shift, "shift_id", "id", ["line_name"])
    return wide.join(_truck_models(truck), "truck_id", "left").select(
        "shift_id", *CITY, *ORG, "line_id", "line_name", "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name",
        "truck_model_type", "truck_model_type_name", "recent_days", *TRIP_SUMS,
        "trans_finish_order_count", "trans_finish_delay_count",
    )


# results

def _one_day(daily: DataFrame, as_of: Day) -> DataFrame:
    return daily.where(F.col("dt") == day(as_of)).withColumn("recent_days", F.lit(1)).drop("dt")


def _all_windows(daily: DataFrame, nd: DataFrame, as_of: Day, columns: Sequence[str]) -> DataFrame:
    """The last day and the N-day table stacked; their windows never overlap."""
    return _one_day(daily, as_of).select("recent_days", *columns).unionByName(nd.select("recent_days", *columns))


def _sums(df: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    return df.groupBy("recent_days", *keys).agg(*[F.sum(m).alias(name) for name, m in measures.items()])


def _side_by_side(keys: Sequence[str], *sides: tuple[DataFrame, dict[str, str]]) -> DataFrame:
    """Sums of several tables by window and key, next to each other, as a full join would give them: all rows are stacked with
    the side they come from and added up in one aggregation. ``sides`` holds one bit for each table that has the key. Rows with
    a NULL in their key meet only those of their own table."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    stacked = [
        df.select("recent_days", *keys, *[F.col(m).alias(name) for name, m in measures.items()], F.lit(1 << n).alias("_side"),
                  F.when(~known, F.lit(n)).alias("_apart"))
        for n, (df, measures) in enumerate(sides)
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    names = [name for _, measures in sides for name in measures]
    return rows.groupBy("recent_days", *keys, "_apart").agg(F.bit_or("_side").alias("sides"), *[F.sum(name).alias(name) for name in names])


_ORDER = {"order_count": "order_count", "order_amount": "order_amount"}
_TRIP = {m: m for m in TRIP_SUMS}


def _trip_means():
    return [
        mean("trans_finish_distance", "trans_finish_count").alias("avg_trans_finish_distance"),
        mean("trans_finish_dur_sec", "trans_finish_count").alias("avg_trans_finish_dur_sec"),
    ]


def _dated(df: DataFrame, as_of: Day, *columns) -> DataFrame:
    return df.select(day(as_of).alias("dt"), "recent_days", *columns)


def city_stats(
    cargo_1d: DataFrame, cargo_nd: DataFrame, truck_1d: DataFrame, shift_nd: DataFrame,
    org: DataFrame, region: DataFrame, as_of: Day,
) -> DataFrame:
    """Orders next to trips per city."""
    cities = _level_places(org, region).select("org_id", *CITY)
    day_trips = truck_1d.join(cities, "org_id", "left")
    both = _side_by_side(
        CITY, (_all_windows(cargo_1d, cargo_nd, as_of, [*CITY, *_ORDER]), _ORDER),
        (_all_windows(day_trips, shift_nd, as_of, [*CITY, *TRIP_SUMS]), _TRIP))
    return _dated(both, as_of, *CITY, "order_count", "order_amount", *TRIP_SUMS, *_trip_means())


def org_stats(cargo_1d: DataFrame, cargo_nd: DataFrame, truck_1d: DataFrame, shift_nd: DataFrame, as_of: Day) -> DataFrame:
    """Orders next to trips per organisation. The N-day rows need both sides, the last day only one."""
    both = _side_by_side(
        ORG, (_all_windows(cargo_1d, cargo_nd, as_of, [*ORG, *_ORDER]), _ORDER),
        (_all_windows(truck_1d, shift_nd, as_of, [*ORG, *TRIP_SUMS]), _TRIP))
    return _dated(both.where("recent_days = 1 or sides = 3"), as_of, *ORG, *_ORDER, *TRIP_SUMS, *_trip_means())


def driver_stats(shift_nd: DataFrame, as_of: Day) -> DataFrame:
    """Trips per driver. With two drivers each gets the trip and half its distance and time.

    Every shift row counts, also when two rows of a driver carry equal numbers.
    """
    crew = F.array_compact(F.array(
        F.when(F.col("driver1_emp_id").isNotNull() | F.col("driver2_emp_id").isNull(),
               F.struct(F.col("driver1_emp_id").alias("id"), F.col("driver1_name").alias("name"))),
        F.when(F.col("driver2_emp_id").isNotNull(),
               F.struct(F.col("driver2_emp_id").alias("id"), F.col("driver2_name").alias("name"))),
    ))
    halves = F.when(F.col("driver2_emp_id").isNull(), F.lit(1)).otherwise(F.lit(2))
    rows = shift_nd.select(
        "recent_days", F.explode(crew).alias("driver"), "trans_finish_count", "trans_finish_delay_count",
        (F.col("trans_finish_distance").cast("decimal(22,4)") / halves).cast("decimal(22,4)").alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec").cast("decimal(20,1)") / halves).cast("decimal(20,1)").alias("trans_finish_dur_sec"),
    )
    totals = rows.groupBy("recent_days", F.col("driver.id").alias("driver_id"), F.col("driver.name").alias("driver_name")).agg(
        *[F.sum(m).alias(m) for m in TRIP_SUMS], F.sum("trans_finish_delay_count").alias("trans_finish_late_count")
    )
    return _dated(totals, as_of, "driver_id", "driver_name", *TRIP_SUMS, *_trip_means(), "trans_finish_late_count")


def _express(
    deliver: tuple[DataFrame, DataFrame], sort: tuple[DataFrame, DataFrame], receive: tuple[DataFrame, DataFrame],
    keys: Sequence[str], as_of: Day,
) -> DataFrame:
    """Delivered, sorted and collected side by side; each argument is a (last day, N-day) pair."""
    both = _side_by_side(
        keys, (_all_windows(*deliver, as_of, [*keys, "order_count"]), {"deliver_suc_count": "order_count"}),
        (_all_windows(*sort, as_of, [*keys, "sort_count"]), {"sort_count": "sort_count"}),
        (_all_windows(*receive, as_of, [*keys, *_ORDER]), {f"receive_{m}": m for m in _ORDER}))
    return _dated(both, as_of, *keys, "receive_order_count", "receive_order_amount", "deliver_suc_count", "sort_count")


def express_city_stats(deliver, sort, receive, as_of: Day) -> DataFrame:
    return _express(deliver, sort, receive, CITY, as_of)


def express_org_stats(deliver, sort, receive, as_of: Day) -> DataFrame:
    return _express(deliver, sort, receive, ORG, as_of)


def express_province_stats(deliver, sort, receive, as_of: Day) -> DataFrame:
    return _express(deliver, sort, receive, PROVINCE, as_of)


def express_stats(deliver: tuple[DataFrame, DataFrame], sort: tuple[DataFrame, DataFrame], as_of: Day) -> DataFrame:
    both = _side_by_side(
        [], (_all_windows(*deliver, as_of, ["order_count"]), {"deliver_suc_count": "order_count"}),
        (_all_windows(*sort, as_of, ["sort_count"]), {"sort_count": "sort_count"}))
    return _dated(both, as_of, "deliver_suc_count", "sort_count")


def line_stats(shift_nd: DataFrame, as_of: Day) -> DataFrame:
    names = {**_TRIP, "trans_finish_order_count": "trans_finish_order_count"}
    return _dated(_sums(shift_nd, ["line_id", "line_name"], names), as_of, "line_id", "line_name", *names)


def cargo_type_stats(cargo_1d: DataFrame, cargo_nd: DataFrame, as_of: Day) -> DataFrame:
    keys = ["cargo_type", "cargo_type_name"]
    rows = _all_windows(cargo_1d, cargo_nd, as_of, [*keys, *_ORDER])
    return _dated(_sums(rows, keys, _ORDER), as_of, *keys, *_ORDER)


def order_stats(cargo_1d: DataFrame, cargo_nd: DataFrame, as_of: Day) -> DataFrame:
    return _dated(_sums(_all_windows(cargo_1d, cargo_nd, as_of, list(_ORDER)), [], _ORDER), as_of, *_ORDER)


def shift_stats(shift_nd: DataFrame, as_of: Day) -> DataFrame:
    return _dated(shift_nd, as_of, "shift_id", *TRIP_SUMS, "trans_finish_order_count")


def trans_order_stats(
    receive: tuple[DataFrame, DataFrame], dispatch: tuple[DataFrame, DataFrame], as_of: Day
) -> DataFrame:
    names = ["order_count", "order_amount"]
    both = _side_by_side(
        [], (_all_windows(*receive, as_of, names), {f"receive_{m}": m for m in names}),
        (_all_windows(*dispatch, as_of, names), {f"dispatch_{m}": m for m in names}))
    return _dated(both, as_of, *[f"receive_{m}" for m in names], *[f"dispatch_{m}" for m in names])


def in_transit_td(dispatched: DataFrame, finished: DataFrame, as_of: Day) -> DataFrame:
    """Dispatched minus finished, as a sum over both with the finished side negated."""
    names = ["order_count", "order_amount"]
    minus = finished.select(*[(-F.col(m)).alias(m) for m in names])
    return dispatched.select(*names).unionByName(minus).agg(
        F.sum("order_count").alias("bounding_order_count"), F.sum("order_amount").alias("bounding_order_amount")
    ).select(day(as_of).alias("dt"), "bounding_order_count", "bounding_order_amount")


def trans_stats(truck_1d: DataFrame, shift_nd: DataFrame, as_of: Day) -> DataFrame:
    return _dated(_sums(_all_windows(truck_1d, shift_nd, as_of, TRIP_SUMS), [], _TRIP), as_of, *TRIP_SUMS)


def truck_stats(shift_nd: DataFrame, as_of: Day) -> DataFrame:
    keys = ["truck_model_type", "truck_model_type_name"]
    return _dated(_sums(shift_nd, keys, _TRIP), as_of, *keys, *TRIP_SUMS, *_trip_means())


# The short form of ten results: one source each, the last 7 days, zeros for what the source lacks.

COUNT_TYPE, AMOUNT_TYPE = "bigint", "decimal(16,2)"
_NO_TRIPS = {"trans_finish_count": COUNT_TYPE, "trans_finish_distance": AMOUNT_TYPE, "trans_finish_dur_sec": COUNT_TYPE}
_NO_MEANS = {"avg_trans_finish_distance": AMOUNT_TYPE, "avg_trans_finish_dur_sec": COUNT_TYPE}


def _week(nd: DataFrame, as_of: Day, keys: Sequence[str], measures: dict[str, str], **zeros: str) -> DataFrame:
    """Sums of the 7-day rows; ``zeros`` names the zero columns and their types."""
    totals = nd.where(F.col("recent_days") == 7).groupBy(*keys).agg(*[F.sum(m).alias(n) for n, m in measures.items()])
    placeholders = {name: F.lit(0).cast(kind) for name, kind in zeros.items()}
    return totals.withColumns({"dt": day(as_of), "recent_days": F.lit(7), **placeholders})


def quick_city_stats(deliver_nd: DataFrame, as_of: Day) -> DataFrame:
    return _week(deliver_nd, as_of, CITY, {"order_count": "order_count"}, order_amount=AMOUNT_TYPE, **_NO_TRIPS, **_NO_MEANS)


def quick_express_stats_by(receive_nd: DataFrame, keys: Sequence[str], as_of: Day) -> DataFrame:
    received = {"receive_order_count": "order_count", "receive_order_amount": "order_amount"}
    return _week(receive_nd, as_of, keys, received, deliver_suc_count=COUNT_TYPE, sort_count=COUNT_TYPE)


def quick_express_stats(sort_nd: DataFrame, as_of: Day) -> DataFrame:
    return _week(sort_nd, as_of, [], {"sort_count": "sort_count"}, deliver_suc_count=COUNT_TYPE)


def quick_order_stats(cargo_nd: DataFrame, as_of: Day) -> DataFrame:
    return _week(cargo_nd, as_of, [], _ORDER)


def quick_org_stats(receive_nd: DataFrame, as_of: Day) -> DataFrame:
    return _week(receive_nd, as_of, ORG, _ORDER, **_NO_TRIPS, **_NO_MEANS)


def quick_trans_order_stats(sent_nd: DataFrame, as_of: Day) -> DataFrame:
    sent = {"dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"}
    return _week(sent_nd, as_of, [], sent, receive_order_count=COUNT_TYPE, receive_order_amount=AMOUNT_TYPE)


def quick_trans_order_stats_td(finished_td: DataFrame, as_of: Day) -> DataFrame:
    return finished_td.select(
        day(as_of).alias("dt"), F.col("order_count").alias("bounding_order_count"),
        F.col("order_amount").alias("bounding_order_amount"),
    )


def quick_trans_stats(truck_1d: DataFrame, as_of: Day) -> DataFrame:
    trips = truck_1d.where(F.col("dt") == day(as_of)).agg(*[F.sum(m).alias(m) for m in TRIP_SUMS])
    return trips.withColumns({"dt": day(as_of), "recent_days": F.lit(1)})


def quick_truck_stats(shift_nd: DataFrame, as_of: Day) -> DataFrame:
    return _week(shift_nd, as_of, ["truck_model_type", "truck_model_type_name"], _TRIP, **_NO_MEANS)
