"""Logistics operators over line items: the supplier is the organisation, its nation the city, its region the province."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.ctes import cte
from bindings.inputs import TRADE_DAY, Inputs
from bindings.register import big, dbl, query, txt
from tidemill.functions.columns import money
from tidemill.plans import transport as tr

T = f"date '{TRADE_DAY}'"


class Freight:
    def __init__(self, i: Inputs):
        self.i = i

    def lines(self):
        i = self.i
        return i.table("lineitem").join(i.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            i.line_id().alias("id"), F.col("l_orderkey").alias("order_id"), "l_suppkey", "l_partkey", "l_linenumber",
            "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("qty"),
            money("o_totalprice").alias("amount"), "o_orderdate", "l_shipdate",
            F.to_date("o_orderdate").alias("odt"), F.to_date("l_shipdate").alias("sdt"),
            F.concat(F.lit("S"), "l_suppkey").alias("district"),
        )

    def region(self):
        i = self.i
        s, n, r = i.table("supplier"), i.table("nation"), i.table("region")
        parts = [
            s.select(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("N"), "s_nationkey").alias("parent_id")),
            n.select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("R"), "n_regionkey").alias("parent_id")),
            r.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_id")),
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def org(self):
        s = self.i.table("supplier")
        level = 1 + F.col("s_suppkey") % 2
        at = F.when(level == 1, F.concat(F.lit("N"), "s_nationkey")).otherwise(F.concat(F.lit("S"), "s_suppkey"))
        return s.join(self.region().select(F.col("id").alias("rid"), F.col("name").alias("region_name")), F.col("rid") == at, "left").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("org_name"), level.alias("org_level"), at.alias("region_id"), "region_name")

    def truck(self):
        return self.i.table("part").select((F.col("p_partkey") % 20).alias("id")).distinct().select(
            "id", F.concat(F.lit("M"), F.col("id") % 4).alias("truck_model_type"),
            F.concat(F.lit("model "), F.col("id") % 4).alias("truck_model_type_name"))

    def shift(self):
        return self.i.table("lineitem").select((F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_suppkey") % 10).alias("line_id")).distinct().select(
            "id", F.concat(F.lit("line "), "line_id").alias("line_name"))

    def order_detail(self):
        s = self.i.table("supplier").select("s_suppkey", F.concat(F.lit("N"), "s_nationkey").alias("sender_city_id"))
        return self.lines().join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
            "order_id", F.col("l_returnflag").alias("cargo_type"), F.lower("l_returnflag").alias("cargo_type_name"),
            F.col("district").alias("sender_district_id"), "sender_city_id", "amount", F.col("odt").alias("dt"))

    def dispatch(self):
        return self.lines().select("order_id", "amount", F.col("odt").alias("dt"))

    def deliver(self):
        return self.lines().where(F.col("l_linestatus") == "F").select("order_id", F.col("district").alias("receiver_district_id"), F.col("sdt").alias("dt"))

    def receive(self):
        return self.lines().select("order_id", "amount", F.col("district").alias("sender_district_id"), F.col("odt").alias("dt"))

    def sort(self):
        return self.lines().select(F.col("l_suppkey").alias("org_id"), F.col("sdt").alias("dt"))

    def bound_finish(self):
        return self.lines().where(F.col("l_linestatus") == "F").select("order_id", "amount", F.col("sdt").alias("dt"))

    def trip(self):
        s = self.i.table("supplier").select("s_suppkey", "s_name")
        two = F.col("l_linenumber") % 2 == 0
        return self.lines().join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
            "id", (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("shift_id"), (F.col("l_suppkey") % 10).alias("line_id"),
            (F.col("l_partkey") % 20).alias("truck_id"), F.col("l_suppkey").alias("start_org_id"), F.col("s_name").alias("start_org_name"),
            F.col("l_suppkey").alias("driver1_emp_id"), F.concat(F.lit("drv"), "l_suppkey").alias("driver1_name"),
            F.when(two, F.col("l_partkey") % 50).alias("driver2_emp_id"), F.when(two, F.concat(F.lit("drv"), F.col("l_partkey") % 50)).alias("driver2_name"),
            F.col("qty").cast("decimal(16,2)").alias("actual_distance"), (F.col("qty") * 61).alias("finish_dur_sec"),
            F.col("l_linenumber").cast("bigint").alias("order_num"), F.col("l_shipdate").alias("actual_end_time"),
            F.expr("o_orderdate + interval 30 days").alias("estimate_end_time"), F.col("sdt").alias("dt"))

    def cargo_1d(self):
        return tr.org_cargo_order_1d(self.order_detail(), self.org(), self.region())

    def cargo(self):
        daily = self.cargo_1d()
        return daily, tr.org_cargo_order_nd(daily, TRADE_DAY)

    def deliver_pair(self):
        daily = tr.org_deliver_suc_1d(self.deliver(), self.org(), self.region())
        return daily, tr.org_deliver_suc_nd(daily, TRADE_DAY)

    def receive_pair(self):
        daily = tr.org_receive_1d(self.receive(), self.org(), self.region())
        return daily, tr.org_receive_nd(daily, TRADE_DAY)

    def sort_pair(self):
        daily = tr.org_sort_1d(self.sort(), self.org(), self.region())
        return daily, tr.org_sort_nd(daily, TRADE_DAY)

    def dispatch_pair(self):
        daily = tr.dispatch_1d(self.dispatch())
        return daily, tr.dispatch_nd(daily, TRADE_DAY)

    def truck_1d(self):
        return tr.org_truck_finish_1d(self.trip(), self.truck())

    def shift_nd(self):
        return tr.shift_finish_nd(self.trip(), self.org(), self.region(), self.shift(), self.truck(), TRADE_DAY)


cte("y_line", """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint)) AS id,
       l_orderkey AS order_id, l_suppkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, cast(l_quantity as bigint) AS qty,
       cast(o_totalprice as decimal(16,2)) AS amount, o_orderdate, l_shipdate, cast(o_orderdate as date) AS odt, cast(l_shipdate as date) AS sdt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
# Organisation with its district (odd keys) or city (even keys), its city and its province.
cte("y_org", """
SELECT s_suppkey AS org_id, s_name AS org_name, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey END AS district_key,
       'N' || n_nationkey AS city_id, n_name AS city_name, 'R' || r_regionkey AS province_id, r_name AS province_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
cte("y_w", "SELECT * FROM (VALUES (7), (30)) d(n)")
cte("y_cargo1d", """
SELECT dt, org_id, org_name, city_id, any_value(city_name) AS city_name, cargo_type, lower(cargo_type) AS cargo_type_name, count(*) AS order_count, sum(amount) AS order_amount
FROM (SELECT DISTINCT odt AS dt, order_id, l_returnflag AS cargo_type, l_suppkey, 'N' || n_nationkey AS city_id, n_name AS city_name, amount
      FROM y_line JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) x
LEFT JOIN (SELECT org_id, org_name, district_key FROM y_org) o ON x.l_suppkey = o.district_key
GROUP BY dt, org_id, org_name, city_id, cargo_type
""")
cte("y_cargond", f"""
SELECT n AS recent_days, org_id, org_name, city_id, city_name, cargo_type, cargo_type_name, sum(order_count) AS order_count, sum(order_amount) AS order_amount
FROM y_cargo1d, y_w WHERE dt BETWEEN {T} - n + 1 AND {T} GROUP BY ALL
""")
cte("y_disp1d", "SELECT dt, count(*) AS order_count, sum(amount) AS order_amount FROM (SELECT DISTINCT odt AS dt, order_id, amount FROM y_line) GROUP BY dt")
cte("y_dispnd", f"SELECT n AS recent_days, sum(order_count) AS order_count, sum(order_amount) AS order_amount FROM y_disp1d, y_w WHERE dt BETWEEN {T} - n + 1 AND {T} GROUP BY n")
cte("y_del1d", """
SELECT dt, org_id, org_name, city_id, city_name, province_id, province_name, count(*) AS order_count
FROM (SELECT DISTINCT sdt AS dt, order_id, l_suppkey FROM y_line WHERE l_linestatus = 'F') x LEFT JOIN y_org o ON x.l_suppkey = o.district_key GROUP BY ALL
""")
cte("y_rec1d", """
SELECT dt, org_id, org_name, city_id, city_name, province_id, province_name, count(*) AS order_count, sum(amount) AS order_amount
FROM (SELECT DISTINCT odt AS dt, order_id, org_id, org_name, city_id, city_name, province_id, province_name, amount
      FROM y_line x LEFT JOIN y_org o ON x.l_suppkey = o.district_key) GROUP BY ALL
""")
cte("y_sort1d", """
SELECT sdt AS dt, org_id, org_name, city_id, city_name, province_id, province_name, count(*) AS sort_count
FROM y_line JOIN y_org ON l_suppkey = org_id GROUP BY ALL
""")
for _src, _m in (("del", "sum(order_count) AS order_count"), ("rec", "sum(order_count) AS order_count, sum(order_amount) AS order_amount"),
                 ("sort", "sum(sort_count) AS sort_count")):
    cte(f"y_{_src}nd", f"""
SELECT n AS recent_days, org_id, org_name, city_id, city_name, province_id, province_name, {_m}
FROM y_{_src}1d, y_w WHERE dt BETWEEN {T} - n + 1 AND {T} GROUP BY ALL
""")
cte("y_trip", """
SELECT y.*, l_suppkey * 10 + l_linenumber AS shift_id, l_suppkey % 10 AS line_id, l_partkey % 20 AS truck_id, s_name,
       CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 50 END AS driver2, l_shipdate > o_orderdate + interval 30 days AS late
FROM y_line y JOIN supplier ON l_suppkey = s_suppkey
""")
cte("y_truck1d", """
SELECT sdt AS dt, l_suppkey AS org_id, s_name AS org_name, 'M' || (truck_id % 4) AS truck_model_type, 'model ' || (truck_id % 4) AS truck_model_type_name,
       count(*) AS trans_finish_count, sum(qty) AS trans_finish_distance, sum(qty * 61) AS trans_finish_dur_sec FROM y_trip GROUP BY ALL
""")
cte("y_shiftnd", f"""
SELECT shift_id, city_id, city_name, org_id, org_name, line_id, 'line ' || line_id AS line_name, org_id AS driver1_emp_id, 'drv' || org_id AS driver1_name,
       driver2 AS driver2_emp_id, 'drv' || driver2 AS driver2_name, 'M' || (truck_id % 4) AS truck_model_type, 'model ' || (truck_id % 4) AS truck_model_type_name,
       n AS recent_days, count(*) AS trans_finish_count, sum(qty) AS trans_finish_distance, sum(qty * 61) AS trans_finish_dur_sec,
       sum(l_linenumber) AS trans_finish_order_count, sum(CASE WHEN late THEN 1 ELSE 0 END) AS trans_finish_delay_count
FROM y_trip JOIN y_org ON l_suppkey = org_id, y_w WHERE sdt BETWEEN {T} - n + 1 AND {T}
GROUP BY shift_id, city_id, city_name, org_id, org_name, line_id, driver2, truck_id, n
""")
# All three windows side by side.
cte("y_cargo", f"SELECT 1 AS recent_days, * EXCLUDE (dt) FROM y_cargo1d WHERE dt = {T} UNION ALL SELECT * FROM y_cargond")
cte("y_del", f"SELECT 1 AS recent_days, * EXCLUDE (dt) FROM y_del1d WHERE dt = {T} UNION ALL SELECT * FROM y_delnd")
cte("y_rec", f"SELECT 1 AS recent_days, * EXCLUDE (dt) FROM y_rec1d WHERE dt = {T} UNION ALL SELECT * FROM y_recnd")
cte("y_sort", f"SELECT 1 AS recent_days, * EXCLUDE (dt) FROM y_sort1d WHERE dt = {T} UNION ALL SELECT * FROM y_sortnd")
cte("y_disp", f"SELECT 1 AS recent_days, order_count, order_amount FROM y_disp1d WHERE dt = {T} UNION ALL SELECT * FROM y_dispnd")
cte("y_trips", f"""
SELECT 1 AS recent_days, t.org_id, t.org_name, city_id, city_name, trans_finish_count, trans_finish_distance, trans_finish_dur_sec
FROM y_truck1d t JOIN y_org o ON t.org_id = o.org_id WHERE dt = {T}
UNION ALL SELECT recent_days, org_id, org_name, city_id, city_name, trans_finish_count, trans_finish_distance, trans_finish_dur_sec FROM y_shiftnd
""")

PLACE = "org_id, org_name, city_id, city_name, province_id, province_name"
ORD = f"{big('order_count', 'order_count')}, {dbl('order_amount', 'order_amount')}"
TRIP = f"{big('trans_finish_count', 'trans_finish_count')}, {dbl('trans_finish_distance', 'trans_finish_distance')}, {big('trans_finish_dur_sec', 'trans_finish_dur_sec')}"
MEANS = ("cast(trans_finish_distance as double) / cast(trans_finish_count as double) AS avg_trans_finish_distance, "
         "cast(trans_finish_dur_sec as double) / cast(trans_finish_count as double) AS avg_trans_finish_dur_sec")
RD = f"'{TRADE_DAY}' AS dt, cast(recent_days as bigint) AS recent_days"


@query(f"SELECT {txt('dt', 'dt')}, org_id, org_name, city_id, city_name, cargo_type, cargo_type_name, {ORD} FROM y_cargo1d")
def org_cargo_order_1d(i: Inputs):
    return Freight(i).cargo_1d()


@query(f"SELECT cast(recent_days as bigint) AS recent_days, org_id, org_name, city_id, city_name, cargo_type, cargo_type_name, {ORD} FROM y_cargond")
def org_cargo_order_nd(i: Inputs):
    return Freight(i).cargo()[1]


@query(f"SELECT {txt('dt', 'dt')}, {ORD} FROM y_disp1d")
def dispatch_1d(i: Inputs):
    return tr.dispatch_1d(Freight(i).dispatch())


@query(f"SELECT cast(recent_days as bigint) AS recent_days, {ORD} FROM y_dispnd")
def dispatch_nd(i: Inputs):
    return Freight(i).dispatch_pair()[1]


@query(f"SELECT {big('sum(order_count)', 'order_count')}, {dbl('sum(order_amount)', 'order_amount')} FROM y_disp1d WHERE dt <= {T}")
def dispatch_td(i: Inputs):
    return tr.dispatch_td(Freight(i).dispatch_pair()[0], TRADE_DAY)


@query(f"SELECT count(*) AS order_count, {dbl('sum(amount)', 'order_amount')} FROM (SELECT DISTINCT order_id, amount FROM y_line WHERE l_linestatus = 'F' AND sdt <= {T})")
def bound_finish_td(i: Inputs):
    return tr.bound_finish_td(Freight(i).bound_finish(), TRADE_DAY)


@query(f"SELECT {txt('dt', 'dt')}, {PLACE}, order_count FROM y_del1d")
def org_deliver_suc_1d(i: Inputs):
    return Freight(i).deliver_pair()[0]


@query(f"SELECT cast(recent_days as bigint) AS recent_days, {PLACE}, {big('order_count', 'order_count')} FROM y_delnd")
def org_deliver_suc_nd(i: Inputs):
    return Freight(i).deliver_pair()[1]


@query(f"SELECT {txt('dt', 'dt')}, {PLACE}, {ORD} FROM y_rec1d")
def org_receive_1d(i: Inputs):
    return Freight(i).receive_pair()[0]


@query(f"SELECT cast(recent_days as bigint) AS recent_days, {PLACE}, {ORD} FROM y_recnd")
def org_receive_nd(i: Inputs):
    return Freight(i).receive_pair()[1]


@query(f"SELECT {txt('dt', 'dt')}, {PLACE}, sort_count FROM y_sort1d")
def org_sort_1d(i: Inputs):
    return Freight(i).sort_pair()[0]


@query(f"SELECT cast(recent_days as bigint) AS recent_days, {PLACE}, {big('sort_count', 'sort_count')} FROM y_sortnd")
def org_sort_nd(i: Inputs):
    return Freight(i).sort_pair()[1]


@query(f"SELECT {txt('dt', 'dt')}, org_id, org_name, truck_model_type, truck_model_type_name, {TRIP} FROM y_truck1d")
def org_truck_finish_1d(i: Inputs):
    return Freight(i).truck_1d()


@query(f"""
SELECT shift_id, city_id, city_name, org_id, org_name, line_id, line_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name,
       truck_model_type, truck_model_type_name, cast(recent_days as bigint) AS recent_days, {TRIP},
       {big('trans_finish_order_count', 'trans_finish_order_count')}, {big('trans_finish_delay_count', 'trans_finish_delay_count')} FROM y_shiftnd
""")
def shift_finish_nd(i: Inputs):
    return Freight(i).shift_nd()


def _sum(group: str, table: str, *measures: str) -> str:
    g = f", {group}" if group else ""
    return f"SELECT recent_days{g}, {', '.join(f'sum({m}) AS {m}' for m in measures)} FROM {table} GROUP BY recent_days{g}"


_TM = ("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec")


@query(f"""
SELECT {RD}, city_id, city_name, {ORD}, {TRIP}, {MEANS} FROM ({_sum('city_id, city_name', 'y_cargo', 'order_count', 'order_amount')}) a
FULL JOIN ({_sum('city_id, city_name', 'y_trips', *_TM)}) b USING (recent_days, city_id, city_name)
""")
def transport_city_stats(i: Inputs):
    f = Freight(i)
    return tr.city_stats(*f.cargo(), f.truck_1d(), f.shift_nd(), f.org(), f.region(), TRADE_DAY)


@query(f"""
WITH o AS ({_sum('org_id, org_name', 'y_cargo', 'order_count', 'order_amount')}), t AS ({_sum('org_id, org_name', 'y_trips', *_TM)})
SELECT {RD}, org_id, org_name, {ORD}, {TRIP}, {MEANS} FROM (SELECT * FROM o WHERE recent_days = 1) a FULL JOIN (SELECT * FROM t WHERE recent_days = 1) b USING (recent_days, org_id, org_name)
UNION ALL
SELECT {RD}, org_id, org_name, {ORD}, {TRIP}, {MEANS} FROM (SELECT * FROM o WHERE recent_days > 1) a JOIN (SELECT * FROM t WHERE recent_days > 1) b USING (recent_days, org_id, org_name)
""")
def transport_org_stats(i: Inputs):
    f = Freight(i)
    return tr.org_stats(*f.cargo(), f.truck_1d(), f.shift_nd(), TRADE_DAY)


@query(f"""
WITH d AS (
  SELECT recent_days, driver1_emp_id AS driver_id, driver1_name AS driver_name, trans_finish_count AS c,
         CASE WHEN driver2_emp_id IS NULL THEN 2 ELSE 1 END * trans_finish_distance AS dist2,
         CASE WHEN driver2_emp_id IS NULL THEN 2 ELSE 1 END * trans_finish_dur_sec AS dur2, trans_finish_delay_count AS late FROM y_shiftnd
  UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, trans_finish_delay_count
  FROM y_shiftnd WHERE driver2_emp_id IS NOT NULL)
SELECT {RD}, driver_id, driver_name, {big('sum(c)', 'trans_finish_count')}, cast(sum(dist2) as double) / 2 AS trans_finish_distance,
       cast(sum(dur2) as double) / 2 AS trans_finish_dur_sec, cast(sum(dist2) as double) / 2 / cast(sum(c) as double) AS avg_trans_finish_distance,
       cast(sum(dur2) as double) / 2 / cast(sum(c) as double) AS avg_trans_finish_dur_sec, {big('sum(late)', 'trans_finish_late_count')}
FROM d GROUP BY recent_days, driver_id, driver_name
""")
def transport_driver_stats(i: Inputs):
    return tr.driver_stats(Freight(i).shift_nd(), TRADE_DAY)


def _express_sql(keys: str) -> str:
    return f"""
SELECT {RD}, {keys}, {big('receive_order_count', 'receive_order_count')}, {dbl('receive_order_amount', 'receive_order_amount')},
       {big('deliver_suc_count', 'deliver_suc_count')}, {big('sort_count', 'sort_count')}
FROM (SELECT recent_days, {keys}, sum(order_count) AS deliver_suc_count FROM y_del GROUP BY ALL) a
FULL JOIN (SELECT recent_days, {keys}, sum(sort_count) AS sort_count FROM y_sort GROUP BY ALL) b USING (recent_days, {keys})
FULL JOIN (SELECT recent_days, {keys}, sum(order_count) AS receive_order_count, sum(order_amount) AS receive_order_amount FROM y_rec GROUP BY ALL) c USING (recent_days, {keys})
"""


@query(_express_sql("city_id, city_name"))
def express_city_stats(i: Inputs):
    f = Freight(i)
    return tr.express_city_stats(f.deliver_pair(), f.sort_pair(), f.receive_pair(), TRADE_DAY)


@query(_express_sql("org_id, org_name"))
def express_org_stats(i: Inputs):
    f = Freight(i)
    return tr.express_org_stats(f.deliver_pair(), f.sort_pair(), f.receive_pair(), TRADE_DAY)


@query(_express_sql("province_id, province_name"))
def express_province_stats(i: Inputs):
    f = Freight(i)
    return tr.express_province_stats(f.deliver_pair(), f.sort_pair(), f.receive_pair(), TRADE_DAY)


@query(f"""
SELECT {RD}, {big('d', 'deliver_suc_count')}, {big('s', 'sort_count')} FROM (SELECT recent_days, sum(order_count) AS d FROM y_del GROUP BY 1) a
FULL JOIN (SELECT recent_days, sum(sort_count) AS s FROM y_sort GROUP BY 1) b USING (recent_days)
""")
def express_stats(i: Inputs):
    f = Freight(i)
    return tr.express_stats(f.deliver_pair(), f.sort_pair(), TRADE_DAY)


@query(f"SELECT {RD}, line_id, line_name, {TRIP}, {big('trans_finish_order_count', 'trans_finish_order_count')} FROM ({_sum('line_id, line_name', 'y_shiftnd', *_TM, 'trans_finish_order_count')})")
def transport_line_stats(i: Inputs):
    return tr.line_stats(Freight(i).shift_nd(), TRADE_DAY)


@query(f"SELECT {RD}, cargo_type, cargo_type_name, {ORD} FROM ({_sum('cargo_type, cargo_type_name', 'y_cargo', 'order_count', 'order_amount')})")
def cargo_type_stats(i: Inputs):
    return tr.cargo_type_stats(*Freight(i).cargo(), TRADE_DAY)


@query(f"SELECT {RD}, {ORD} FROM ({_sum('', 'y_cargo', 'order_count', 'order_amount')})")
def transport_order_stats(i: Inputs):
    return tr.order_stats(*Freight(i).cargo(), TRADE_DAY)


@query(f"SELECT {RD}, shift_id, {TRIP}, {big('trans_finish_order_count', 'trans_finish_order_count')} FROM y_shiftnd")
def transport_shift_stats(i: Inputs):
    return tr.shift_stats(Freight(i).shift_nd(), TRADE_DAY)


@query(f"""
SELECT {RD}, {big('rc', 'receive_order_count')}, {dbl('ra', 'receive_order_amount')}, {big('dc', 'dispatch_order_count')}, {dbl('da', 'dispatch_order_amount')}
FROM (SELECT recent_days, sum(order_count) AS rc, sum(order_amount) AS ra FROM y_rec GROUP BY 1) a
FULL JOIN (SELECT recent_days, sum(order_count) AS dc, sum(order_amount) AS da FROM y_disp GROUP BY 1) b USING (recent_days)
""")
def trans_order_stats(i: Inputs):
    f = Freight(i)
    return tr.trans_order_stats(f.receive_pair(), f.dispatch_pair(), TRADE_DAY)


@query(f"""
WITH f AS (SELECT DISTINCT order_id, amount FROM y_line WHERE l_linestatus = 'F' AND sdt <= {T})
SELECT '{TRADE_DAY}' AS dt, cast((SELECT sum(order_count) FROM y_disp1d WHERE dt <= {T}) - (SELECT count(*) FROM f) as bigint) AS bounding_order_count,
       cast((SELECT sum(order_amount) FROM y_disp1d WHERE dt <= {T}) - (SELECT sum(amount) FROM f) as double) AS bounding_order_amount
""")
def in_transit_td(i: Inputs):
    f = Freight(i)
    return tr.in_transit_td(tr.dispatch_td(f.dispatch_pair()[0], TRADE_DAY), tr.bound_finish_td(f.bound_finish(), TRADE_DAY), TRADE_DAY)


@query(f"SELECT {RD}, {TRIP} FROM ({_sum('', 'y_trips', *_TM)})")
def trans_stats(i: Inputs):
    f = Freight(i)
    return tr.trans_stats(f.truck_1d(), f.shift_nd(), TRADE_DAY)


@query(f"SELECT {RD}, truck_model_type, truck_model_type_name, {TRIP}, {MEANS} FROM ({_sum('truck_model_type, truck_model_type_name', 'y_shiftnd', *_TM)})")
def truck_stats(i: Inputs):
    return tr.truck_stats(Freight(i).shift_nd(), TRADE_DAY)


_QUICK_FN = {
    "city_stats": lambda f: tr.quick_city_stats(f.deliver_pair()[1], TRADE_DAY),
    "express_city_stats": lambda f: tr.quick_express_stats_by(f.receive_pair()[1], tr.CITY, TRADE_DAY),
    "express_org_stats": lambda f: tr.quick_express_stats_by(f.receive_pair()[1], tr.ORG, TRADE_DAY),
    "express_stats": lambda f: tr.quick_express_stats(f.sort_pair()[1], TRADE_DAY),
    "order_stats": lambda f: tr.quick_order_stats(f.cargo()[1], TRADE_DAY),
    "org_stats": lambda f: tr.quick_org_stats(f.receive_pair()[1], TRADE_DAY),
    "trans_order_stats": lambda f: tr.quick_trans_order_stats(f.dispatch_pair()[1], TRADE_DAY),
    "trans_order_stats_td": lambda f: tr.quick_trans_order_stats_td(tr.bound_finish_td(f.bound_finish(), TRADE_DAY), TRADE_DAY),
    "trans_stats": lambda f: tr.quick_trans_stats(f.truck_1d(), TRADE_DAY),
    "truck_stats": lambda f: tr.quick_truck_stats(f.shift_nd(), TRADE_DAY),
}
_W7 = f"'{TRADE_DAY}' AS dt, cast(7 as bigint) AS recent_days"
_Z = "cast(0 as bigint) AS trans_finish_count, cast(0 as double) AS trans_finish_distance, cast(0 as bigint) AS trans_finish_dur_sec"
_ZM = "cast(0 as double) AS avg_trans_finish_distance, cast(0 as bigint) AS avg_trans_finish_dur_sec"
_ZD = "cast(0 as bigint) AS deliver_suc_count, cast(0 as bigint) AS sort_count"
_R7 = f"{big('sum(order_count)', 'receive_order_count')}, {dbl('sum(order_amount)', 'receive_order_amount')}"
_O7 = f"{big('sum(order_count)', 'order_count')}, {dbl('sum(order_amount)', 'order_amount')}"
_QUICK = {
    "city_stats": f"SELECT {_W7}, city_id, city_name, {big('sum(order_count)', 'order_count')}, cast(0 as double) AS order_amount, {_Z}, {_ZM} FROM y_delnd WHERE recent_days = 7 GROUP BY city_id, city_name",
    "express_city_stats": f"SELECT {_W7}, city_id, city_name, {_R7}, {_ZD} FROM y_recnd WHERE recent_days = 7 GROUP BY city_id, city_name",
    "express_org_stats": f"SELECT {_W7}, org_id, org_name, {_R7}, {_ZD} FROM y_recnd WHERE recent_days = 7 GROUP BY org_id, org_name",
    "express_stats": f"SELECT {_W7}, cast(0 as bigint) AS deliver_suc_count, {big('sum(sort_count)', 'sort_count')} FROM y_sortnd WHERE recent_days = 7",
    "order_stats": f"SELECT {_W7}, {_O7} FROM y_cargond WHERE recent_days = 7",
    "org_stats": f"SELECT {_W7}, org_id, org_name, {_O7}, {_Z}, {_ZM} FROM y_recnd WHERE recent_days = 7 GROUP BY org_id, org_name",
    "trans_order_stats": f"SELECT {_W7}, cast(0 as bigint) AS receive_order_count, cast(0 as double) AS receive_order_amount, {big('sum(order_count)', 'dispatch_order_count')}, {dbl('sum(order_amount)', 'dispatch_order_amount')} FROM y_dispnd WHERE recent_days = 7",
    "trans_order_stats_td": f"SELECT '{TRADE_DAY}' AS dt, count(*) AS bounding_order_count, {dbl('sum(amount)', 'bounding_order_amount')} FROM (SELECT DISTINCT order_id, amount FROM y_line WHERE l_linestatus = 'F' AND sdt <= {T})",
    "trans_stats": f"SELECT '{TRADE_DAY}' AS dt, cast(1 as bigint) AS recent_days, {big('sum(trans_finish_count)', 'trans_finish_count')}, {dbl('sum(trans_finish_distance)', 'trans_finish_distance')}, {big('sum(trans_finish_dur_sec)', 'trans_finish_dur_sec')} FROM y_truck1d WHERE dt = {T}",
    "truck_stats": f"SELECT {_W7}, truck_model_type, truck_model_type_name, {big('sum(trans_finish_count)', 'trans_finish_count')}, {dbl('sum(trans_finish_distance)', 'trans_finish_distance')}, {big('sum(trans_finish_dur_sec)', 'trans_finish_dur_sec')}, {_ZM} FROM y_shiftnd WHERE recent_days = 7 GROUP BY truck_model_type, truck_model_type_name",
}
for _name, _sql in _QUICK.items():
    query(_sql, name=f"quick_{_name}")(lambda i, _name=_name: _QUICK_FN[_name](Freight(i)))
