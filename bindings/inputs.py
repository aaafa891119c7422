"""Operator inputs as DataFrames over the driver's parquet tables. ``ctes.py`` holds the same inputs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import money
from tidemill.session import scratch

TRADE_DAY = "2001-08-01"
EVENT_DAY = "2024-01-30"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}
        self.folders: dict[tuple[str, str], tuple[str, int]] = {}  # tables written for streams, with their files a batch

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        times = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
        return df.withColumns(times) if times else df

    # trade

    @staticmethod
    def line_id():
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)

    def raw_order_detail(self) -> DataFrame:
        li, o = self.table("lineitem"), self.table("orders")
        price = money("l_extendedprice")
        unit = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)") * F.lit(0.01).cast("decimal(3,2)")
        return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self.line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            F.col("o_orderdate").alias("create_time"), F.col("l_quantity").cast("bigint").alias("sku_num"),
            money(unit).alias("order_price"),
            money(price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("split_total_amount"),
            F.when(F.col("l_discount") > 0, money(price * F.col("l_discount").cast("decimal(4,2)"))).alias("split_activity_amount"),
            F.when(F.col("l_tax") > 0, money(price * F.col("l_tax").cast("decimal(4,2)"))).alias("split_coupon_amount"),
            F.to_date("o_orderdate").alias("ds"),
        )

    def raw_orders(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        total = money("o_totalprice")
        return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("c_nationkey").cast("bigint").alias("province_id"), F.col("o_orderdate").alias("create_time"),
            total.alias("original_total_amount"),
            money(total * F.lit(0.05).cast("decimal(3,2)")).alias("activity_reduce_amount"),
            money(total * F.lit(0.01).cast("decimal(3,2)")).alias("coupon_reduce_amount"),
            money(total * F.lit(0.94).cast("decimal(3,2)")).alias("total_amount"),
            F.col("o_orderstatus").alias("order_status"), F.to_date("o_orderdate").alias("ds"),
        )

    def of_days(self, first: str, last: str) -> Inputs:
        """The same tables with the orders of some days only and their lines, as a daily job finds them in its partitions.

        The rows are written once, so that their true size is known to the joins that follow.
        """
        out = Inputs(self.spark, self.sf_dir)
        days = F.to_date("o_orderdate").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        out._tables["orders"] = self._written(self.table("orders").where(days), "orders-of-days")
        keys = out.table("orders").select(F.col("o_orderkey").alias("_of"))
        out._tables["lineitem"] = self._written(self.table("lineitem").join(keys, F.col("l_orderkey") == F.col("_of"), "left_semi"), "lines-of-days")
        return out

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        folder = scratch(self.spark, name)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _with_day(self, lines: DataFrame, day: bool) -> DataFrame:
        """Lines with their order's day as ``ds`` where a job goes by it; else no join is needed."""
        if not day:
            return lines
        o = self.table("orders").select(F.col("o_orderkey").alias("_of"), F.to_date("o_orderdate").alias("ds"))
        return lines.join(o, F.col("l_orderkey") == F.col("_of"))

    def raw_detail_activity(self, day: bool = False) -> DataFrame:
        activity = F.round(F.col("l_discount") * 100).cast("bigint")
        return self._with_day(self.table("lineitem").where(F.col("l_discount") > 0), day).select(
            F.col("l_orderkey").alias("order_id"), self.line_id().alias("order_detail_id"), activity.alias("activity_id"),
            (activity * 10 + F.col("l_linenumber")).alias("activity_rule_id"), *(["ds"] if day else []),
        )

    def raw_detail_coupon(self, day: bool = False) -> DataFrame:
        return self._with_day(self.table("lineitem").where(F.col("l_tax") > 0), day).select(
            F.col("l_orderkey").alias("order_id"), self.line_id().alias("order_detail_id"),
            F.round(F.col("l_tax") * 100).cast("bigint").alias("coupon_id"), *(["ds"] if day else []),
        )

    def raw_payment(self) -> DataFrame:
        """One payment per order with a shipped line: paid on its first such ship date, never before ordering."""
        li, o = self.table("lineitem"), self.table("orders")
        total = money(money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)")))
        paid = li.where(F.col("l_linestatus") == "F").groupBy("l_orderkey").agg(
            F.sum(total).alias("total_amount"), F.min("l_shipdate").alias("first_ship"), F.count(F.lit(1)).alias("n")
        )
        at = F.greatest("first_ship", "o_orderdate")
        return paid.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            F.concat(F.lit("110"), (F.col("l_orderkey") % 4).cast("string")).alias("payment_type"),
            F.when(F.col("n") % 2 == 0, F.lit("1602")).otherwise(F.lit("1601")).alias("payment_status"),
            at.alias("callback_time"), money("total_amount").alias("total_amount"), F.to_date(at).alias("ds"),
        )

    def status_log(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("order_id"), F.expr("o_orderdate + interval 20 days").alias("operate_time"),
            F.when(F.col("o_orderstatus") == "F", F.lit("1004")).otherwise(F.lit("1002")).alias("order_status"),
        )

    def dictionary(self) -> DataFrame:
        """Codes read off the data: payment types, coupon and activity kinds."""
        o = self.table("orders")
        tens = o.select((F.col("o_orderkey") % 4).cast("string").alias("n")).distinct()
        pay = tens.select(F.lit("11").alias("parent_code"), F.concat(F.lit("110"), "n").alias("dic_code"),
                          F.concat(F.lit("pay-"), "n").alias("dic_name"))
        kinds = tens.where(F.col("n") != "0")
        rest = [
            kinds.select(F.lit(parent).alias("parent_code"), F.concat(F.lit(f"{parent}0"), "n").alias("dic_code"),
                         F.concat(F.lit(f"{word}-"), "n").alias("dic_name"))
            for parent, word in (("31", "activity"), ("32", "coupon"), ("33", "range"))
        ]
        for r in rest:
            pay = pay.unionByName(r)
        return pay

    def order_fact(self, province: bool = False) -> DataFrame:
        """The order-detail fact straight from the lines, equal to ``fact_order_detail`` over the raw tables."""
        li, o = self.table("lineitem"), self.table("orders")
        price, cut = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
        wide = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        if province:
            c = self.table("customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("province_id"))
            wide = wide.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
        unit = F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)") * F.lit(0.01).cast("decimal(3,2)")
        qty = F.col("l_quantity").cast("bigint")
        return wide.select(
            F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
            *([F.col("province_id")] if province else []),
            qty.alias("sku_num"), money(qty * money(unit)).alias("split_original_amount"),
            money(price * cut).alias("split_activity_amount"),
            money(price * F.col("l_tax").cast("decimal(4,2)")).alias("split_coupon_amount"),
            money(price * (1 - cut)).alias("split_total_amount"),
            F.col("o_orderdate").alias("create_time"), F.to_date("o_orderdate").alias("dt"),
        )

    def payment_fact(self) -> DataFrame:
        paid = self.raw_payment().select("order_id", "callback_time")
        return self.order_fact().drop("dt").join(paid, "order_id").select(
            "order_id", "user_id", "sku_id", "sku_num", F.col("split_total_amount").alias("split_payment_amount"),
            F.to_date("callback_time").alias("dt"),
        )

    def raw_cart(self) -> DataFrame:
        li, o, p = self.table("lineitem"), self.table("orders"), self.table("part")
        return (
            li.where(F.col("l_returnflag") == "N")
            .join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                self.line_id().alias("id"), F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
                F.col("p_name").alias("sku_name"), F.col("l_quantity").cast("bigint").alias("sku_num"),
                F.when(F.col("l_linestatus") == "O", F.lit("0")).otherwise(F.lit("1")).alias("is_ordered"),
                F.col("o_orderdate").alias("create_time"),
            )
        )

    def raw_favor(self) -> DataFrame:
        li, o = self.table("lineitem"), self.table("orders")
        return li.where(F.col("l_returnflag") == "A").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self.line_id().alias("id"), F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").alias("create_time"),
        )

    def raw_coupon_use(self) -> DataFrame:
        li, o = self.table("lineitem"), self.table("orders")
        return li.where(F.col("l_tax") > 0).join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self.line_id().alias("id"), F.round(F.col("l_tax") * 100).cast("bigint").alias("coupon_id"),
            F.col("o_custkey").alias("user_id"), F.col("l_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("get_time"), F.col("l_shipdate").alias("used_time"),
        )

    # dimensions

    def categories(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_type").alias("c1"), F.concat_ws("-", "p_type", F.col("p_size") % 5).alias("c2"),
            F.concat_ws("-", "p_type", F.col("p_size") % 5, "p_size").alias("c3"),
        )

    def raw_sku(self) -> dict[str, DataFrame]:
        p, li, c = self.table("part"), self.table("lineitem"), self.categories()
        c3 = F.concat_ws("-", "p_type", F.col("p_size") % 5, "p_size")
        return {
            "sku": p.select(
                F.col("p_partkey").alias("id"), money("p_retailprice").alias("price"), F.col("p_name").alias("sku_name"),
                F.lower("p_name").alias("sku_desc"), F.col("p_size").alias("weight"), (F.col("p_size") % 2).alias("is_sale"),
                F.col("p_name").alias("spu_id"), c3.alias("category3_id"), F.col("p_brand").alias("tm_id"),
                F.lit(None).cast("timestamp").alias("create_time"),
            ),
            "spu": p.select(F.col("p_name").alias("id"), F.upper("p_name").alias("spu_name")).distinct(),
            "category3": c.select(F.col("c3").alias("id"), F.concat(F.lit("n3 "), "c3").alias("name"), F.col("c2").alias("category2_id")).distinct(),
            "category2": c.select(F.col("c2").alias("id"), F.concat(F.lit("n2 "), "c2").alias("name"), F.col("c1").alias("category1_id")).distinct(),
            "category1": c.select(F.col("c1").alias("id"), F.concat(F.lit("n1 "), "c1").alias("name")).distinct(),
            "trademark": p.select(F.col("p_brand").alias("id"), F.lower("p_brand").alias("tm_name")).distinct(),
            "attr_values": li.select(
                F.col("l_partkey").alias("sku_id"), F.lit("flag").alias("attr_id"), F.col("l_returnflag").alias("value_id"),
                F.lit("return flag").alias("attr_name"), F.lower("l_returnflag").alias("value_name"),
            ),
            "sale_attr_values": li.select(
                F.col("l_partkey").alias("sku_id"), F.lit("status").alias("sale_attr_id"),
                F.col("l_linestatus").alias("sale_attr_value_id"), F.lit("line status").alias("sale_attr_name"),
                F.lower("l_linestatus").alias("sale_attr_value_name"),
            ),
        }

    def sku(self) -> DataFrame:
        p = self.table("part")
        c1, c2 = F.col("p_type"), F.concat_ws("-", "p_type", F.col("p_size") % 5)
        c3 = F.concat_ws("-", "p_type", F.col("p_size") % 5, "p_size")
        return p.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            c1.alias("category1_id"), F.concat(F.lit("n1 "), c1).alias("category1_name"),
            c2.alias("category2_id"), F.concat(F.lit("n2 "), c2).alias("category2_name"),
            c3.alias("category3_id"), F.concat(F.lit("n3 "), c3).alias("category3_name"),
            F.col("p_brand").alias("tm_id"), F.lower("p_brand").alias("tm_name"), money("p_retailprice").alias("price"),
        )

    def raw_province(self) -> DataFrame:
        n = self.table("nation")
        key = F.col("n_nationkey")
        return n.select(
            key.cast("bigint").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_id"),
            F.concat(F.lit("0"), key + 10).alias("area_code"), F.concat(F.lit("CN-"), key).alias("iso_code"),
            F.concat(F.lit("ISO-"), key).alias("iso_3166_2"),
        )

    def raw_region(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name"))

    def province(self) -> DataFrame:
        from tidemill.plans.dims import dim_province
        return dim_province(self.raw_province(), self.raw_region())

    def raw_coupon(self) -> DataFrame:
        """One coupon per tax rate seen in the lines."""
        rate = self.table("lineitem").where(F.col("l_tax") > 0).select(F.round(F.col("l_tax") * 100).cast("bigint").alias("id")).distinct()
        kind = F.concat(F.lit("320"), (F.col("id") % 4).cast("string"))
        none = F.lit(None)
        return rate.select(
            "id", F.concat(F.lit("coupon "), "id").alias("coupon_name"), kind.alias("coupon_type"),
            money(F.col("id") * 100).alias("condition_amount"), (F.col("id") + 1).alias("condition_num"),
            (F.col("id") * 10).alias("activity_id"), money(F.col("id") * 5).alias("benefit_amount"),
            (10 - F.col("id")).alias("benefit_discount"), none.cast("timestamp").alias("create_time"),
            F.concat(F.lit("330"), (F.col("id") % 3).cast("string")).alias("range_type"),
            (F.col("id") + 5).alias("limit_num"), (F.col("id") + 3).alias("taken_count"),
            none.cast("timestamp").alias("start_time"), none.cast("timestamp").alias("end_time"),
            none.cast("timestamp").alias("operate_time"), none.cast("timestamp").alias("expire_time"),
        )

    def coupon(self) -> DataFrame:
        from tidemill.plans.dims import dim_coupon
        return dim_coupon(self.raw_coupon(), self.dictionary())

    def raw_activity(self) -> DataFrame:
        cut = self.table("lineitem").where(F.col("l_discount") > 0).select(F.round(F.col("l_discount") * 100).cast("bigint").alias("id")).distinct()
        none = F.lit(None).cast("timestamp")
        return cut.select("id", F.concat(F.lit("activity "), "id").alias("activity_name"),
                          F.concat(F.lit("cut "), "id").alias("activity_desc"),
                          none.alias("start_time"), none.alias("end_time"), none.alias("create_time"))

    def raw_activity_rule(self) -> DataFrame:
        pair = self.table("lineitem").where(F.col("l_discount") > 0).select(
            F.round(F.col("l_discount") * 100).cast("bigint").alias("activity_id"), F.col("l_linenumber").cast("bigint").alias("n")
        ).distinct()
        a, n = F.col("activity_id"), F.col("n")
        return pair.select(
            (a * 10 + n).alias("id"), "activity_id", F.concat(F.lit("310"), (n % 4).cast("string")).alias("activity_type"),
            money(a * 50).alias("condition_amount"), n.alias("condition_num"), money(a * 3).alias("benefit_amount"),
            (10 - n).alias("benefit_discount"), n.alias("benefit_level"),
        )

    # behaviour

    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.to_date("ts").alias("dt"),
        )

    def app_log(self) -> DataFrame:
        """Parsed app log, one page record per event."""
        e = self.events()
        page = (
            F.when(F.col("event_type") == "view", "good_detail").when(F.col("event_type") == "click", "home")
            .when(F.col("event_type") == "signup", "cart").when(F.col("event_type") == "purchase", "trade").otherwise("mine")
        )
        uid, k = F.col("user_id"), F.col("k")
        common = F.struct(
            (uid % 25).cast("string").alias("ar"), uid.cast("string").alias("uid"),
            F.concat(F.lit("ch"), uid % 4).alias("ch"), F.when(k % 3 == 0, "1").otherwise("0").alias("is_new"),
            F.concat(F.lit("v"), k % 5).alias("vc"), F.concat(F.lit("ba"), uid % 6).alias("ba"),
            F.concat(F.lit("os"), uid % 2).alias("os"), F.concat(F.lit("md"), uid % 9).alias("md"),
            F.concat(F.lit("mid_"), uid).alias("mid"), F.concat_ws("_", uid, F.col("dt")).alias("sid"),
        )
        page_struct = F.struct(
            k.cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
            F.when(k % 4 != 0, "home").alias("last_page_id"), page.alias("page_id"),
            (k % 7).cast("string").alias("from_pos_id"), (k % 3).cast("string").alias("from_pos_seq"),
            (k % 5).cast("string").alias("refer_id"), F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        )
        return e.select("event_type", common.alias("common"), page_struct.alias("page"),
                        F.unix_millis("ts").alias("ts"), "event_id", k.alias("k"))

    def page_view(self) -> DataFrame:
        from tidemill.plans.facts import fact_page_view
        return fact_page_view(self.app_log())

    def logins(self) -> DataFrame:
        return self.events().where(F.col("event_type") == "signup").select("user_id", "dt", F.col("ts").alias("login_time"))
