"""Shop-shaped views over the given tables: logs, changes, orders, dimensions.

Every rule works on one row at a time (no window, no join but the product
name), so a view adds no shuffle of its own and streams as well as it batches.
FIXTURES.md lists the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.sources import topics
from rillmart.sources.tables import read_table

PARTITIONS = 4  # partitions of the log topic
ORDER_DAYS = 60  # orders fall on the 60 days from 2024-01-01
DAY_SECONDS = 86400

_PAGES = ["view", "click", "signup", "purchase", "error"]


def _utc_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _text(value: Column) -> Column:
    return value.cast("string")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# ---- behaviour logs -----------------------------------------------------------


def raw_logs(events: DataFrame) -> DataFrame:
    """Events as nested log rows, plus ``event_id`` and ``ts_event``."""
    event, user = F.col("event_id"), F.col("user_id")
    has_page = event % 20 != 10
    common = F.struct(
        _text(user % 25).alias("ar"),
        _text(user).alias("uid"),
        F.when(user % 2 == 0, "Android").otherwise("iOS").alias("os"),
        F.concat(F.lit("ch_"), _text(user % 5)).alias("ch"),
        F.when(user % 3 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("md_"), _text(user % 7)).alias("md"),
        F.concat(F.lit("mid_"), _text(user)).alias("mid"),
        F.concat(F.lit("v2."), _text(user % 4)).alias("vc"),
        F.when(user % 11 != 0, F.concat(F.lit("ba_"), _text(user % 6))).alias("ba"),
    )
    page = F.struct(
        F.col("event_type").alias("page_id"),
        F.get_json_object("props", "$.k").alias("item"),
        F.when(event % 2 == 0, "sku_id").alias("item_type"),
        F.when(event % 13 != 0, F.floor(F.col("value") * 1000)).alias("during_time"),
        F.when(event % 4 != 0, _pick(_PAGES, event % 5)).alias("last_page_id"),
        F.when(event % 3 != 0, F.when(event % 3 == 1, "promotion").otherwise("query")).alias("source_type"),
    )
    display = lambda j: F.struct(
        F.when(j % 2 == 0, "promotion").otherwise("recommend").alias("display_type"),
        _text((event + j) % 100).alias("item"),
        F.lit("sku_id").alias("item_type"),
        _text(j + 1).alias("order"),
        _text((event + j) % 5).alias("pos_id"),
    )
    action = lambda j: F.struct(
        F.when(j == 0, "cart_add").otherwise("favor_add").alias("action_id"),
        _text((event + j) % 100).alias("item"),
        F.lit("sku_id").alias("item_type"),
    )
    some = lambda n, row: F.slice(F.array(*[row(F.lit(j)) for j in range(3)]), 1, n.cast("int"))
    start = F.struct(
        F.when(event % 20 == 0, "icon").otherwise("notice").alias("entry"),
        (event % 3000).alias("loading_time_ms"),
        _text(event % 17).alias("open_ad_id"),
        (event % 5000).alias("open_ad_ms"),
        F.when(event % 30 != 0, event % 1000).alias("open_ad_skip_ms"),
    )
    return events.select(
        "event_id",
        F.col("ts").alias("ts_event"),
        F.when(event % 50 == 0, F.struct(_text(event % 7).alias("code"), F.lit("boom").alias("msg"))).alias("err"),
        _utc_ms(F.col("ts")).alias("ts"),
        common.alias("common"),
        F.when(has_page, page).alias("page"),
        # event_id % 8 = 0: the array is missing; % 8 = 4: it is empty.
        F.when(event % 8 != 0, some(event % 4, display)).alias("displays"),
        F.when(event % 9 != 0, some(event % 3, action)).alias("actions"),
        F.when(event % 10 == 0, start).alias("start"),
    )


LOG_FIELDS = ["err", "ts", "common", "page", "displays", "actions", "start"]


def log_topic(events: DataFrame) -> DataFrame:
    """The raw log topic; partition and offset follow the event id."""
    return raw_logs(events).select(
        F.lit(topics.ODS_LOG).alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / PARTITIONS).alias("offset"),
        F.col("ts_event").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*LOG_FIELDS)).alias("value"),
    )


# ---- orders -------------------------------------------------------------------


def _order_time(order_key: Column) -> Column:
    seconds = (order_key % ORDER_DAYS) * DAY_SECONDS + (order_key * 977) % DAY_SECONDS
    return seconds + F.lit(1704067200)  # 2024-01-01 00:00:00


def _clock(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def order_info(orders: DataFrame) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    placed = _order_time(key)
    return orders.select(
        key.alias("id"),
        (customer % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        customer.alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        (key % 3).cast("double").alias("activity_reduce_amount"),
        (key % 5).cast("double").alias("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        (key % 20).cast("double").alias("feight_fee"),
        F.lit(0.0).alias("feight_fee_reduce"),
        _clock(placed + 900).alias("expire_time"),
        _clock(placed + 7 * DAY_SECONDS).alias("refundable_time"),
        _clock(placed).alias("create_time"),
        F.when(key % 3 != 0, _clock(placed + 60)).alias("operate_time"),
    )


def order_detail(lineitem: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """Order lines. The id is a hash of six columns that name a line; copies of a line share it.

    Without ``part`` the product name stays null and no join is made.
    """
    key = F.col("l_orderkey")
    identity = F.concat_ws(
        "|",
        *[_text(F.col(c)) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        _text(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        _text(F.col("l_shipdate").cast("date")),
    )
    lines = lineitem
    name = F.lit(None).cast("string")
    if part is not None:
        lines = lineitem.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
        name = F.col("p_name")
    return lines.select(
        F.conv(F.substring(F.md5(identity), 1, 15), 16, 10).cast("bigint").alias("id"),
        key.alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        name.alias("sku_name"),
        _clock(_order_time(key) + F.col("l_linenumber")).alias("create_time"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("split_total_amount"),
        F.lit(0.0).alias("split_activity_amount"),
        F.lit(0.0).alias("split_coupon_amount"),
    )


# ---- dimensions -----------------------------------------------------------------


def _birthday(key: Column) -> Column:
    return F.date_add(F.lit("1960-01-01").cast("date"), ((key * 7919) % 18000).cast("int")).cast("string")


def user_info(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        key.alias("id"),
        F.when(key % 97 == 96, "U").when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        _birthday(key).alias("birthday"),
    )


def base_province(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return nation.select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("CN-"), _text(key)).alias("iso_code"),
        F.concat(F.lit("CN-"), F.substring("n_name", 1, 2), _text(key)).alias("iso_3166_2"),
        _text(key + 100000).alias("area_code"),
    )


# ---- change records ---------------------------------------------------------------


def _change(change_type: Column, table: str, data: list[Column]) -> Column:
    return F.to_json(
        F.struct(change_type.alias("type"), F.lit(table).alias("table"), F.struct(*data).alias("data"))
    )


def _fact_type(key: Column) -> Column:
    return _pick(["insert", "bootstrap-insert", "update", "delete", "table-alter"], key % 5)


def change_topic_of_orders(orders: DataFrame) -> DataFrame:
    """One change per order; every fifth has a type that no consumer knows."""
    info = order_info(orders).withColumn("change", _fact_type(F.col("id")))
    data = [F.col(c) for c in schemas.ORDER_INFO.fieldNames()]
    return info.select(
        (F.col("id") * 10).alias("version"), _change(F.col("change"), "order_info", data).alias("value")
    )


def change_topic_of_lines(lineitem: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """One change per order line, with the product's name if ``part`` is given; prices carry eight decimals."""
    lines = order_detail(lineitem, part).withColumn("change", _fact_type(F.col("order_id")))
    exact = {name: F.round(name, 8) for name in ("order_price", "split_total_amount")}
    data = [exact.get(c, F.col(c)).alias(c) for c in schemas.ORDER_DETAIL.fieldNames()]
    return lines.select(
        (F.col("order_id") * 10 + 1).alias("version"), _change(F.col("change"), "order_detail", data).alias("value")
    )


def change_topic_of_users(customer: DataFrame) -> DataFrame:
    """Each user is inserted with an old birthday, then updated; every seventh is then deleted."""
    users = user_info(customer).withColumn(
        "step",
        F.explode(
            F.when(F.col("id") % 7 == 0, F.array(*map(F.lit, ["bootstrap-insert", "update", "delete"]))).otherwise(
                F.array(*map(F.lit, ["insert", "update"]))
            )
        ),
    )
    first = F.col("step").endswith("insert")
    order = F.when(first, 0).when(F.col("step") == "update", 1).otherwise(2)
    data = [F.col("id"), F.col("gender"), F.when(first, "1900-01-01").otherwise(F.col("birthday")).alias("birthday")]
    return users.select(
        (F.col("id") * 3 + order).cast("bigint").alias("version"),
        _change(F.col("step"), "user_info", data).alias("value"),
    )


def change_topic_of_provinces(nation: DataFrame) -> DataFrame:
    provinces = base_province(nation)
    data = [F.col(c) for c in schemas.BASE_PROVINCE.fieldNames()]
    return provinces.select(
        F.col("id").alias("version"), _change(F.lit("bootstrap-insert"), "base_province", data).alias("value")
    )


def change_topic_of_parts(part: DataFrame) -> DataFrame:
    """Changes of a table that is in no list."""
    data = [F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name")]
    return part.select(
        F.col("p_partkey").alias("version"), _change(F.lit("insert"), "sku_info", data).alias("value")
    )


# ---- views of one folder of tables ---------------------------------------------------


class Shop:
    """The shop views of one table folder, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def log_topic(self) -> DataFrame:
        return log_topic(self.table("events"))

    def order_info(self) -> DataFrame:
        return order_info(self.table("orders"))

    def order_detail(self) -> DataFrame:
        return order_detail(self.table("lineitem"), self.table("part"))

    def order_lines(self) -> DataFrame:
        """Order lines without product names, hence without a join."""
        return order_detail(self.table("lineitem"))

    def user_info(self) -> DataFrame:
        return user_info(self.table("customer"))

    def base_province(self) -> DataFrame:
        return base_province(self.table("nation"))

    def change_topic(self) -> DataFrame:
        """Every change record: ``(version, value)``."""
        return (
            change_topic_of_orders(self.table("orders"))
            .union(change_topic_of_lines(self.table("lineitem"), self.table("part")))
            .union(self.dimension_changes())
            .union(change_topic_of_parts(self.table("part")))
        )

    def dimension_changes(self) -> DataFrame:
        return change_topic_of_users(self.table("customer")).union(
            change_topic_of_provinces(self.table("nation"))
        )
