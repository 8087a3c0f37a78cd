"""Record layouts: nested inputs as Spark types, outputs as field tables.

Tables use snake_case column names. On the wire (the JSON payload of a topic)
some records use other names, so each output record is a table of
``(column, wire name, type)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A struct type; needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields.items()])


def like(df, names) -> T.StructType:
    """The schema of some columns of ``df``, in the order of ``names``."""
    return T.StructType([df.schema[name] for name in names])


def strings(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


# ---- nested inputs ---------------------------------------------------------

CORRUPT = "_corrupt_record"

_COMMON = struct(**strings("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba"))
_PAGE = struct(
    **strings("page_id", "item", "item_type", "during_time", "last_page_id", "source_type")
)
_DISPLAY = struct(**strings("display_type", "item", "item_type", "order", "pos_id"))
_ACTION = struct(**strings("action_id", "item", "item_type"))
_START = struct(**strings("entry", "loading_time_ms", "open_ad_id", "open_ad_ms", "open_ad_skip_ms"))

# ``err`` is any JSON value; read as STRING it keeps its JSON text. Numbers are read as text too, as producers may quote
# them, and become numbers where they are used.
LOG_RECORD = struct(
    err="string",
    ts="string",
    common=_COMMON,
    page=_PAGE,
    displays=T.ArrayType(_DISPLAY),
    actions=T.ArrayType(_ACTION),
    start=_START,
    **strings(CORRUPT),
)

# ``data`` differs by table, so it stays JSON text until its table is known.
CHANGE_RECORD = struct(**strings("type", "table", "data", CORRUPT))

# Same columns as Spark's Kafka source, with key and value already text.
TOPIC_RECORD = struct(
    topic="string", partition="int", offset="bigint", timestamp="timestamp", key="string", value="string"
)

# ---- outputs: (column, wire name, type); fixed values -----------------------

PAGE_LOG = [
    ("mid", "mid", "string"),
    ("user_id", "user_id", "string"),
    ("province_id", "province_id", "string"),
    ("channel", "channel", "string"),
    ("is_new", "is_new", "string"),
    ("model", "model", "string"),
    ("operate_system", "operate_system", "string"),
    ("version_code", "version_code", "string"),
    ("brand", "brand", "string"),
    ("page_id", "page_id", "string"),
    ("last_page_id", "last_page_id", "string"),
    ("page_item", "page_item", "string"),
    ("page_item_type", "page_item_type", "string"),
    ("during_time", "during_time", "bigint"),
    ("source_type", "sourceType", "string"),
    ("ts", "ts", "bigint"),
]

DISPLAY_LOG = [
    ("mid", "mid", "string"),
    ("user_id", "userId", "string"),
    ("province_id", "provinceId", "string"),
    ("channel", "channel", "string"),
    ("is_new", "isNew", "string"),
    ("model", "model", "string"),
    ("operate_system", "operateSystem", "string"),
    ("version_code", "versionCode", "string"),
    ("brand", "brand", "string"),
    ("page_id", "pageId", "string"),
    ("last_page_id", "lastPageId", "string"),
    ("page_item", "pageItem", "string"),
    ("page_item_type", "pageItemType", "string"),
    ("during_time", "duringTime", "bigint"),
    ("source_type", "sourceType", "string"),
    ("display_type", "displayType", "string"),
    ("display_item", "displayItem", "string"),
    ("display_item_type", "displayItem_type", "string"),
    ("display_order", "displayOrder", "string"),
    ("display_pos_id", "displayPosId", "string"),
    ("ts", "ts", "bigint"),
]

ACTION_LOG = [
    *DISPLAY_LOG[:15],
    ("action_id", "action_id", "string"),
    ("action_item", "action_item", "string"),
    ("action_item_type", "action_item_type", "string"),
    ("ts", "ts", "bigint"),
]

# Start rows carry no brand.
START_LOG = [
    *DISPLAY_LOG[:8],
    ("entry", "entry", "string"),
    ("open_ad_id", "openAdId", "string"),
    ("loading_time_ms", "loadingTimeMs", "bigint"),
    ("open_ad_ms", "openAdMs", "bigint"),
    ("open_ad_skip_ms", "openAdSkipMs", "bigint"),
    ("ts", "ts", "bigint"),
]

ORDER_INFO = struct(
    id="bigint",
    province_id="bigint",
    order_status="string",
    user_id="bigint",
    total_amount="double",
    activity_reduce_amount="double",
    coupon_reduce_amount="double",
    original_total_amount="double",
    feight_fee="double",
    feight_fee_reduce="double",
    **strings("expire_time", "refundable_time", "create_time", "operate_time"),
)

ORDER_DETAIL = struct(
    id="bigint",
    order_id="bigint",
    sku_id="bigint",
    order_price="double",
    sku_num="bigint",
    sku_name="string",
    create_time="string",
    split_total_amount="double",
    split_activity_amount="double",
    split_coupon_amount="double",
)

USER_INFO = struct(id="bigint", gender="string", birthday="string")
BASE_PROVINCE = struct(id="bigint", **strings("name", "iso_code", "iso_3166_2", "area_code"))

DAU_INFO = [
    "mid", "user_id", "province_id", "channel", "is_new", "model", "operate_system", "version_code", "brand",
    "page_id", "page_item", "page_item_type", "during_time", "source_type", "user_gender", "user_age",
    "province_name", "province_iso_code", "province_3166_2", "province_area_code", "dt", "hr", "ts",
]

ORDER_WIDE = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "split_total_amount",
    "split_activity_amount", "split_coupon_amount", "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee", "feight_fee_reduce",
    "expire_time", "refundable_time", "create_time", "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_3166_2_code", "province_iso_code", "user_age", "user_gender",
]

# Columns of the order search page. ``sku_name`` comes back highlighted.
DETAIL_COLUMNS = [
    "create_time", "order_price", "province_name", "sku_name", "sku_num", "total_amount", "user_age", "user_gender",
]


def columns(record: list[tuple[str, str, str]]) -> list[str]:
    return [name for name, _, _ in record]


def wire_schema(record: list[tuple[str, str, str]]) -> T.StructType:
    return struct(**{wire: kind for _, wire, kind in record})
