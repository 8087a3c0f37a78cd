"""SQL twins of the registered queries, straight from the given tables.

Written for DuckDB. They share no code with the Spark side: the shop rules of
FIXTURES.md are stated again here as common table expressions.
"""

from __future__ import annotations

AS_OF = "DATE '2024-06-30'"
DAY = "2024-01-15"


def _json(fields: list[tuple[str, str, bool]], alias: str = "") -> str:
    """SQL for a JSON object; a null field drops out. Fields: (json name, SQL, is text)."""
    parts = []
    for name, sql, is_text in fields:
        value = f"'\"' || {sql} || '\"'" if is_text else f"{sql}"
        parts.append(f"'\"{name}\":' || {value}")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'" + alias


# ---- common table expressions ------------------------------------------------------

_EV = """ev AS (
  SELECT event_id AS e, user_id AS u, epoch_us(ts) // 1000 AS ts, event_id % 50 = 0 AS is_err,
    event_id % 20 <> 10 AS with_page, event_id % 10 = 0 AS with_start,
    'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS user_id, CAST(user_id % 25 AS VARCHAR) AS province_id,
    'ch_' || (user_id % 5) AS channel, CASE WHEN user_id % 3 = 0 THEN '1' ELSE '0' END AS is_new,
    'md_' || (user_id % 7) AS model, CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS operate_system,
    'v2.' || (user_id % 4) AS version_code, CASE WHEN user_id % 11 <> 0 THEN 'ba_' || (user_id % 6) END AS brand,
    event_type AS page_id,
    CASE WHEN event_id % 4 <> 0
      THEN list_extract(['view', 'click', 'signup', 'purchase', 'error'], event_id % 5 + 1) END AS last_page_id,
    json_extract_string(props, '$.k') AS page_item, CASE WHEN event_id % 2 = 0 THEN 'sku_id' END AS page_item_type,
    CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value * 1000) AS BIGINT) END AS during_time,
    CASE event_id % 3 WHEN 1 THEN 'promotion' WHEN 2 THEN 'query' END AS source_type,
    CASE WHEN event_id % 20 = 0 THEN 'icon' ELSE 'notice' END AS entry,
    CAST(event_id % 17 AS VARCHAR) AS open_ad_id, event_id % 3000 AS loading_time_ms,
    event_id % 5000 AS open_ad_ms, CASE WHEN event_id % 30 <> 0 THEN event_id % 1000 END AS open_ad_skip_ms
  FROM events)"""

_COMMON = "mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand"
_PAGE = "page_id, last_page_id, page_item, page_item_type, during_time, source_type"

_PAGES = f"{_EV}, page_log AS (SELECT {_COMMON}, {_PAGE}, ts, e FROM ev WHERE NOT is_err AND with_page)"

_DISPLAYS = f"""displays AS (
  SELECT {_COMMON}, {_PAGE}, CASE WHEN j % 2 = 0 THEN 'promotion' ELSE 'recommend' END AS display_type,
    CAST((e + j) % 100 AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
    CAST(j + 1 AS VARCHAR) AS display_order, CAST((e + j) % 5 AS VARCHAR) AS display_pos_id, ts
  FROM page_log, (VALUES (0), (1), (2)) AS steps(j) WHERE j < e % 4)"""

_ACTIONS = f"""actions AS (
  SELECT {_COMMON}, {_PAGE}, CASE WHEN j = 0 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
    CAST((e + j) % 100 AS VARCHAR) AS action_item, 'sku_id' AS action_item_type, ts
  FROM page_log, (VALUES (0), (1)) AS steps(j) WHERE j < e % 3 AND e % 9 <> 0)"""

_STARTS = """starts AS (
  SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, entry, open_ad_id,
    loading_time_ms, open_ad_ms, open_ad_skip_ms, ts
  FROM ev WHERE NOT is_err AND with_start)"""

_USERS = """users AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 97 = 96 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    strftime(DATE '1960-01-01' + CAST((c_custkey * 7919) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday
  FROM customer)"""

_AGE = (
    f"CAST(date_diff('year', CAST(birthday AS DATE), {AS_OF})"
    f" - CASE WHEN strftime({AS_OF}, '%m%d') < strftime(CAST(birthday AS DATE), '%m%d') THEN 1 ELSE 0 END AS INTEGER)"
)

_PROVINCES = """provinces AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 'CN-' || n_nationkey AS iso_code,
    'CN-' || substr(n_name, 1, 2) || n_nationkey AS iso_3166_2,
    CAST(n_nationkey + 100000 AS VARCHAR) AS area_code
  FROM nation)"""


def _clock(key: str, extra: str = "0") -> str:
    seconds = f"(({key} % 60) * 86400 + ({key} * 977) % 86400 + {extra})"
    return f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST({seconds} AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


_INFO = f"""info AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
    o_totalprice AS total_amount, CAST(o_orderkey % 3 AS DOUBLE) AS activity_reduce_amount,
    CAST(o_orderkey % 5 AS DOUBLE) AS coupon_reduce_amount, o_totalprice AS original_total_amount,
    CAST(o_orderkey % 20 AS DOUBLE) AS feight_fee, CAST(0 AS DOUBLE) AS feight_fee_reduce,
    {_clock('o_orderkey', '900')} AS expire_time, {_clock('o_orderkey', '604800')} AS refundable_time,
    {_clock('o_orderkey')} AS create_time,
    CASE WHEN o_orderkey % 3 <> 0 THEN {_clock('o_orderkey', '60')} END AS operate_time
  FROM orders)"""

_DETAIL = f"""detail AS (
  SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(round(l_extendedprice * 100) AS BIGINT), strftime(l_shipdate, '%Y-%m-%d'))), 1, 15) AS BIGINT) AS id,
    l_orderkey AS order_id, l_partkey AS sku_id, l_extendedprice / l_quantity AS order_price,
    CAST(l_quantity AS BIGINT) AS sku_num, p_name AS sku_name, {_clock('l_orderkey', 'l_linenumber')} AS create_time,
    l_extendedprice * (1 - l_discount) AS split_total_amount, CAST(0 AS DOUBLE) AS split_activity_amount,
    CAST(0 AS DOUBLE) AS split_coupon_amount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

_INFO_COLUMNS = (
    "id province_id order_status user_id total_amount activity_reduce_amount coupon_reduce_amount original_total_amount "
    "feight_fee feight_fee_reduce expire_time refundable_time create_time operate_time"
).split()
_DETAIL_FIELDS = (
    "id order_id sku_id order_price sku_num sku_name create_time split_total_amount split_activity_amount "
    "split_coupon_amount"
).split()
_JOINED = ", ".join(
    ["d.id AS detail_id", *(f"d.{c}" for c in _DETAIL_FIELDS[1:])]
    + [f"i.{c}" for c in _INFO_COLUMNS if c not in ("id", "create_time")]
)

_WIDE_SELECT = f"""SELECT d.id AS detail_id, d.order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
    d.split_total_amount, d.split_activity_amount, d.split_coupon_amount, i.province_id, i.order_status, i.user_id,
    i.total_amount, i.activity_reduce_amount, i.coupon_reduce_amount, i.original_total_amount, i.feight_fee,
    i.feight_fee_reduce, i.expire_time, i.refundable_time, d.create_time, i.operate_time,
    substr(i.create_time, 1, 10) AS create_date, substr(i.create_time, 12, 2) AS create_hour,
    p.name AS province_name, p.area_code AS province_area_code, p.iso_3166_2 AS province_3166_2_code,
    p.iso_code AS province_iso_code, {_AGE} AS user_age, u.gender AS user_gender
  FROM info i JOIN detail d ON d.order_id = i.id LEFT JOIN users u ON i.user_id = u.id
    LEFT JOIN provinces p ON i.province_id = p.id"""

_WIDE = f"{_INFO}, {_DETAIL}, {_USERS}, {_PROVINCES}, wide AS ({_WIDE_SELECT})"
_WIDE_ONCE = f"""{_INFO}, {_DETAIL.replace('detail AS', 'all_detail AS', 1)},
  detail AS (SELECT DISTINCT * FROM all_detail), {_USERS}, {_PROVINCES}, wide AS ({_WIDE_SELECT})"""

_DAY_HOUR = "strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(ts * 1000), '%H') AS hr"

_FIRST = f"""{_PAGES}, first AS (
  SELECT * FROM (
    SELECT *, {_DAY_HOUR}, row_number() OVER (
      PARTITION BY strftime(make_timestamp(ts * 1000), '%Y-%m-%d'), mid
      ORDER BY ts, page_id, page_item, page_item_type NULLS FIRST, during_time NULLS FIRST,
        source_type NULLS FIRST) AS rn
    FROM page_log WHERE last_page_id IS NULL)
  WHERE rn = 1)"""

_DAU = f"""{_FIRST}, {_USERS}, {_PROVINCES}, dau AS (
  SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand, page_id, page_item,
    page_item_type, during_time, source_type, gender AS user_gender, CAST({_AGE} AS VARCHAR) AS user_age,
    name AS province_name, iso_code AS province_iso_code, iso_3166_2 AS province_3166_2,
    area_code AS province_area_code, dt, hr, ts
  FROM first LEFT JOIN users ON user_id = CAST(users.id AS VARCHAR)
    LEFT JOIN provinces ON province_id = CAST(provinces.id AS VARCHAR))"""

# ---- JSON texts ------------------------------------------------------------------------

_TEXT_COMMON = [
    ("mid", "mid"), ("userId", "user_id"), ("provinceId", "province_id"), ("channel", "channel"),
    ("isNew", "is_new"), ("model", "model"), ("operateSystem", "operate_system"), ("versionCode", "version_code"),
]
_CAMEL = [(n, s, True) for n, s in _TEXT_COMMON]
_CAMEL_PAGE = [
    *_CAMEL, ("brand", "brand", True), ("pageId", "page_id", True), ("lastPageId", "last_page_id", True),
    ("pageItem", "page_item", True), ("pageItemType", "page_item_type", True), ("duringTime", "during_time", False),
    ("sourceType", "source_type", True),
]
_TS = [("ts", "ts", False)]
_PAGE_JSON = _json(
    [(c, c, True) for c in f"{_COMMON}, page_id, last_page_id, page_item, page_item_type".split(", ")]
    + [("during_time", "during_time", False), ("sourceType", "source_type", True)] + _TS
)
_DISPLAY_JSON = _json(
    _CAMEL_PAGE
    + [
        ("displayType", "display_type", True), ("displayItem", "display_item", True),
        ("displayItem_type", "display_item_type", True), ("displayOrder", "display_order", True),
        ("displayPosId", "display_pos_id", True),
    ] + _TS
)
_ACTION_JSON = _json(
    _CAMEL_PAGE + [(c, c, True) for c in ("action_id", "action_item", "action_item_type")] + _TS
)
_START_JSON = _json(
    _CAMEL
    + [
        ("entry", "entry", True), ("openAdId", "open_ad_id", True), ("loadingTimeMs", "loading_time_ms", False),
        ("openAdMs", "open_ad_ms", False), ("openAdSkipMs", "open_ad_skip_ms", False),
    ] + _TS
)

_COMMON_JSON = _json([
    ("ar", "province_id", True), ("uid", "user_id", True), ("os", "operate_system", True), ("ch", "channel", True),
    ("is_new", "is_new", True), ("md", "model", True), ("mid", "mid", True), ("vc", "version_code", True),
    ("ba", "brand", True),
])
_RAW_PAGE_JSON = _json([
    ("page_id", "page_id", True), ("item", "page_item", True), ("item_type", "page_item_type", True),
    ("during_time", "during_time", False), ("last_page_id", "last_page_id", True),
    ("source_type", "source_type", True),
])
_RAW_START_JSON = _json([
    ("entry", "entry", True), ("loading_time_ms", "loading_time_ms", False), ("open_ad_id", "open_ad_id", True),
    ("open_ad_ms", "open_ad_ms", False), ("open_ad_skip_ms", "open_ad_skip_ms", False),
])


def _one_display(j: int) -> str:
    kind = "promotion" if j % 2 == 0 else "recommend"
    return (
        f"""'{{"display_type":"{kind}","item":"' || ((e + {j}) % 100) || '","item_type":"sku_id","order":"{j + 1}","""
        f""""pos_id":"' || ((e + {j}) % 5) || '"}}'"""
    )


def _one_action(j: int) -> str:
    kind = "cart_add" if j == 0 else "favor_add"
    return f"""'{{"action_id":"{kind}","item":"' || ((e + {j}) % 100) || '","item_type":"sku_id"}}'"""


_DISPLAY_LIST = "'[' || concat_ws(',', " + ", ".join(
    f"CASE WHEN e % 4 > {j} THEN {_one_display(j)} END" for j in range(3)) + ") || ']'"
_ACTION_LIST = "'[' || concat_ws(',', " + ", ".join(
    f"CASE WHEN e % 3 > {j} THEN {_one_action(j)} END" for j in range(2)) + ") || ']'"
_ERR_JSON = """'{"code":"' || (e % 7) || '","msg":"boom"}'"""

_RAW_JSON = _json([
    ("err", f"CASE WHEN is_err THEN {_ERR_JSON} END", False),
    ("ts", "ts", False),
    ("common", f"({_COMMON_JSON})", False),
    ("page", f"CASE WHEN with_page THEN {_RAW_PAGE_JSON} END", False),
    ("displays", f"CASE WHEN e % 8 <> 0 THEN {_DISPLAY_LIST} END", False),
    ("actions", f"CASE WHEN e % 9 <> 0 THEN {_ACTION_LIST} END", False),
    ("start", f"CASE WHEN with_start THEN {_RAW_START_JSON} END", False),
])

_ROUTED = f"""{_PAGES}, {_DISPLAYS}, {_ACTIONS}, {_STARTS}, routed AS (
  SELECT 'DWD_ERROR_LOG_TOPIC' AS topic, mid AS key, {_RAW_JSON} AS value FROM ev WHERE is_err
  UNION ALL SELECT 'DWD_PAGE_LOG_TOPIC', mid, {_PAGE_JSON} FROM page_log
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC', mid, {_DISPLAY_JSON} FROM displays
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC', mid, {_ACTION_JSON} FROM actions
  UNION ALL SELECT 'DWD_START_LOG_TOPIC', mid, {_START_JSON} FROM starts)"""

# How many records of each topic the even and the odd events give.
_PARITY_COUNTS = f"""{_PAGES}, counts AS (
  SELECT e % 2 AS half, 'DWD_ERROR_LOG_TOPIC' AS topic, count(*) AS n FROM ev WHERE is_err GROUP BY 1
  UNION ALL SELECT e % 2, 'DWD_PAGE_LOG_TOPIC', count(*) FROM page_log GROUP BY 1
  UNION ALL SELECT e % 2, 'DWD_PAGE_DISPLAY_TOPIC', CAST(sum(e % 4) AS BIGINT) FROM page_log GROUP BY 1
  UNION ALL SELECT e % 2, 'DWD_PAGE_ACTION_TOPIC', CAST(sum(CASE WHEN e % 9 <> 0 THEN e % 3 ELSE 0 END) AS BIGINT)
    FROM page_log GROUP BY 1
  UNION ALL SELECT e % 2, 'DWD_START_LOG_TOPIC', count(*) FROM ev WHERE NOT is_err AND with_start GROUP BY 1)"""

# ---- change records ------------------------------------------------------------------------

_INFO_JSON = _json([
    ("id", "id", False), ("province_id", "province_id", False), ("order_status", "order_status", True),
    ("user_id", "user_id", False), ("total_amount", "total_amount", False),
    ("activity_reduce_amount", "activity_reduce_amount", False),
    ("coupon_reduce_amount", "coupon_reduce_amount", False),
    ("original_total_amount", "original_total_amount", False), ("feight_fee", "feight_fee", False),
    ("feight_fee_reduce", "feight_fee_reduce", False), ("expire_time", "expire_time", True),
    ("refundable_time", "refundable_time", True), ("create_time", "create_time", True),
    ("operate_time", "operate_time", True),
])
_DETAIL_JSON = _json([
    ("id", "id", False), ("order_id", "order_id", False), ("sku_id", "sku_id", False),
    ("order_price", "round(order_price, 8)", False), ("sku_num", "sku_num", False),
    ("sku_name", "sku_name", True), ("create_time", "create_time", True),
    ("split_total_amount", "round(split_total_amount, 8)", False),
    ("split_activity_amount", "split_activity_amount", False), ("split_coupon_amount", "split_coupon_amount", False),
])
_USER_JSON = _json([("id", "id", False), ("gender", "gender", True), ("birthday", "birthday", True)])
_PROVINCE_JSON = _json([
    ("id", "id", False), ("name", "name", True), ("iso_code", "iso_code", True),
    ("iso_3166_2", "iso_3166_2", True), ("area_code", "area_code", True),
])
_PART_JSON = _json([("id", "p_partkey", False), ("sku_name", "p_name", True)])


def _fact_type(key: str) -> str:
    return f"list_extract(['insert', 'bootstrap-insert', 'update', 'delete', 'table-alter'], {key} % 5 + 1)"


_USER_STEPS = f"""{_USERS}, user_steps AS (
  SELECT id, gender, '1900-01-01' AS birthday, id * 3 AS version,
    CASE WHEN id % 7 = 0 THEN 'bootstrap-insert' ELSE 'insert' END AS change_type FROM users
  UNION ALL SELECT id, gender, birthday, id * 3 + 1, 'update' FROM users
  UNION ALL SELECT id, gender, birthday, id * 3 + 2, 'delete' FROM users WHERE id % 7 = 0)"""

_OP = ("CASE WHEN change_type IN ('insert', 'bootstrap-insert') THEN 'I'"
       " WHEN change_type = 'update' THEN 'U' WHEN change_type = 'delete' THEN 'D' END")

_DIM_CHANGES = f"""
  SELECT 'user_info' AS table_name, version, change_type, CAST(id AS VARCHAR) AS id, {_USER_JSON} AS data FROM user_steps
  UNION ALL SELECT 'base_province', id, 'bootstrap-insert', CAST(id AS VARCHAR), {_PROVINCE_JSON} FROM provinces"""

_CHANGES = f"""{_INFO}, {_DETAIL}, {_USER_STEPS}, {_PROVINCES}, raw_changes AS (
  SELECT 'order_info' AS table_name, id * 10 AS version, {_fact_type('id')} AS change_type,
    CAST(id AS VARCHAR) AS id, {_INFO_JSON} AS data FROM info
  UNION ALL SELECT 'order_detail', order_id * 10 + 1, {_fact_type('order_id')}, CAST(id AS VARCHAR), {_DETAIL_JSON}
    FROM detail
  UNION ALL {_DIM_CHANGES}
  UNION ALL SELECT 'sku_info', p_partkey, 'insert', CAST(p_partkey AS VARCHAR), {_PART_JSON} FROM part
  ), changes AS (SELECT *, {_OP} AS op FROM raw_changes)"""

_DIM_LATEST = f"""{_USER_STEPS}, {_PROVINCES}, raw_changes AS ({_DIM_CHANGES}),
  ranked AS (SELECT table_name, id, {_OP} AS op, version, data,
    row_number() OVER (PARTITION BY table_name, id ORDER BY version DESC) AS rn FROM raw_changes),
  latest AS (SELECT table_name, id, op, version, data FROM ranked WHERE rn = 1)"""

_IS_FACT = "table_name IN ('order_info', 'order_detail')"
_IS_DIM = "table_name IN ('user_info', 'base_province')"
_FACT_TOPIC = "'DWD_' || upper(table_name) || '_' || op"
_DIM_KEY = "'DIM:' || upper(table_name) || ':' || id"


def _terms(name: str, *terms: str) -> str:
    return " AND ".join(f"list_contains(string_split(lower({name}), ' '), '{t}')" for t in terms)


_HIT = _terms("sku_name", "red", "widget")

_AMOUNTS = f"""{_WIDE}, amounts AS (
  SELECT create_date, user_age AS key, count(*) AS n, sum(split_total_amount) AS amount FROM wide
  WHERE {_HIT} AND user_age IS NOT NULL GROUP BY ALL)"""

_BUCKETS = """
  SELECT create_date, '20岁以下' AS name, round(sum(CASE WHEN key < 20 THEN amount ELSE 0 END), 4) AS value
    FROM amounts GROUP BY create_date
  UNION ALL SELECT create_date, '20到29岁', round(sum(CASE WHEN key BETWEEN 20 AND 29 THEN amount ELSE 0 END), 4)
    FROM amounts GROUP BY create_date
  UNION ALL SELECT create_date, '30岁以上', round(sum(CASE WHEN key >= 30 THEN amount ELSE 0 END), 4)
    FROM amounts GROUP BY create_date"""

_GENDER = "CASE gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE gender END"

_HOURLY = f"{_DAU}, hourly AS (SELECT dt, hr, count(*) AS cnt FROM dau GROUP BY dt, hr)"
_NEXT = "strftime(CAST(dt AS DATE) + 1, '%Y-%m-%d')"

_REALTIME = f"""{_HOURLY}, parts AS (
  SELECT dt AS td, 'today' AS series, hr, cnt FROM hourly
  UNION ALL SELECT {_NEXT}, 'yesterday', hr, cnt FROM hourly
  UNION ALL SELECT td, 'total', NULL, coalesce((SELECT sum(cnt) FROM hourly WHERE dt = td), 0)
    FROM (SELECT dt AS td FROM hourly UNION SELECT {_NEXT} FROM hourly))"""

_DETAIL_COLUMNS = "create_time, order_price, province_name, sku_name, sku_num, total_amount, user_age, user_gender"


def oracle_sql() -> dict[str, str]:
    topic_counts = f"WITH {_ROUTED} SELECT topic, count(*) AS n FROM routed GROUP BY topic"
    all_dau = f"WITH {_DAU} SELECT * FROM dau"
    log_rows = f"""SELECT 'ODS_BASE_LOG' AS topic, CAST(e % 4 AS INTEGER) AS "partition", e // 4 AS "offset",
      {_RAW_JSON} AS value FROM ev"""
    latest = f"WITH {_DIM_LATEST} SELECT table_name, id, op, version, data FROM latest"
    first_keys = f"WITH {_FIRST} SELECT dt, mid FROM first"
    sql = {
        "src_topic": f"WITH {_EV} {log_rows}",
        "src_topic_from_offsets": f"""WITH {_EV} SELECT * FROM ({log_rows})
          WHERE "offset" >= CASE "partition" WHEN 0 THEN 25 WHEN 1 THEN 100 WHEN 2 THEN 60 ELSE 0 END""",
        "commit_after_write": f"WITH {_PARITY_COUNTS} SELECT half AS batch, topic, n FROM counts WHERE n > 0",
        "resume": f"WITH {_PARITY_COUNTS} SELECT half AS run, half AS batch, topic, n FROM counts WHERE n > 0",
        "trigger_5s": topic_counts,
        "sink_topics": f"WITH {_ROUTED} SELECT topic, value FROM routed",
        "sink_topics_keyed": f"WITH {_ROUTED} SELECT topic, key, value FROM routed",
        "route_log": f"WITH {_ROUTED} SELECT topic, value FROM routed",
        "sink_upsert_daily": all_dau,
        "scan_index_field": f"WITH {_DAU} SELECT mid FROM dau WHERE dt = '{DAY}'",
        "sink_dim_upsert": latest,
        "dim_latest": latest,
        "src_table_lists": f"""WITH {_CHANGES}
          SELECT 'fact' AS kind, table_name, count(*) AS n FROM changes
            WHERE op IS NOT NULL AND {_IS_FACT} GROUP BY table_name
          UNION ALL SELECT 'dim', table_name, count(*) FROM changes
            WHERE op IS NOT NULL AND {_IS_DIM} GROUP BY table_name""",
        "parse_json": f"""WITH {_EV} SELECT ts, mid, CASE WHEN with_page THEN page_id END AS page_id,
          CASE WHEN is_err THEN {_ERR_JSON} END AS err,
          CAST(CASE WHEN e % 8 <> 0 THEN e % 4 END AS INTEGER) AS n_displays,
          CAST(CASE WHEN e % 9 <> 0 THEN e % 3 END AS INTEGER) AS n_actions FROM ev""",
        "json_get": f"""WITH {_EV} SELECT mid, ts, CASE WHEN with_page THEN last_page_id END AS last_page_id,
          CASE WHEN with_start THEN entry END AS entry,
          CASE WHEN e % 9 <> 0 AND e % 3 > 0 THEN 'cart_add' END AS first_action FROM ev""",
        "to_json_row": f"WITH {_PAGES} SELECT {_PAGE_JSON} AS value FROM page_log",
        "flatten_common": f"WITH {_EV} SELECT {_COMMON}, ts FROM ev WHERE NOT is_err",
        "page_log": f"WITH {_PAGES} SELECT {_COMMON}, {_PAGE}, ts FROM page_log",
        "explode_displays": f"WITH {_PAGES}, {_DISPLAYS} SELECT * FROM displays",
        "explode_actions": f"WITH {_PAGES}, {_ACTIONS} SELECT * FROM actions",
        "start_log": f"WITH {_EV}, {_STARTS} SELECT * FROM starts",
        "cdc_op": f"WITH {_CHANGES} SELECT table_name, version, change_type, op FROM changes",
        "cdc_fact_topic": f"""WITH {_CHANGES} SELECT {_FACT_TOPIC} AS topic, data AS value FROM changes
          WHERE op IS NOT NULL AND {_IS_FACT}""",
        "copy_by_name": f"""WITH {_PAGES} SELECT {_COMMON}, page_id, page_item, page_item_type, during_time,
          source_type, CAST(NULL AS VARCHAR) AS user_gender, CAST(NULL AS VARCHAR) AS user_age,
          CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_iso_code,
          CAST(NULL AS VARCHAR) AS province_3166_2, CAST(NULL AS VARCHAR) AS province_area_code,
          CAST(NULL AS VARCHAR) AS dt, CAST(NULL AS VARCHAR) AS hr, ts FROM page_log""",
        "merge_order_wide": f"""WITH {_INFO}, {_DETAIL} SELECT {_JOINED}, substr(i.create_time, 1, 10) AS create_date,
          substr(i.create_time, 12, 2) AS create_hour FROM info i JOIN detail d ON d.order_id = i.id""",
        "stat_fields": f"WITH {_WIDE} SELECT {_DETAIL_COLUMNS} FROM wide",
        "route_error": f"WITH {_EV} SELECT {_RAW_JSON} AS value FROM ev WHERE is_err",
        "has_page": f"WITH {_EV} SELECT ts, page_id FROM ev WHERE NOT is_err AND with_page",
        "has_start": f"WITH {_EV} SELECT ts, entry FROM ev WHERE NOT is_err AND with_start",
        "drop_unknown_op": f"WITH {_CHANGES} SELECT table_name, version, op FROM changes WHERE op IS NOT NULL",
        "table_in_set": f"""WITH {_CHANGES}
          SELECT 'fact' AS kind, table_name, version FROM changes WHERE {_IS_FACT}
          UNION ALL SELECT 'dim', table_name, version FROM changes WHERE {_IS_DIM}""",
        "session_start": f"WITH {_PAGES} SELECT mid, page_id, ts FROM page_log WHERE last_page_id IS NULL",
        "match_all_terms": f"WITH {_DETAIL} SELECT id, sku_name FROM detail WHERE {_HIT}",
        "day_partition": f"""WITH {_DAU} SELECT '{DAY}' AS dt, count(*) AS total FROM dau WHERE dt = '{DAY}'
          UNION ALL SELECT '1999-01-01', count(*) FROM dau WHERE dt = '1999-01-01'""",
        "dim_join_user": f"""WITH {_INFO}, {_USERS} SELECT i.id, user_id, gender AS user_gender, {_AGE} AS user_age
          FROM info i LEFT JOIN users u ON i.user_id = u.id""",
        "dim_lookup_user": f"""WITH {_INFO}, {_USERS} SELECT i.id, user_id, gender AS user_gender, {_AGE} AS user_age
          FROM info i LEFT JOIN users u ON i.user_id = u.id WHERE substr(i.create_time, 1, 10) = '{DAY}'""",
        "dim_join_province": f"""WITH {_INFO}, {_PROVINCES} SELECT i.id, province_id, name AS province_name,
          iso_code AS province_iso_code, iso_3166_2 AS province_3166_2_code, area_code AS province_area_code
          FROM info i LEFT JOIN provinces p ON i.province_id = p.id""",
        "order_full_outer": f"""WITH {_INFO}, {_DETAIL.replace("p_name AS sku_name", "CAST(NULL AS VARCHAR) AS sku_name")}
          SELECT {", ".join(f"i.{c} AS info_{c}" for c in _INFO_COLUMNS)},
            {", ".join(f"d.{c} AS detail_{c}" for c in _DETAIL_FIELDS)}
          FROM info i FULL OUTER JOIN detail d ON d.order_id = i.id""",
        "order_buffered_join": f"""WITH {_INFO}, {_DETAIL} SELECT DISTINCT {_JOINED}
          FROM info i JOIN detail d ON d.order_id = i.id""",
        "state_ttl_24h": f"""WITH {_INFO}, {_DETAIL} SELECT DISTINCT d.id AS detail_id, d.order_id, d.create_time
          FROM info i JOIN detail d ON d.order_id = i.id WHERE d.id % 7 <> 0""",
        "order_waiting_join": f"""WITH {_INFO}, {_DETAIL} SELECT DISTINCT d.id AS detail_id, d.order_id, d.create_time
          FROM info i JOIN detail d ON d.order_id = i.id
          WHERE i.id % 10 < 2 OR EXISTS (SELECT 1 FROM detail later WHERE later.order_id = i.id AND later.id % 3 <> 0)""",
        "order_wide": f"WITH {_WIDE_ONCE} SELECT * FROM wide",
        "order_wide_stream": f"WITH {_WIDE_ONCE} SELECT * FROM wide",
        "orphan_orders": f"""WITH {_INFO}, {_DETAIL}
          SELECT 'header' AS side, id, id AS order_id, create_time FROM info
            WHERE NOT EXISTS (SELECT 1 FROM detail WHERE order_id = info.id)
          UNION ALL SELECT 'line', id, order_id, create_time FROM detail
            WHERE NOT EXISTS (SELECT 1 FROM info WHERE info.id = order_id)""",
        "dau_total": f"WITH {_DAU} SELECT dt, count(*) AS total FROM dau GROUP BY dt",
        "dau_by_hour": f"WITH {_HOURLY} SELECT * FROM hourly",
        "dau_by_hour_filled": f"""WITH {_HOURLY}, spine AS (
            SELECT dt, lpad(CAST(h AS VARCHAR), 2, '0') AS hr
            FROM (SELECT DISTINCT dt FROM hourly), range(24) AS hours(h))
          SELECT spine.dt, spine.hr, coalesce(cnt, 0) AS cnt FROM spine
          LEFT JOIN hourly ON spine.dt = hourly.dt AND spine.hr = hourly.hr""",
        "amount_by_field": f"WITH {_AMOUNTS} SELECT create_date, key, n, round(amount, 4) AS amount FROM amounts",
        "top_terms": f"""WITH {_WIDE} SELECT sku_id AS key, count(*) AS n FROM wide GROUP BY sku_id
          ORDER BY n DESC, key LIMIT 100""",
        "age_bucket_amount": f"WITH {_AMOUNTS.replace(_HIT, _terms('sku_name', 'widget'))} {_BUCKETS}",
        "gender_label": f"WITH {_USERS} SELECT id, {_GENDER} AS gender FROM users",
        "dau_dedup": f"WITH {_FIRST} SELECT dt, hr, mid, page_id, ts FROM first",
        "dau_dedup_stream": first_keys,
        "dau_state_rebuild": f"WITH {_FIRST} SELECT dt, mid, ts FROM first WHERE dt >= '{DAY}'",
        "paginate": f"""WITH {_INFO}, {_DETAIL} SELECT d.id AS detail_id, d.create_time, d.order_id
          FROM detail d JOIN info i ON d.order_id = i.id ORDER BY d.create_time DESC, d.id LIMIT 20 OFFSET 40""",
        "paginate_after": f"""WITH {_INFO}, {_DETAIL} SELECT d.id AS detail_id, d.create_time, d.order_id
          FROM detail d JOIN info i ON d.order_id = i.id ORDER BY d.create_time DESC, d.id LIMIT 20 OFFSET 40""",
        "paginate_deep": f"""WITH {_INFO}, {_DETAIL} SELECT d.id AS detail_id, d.create_time, d.order_id
          FROM detail d JOIN info i ON d.order_id = i.id ORDER BY d.create_time DESC, d.id LIMIT 20 OFFSET 3980""",
        "detail_total": f"WITH {_WIDE} SELECT create_date, count(*) AS total FROM wide WHERE {_HIT} GROUP BY create_date",
        "ts_to_dt_hr": f"WITH {_PAGES} SELECT mid, ts, {_DAY_HOUR} FROM page_log",
        "split_create_time": f"""WITH {_INFO} SELECT id, substr(create_time, 1, 10) AS create_date,
          substr(create_time, 12, 2) AS create_hour FROM info""",
        "age_years": f"WITH {_USERS} SELECT id, birthday, {_AGE} AS age FROM users",
        "upper_concat": f"""WITH {_CHANGES} SELECT version, {_FACT_TOPIC} AS topic, {_DIM_KEY} AS key FROM changes
          WHERE op IS NOT NULL""",
        "highlight": f"""WITH {_DETAIL} SELECT id, replace(sku_name, 'widget', '<em>widget</em>') AS sku_name
          FROM detail WHERE {_terms('sku_name', 'widget')}""",
        "prev_day": f"""WITH {_INFO} SELECT id, substr(create_time, 1, 10) AS day,
          strftime(CAST(substr(create_time, 1, 10) AS DATE) - 1, '%Y-%m-%d') AS prev_day FROM info""",
        "code_label": f"""WITH {_USERS}
          SELECT id, 'age' AS kind, 'user_age' AS field, CAST({_AGE} AS VARCHAR) AS value FROM users
          UNION ALL SELECT id, 'gender', 'user_gender', gender FROM users""",
        "dau_realtime": f"WITH {_REALTIME} SELECT td, series, hr, CAST(cnt AS BIGINT) AS cnt FROM parts",
        "dau_realtime_rolled": f"WITH {_REALTIME} SELECT td, series, hr, CAST(cnt AS BIGINT) AS cnt FROM parts",
        "dau_realtime_day": f"""WITH {_REALTIME} SELECT td, series, hr, CAST(cnt AS BIGINT) AS cnt FROM parts
          WHERE td = '{DAY}'""",
        "stats_by_item": f"""WITH {_WIDE} SELECT create_date,
          CASE user_gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE user_gender END AS name,
          round(sum(split_total_amount), 4) AS value FROM wide WHERE {_HIT} GROUP BY ALL""",
        "stats_by_item_rolled": f"""WITH {_WIDE} SELECT create_date,
          CASE user_gender WHEN 'F' THEN '女' WHEN 'M' THEN '男' ELSE user_gender END AS name,
          round(sum(split_total_amount), 4) AS value FROM wide WHERE {_HIT} GROUP BY ALL""",
        "detail_empty_page": f"""WITH {_WIDE} SELECT {_DETAIL_COLUMNS}, total
          FROM (SELECT count(*) AS total FROM wide WHERE create_date = '{DAY}' AND {_HIT})
          LEFT JOIN (SELECT {_DETAIL_COLUMNS} FROM wide WHERE false) ON true""",
        "stats_by_item_age": f"WITH {_AMOUNTS} {_BUCKETS}",
        "detail_by_item": f"""WITH {_WIDE}, found AS (
            SELECT * FROM wide WHERE create_date = '{DAY}' AND {_HIT})
          SELECT create_time, order_price, province_name,
            regexp_replace(sku_name, '(red|widget)', '<em>\\1</em>', 'g') AS sku_name, sku_num, total_amount, user_age,
            user_gender, (SELECT count(*) FROM found) AS total
          FROM found ORDER BY found.create_time DESC, detail_id LIMIT 20""",
        "dau_wide": all_dau,
        "dau_wide_stream": f"""WITH {_DAU} SELECT dt, mid, user_id, user_gender, user_age, province_name,
          province_3166_2 FROM dau""",
        "route_cdc": f"""WITH {_CHANGES}
          SELECT 'fact' AS target, {_FACT_TOPIC} AS topic, CAST(NULL AS VARCHAR) AS key, version, op, data AS value
            FROM changes WHERE op IS NOT NULL AND {_IS_FACT}
          UNION ALL SELECT 'dim', NULL, {_DIM_KEY}, version, op, data FROM changes WHERE op IS NOT NULL AND {_IS_DIM}""",
        "route_cdc_stream": f"""WITH {_CHANGES}
          SELECT {_FACT_TOPIC} AS name, count(*) AS n FROM changes WHERE op IS NOT NULL AND {_IS_FACT} GROUP BY 1
          UNION ALL SELECT upper(table_name), count(DISTINCT id) FROM changes
            WHERE op IS NOT NULL AND {_IS_DIM} GROUP BY 1""",
    }
    sql |= _reports()
    return sql


_VIEWS = f"{_PAGES}, views AS (SELECT *, {_DAY_HOUR} FROM page_log)"
_VISITS = f"""{_VIEWS}, numbered AS (SELECT *, sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END)
    OVER (PARTITION BY mid ORDER BY ts, e ROWS UNBOUNDED PRECEDING) AS session FROM views),
  visits AS (SELECT mid, session, arg_min(is_new, ts) AS is_new, arg_min(channel, ts) AS channel, count(*) AS pages,
  coalesce(sum(during_time), 0) AS millis FROM numbered GROUP BY mid, session)"""


def _reports() -> dict[str, str]:
    total = """SELECT count(*) AS pv_count, count(DISTINCT mid) AS uv_count,
      count(DISTINCT CASE WHEN is_new = '1' THEN mid END) AS new_count FROM views"""
    steps = [("home", "view"), ("detail", "click"), ("order", "signup"), ("pay", "purchase")]
    funnel = " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(DISTINCT user_id) AS users FROM page_log WHERE page_id = '{page}'"
        for step, page in steps
    ) + " UNION ALL SELECT 'cart', count(DISTINCT user_id) FROM actions WHERE action_id = 'cart_add'"
    amount = "round(sum(split_total_amount), 4)"
    sold = "detail JOIN part ON sku_id = p_partkey"
    return {
        "pv_by_day": f"WITH {_VIEWS} SELECT dt, count(*) AS pv FROM views GROUP BY dt",
        "uv_by_day": f"WITH {_VIEWS} SELECT dt, count(DISTINCT mid) AS uv FROM views GROUP BY dt",
        "visit_total": f"WITH {_VIEWS} {total}",
        "visit_total_week": f"WITH {_VIEWS} {total} WHERE dt BETWEEN '2024-01-09' AND '{DAY}'",
        "new_vs_old": f"""WITH {_VISITS} SELECT is_new, CAST(sum(pages) AS BIGINT) AS pv, count(DISTINCT mid) AS uv,
          round(avg(CASE WHEN pages = 1 THEN 1.0 ELSE 0.0 END), 6) AS bounce_rate,
          round(CAST(sum(millis) AS DOUBLE) / 1000 / count(*), 6) AS mean_seconds,
          round(CAST(sum(pages) AS DOUBLE) / count(*), 6) AS mean_pages FROM visits GROUP BY is_new""",
        "channel_pv": f"WITH {_VIEWS} SELECT channel, count(*) AS pv FROM views GROUP BY channel",
        "channel_bounce": f"""WITH {_VISITS} SELECT channel,
          round(avg(CASE WHEN pages = 1 THEN 1.0 ELSE 0.0 END), 6) AS bounce_rate FROM visits GROUP BY channel""",
        "page_path": f"""WITH {_VIEWS} SELECT last_page_id AS source, page_id AS target, count(*) AS value FROM views
          WHERE last_page_id IS NOT NULL GROUP BY ALL""",
        "page_path_nodes": f"""WITH {_VIEWS} SELECT page_id AS name FROM views WHERE last_page_id IS NOT NULL
          UNION SELECT last_page_id FROM views WHERE last_page_id IS NOT NULL""",
        "action_funnel": f"WITH {_PAGES}, {_ACTIONS} {funnel}",
        "user_total": f"""WITH {_VIEWS}, {_INFO}, {_USERS}, flags AS (
          SELECT id, EXISTS (SELECT 1 FROM info WHERE info.user_id = users.id) AS ordered,
            EXISTS (SELECT 1 FROM views WHERE is_new = '1' AND views.user_id = CAST(users.id AS VARCHAR)) AS fresh
          FROM users)
          SELECT count(*) AS user_total, count(*) FILTER (ordered) AS order_user_total,
            count(*) FILTER (fresh) AS new_user_count, count(*) FILTER (fresh AND ordered) AS new_order_user_count
          FROM flags""",
        "paid_share": f"""WITH {_INFO}, {_USERS} SELECT
            CASE WHEN id IN (SELECT user_id FROM info) THEN 'paid' ELSE 'unpaid' END AS name, count(*) AS value
          FROM users GROUP BY 1""",
        "order_total": f"""WITH {_INFO} SELECT count(*) AS order_count, round(sum(total_amount), 2) AS order_amount,
          count(DISTINCT user_id) AS order_user FROM info""",
        "spu_top": f"""WITH {_DETAIL} SELECT sku_name AS name, {amount} AS value FROM detail GROUP BY 1
          ORDER BY sum(split_total_amount) DESC, 1 LIMIT 7""",
        "brand_top": f"""WITH {_DETAIL} SELECT p_brand AS name, {amount} AS value FROM {sold} GROUP BY 1
          ORDER BY sum(split_total_amount) DESC, 1 LIMIT 7""",
        "category_share": f"WITH {_DETAIL} SELECT p_type AS name, round(sum(split_total_amount), 2) AS value FROM {sold} GROUP BY 1",
        "area_orders": f"""WITH {_INFO}, {_DETAIL}, {_PROVINCES} SELECT p.name, count(DISTINCT order_id) AS orders,
          {amount} AS amount
          FROM detail d JOIN info i ON d.order_id = i.id LEFT JOIN provinces p ON p.id = i.province_id GROUP BY 1""",
    }
