import json

from rillmart import schemas
from rillmart.functions.records import copy_by_name, from_wire
from rillmart.operators import logs
from rillmart.sources import topics

COMMON = {"ar": "1", "uid": "7", "os": "iOS", "ch": "c", "is_new": "1", "md": "m", "mid": "mid_7", "vc": "v1", "ba": "b"}
PAGE = {"page_id": "home", "during_time": 10}
START = {"entry": "icon", "loading_time_ms": 3, "open_ad_id": "9", "open_ad_ms": 4, "open_ad_skip_ms": 0}


def routed(values, *records):
    rows = logs.route_logs(logs.parse_logs(values(*records))).collect()
    return sorted((r.topic, r.value or "") for r in rows)


def test_error_goes_only_to_the_error_topic_and_whole(values):
    record = {"err": {"code": 1}, "ts": 5, "common": COMMON, "page": PAGE, "start": START}
    assert routed(values, record) == [(topics.ERROR_LOG, json.dumps(record))]


def test_null_error_is_no_error(values):
    assert [t for t, _ in routed(values, {"err": None, "ts": 1, "common": COMMON, "page": PAGE})] == [topics.PAGE_LOG]


def test_page_and_start_in_one_record(values):
    got = routed(values, {"ts": 5, "common": COMMON, "page": PAGE, "start": START})
    assert [t for t, _ in got] == [topics.PAGE_LOG, topics.START_LOG]
    start = json.loads(got[1][1])
    assert "brand" not in start and start["openAdSkipMs"] == 0 and start["userId"] == "7"


def test_arrays_empty_missing_or_without_page(values):
    display = [{"display_type": "promotion", "item": "1", "item_type": "sku", "order": "1", "pos_id": "2"}]
    action = [{"action_id": "cart_add", "item": "1", "item_type": "sku", "ts": 99}]
    got = routed(
        values,
        {"ts": 1, "common": COMMON, "page": PAGE, "displays": [], "actions": []},
        {"ts": 2, "common": COMMON, "page": PAGE},
        {"ts": 3, "common": COMMON, "displays": display, "actions": action},
        {"ts": 4, "common": COMMON, "page": PAGE, "displays": display * 2, "actions": action},
        {"ts": 5, "common": COMMON, "page": PAGE, "actions": action},
    )
    by_topic = [t for t, _ in got]
    assert by_topic.count(topics.PAGE_LOG) == 4
    assert by_topic.count(topics.PAGE_DISPLAY) == 2
    assert by_topic.count(topics.PAGE_ACTION) == 2
    # An action row carries the time of its log, not its own.
    assert sorted(json.loads(v)["ts"] for t, v in got if t == topics.PAGE_ACTION) == [4, 5]
    assert json.loads(got[0][1])["action_id"] == "cart_add"


def test_absent_fields_stay_null(values):
    parsed = logs.parse_logs(values({"common": {"mid": "m"}, "page": {"page_id": "p"}}, {"page": {"page_id": "q"}}))
    rows = {r.page_id: r for r in logs.page_views(parsed).collect()}
    assert rows["p"].during_time is None and rows["p"].ts is None and rows["q"].mid is None


def test_corrupt_records_are_kept_apart(values):
    got = routed(values, "not json", None, '{"ts": "x"', {"ts": 1, "common": COMMON, "page": PAGE})
    assert [v for t, v in got if t == topics.CORRUPT] == ["", "not json", '{"ts": "x"']
    assert [t for t, _ in got].count(topics.PAGE_LOG) == 1 and len(got) == 4


def test_error_comes_before_unreadable_fields_and_quoted_numbers_are_read(values):
    bad = json.dumps({"err": {"code": 1}, "ts": "soon", "common": COMMON})
    quoted = {"ts": "7", "common": COMMON, "page": PAGE | {"during_time": "123"}}
    got = routed(values, bad, quoted)
    assert [t for t, _ in got] == [topics.ERROR_LOG, topics.PAGE_LOG] and got[0][1] == bad
    page = json.loads(got[1][1])
    assert page["ts"] == 7 and page["during_time"] == 123
    assert logs.normal_records(logs.parse_logs(values(bad))).count() == 0


def test_routes_agree_with_the_single_tables(values):
    display = {"display_type": "promotion", "item": "1", "item_type": "sku", "order": "1", "pos_id": "2"}
    records = [
        {"ts": 4, "common": COMMON, "page": PAGE, "displays": [display, display | {"order": "2"}],
         "actions": [{"action_id": "a"}, {"action_id": "b"}], "start": START},
        {"ts": 9, "common": COMMON, "page": PAGE | {"last_page_id": "x"}, "displays": [display]},
    ]
    parsed = logs.parse_logs(values(*records))
    all_routed = logs.route_logs(parsed)
    for topic, record, table in [
        (topics.PAGE_LOG, schemas.PAGE_LOG, logs.page_views),
        (topics.PAGE_DISPLAY, schemas.DISPLAY_LOG, logs.page_displays),
        (topics.PAGE_ACTION, schemas.ACTION_LOG, logs.page_actions),
        (topics.START_LOG, schemas.START_LOG, logs.app_starts),
    ]:
        back = from_wire(all_routed.where(all_routed.topic == topic), record)
        assert back.columns == schemas.columns(record)
        assert sorted(map(str, back.collect())) == sorted(map(str, table(parsed).collect()))


def test_copy_by_name_needs_name_and_type(spark):
    source = spark.createDataFrame([(1, "x", "z")], "a INT, b STRING, extra STRING")
    target = schemas.struct(a="bigint", b="string", c="double")
    copied = copy_by_name(source, target)
    assert copied.schema == target and copied.collect()[0].asDict() == {"a": None, "b": "x", "c": None}
