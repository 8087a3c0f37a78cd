from rillmart.operators import changes, dims


def change(kind, table, **data):
    return {"type": kind, "table": table, "data": data, "ts": 1, "xid": 2}


def lists(spark):
    return changes.table_lists(spark, ["order_info", "sku_info"], ["user_info", "sku_info"])


def test_operation_codes(values):
    kinds = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "table-alter"]
    rows = changes.parse_changes(values(*[change(k, "t", id=1) for k in kinds])).orderBy("version").collect()
    assert [r.op for r in rows] == ["I", "I", "U", "D", None, None]


def test_routing_by_list(spark, values):
    records = [
        change("insert", "order_info", id=1, total_amount=2.5),
        change("update", "sku_info", id=2),
        change("delete", "user_info", id=3),
        change("insert", "nowhere", id=4),
        change("table-create", "order_info", id=5),
        "oops",
        '{"type": "insert", "data": {"id": 6}}',
    ]
    parsed = changes.parse_changes(values(*records))
    rows = changes.route_changes(parsed, lists(spark)).collect()
    assert sorted((r.target, r.topic, r.key, r.value) for r in rows if r.target == "fact") == [
        ("fact", "DWD_ORDER_INFO_I", None, '{"id":1,"total_amount":2.5}'),
        ("fact", "DWD_SKU_INFO_U", None, '{"id":2}'),
    ]
    assert sorted((r.key, r.op) for r in rows if r.target == "dim") == [
        ("DIM:SKU_INFO:2", "U"), ("DIM:USER_INFO:3", "D"),
    ]
    assert [r.value for r in rows if r.target == "corrupt"] == ["oops"]
    assert sorted(r.topic for r in changes.fact_records(parsed, lists(spark)).collect()) == [
        "DWD_ORDER_INFO_I", "DWD_SKU_INFO_U",
    ]
    assert {r.key for r in changes.dim_records(parsed, lists(spark)).collect()} == {
        "DIM:SKU_INFO:2", "DIM:USER_INFO:3",
    }


def test_latest_dimension_row_whatever_the_order(spark, values):
    records = [
        (3, change("delete", "user_info", id=1, gender="F", birthday="2000-01-03")),
        (1, change("insert", "user_info", id=1, gender="F", birthday="2000-01-01")),
        (2, change("update", "user_info", id=1, gender="F", birthday="2000-01-02")),
        (9, change("insert", "user_info", id=2, gender="M", birthday="1990-01-01")),
    ]
    rows = values(*[c for _, c in records]).drop("version")
    versions = spark.createDataFrame([(v,) for v, _ in records], "version BIGINT")
    paired = spark.createDataFrame(
        [(v.version, r.value) for v, r in zip(versions.collect(), rows.collect())], "version BIGINT, value STRING"
    )
    latest = dims.dim_latest(changes.dim_records(changes.parse_changes(paired), lists(spark)))
    # A delete writes its row like any other change.
    assert {(r.id, r.gender, r.birthday) for r in dims.users(latest).collect()} == {
        (1, "F", "2000-01-03"), (2, "M", "1990-01-01"),
    }
    kept = dims.dim_latest(changes.dim_records(changes.parse_changes(paired), lists(spark)), drop_deleted=True)
    assert [r.id for r in dims.users(kept).collect()] == [2]
