import pytest

from rillmart import schemas
from rillmart.operators import orders

INFO = dict(
    id=1, province_id=1, order_status="1001", user_id=1, total_amount=10.0, activity_reduce_amount=0.0,
    coupon_reduce_amount=0.0, original_total_amount=10.0, feight_fee=0.0, feight_fee_reduce=0.0, expire_time=None,
    refundable_time=None, create_time="2024-01-01 23:59:59", operate_time=None,
)
LINE = dict(
    id=11, order_id=1, sku_id=5, order_price=5.0, sku_num=2, sku_name="red ring", create_time="2024-01-02 00:00:03",
    split_total_amount=10.0, split_activity_amount=0.0, split_coupon_amount=0.0,
)


@pytest.fixture
def info(spark):
    return lambda *rows: spark.createDataFrame([tuple((INFO | r).values()) for r in rows], schemas.ORDER_INFO)


@pytest.fixture
def detail(spark):
    return lambda *rows: spark.createDataFrame([tuple((LINE | r).values()) for r in rows], schemas.ORDER_DETAIL)


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, "F", "2000-01-01")], schemas.USER_INFO)


@pytest.fixture
def provinces(spark):
    return spark.createDataFrame([(1, "North", "CN-1", "CN-N1", "100001")], schemas.BASE_PROVINCE)


def test_line_overwrites_time_and_header_keeps_the_date(info, detail, users, provinces):
    wide = orders.order_wide(info({}), detail({}), users, provinces, "2024-06-30")
    assert wide.columns == schemas.ORDER_WIDE
    row = wide.collect()[0]
    assert (row.detail_id, row.order_id, row.create_time) == (11, 1, "2024-01-02 00:00:03")
    assert (row.create_date, row.create_hour) == ("2024-01-01", "23")
    assert (row.user_age, row.user_gender, row.province_3166_2_code) == (24, "F", "CN-N1")


def test_copies_and_missing_dimensions(info, detail, users, provinces):
    wide = orders.order_wide(
        info({"user_id": 99, "province_id": 99}, {"user_id": 99, "province_id": 99}),
        detail({}, {}, {"id": 12}, {"id": 13, "order_id": 2}),
        users, provinces, "2024-06-30",
    )
    rows = wide.orderBy("detail_id").collect()
    assert [r.detail_id for r in rows] == [11, 12]
    assert rows[0].user_gender is None and rows[0].province_name is None


def test_full_outer_and_orphans(info, detail):
    i, d = info({}, {"id": 2}), detail({}, {"id": 12}, {"id": 13, "order_id": 3}, {"id": 14, "order_id": None})
    rows = orders.full_outer(i, d).collect()
    want = i.join(d, i.id == d.order_id, "full_outer").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, map(tuple, want)))
    assert sorted((r.side, r.id) for r in orders.orphans(i, d).collect()) == [
        ("header", 2), ("line", 13), ("line", 14),
    ]
