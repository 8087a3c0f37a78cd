import pytest
from pyspark.sql import functions as F

from rillmart.functions.text import highlight, match_all_terms, query_terms
from rillmart.functions.labels import stat_field
from rillmart.operators import serving

DAY = "2024-01-02"


@pytest.fixture
def wide(spark):
    rows = [
        # detail_id, create_date, create_time, sku_name, user_age, user_gender, split_total_amount
        (1, DAY, "2024-01-02 10:00:00", "red ring", 19, "F", 1.0),
        (2, DAY, "2024-01-02 11:00:00", "Red-Ring XL", 20, "M", 2.0),
        (3, DAY, "2024-01-02 11:00:00", "ring, red", 29, "X", 4.0),
        (4, DAY, "2024-01-02 12:00:00", "red rings", 30, "F", 8.0),
        (5, DAY, "2024-01-02 13:00:00", "red  ring", 30, "F", 16.0),
        (6, "2024-01-03", "2024-01-03 13:00:00", "red ring", None, None, 32.0),
    ]
    df = spark.createDataFrame(
        rows,
        "detail_id BIGINT, create_date STRING, create_time STRING, sku_name STRING, user_age INT, user_gender STRING,"
        " split_total_amount DOUBLE",
    )
    return df.select(
        "*", F.lit(5.0).alias("order_price"), F.lit("North").alias("province_name"),
        F.lit(2).cast("bigint").alias("sku_num"), F.lit(10.0).alias("total_amount"),
    )


def as_dict(df):
    return {r.name: r.value for r in df.collect()}


def test_terms():
    assert query_terms("Red, RING-xl 2") == ["2", "red", "ring", "xl"]
    assert query_terms("红色 iPhone手机") == sorted(["红", "色", "iphone", "手", "机"])
    assert query_terms(" -_- ") == []


@pytest.mark.parametrize(
    "name, text, hit",
    [
        ("red ring", "ring red", True), ("red rings", "ring", False), ("Red", "RED", True), ("red", "", False),
        ("小米手机10", "手机", True), ("小米手机10", "机小", True), ("小米手机10", "10", True), ("小米手机10", "1", False),
        (None, "red", False),
    ],
)
def test_match(spark, name, text, hit):
    df = spark.createDataFrame([(name,)], "n STRING")
    assert df.where(match_all_terms(F.col("n"), text)).count() == int(hit)


@pytest.mark.parametrize(
    "name, text, want",
    [
        ("Red ring, rings", "ring red", "<em>Red</em> <em>ring</em>, rings"),
        ("小米手机x10", "手机", "小米<em>手</em><em>机</em>x10"),
        ("红x", "x", "红<em>x</em>"),
    ],
)
def test_highlight(spark, name, text, want):
    df = spark.createDataFrame([(name,)], "n STRING")
    assert df.select(highlight(F.col("n"), text)).collect()[0][0] == want


def test_age_groups(wide):
    assert as_dict(serving.stats_by_item(wide, "red ring", "age", DAY)) == {
        "20岁以下": 1.0, "20到29岁": 6.0, "30岁以上": 16.0,
    }
    # A day whose only hit has no age has no groups; so has an item nobody bought.
    assert serving.stats_by_item(wide, "ring", "age", "2024-01-03").count() == 0
    assert serving.stats_by_item(wide, "hammer", "age", DAY).count() == 0
    assert as_dict(serving.stats_by_item(wide, "rings", "age", DAY)) == {
        "20岁以下": 0.0, "20到29岁": 0.0, "30岁以上": 8.0,
    }


def test_genders(wide):
    assert as_dict(serving.stats_by_item(wide, "red ring", "gender", DAY)) == {"女": 17.0, "男": 2.0, "X": 4.0}
    with pytest.raises(ValueError):
        stat_field("height")


def test_detail_page(wide):
    page = serving.detail_by_item(wide, DAY, "red ring", page_no=1, page_size=3)
    assert page.total.collect()[0].total == 4
    assert [(r.create_time[11:13], r.sku_name) for r in page.detail.collect()] == [
        ("13", "<em>red</em>  <em>ring</em>"),
        ("11", "<em>Red</em>-<em>Ring</em> XL"),
        ("11", "<em>ring</em>, <em>red</em>"),
    ]
    assert [r.sku_num for r in serving.detail_by_item(wide, DAY, "ring", 2, 3).detail.collect()] == [2]
    beyond = serving.detail_by_item(wide, DAY, "red ring", page_no=9)
    assert beyond.detail.count() == 0 and beyond.total.collect()[0].total == 4
    missing = serving.detail_by_item(wide, "1999-01-01", "red ring")
    assert missing.detail.count() == 0 and missing.total.collect()[0].total == 0


def test_top_terms_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k STRING")
    assert [(r.key, r.n) for r in serving.top_terms(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


def test_every_group_counts(spark):
    rows = [(DAY, "ring", age, 1.0) for age in range(150)]
    df = spark.createDataFrame(rows, "create_date STRING, sku_name STRING, user_age INT, split_total_amount DOUBLE")
    assert serving.amount_by_field(df, "ring", "user_age").count() == 150
    assert sum(r.value for r in serving.stats_by_item(df, "ring", "age").collect()) == 150.0


def test_daily_active(spark):
    rows = [("2024-01-01", "09", "a"), ("2024-01-01", "09", "b"), ("2024-01-02", "23", "a")]
    index = spark.createDataFrame(rows, "dt STRING, hr STRING, mid STRING")
    assert {(r.dt, r.total) for r in serving.dau_total(index).collect()} == {("2024-01-01", 2), ("2024-01-02", 1)}
    assert [tuple(r) for r in serving.dau_total(index, "1999-01-01").collect()] == [("1999-01-01", 0)]
    filled = {(r.dt, r.hr): r.cnt for r in serving.dau_by_hour_filled(index).collect()}
    assert len(filled) == 48 and sum(filled.values()) == 3 and filled["2024-01-01", "09"] == 2
    one = {r.hr: r.cnt for r in serving.dau_by_hour_filled(index, "2024-01-02").collect()}
    assert len(one) == 24 and one["23"] == 1 and one["00"] == 0
    empty = {r.hr: r.cnt for r in serving.dau_by_hour_filled(index, "1999-01-01").collect()}
    assert len(empty) == 24 and set(empty.values()) == {0}
    realtime = {(r.series, r.hr): r.cnt for r in serving.dau_realtime(index, "2024-01-02").collect()}
    assert realtime == {("total", None): 1, ("today", "23"): 1, ("yesterday", "09"): 2}
    assert {(r.series, r.hr): r.cnt for r in serving.dau_realtime(index, "1999-01-01").collect()} == {("total", None): 0}
