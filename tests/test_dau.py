import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.time import age_years, prev_day
from rillmart.operators import dau

DAY_MS = 86_400_000


def ms(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


@pytest.fixture
def page_log(spark):
    def make(*rows):
        schema = schemas.wire_schema(schemas.PAGE_LOG)
        blank = dict.fromkeys(schema.fieldNames())
        data = [tuple((blank | {"user_id": "1", "province_id": "1"} | r).values()) for r in rows]
        return spark.createDataFrame(data, schema).withColumnRenamed("sourceType", "source_type")

    return make


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, "F", "2000-02-29"), (2, "M", "1990-06-30")], schemas.USER_INFO)


@pytest.fixture
def provinces(spark):
    return spark.createDataFrame([(1, "North", "CN-1", "CN-N1", "100001")], schemas.BASE_PROVINCE)


def test_one_row_per_device_and_day(page_log, users, provinces):
    log = page_log(
        {"mid": "a", "page_id": "late", "ts": ms("2024-01-01 12:00:00")},
        {"mid": "a", "page_id": "first", "ts": ms("2024-01-01 09:30:00")},
        {"mid": "a", "page_id": "inner", "last_page_id": "x", "ts": ms("2024-01-01 00:00:01")},
        {"mid": "a", "page_id": "before", "ts": ms("2024-01-01 23:59:59")},
        {"mid": "a", "page_id": "after", "ts": ms("2024-01-02 00:00:00")},
        {"mid": "b", "page_id": "never", "last_page_id": "x", "ts": ms("2024-01-01 10:00:00")},
    )
    rows = dau.dau_wide(log, users, provinces, "2024-06-30").orderBy("dt").collect()
    assert [(r.dt, r.hr, r.mid, r.page_id) for r in rows] == [
        ("2024-01-01", "09", "a", "first"), ("2024-01-02", "00", "a", "after"),
    ]
    assert rows[0].user_gender == "F" and rows[0].user_age == "24" and rows[0].province_3166_2 == "CN-N1"
    times = dau.first_times(log).orderBy("dt").collect()
    assert [(r.dt, r.hr, r.mid, r.ts) for r in times] == [(r.dt, r.hr, r.mid, r.ts) for r in rows]


def test_missing_dimensions_give_nulls(page_log, users, provinces):
    log = page_log({"mid": "a", "user_id": "99", "province_id": None, "ts": 0})
    row = dau.dau_wide(log, users, provinces).collect()[0]
    assert row.user_gender is None and row.user_age is None and row.province_name is None


def test_rerun_adds_nothing_that_is_stored(spark, page_log):
    first = dau.first_of_day(dau.with_day_hour(page_log({"mid": "a", "ts": 0}, {"mid": "b", "ts": 0})))
    stored = spark.createDataFrame([("1970-01-01", "a"), ("1970-01-02", "b")], "dt STRING, mid STRING")
    assert [r.mid for r in dau.not_yet_stored(first, stored).collect()] == ["b"]


@pytest.mark.parametrize(
    "birthday, as_of, age",
    [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("2000-06-30", "2024-06-30", 24),
        ("2000-07-01", "2024-06-30", 23),
        ("1999-12-31", "2024-01-01", 24),
    ],
)
def test_age(spark, birthday, as_of, age):
    row = spark.range(1).select(age_years(F.lit(birthday), as_of).alias("age")).collect()[0]
    assert row.age == age


def test_prev_day(spark):
    assert spark.range(1).select(prev_day(F.lit("2024-03-01"))).collect()[0][0] == "2024-02-29"
