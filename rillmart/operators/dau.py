"""Daily active users: first page view of each device on each day, with user and province."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.time import ms_date, ms_hour
from rillmart.operators.dims import join_province, join_user


def session_starts(page_log: DataFrame) -> DataFrame:
    """Page views that open a visit. Must come before the dedup."""
    return page_log.where(F.col("last_page_id").isNull())


def with_day_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", ms_date(F.col("ts"))).withColumn("hr", ms_hour(F.col("ts")))


def first_times(page_log: DataFrame) -> DataFrame:
    """Only ``(dt, hr, mid, ts)`` of the first rows: all that counting needs.

    A minimum by key combines before the shuffle and needs no sort.
    """
    starts = session_starts(page_log).withColumn("dt", ms_date(F.col("ts")))
    first = starts.groupBy("dt", "mid").agg(F.min("ts").alias("ts"))
    return first.select("dt", ms_hour(F.col("ts")).alias("hr"), "mid", "ts")


def first_of_day(page_log: DataFrame) -> DataFrame:
    """The earliest row of each ``(dt, mid)``; equal times are settled by one hash of the other columns."""
    rest = [c for c in page_log.columns if c not in ("dt", "mid", "ts")]
    window = Window.partitionBy("dt", "mid").orderBy("ts", "_tie")
    marked = page_log.withColumn("_tie", F.xxhash64(*rest))
    return marked.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "_tie")


def enrich(
    first: DataFrame, users: DataFrame, provinces: DataFrame, as_of: str | dt.date | None = None
) -> DataFrame:
    """First views to rows of the daily index."""
    wide = join_province(join_user(first, users, as_of), provinces, iso_3166_2="province_3166_2")
    return wide.withColumn("user_age", F.col("user_age").cast("string")).select(*schemas.DAU_INFO)


def dau_wide(
    page_log: DataFrame, users: DataFrame, provinces: DataFrame, as_of: str | dt.date | None = None
) -> DataFrame:
    return enrich(first_of_day(with_day_hour(session_starts(page_log))), users, provinces, as_of)


def not_yet_stored(first: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose ``(dt, mid)`` the daily index does not hold: the dedup state rebuilt from the index.

    ``stored`` need only be of the days of ``first``.
    """
    return first.join(stored.select("dt", "mid"), ["dt", "mid"], "left_anti")
