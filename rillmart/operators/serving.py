"""Serving queries over the two daily indexes (``dau_info`` and ``order_wide``).

Each takes an optional day. With a day only that day's partition is read; a
day that does not exist gives an empty result, never an error. Without a day
the query answers for every day at once and keeps the day as a column.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.labels import AGE_LABELS, gender_label, stat_field
from rillmart.functions.text import highlight, match_all_terms
from rillmart.functions.time import next_day

MAX_TERMS = 100  # fixed value: default length of a list of terms
PAGE_SIZE = 20  # fixed value: default page size


def of_day(index: DataFrame, day: str | None, column: str = "dt") -> DataFrame:
    return index if day is None else index.where(F.col(column) == day)


def scan_field(index: DataFrame, field: str, day: str, column: str = "dt") -> DataFrame:
    """The values of one field on one day."""
    return of_day(index, day, column).select(field)


# ---- daily active users -----------------------------------------------------------


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``(dt, total)``; for a given day always one row, 0 if there is no data."""
    if day is None:
        return dau.groupBy("dt").agg(F.count("*").alias("total"))
    return of_day(dau, day).agg(F.lit(day).alias("dt"), F.count("*").alias("total"))


def dau_by_hour(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``(dt, hr, cnt)`` for the hours that occur."""
    return of_day(dau, day).groupBy("dt", "hr").agg(F.count("*").alias("cnt"))


def dau_by_hour_filled(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``(dt, hr, cnt)`` with all 24 hours of a day, 0 where nothing happened."""
    hourly = dau_by_hour(dau, day)
    hours = [F.lit(f"{h:02d}") for h in range(24)]
    zero = F.lit(0).cast("bigint")
    if day is None:
        # Each counted hour brings the 24 zero rows of its day along; days x 24 rows, no join.
        blank = [F.struct(hr.alias("hr"), zero.alias("cnt")) for hr in hours]
        rows = hourly.select("dt", F.inline(F.array(F.struct("hr", "cnt"), *blank)))
    else:
        blank = dau.sparkSession.range(1).select(F.explode(F.array(*hours)).alias("hr"))
        rows = hourly.union(blank.select(F.lit(day), "hr", zero))
    return rows.groupBy("dt", "hr").agg(F.sum("cnt").alias("cnt"))


def dau_realtime(dau: DataFrame, day: str | None = None) -> DataFrame:
    """``(td, series, hr, cnt)``: the day's total, its hours, and the hours of the day before.

    ``series`` is ``total`` (``hr`` null), ``today`` or ``yesterday``. One
    aggregation by hour feeds all three.
    """
    source = dau
    if day is not None:
        source = dau.where(F.col("dt").isin(day, _shift(day, -1)))
    return realtime_of_hours(dau_by_hour(source), day)


def realtime_of_hours(hourly: DataFrame, day: str | None = None) -> DataFrame:
    """``dau_realtime`` from ``(dt, hr, cnt)``, one row an hour."""
    if day is not None:
        hourly = hourly.where(F.col("dt").isin(day, _shift(day, -1)))

    def row(td: Column, series: str, hr: Column, cnt: Column) -> Column:
        return F.struct(td.alias("td"), F.lit(series).alias("series"), hr.alias("hr"), cnt.alias("cnt"))

    today, tomorrow, hr, cnt = F.col("dt"), next_day(F.col("dt")), F.col("hr"), F.col("cnt")
    no_hour, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    rows = F.array(
        row(today, "today", hr, cnt),
        row(tomorrow, "yesterday", hr, cnt),
        row(today, "total", no_hour, cnt),
        row(tomorrow, "total", no_hour, zero),
    )
    parts = hourly.select(F.explode(rows).alias("row")).select("row.*")
    if day is not None:
        empty = hourly.sparkSession.range(1).select(
            F.lit(day).alias("td"), F.lit("total").alias("series"), no_hour.alias("hr"), zero.alias("cnt")
        )
        parts = parts.where(F.col("td") == day).union(empty)
    return parts.groupBy("td", "series", "hr").agg(F.sum("cnt").alias("cnt"))


def _shift(day: str, days: int) -> str:
    return str(dt.date.fromisoformat(day) + dt.timedelta(days=days))


# ---- orders by item -----------------------------------------------------------------


def hits(wide: DataFrame, item_name: str, day: str | None = None) -> DataFrame:
    """Order lines whose product name holds every term of ``item_name``."""
    return of_day(wide, day, "create_date").where(match_all_terms(F.col("sku_name"), item_name))


def top_terms(df: DataFrame, field: str, k: int = MAX_TERMS) -> DataFrame:
    """The ``k`` most frequent values of a field as ``(key, n)``: by count, then by value."""
    counts = df.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("key")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "key").limit(k)


def amount_by_field(wide: DataFrame, item_name: str, field: str, day: str | None = None) -> DataFrame:
    """``(create_date, key, n, amount)``: sum of ``split_total_amount`` by each value of ``field``."""
    return (
        hits(wide, item_name, day)
        .where(F.col(field).isNotNull())
        .groupBy("create_date", F.col(field).alias("key"))
        .agg(F.count("*").alias("n"), F.sum("split_total_amount").alias("amount"))
    )


def age_buckets(amounts: DataFrame) -> DataFrame:
    """``(create_date, name, value)`` for the three age groups: all three for a day with any hit, else none."""
    age, amount = F.col("key").cast("int"), F.col("amount")
    groups = (age < 20, (age >= 20) & (age <= 29), age >= 30)
    sums = [F.sum(F.when(test, amount).otherwise(0.0)) for test in groups]
    pairs = F.array(
        *[F.struct(F.lit(label).alias("name"), total.alias("value")) for label, total in zip(AGE_LABELS, sums)]
    )
    daily = amounts.groupBy("create_date").agg(pairs.alias("pairs"))
    return daily.select("create_date", F.inline("pairs"))


def gender_amounts(amounts: DataFrame) -> DataFrame:
    return amounts.select("create_date", gender_label(F.col("key")).alias("name"), F.col("amount").alias("value"))


def stats_by_item(wide: DataFrame, item_name: str, kind: str, day: str | None = None) -> DataFrame:
    """``(create_date, name, value)``: amounts of an item by ``age`` group or ``gender``."""
    amounts = amount_by_field(wide, item_name, stat_field(kind), day)
    return age_buckets(amounts) if kind == "age" else gender_amounts(amounts)


ITEM_GROUPS = ["create_date", "sku_name", "user_gender", "user_age"]  # what the statistics of an item ask for


def stats_of_rollup(rolled: DataFrame, item_name: str, kind: str, day: str | None = None) -> DataFrame:
    """``stats_by_item`` from sums by ``ITEM_GROUPS``, ``(n, amount)``: a few rows for each name and day instead of all lines."""
    field = stat_field(kind)
    found = hits(rolled, item_name, day).where(F.col(field).isNotNull()).groupBy("create_date", F.col(field).alias("key"))
    amounts = found.agg(F.sum("n").alias("n"), F.sum("amount").cast("double").alias("amount"))
    return age_buckets(amounts) if kind == "age" else gender_amounts(amounts)


# ---- order detail search --------------------------------------------------------------


def paginate(rows: DataFrame, order: list[Column], page_no: int = 1, page_size: int = PAGE_SIZE) -> DataFrame:
    """One page in a fixed order. Spark runs it as a top-k, not as a full sort."""
    if page_no < 1 or page_size < 0:
        raise ValueError("page_no starts at 1 and page_size cannot be negative")
    return rows.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)


def page_after(rows: DataFrame, cursor: tuple[str, int] | None, page_size: int = PAGE_SIZE) -> DataFrame:
    """The page after the row with this ``(create_time, detail_id)``, newest first; from the start without one.

    Any page is a top-k of its own size, however deep it is; on rows that are stored by time the filter skips all before.
    """
    if cursor is not None:
        created, detail = cursor
        after = (F.col("create_time") == created) & (F.col("detail_id") > detail)
        rows = rows.where((F.col("create_time") <= created) & ((F.col("create_time") < created) | after))
    return rows.orderBy(*newest_first()).limit(page_size)


def newest_first() -> list[Column]:
    return [F.desc("create_time"), F.col("detail_id")]


def detail_fields(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.DETAIL_COLUMNS)


def detail_total(wide: DataFrame, item_name: str, day: str | None = None) -> DataFrame:
    """``(create_date, total)`` of the hits; for a given day always one row."""
    found = hits(wide, item_name, day)
    if day is None:
        return found.groupBy("create_date").agg(F.count("*").alias("total"))
    return found.agg(F.lit(day).alias("create_date"), F.count("*").alias("total"))


class DetailPage(NamedTuple):
    total: DataFrame  # one row: create_date, total
    detail: DataFrame  # the rows of the page, names highlighted


def detail_by_item(
    wide: DataFrame, day: str, item_name: str, page_no: int = 1, page_size: int = PAGE_SIZE
) -> DetailPage:
    found = hits(wide, item_name, day)
    page = paginate(found.select(*schemas.DETAIL_COLUMNS, "detail_id"), newest_first(), page_no, page_size)
    marked = page.withColumn("sku_name", highlight(F.col("sku_name"), item_name))
    return DetailPage(detail_total(wide, item_name, day), detail_fields(marked))


def detail_with_total(page: DetailPage) -> DataFrame:
    """The rows of the page, each with the total; of an empty page one row with nothing but the total."""
    rows = page.detail.agg(F.collect_list(F.struct("*")).alias("rows"))  # a page of bounded size
    each = rows.select(F.explode_outer("rows").alias("row"))
    return each.select("row.*", page.total.select("total").scalar().alias("total"))
