"""Order wide rows: header and line joined, with user and province."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.time import create_date, create_hour
from rillmart.operators.dims import join_province, join_user, keep_latest


def enrich_headers(
    info: DataFrame,
    users: DataFrame | None,
    provinces: DataFrame | None,
    as_of: str | dt.date | None = None,
) -> DataFrame:
    """Headers with ``create_date``, ``create_hour`` and the given dimensions.

    A lookup that a query does not use is better left out (``None``): Spark
    cannot know that ids are unique, so it would make the join anyway.
    """
    dated = info.withColumn("create_date", create_date(F.col("create_time"))).withColumn(
        "create_hour", create_hour(F.col("create_time"))
    )
    with_user = dated if users is None else join_user(dated, users, as_of)
    return with_user if provinces is None else join_province(with_user, provinces)


def unique_by_id(rows: DataFrame) -> DataFrame:
    """One row per id: replayed copies fall away before the join, the latest ``create_time`` stays."""
    rest = [c for c in rows.columns if c not in ("id", "create_time")]
    # one hash settles equal times as well as all columns would, and sorts less
    marked = rows.withColumn("_tie", F.xxhash64(*rest))
    return keep_latest(marked, ["id"], ["create_time", "_tie"]).drop("_tie")


def merge(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Join on the order id and lay the line over the header.

    The line's ``create_time`` wins (the one name both carry); date and hour
    stay the header's. The second key follows from the first: with it Spark
    shuffles both sides here instead of reusing the partitioning of an earlier
    dedup, and only such a plain shuffle can adaptive execution split when one
    order is hot.
    """
    h = headers.drop("create_time").withColumnRenamed("id", "_header_id")
    d = lines.withColumnRenamed("id", "detail_id")
    same_order = (F.col("order_id") == F.col("_header_id")) & (
        F.xxhash64("order_id") == F.xxhash64("_header_id")
    )
    joined = d.join(h, same_order)
    return joined.select(*[c for c in schemas.ORDER_WIDE if c in joined.columns])


def order_wide(
    info: DataFrame,
    detail: DataFrame,
    users: DataFrame | None,
    provinces: DataFrame | None,
    as_of: str | dt.date | None = None,
    unique: bool = True,
) -> DataFrame:
    """The order wide table. ``unique=False`` skips the dedup for inputs whose ids are unique already."""
    if unique:
        info, detail = unique_by_id(info), unique_by_id(detail)
    return merge(enrich_headers(info, users, provinces, as_of), detail)


def full_outer(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Full outer join of headers and lines on the order id.

    Adaptive execution cannot split a hot key of a full outer join, so it is
    put together from a left join (whose left side, the lines, can be split)
    and the headers that no line names (an anti join against distinct keys).
    """
    h = info.select(*[F.col(c).alias(f"info_{c}") for c in info.columns])
    d = detail.select(*[F.col(c).alias(f"detail_{c}") for c in detail.columns])
    names = h.columns + d.columns
    with_lines = d.join(h, F.col("detail_order_id") == F.col("info_id"), "left").select(*names)
    alone = headers_without_lines(info, detail).select(
        *[F.col(c).alias(f"info_{c}") for c in info.columns],
        *[F.lit(None).cast(f.dataType).alias(f"detail_{f.name}") for f in detail.schema.fields],
    )
    return with_lines.unionByName(alone)


def headers_without_lines(info: DataFrame, detail: DataFrame) -> DataFrame:
    keys = detail.select(F.col("order_id").alias("id")).distinct()
    return info.join(keys, "id", "left_anti")


def lines_without_header(info: DataFrame, detail: DataFrame) -> DataFrame:
    return detail.join(info.select(F.col("id").alias("order_id")), "order_id", "left_anti")


def orphans(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Rows that never find their other half, as ``(side, id, order_id, create_time)``."""
    headers = headers_without_lines(info, detail).select(
        F.lit("header").alias("side"), "id", F.col("id").alias("order_id"), "create_time"
    )
    lines = lines_without_header(info, detail).select(F.lit("line").alias("side"), "id", "order_id", "create_time")
    return headers.union(lines)
