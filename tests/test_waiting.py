"""Orders whose lines wait anew with each line."""

import pytest
from pyspark.sql import functions as F
from test_streaming import Feed, info, line

from rillmart import schemas
from rillmart.functions.records import from_rows
from rillmart.session import run_folder
from rillmart.streaming import run
from rillmart.streaming.waiting import waiting_join

T = "2024-01-01 10:00:00"


def going(spark, headers, lines, folder, how="inner"):
    joined = waiting_join(
        from_rows(headers.stream(), schemas.ORDER_INFO, "timestamp"), from_rows(lines.stream(), schemas.ORDER_DETAIL, "timestamp"), how
    ).select("detail_id", "order_id", "_header_id", "split_total_amount", "total_amount", "_line_time", "_header_time")
    run.run_to_end(spark, joined.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/c", 3)
    return spark.read.parquet(f"{folder}/out")


def test_each_line_restarts_the_wait(spark):
    headers, lines, folder = Feed(spark, "w_info"), Feed(spark, "w_detail"), run_folder(spark, "w_join")
    # order 1: lines 30 and 10 hours before the header; order 2: only 30 hours; order 3: 30 and 5 hours, with 25 between
    lines.add(line(11, 1, T), line(21, 2, T), line(31, 3, T), hour=0)
    headers.add(info(90, T), hour=0)
    lines.add(line(12, 1, T), hour=20)
    headers.add(info(91, T), hour=20)
    lines.add(line(32, 3, T), hour=25)
    headers.add(info(92, T), hour=25)
    headers.add(info(1, T), info(2, T), info(3, T), hour=30)
    lines.add(line(901, 90, T), line(902, 92, T), hour=30)  # 90 came 30 hours before, 92 only 5
    assert sorted((r.detail_id, r.order_id) for r in going(spark, headers, lines, folder).collect()) == [(11, 1), (12, 1), (32, 3), (902, 92)]


def test_state_outlives_a_restart_and_lines_are_given_up(spark):
    headers, lines, folder = Feed(spark, "w_info"), Feed(spark, "w_detail"), run_folder(spark, "w_again")
    headers.add(info(1, T), info(1, T), hour=0)
    lines.add(line(11, 1, T), line(99, 9, T), line(99, 9, T), hour=0)
    going(spark, headers, lines, folder, "left_outer")
    headers.add(info(5, T), hour=20)
    lines.add(line(12, 1, T), line(98, 9, T), hour=20)
    going(spark, headers, lines, folder, "left_outer")
    for hour in (200, 400):
        headers.add(info(hour, T), hour=hour)
        lines.add(line(hour, hour, T), hour=hour)
    rows = going(spark, headers, lines, folder, "left_outer")
    got = sorted((r.detail_id, r._header_id or 0, r.total_amount or 0.0) for r in rows.collect())
    assert got == [(11, 1, 1.0), (12, 1, 1.0), (98, 0, 0.0), (99, 0, 0.0), (99, 0, 0.0), (200, 200, 1.0), (400, 400, 1.0)]
    assert rows.where("detail_id = 12").select((F.col("_line_time").cast("long") - F.col("_header_time").cast("long")).alias("x")).first().x == 20 * 3600


def test_a_header_that_comes_again_waits_anew(spark):
    headers, lines, folder = Feed(spark, "w_info"), Feed(spark, "w_detail"), run_folder(spark, "w_anew")
    headers.add(info(1, T), hour=0)
    lines.add(line(1000, 1000, T), hour=0)
    headers.add(info(1, T), hour=20)
    lines.add(line(1001, 1000, T), hour=20)
    headers.add(info(2, T), hour=40)
    lines.add(line(11, 1, T), line(21, 2, T), hour=40)
    assert sorted(r.detail_id for r in going(spark, headers, lines, folder).collect()) == [11, 21]


def test_orders_of_one_bucket_share_a_state_row_and_wait_apart(spark):
    headers, lines, folder = Feed(spark, "w_info"), Feed(spark, "w_detail"), run_folder(spark, "w_bucket")
    headers.add(*[info(n, T) for n in range(100, 200)], hour=0)
    lines.add(line(11, 1, T), line(21, 2, T), *[line(n + 1000, n, T) for n in range(100, 200)], hour=0)
    headers.add(info(3, T), hour=20)
    lines.add(line(22, 2, T), line(23, 2, T), hour=20)
    headers.add(info(1, T), info(2, T), hour=30)  # the only line of order 1 came 30 hours before
    lines.add(line(31, 3, T), hour=30)
    topics = [from_rows(f.stream(), s, "timestamp") for f, s in ((headers, schemas.ORDER_INFO), (lines, schemas.ORDER_DETAIL))]
    joined = waiting_join(*topics, "left_outer", buckets=2).select("detail_id", "order_id", "_header_id")
    query = run.run_to_end(spark, joined.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/c", 3)
    got = {r.detail_id: r._header_id for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {11: None, 21: 2, 22: 2, 23: 2, 31: 3} | {n + 1000: n for n in range(100, 200)}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 2


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        waiting_join(None, None, "full_outer")
