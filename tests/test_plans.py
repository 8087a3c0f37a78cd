"""The physical plans that large inputs depend on."""

import re

import pytest
from pyspark.sql import functions as F

from rillmart.operators import dims, logs, orders
from rillmart.plans.queries import REGISTRY
from rillmart.session import run_folder
from rillmart.sources import shop_views as views
from rillmart.streaming import sinks
from rillmart import schemas

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return [line for line in plan_of(df).splitlines() if re.search(rf"[ *)-]{name}\b", line)]


@pytest.mark.parametrize("name", ["dau_wide", "order_wide", "dim_latest", "dau_dedup"])
def test_latest_row_is_cut_before_the_shuffle(spark, name):
    plan = plan_of(REGISTRY[name](spark, FOLDER)).splitlines()
    exchange = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in plan[exchange:])


@pytest.mark.parametrize("name", ["route_log", "page_log", "route_cdc", "route_error"])
def test_routing_needs_no_shuffle_and_parses_once(spark, name):
    df = REGISTRY[name](spark, FOLDER)
    # The only exchange may be the one over the two table lists.
    assert len(nodes(df, "Exchange")) <= (1 if name == "route_cdc" else 0)
    for line in plan_of(df).splitlines():
        assert "from_json" not in line or "explode(array(from_json" in line


def test_counting_reads_few_columns_and_sorts_nothing(spark):
    df = REGISTRY["dau_total"](spark, FOLDER)
    assert not nodes(df, "Sort") and "HashAggregate" in plan_of(df)


def test_page_is_a_top_k(spark):
    assert "TakeOrderedAndProject(limit=60, offset=40" in plan_of(REGISTRY["paginate"](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not n.startswith(("src_", "sink_"))
                                        and n not in ("resume", "commit_after_write", "trigger_5s", "state_ttl_24h",
                                                      "order_buffered_join", "scan_index_field", "day_partition")
                                        and not n.endswith("_stream")))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(REGISTRY[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert word not in plan
    # One task may only ever receive sums that the others have made already.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate(keys=[], functions=[partial_" in lines[i + 1]


def test_a_day_reads_its_partition_only(spark):
    schema = schemas.struct(mid="string", v="bigint", dt="string")
    table = sinks.DailyTable(spark, f"{run_folder(spark, 't_prune')}/t", schema, "mid")
    table.append(spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 1, "2024-01-02")], schema), version=1)
    scan = nodes(table.read("2024-01-02"), "FileScan")
    assert len(scan) == 1 and re.search(r"PartitionFilters: \[[^\]]*2024-01-02", scan[0])


@pytest.fixture
def split_settings(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_order_is_split(spark, split_settings):
    """Half of all lines belong to one order; the adaptive plan splits its partition and loses no row."""
    shop = views.Shop(spark, FOLDER)
    hot = F.when(F.col("l_orderkey") % 2 == 0, F.lit(77)).otherwise(F.col("l_orderkey"))
    detail = views.order_detail(shop.table("lineitem").withColumn("l_orderkey", hot).repartition(16), shop.table("part"))
    info = shop.order_info()
    results = {
        "deduped": orders.order_wide(info, detail, shop.user_info(), shop.base_province()),
        "plain": orders.order_wide(info, detail, shop.user_info(), shop.base_province(), unique=False),
        "outer": orders.full_outer(info, detail),
        "orphans": orders.lines_without_header(info, detail),
    }
    lines = detail.count()
    for name, df in results.items():
        n = len(df.collect())
        assert "skew=true" in plan_of(df), name
        if name in ("deduped", "plain"):
            assert n == lines


def test_hot_device_and_hot_copies(spark):
    """A device with most page views, and a line that is mostly copies, still give one row each."""
    shop = views.Shop(spark, FOLDER)
    events = shop.table("events").withColumn("user_id", F.when(F.col("event_id") % 3 > 0, 1).otherwise(F.col("user_id")))
    page_log = logs.page_views(logs.parse_logs(views.log_topic(events)))
    from rillmart.operators import dau

    days = dau.dau_wide(page_log, shop.user_info(), shop.base_province())
    assert days.count() == days.select("dt", "mid").distinct().count() == dau.first_times(page_log).count()
    lineitem = shop.table("lineitem")
    copies = lineitem.limit(1).crossJoin(spark.range(5000)).drop("id")
    wide = orders.order_wide(shop.order_info(), views.order_detail(lineitem.union(copies)), None, None)
    assert wide.count() == lineitem.count()


def test_only_rows_with_rivals_are_ranked(spark, monkeypatch):
    rows = [(1, "a", 1), (1, "a", 2), (1, "b", 1), (2, None, 1), (2, None, 3), (None, None, 1), (None, "a", 5), (3, "c", None), (3, "c", 0)]
    path = f"{run_folder(spark, 't_few')}/rows"
    spark.createDataFrame(rows, "id INT, name STRING, v INT").write.parquet(path)
    stored = spark.read.parquet(path)
    want = sorted(map(str, dims.keep_latest(stored, ["id", "name"], ["v"]).collect()))
    for most in (100_000, 1):
        monkeypatch.setattr(dims, "FEW_REPEATED", most)
        assert sorted(map(str, dims.keep_latest_of_few(stored, ["id", "name"], ["v"]).collect())) == want
    few = dims.keep_latest_of_few(stored.where("v = 1"), ["id", "name"], ["v"])
    assert not nodes(few, "Exchange") and not nodes(few, "Sort") and few.count() == 4
    assert few.columns == stored.columns
