"""Streaming forms over several small batches, restarts and replays."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_dau import ms

from rillmart import schemas
from rillmart.functions.records import from_rows, from_wire
from rillmart.operators import changes, dau, dims, serving
from rillmart.plans import queries
from rillmart.session import run_folder
from rillmart.sources import topics
from rillmart.sources.shop_views import Shop
from rillmart.streaming import jobs, run, sinks


class Feed:
    """A folder that gets one file per batch, read one file per micro-batch."""

    def __init__(self, spark, name):
        self.spark, self.path, self.n = spark, f"{run_folder(spark, name)}/in", 0

    def add(self, *rows, hour=None):
        """One file, which arrives ``hour`` hours after the first."""
        values = [(r if isinstance(r, str) else json.dumps(r),) for r in rows]
        df = self.spark.createDataFrame(values, "value STRING").withColumn("version", F.lit(self.n).cast("bigint"))
        arrived = F.timestamp_seconds(F.lit(1706745600 + 3600 * (self.n if hour is None else hour)))
        df.withColumn("timestamp", arrived).coalesce(1).write.mode("append").parquet(self.path)
        self.n += 1

    def stream(self):
        schema = "value STRING, version BIGINT, timestamp TIMESTAMP"
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def page(mid, when, last=None, **more):
    return {"mid": mid, "user_id": "1", "province_id": "1", "page_id": "home", "last_page_id": last, "ts": ms(when)} | more


def test_daily_dedup_over_batches_restart_and_backlog(spark):
    feed, folder = Feed(spark, "t_dau"), run_folder(spark, "t_dau")
    dims_path = f"{folder}/dims"
    store = sinks.DimensionStore(spark, dims_path, compact_every=2)
    store.append(dim_rows(spark, ("user_info", 1, {"id": 1, "gender": "F", "birthday": "2000-01-01"})), 0)
    provinces = spark.createDataFrame([(1, "North", "CN-1", "CN-N1", "100001")], schemas.BASE_PROVINCE)
    schema = schemas.struct(**{c: "bigint" if c in ("ts", "during_time") else "string" for c in schemas.DAU_INFO})
    table = sinks.DailyTable(spark, f"{folder}/dau", schema, "mid")

    def go():
        log = from_wire(feed.stream(), schemas.PAGE_LOG, "timestamp")
        job = jobs.dau_job(log, lambda: dims.users(store.read()), lambda: provinces, table, "2024-06-30")
        run.run_to_end(spark, job, f"{folder}/c", 4)

    feed.add(page("a", "2024-01-01 23:59:58"), page("a", "2024-01-01 23:59:59"), page("b", "2024-01-01 10:00:00", "x"))
    feed.add(page("a", "2024-01-01 23:59:59"), page("a", "2024-01-02 00:00:00"), page("b", "2024-01-02 10:00:00"))
    go()
    want = [("2024-01-01", "a"), ("2024-01-02", "a"), ("2024-01-02", "b")]
    assert sorted((r.dt, r.mid) for r in table.writes().collect()) == want
    go()  # nothing new
    # the user changes and another comes while the job's checkpoint lives on
    store.append(dim_rows(spark, ("user_info", 2, {"id": 1, "gender": "M", "birthday": "2000-01-01"}),
                          ("user_info", 3, {"id": 2, "gender": "F", "birthday": "2000-01-01"})), 1)
    feed.add(page("a", "2024-01-02 11:00:00"), page("c", "2024-01-02 11:00:00"), page("d", "2023-06-01 11:00:00", user_id="2"))
    go()  # state survived the restarts; a view of half a year ago is no less a view
    new = [("2023-06-01", "d"), ("2024-01-02", "c")]
    assert sorted((r.dt, r.mid) for r in table.writes().collect()) == sorted(want + new)
    # long after the state is gone, the index still knows the device
    feed.add(page("e", "2024-01-09 11:00:00"), hour=100)
    feed.add(page("a", "2024-01-01 23:59:59"), page("f", "2024-01-09 11:00:00"), hour=200)
    go()
    assert table.writes().where("mid = 'a'").count() == 2 and table.read().where("mid IN ('e', 'f')").count() == 2
    batch = dau.first_times(from_wire(spark.read.parquet(feed.path), schemas.PAGE_LOG))
    assert sorted((r.dt, r.mid) for r in batch.collect()) == sorted((r.dt, r.mid) for r in table.read().collect())
    assert {(r.mid, r.user_gender) for r in table.read("2024-01-02").collect()} == {("a", "F"), ("b", "F"), ("c", "M")}
    assert [r.user_gender for r in table.read("2023-06-01").collect()] == ["F"]


def dim_rows(spark, *changed):
    rows = [(t, str(d["id"]), f"{t}:{d['id']}", "U", v, json.dumps(d)) for t, v, d in changed]
    return spark.createDataFrame(rows, sinks.DIM_RECORD)


def test_dimension_store_keeps_one_snapshot_and_the_batches_after_it(spark):
    store = sinks.DimensionStore(spark, f"{run_folder(spark, 't_store')}/dims", compact_every=2)
    assert store.read().count() == 0
    user = lambda v, name: dim_rows(spark, ("user_info", v, {"id": 1, "gender": name}))
    for batch, name in enumerate("ABC"):
        store.append(user(batch, name), batch)
    assert store.writes().count() == 2  # the snapshot of the first two, and the third
    store.append(user(0, "A"), 0)  # a replay of what the snapshot includes
    assert [json.loads(r.data)["gender"] for r in store.read().collect()] == ["C"]
    assert store.writes().count() == 2


def test_streams_are_complete_over_many_batches(spark):
    """Shuffled files, one a batch, whose event times are months apart."""
    from rillmart.plans import queries
    from rillmart.sources.shop_views import Shop

    shop = Shop(spark, "/root/testdata/sf0.001")
    lines = shop.order_lines().select("id").distinct().count()
    joined = jobs.buffered_join(*queries.order_streams(shop, "t_complete")).select("detail_id")
    assert queries._run_to_files(shop, "t_complete", joined).distinct().count() == lines


def info(order, when):
    return {"id": order, "user_id": 1, "province_id": 1, "create_time": when, "total_amount": 1.0}


def line(detail, order, when):
    return {"id": detail, "order_id": order, "create_time": when, "sku_name": "ring", "split_total_amount": 1.0}


@pytest.mark.parametrize("salts", [1, 4])
def test_buffered_join_in_any_order_of_arrival(spark, salts):
    headers, lines, folder = Feed(spark, "t_info"), Feed(spark, "t_detail"), run_folder(spark, "t_join")
    out = f"{folder}/out"

    def go():
        joined = jobs.buffered_join(
            from_rows(headers.stream(), schemas.ORDER_INFO, "timestamp"),
            from_rows(lines.stream(), schemas.ORDER_DETAIL, "timestamp"), salts=salts,
        ).select("detail_id", "order_id")
        run.run_to_end(spark, joined.writeStream.format("parquet").option("path", out), f"{folder}/c", 4)

    headers.add(info(1, "2024-01-01 10:00:00"), info(1, "2024-01-01 10:00:00"), info(2, "2024-01-01 10:00:00"))
    lines.add(line(11, 1, "2024-01-01 10:00:01"), line(31, 3, "2024-01-01 11:00:00"))
    go()
    headers.add(info(3, "2024-01-01 11:00:00"), info(1, "2024-01-01 10:00:00"))  # header after its line; a replay
    lines.add(line(21, 2, "2024-01-01 10:00:02"), line(12, 1, "2024-01-01 10:00:02"))  # line after its header
    go()
    headers.add(info(4, "2023-01-05 10:00:00"), hour=40)
    lines.add(line(22, 2, "2024-01-02 10:00:01"), line(41, 4, "2024-01-05 10:00:00"), hour=40)  # 22: over 24 hours later
    go()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.detail_id, r.order_id) for r in rows) == [(11, 1), (12, 1), (21, 2), (31, 3), (41, 4)]


def test_lines_that_never_find_a_header(spark):
    headers, lines, folder = Feed(spark, "t_info"), Feed(spark, "t_detail"), run_folder(spark, "t_orphan")
    headers.add(info(1, "2024-01-01 10:00:00"))
    lines.add(line(11, 1, "2024-01-01 10:00:01"), line(99, 9, "2024-01-01 10:00:01"))
    headers.add(info(2, "2024-01-09 10:00:00"), hour=200)
    lines.add(line(21, 2, "2024-01-09 10:00:01"), hour=200)
    headers.add(info(3, "2024-01-19 10:00:00"), hour=400)
    lines.add(line(31, 3, "2024-01-19 10:00:01"), hour=400)
    joined = jobs.buffered_join(
        from_rows(headers.stream(), schemas.ORDER_INFO, "timestamp"),
        from_rows(lines.stream(), schemas.ORDER_DETAIL, "timestamp"), "left_outer",
    ).select("detail_id", "_header_id")
    run.run_to_end(spark, joined.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/c", 4)
    rows = {r.detail_id: r._header_id for r in spark.read.parquet(f"{folder}/out").collect()}
    assert rows == {11: 1, 21: 2, 31: 3, 99: None}


def test_the_routed_batch_is_kept_on_disk_in_small_blocks(spark):
    feed, folder, seen = Feed(spark, "t_kept"), run_folder(spark, "t_kept"), []
    kept = lambda: dict(spark.sparkContext._jsc.getPersistentRDDs())
    before = set(kept())

    class Store:
        def append(self, rows, batch_id):
            seen.extend(rdd.getStorageLevel().useMemory() for number, rdd in kept().items() if number not in before)
            seen.append(rows.sparkSession.conf.get("spark.sql.inMemoryColumnarStorage.batchSize"))

    jobs.save_table_lists(changes.table_lists(spark, ["order_info"], ["user_info"]), f"{folder}/lists")
    feed.add({"type": "insert", "table": "order_info", "data": {"id": 1}}, {"type": "insert", "table": "user_info", "data": {"id": 1}})
    run.run_to_end(spark, jobs.change_router(feed.stream(), f"{folder}/lists", f"{folder}/facts", Store()), f"{folder}/c")
    assert seen == [False, "1000"]


def test_change_router_reloads_lists_and_replays(spark):
    feed, folder = Feed(spark, "t_cdc"), run_folder(spark, "t_cdc")
    store = sinks.DimensionStore(spark, f"{folder}/dims")

    def go(facts, dims):
        jobs.save_table_lists(changes.table_lists(spark, facts, dims), f"{folder}/lists")
        writer = jobs.change_router(feed.stream(), f"{folder}/lists", f"{folder}/facts", store)
        run.run_to_end(spark, writer, f"{folder}/c")

    def change(kind, table, **data):
        return {"type": kind, "table": table, "data": data}

    feed.add(change("insert", "order_info", id=1), change("insert", "user_info", id=1, gender="F"),
             change("insert", "sku_info", id=5), "broken")
    go(["order_info"], ["user_info"])
    feed.add(change("delete", "order_info", id=1), change("update", "user_info", id=1, gender="M"),
             change("insert", "sku_info", id=6))
    go(["order_info", "sku_info"], ["user_info"])
    facts = sinks.read_topic_files(spark, f"{folder}/facts")
    assert sorted((r.topic, r.value) for r in facts.collect()) == [
        ("DWD_ORDER_INFO_D", '{"id":1}'), ("DWD_ORDER_INFO_I", '{"id":1}'), ("DWD_SKU_INFO_I", '{"id":6}'),
        (topics.CORRUPT, "broken"),
    ]
    assert [(r.id, r.op, json.loads(r.data)["gender"]) for r in store.read().collect()] == [("1", "U", "M")]
    # A batch that is written again replaces itself.
    batch = changes.table_lists(spark, [], ["user_info"])
    again = changes.dim_records(changes.parse_changes(spark.read.parquet(feed.path).where("version = 1")), batch)
    store.append(again, 1)
    assert store.writes().count() == 2
    store.compact(1)
    assert store.writes().count() == 1 and store.read().collect()[0].op == "U"


def test_upsert_keeps_the_last_write(spark):
    schema = schemas.struct(mid="string", v="bigint", dt="string")
    table = sinks.DailyTable(spark, f"{run_folder(spark, 't_upsert')}/t", schema, "mid")
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    table.append(make(("a", 2, "2024-01-01")), 2)
    table.append(make(("a", 9, "2024-01-01"), ("b", 1, "2024-01-01"), ("a", 1, "2024-01-02")), 1)  # an older version, later
    want = [("2024-01-01", "a", 2), ("2024-01-01", "b", 1), ("2024-01-02", "a", 1)]
    assert sorted((r.dt, r.mid, r.v) for r in table.read().collect()) == want
    target = f"{table.path}-compact"
    assert sorted((r.dt, r.mid, r.v) for r in table.compact(target).collect()) == want
    table.append(make(("b", 7, "2024-01-01")), 3)
    compact = table.compact(target, "2024-01-01")
    assert sorted((r.dt, r.mid, r.v) for r in compact.collect()) == [
        ("2024-01-01", "a", 2), ("2024-01-01", "b", 7), ("2024-01-02", "a", 1),
    ]
    assert table.read("1999-01-01").count() == 0


def test_a_batch_write_after_a_stream_is_seen(spark):
    feed, folder = Feed(spark, "t_both"), run_folder(spark, "t_both")
    schema = schemas.struct(mid="string", v="bigint", dt="string")
    table = sinks.DailyTable(spark, f"{folder}/t", schema, "mid")
    assert table.read().count() == 0
    feed.add({"mid": "a", "v": 1, "dt": "2024-01-01"}, {"mid": "b", "v": 1, "dt": "2024-01-01"})
    run.run_to_end(spark, table.stream(from_rows(feed.stream(), schema)), f"{folder}/c")
    table.append(spark.createDataFrame([("a", 5, "2024-01-01")], schema), 10)
    assert sorted((r.mid, r.v) for r in table.read().collect()) == [("a", 5), ("b", 1)]
    plan = table.read("2024-01-01").select("mid")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<mid:string,_version:bigint,_source:string,_row:bigint>" in plan


def test_keyed_topics_put_a_key_in_one_partition(spark):
    rows = [("t", f"k{i % 7}", str(i)) for i in range(100)]
    keyed = sinks.keyed(spark.createDataFrame(rows, "topic STRING, key STRING, value STRING"), 3)
    places = keyed.groupBy("key").agg(F.count_distinct("partition").alias("n")).collect()
    assert {r.n for r in places} == {1}
    assert keyed.select("partition").distinct().count() > 1


def test_offsets(spark):
    rows = [("t", p, o, None, None, f"{p}-{o}") for p in range(3) for o in range(4)]
    records = spark.createDataFrame(rows, schemas.TOPIC_RECORD)
    kept = topics.from_offsets(records, {0: 2, 1: 4})
    assert sorted(r.value for r in kept.collect()) == ["0-2", "0-3", "2-0", "2-1", "2-2", "2-3"]
    assert topics.from_offsets(records, {}).count() == 12


def test_kafka_options():
    options = topics.kafka_source_options("h:1", "t", {1: 5, 0: 3})
    assert options["startingOffsets"] == '{"t": {"0": 3, "1": 5}}' and options["subscribe"] == "t"
    assert topics.kafka_source_options("h:1", "t")["startingOffsets"] == "latest"
    sink = topics.kafka_sink_options("h:1")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_topic_to_topic(spark):
    """Log topic files -> routed topics -> page log stream of the next job."""
    folder = run_folder(spark, "t_topics")
    record = {"ts": ms("2024-01-01 00:00:00"), "common": {"mid": "a"}, "page": {"page_id": "home"}}
    value = [("ODS", 0, 0, dt.datetime(2024, 1, 1), None, json.dumps(record))]
    spark.createDataFrame(value, schemas.TOPIC_RECORD).write.parquet(f"{folder}/ods")
    routed = jobs.routed_logs(topics.file_topic(spark, f"{folder}/ods", 1))
    run.run_to_end(spark, sinks.topic_files(routed, f"{folder}/dwd"), f"{folder}/c1")
    pages = from_wire(sinks.stream_topic_files(spark, f"{folder}/dwd", topics.PAGE_LOG), schemas.PAGE_LOG)
    run.run_to_end(spark, pages.writeStream.format("parquet").option("path", f"{folder}/p"), f"{folder}/c2")
    assert [(r.mid, r.page_id) for r in spark.read.parquet(f"{folder}/p").collect()] == [("a", "home")]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with run.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_offsets_are_committed_only_after_the_output(spark):
    """A batch whose output fails is not committed, and comes again after a restart."""
    feed, folder = Feed(spark, "t_commit"), run_folder(spark, "t_commit")
    feed.add(page("a", "2024-01-01 10:00:00"))
    out, broken = f"{folder}/out", [True]

    def write(batch, batch_id):
        if broken[0]:
            raise RuntimeError("the sink is down")
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def commits():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/c/commits/0")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    with pytest.raises(Exception, match="the sink is down"):
        run.run_to_end(spark, feed.stream().writeStream.foreachBatch(write), f"{folder}/c")
    assert not commits()
    broken[0] = False
    run.run_to_end(spark, feed.stream().writeStream.foreachBatch(write), f"{folder}/c")
    run.run_to_end(spark, feed.stream().writeStream.foreachBatch(write), f"{folder}/c")
    assert commits() and spark.read.parquet(out).count() == 1


def test_change_topic_to_dashboard(spark):
    """Change records -> fact topics and dimensions -> order wide stream -> daily table -> statistics."""
    feed, folder = Feed(spark, "t_all"), run_folder(spark, "t_all")
    store = sinks.DimensionStore(spark, f"{folder}/dims")
    jobs.save_table_lists(
        changes.table_lists(spark, ["order_info", "order_detail"], ["user_info", "base_province"]), f"{folder}/lists"
    )
    change = lambda table, data: {"type": "insert", "table": table, "data": data}
    feed.add(
        change("user_info", {"id": 1, "gender": "M", "birthday": "2000-01-01"}),
        change("base_province", {"id": 1, "name": "North", "iso_code": "CN-1", "iso_3166_2": "CN-N", "area_code": "9"}),
        change("order_detail", line(11, 1, "2024-01-01 10:00:01")),
    )
    feed.add(
        change("order_info", info(1, "2024-01-01 10:00:00")),
        change("order_detail", line(12, 1, "2024-01-01 10:00:01")),
        change("order_detail", line(12, 1, "2024-01-01 10:00:01")),
    )
    run.run_to_end(
        spark, jobs.change_router(feed.stream(), f"{folder}/lists", f"{folder}/facts", store), f"{folder}/c1"
    )
    stream = lambda topic, schema: from_rows(
        sinks.stream_topic_files(spark, f"{folder}/facts", topic), schema
    ).withColumn("timestamp", F.current_timestamp())
    doubles = {c: "double" for c in schemas.ORDER_WIDE if "amount" in c or "feight" in c or c == "order_price"}
    longs = {c: "bigint" for c in ("detail_id", "order_id", "sku_id", "sku_num", "province_id", "user_id")} | {"user_age": "int"}
    wide = schemas.struct(**{c: (doubles | longs).get(c, "string") for c in schemas.ORDER_WIDE})
    table = sinks.DailyTable(spark, f"{folder}/wide", wide, "detail_id", "create_date")
    job = jobs.order_job(
        stream(topics.ORDER_INFO, schemas.ORDER_INFO), stream(topics.ORDER_DETAIL, schemas.ORDER_DETAIL),
        lambda: dims.users(store.read()), lambda: dims.provinces(store.read()), table, f"{folder}/alone", "2024-06-30",
    )
    run.run_to_end(spark, job, f"{folder}/c2", 4)
    index = table.compact(f"{folder}/index")
    rows = serving.stats_by_item(index, "ring", "gender", "2024-01-01").collect()
    assert [(r.name, r.value) for r in rows] == [("男", 2.0)]
    found = serving.detail_by_item(index, "2024-01-01", "ring")
    assert found.total.collect()[0].total == 2
    assert {r.province_name for r in found.detail.collect()} == {"North"}


@pytest.mark.parametrize("hours", [(0, 1, 2), (0, 30)])
def test_an_hour_is_one_batch_however_many_tasks_wrote_it(spark, hours):
    rows = spark.range(900).repartition(9)
    late = F.when(F.col("id") < 3, 1).otherwise(0)  # an hour of few rows
    stream = queries._arriving(Shop(spark, ""), "hours", rows, None if len(hours) == 3 else late, hours)
    seen = []

    def write(batch, _):
        seen.append([tuple(r) for r in batch.groupBy(F.hour("timestamp"), F.to_date("timestamp")).count().collect()])

    run.run_to_end(spark, stream.writeStream.foreachBatch(write), run_folder(spark, "hours"))
    assert [len(times) for times in seen] == [1] * len(hours)
    assert sum(times[0][2] for times in seen) == 900


def test_an_arriving_topic_is_written_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "run_folder", lambda spark, name: str(tmp_path))
    rows = spark.range(900).withColumn("name", F.lit("ring"))
    stream = queries._arriving(Shop(spark, ""), "once", rows, F.when(F.col("id") < 100, 7).otherwise(F.col("id") % 2), (0, 20))
    assert sum(spark.read.parquet(str(f)).count() for f in tmp_path.rglob("part-*")) == 800  # hour 7 is none
    times = [{int(f.stat().st_mtime) for f in (tmp_path / f"topic/_file={n}").glob("part-*")} for n in range(2)]
    assert [len(t) for t in times] == [1, 1] and max(times[0]) < min(times[1])
    assert stream.columns == ["id", "name", "timestamp"]


def test_state_is_compressed_by_zstandard(spark):
    with run.state_settings(spark):
        for name in ("rocksdb.compression", "compression.codec"):
            assert spark.conf.get(f"spark.sql.streaming.stateStore.{name}") == "zstd"


def test_a_read_of_few_repeated_ids_shuffles_no_other_rows(spark):
    schema = schemas.struct(mid="string", v="bigint", dt="string")
    table = sinks.DailyTable(spark, f"{run_folder(spark, 't_few')}/t", schema, "mid")
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    table.append(make(("a", 1, "2024-01-01"), ("b", 1, "2024-01-01"), (None, 1, None)), 1)
    plan = table.read(few=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and table.read(few=True).count() == 3
    table.append(make(("a", 2, "2024-01-01"), ("a", 3, "2024-01-02"), (None, 4, None)), 2)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(table.read(few=True)) == rows(table.read()) and table.read(few=True).count() == 4
    assert rows(table.read("2024-01-01", few=True)) == rows(table.read("2024-01-01"))
