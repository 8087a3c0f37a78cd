"""Topics as segments: seeking, restarts, replays under a reader."""

import json

import pytest
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.operators import changes
from rillmart.session import run_folder
from rillmart.sources import topics
from rillmart.sources.segments import SegmentReader, SegmentTopics
from rillmart.streaming import jobs, run, sinks


def records(spark, low, high, partitions=2):
    ids = spark.range(low * partitions, high * partitions)
    return ids.select(
        F.lit("t").alias("topic"), (F.col("id") % partitions).cast("int").alias("partition"), F.floor(F.col("id") / partitions).alias("offset"),
        F.timestamp_seconds(F.lit(1706745600) + F.col("id")).alias("timestamp"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"),
    )


def taken(spark, stream, folder):
    run.run_to_end(spark, stream.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/c")
    return spark.read.schema(schemas.TOPIC_RECORD).parquet(f"{folder}/out")


def test_a_stream_opens_files_from_its_offsets_on(spark):
    folder = run_folder(spark, "t_seek")
    store = SegmentTopics(spark, f"{folder}/t")
    for n in range(5):
        assert store.append(records(spark, n * 10, n * 10 + 10).coalesce(1), n)
    files = store.manifest().collect()
    reader = SegmentReader(f"{folder}/t", "t", {"0": 37, "1": 45})
    end = reader.latestOffset()
    assert end == {"0": 50, "1": 50} and SegmentReader(f"{folder}/t", "other", {}).latestOffset() == {}
    opened = reader.partitions(reader.initialOffset(), end)
    late = {r.file for r in files if r.last >= (37 if r.partition == 0 else 45)}
    assert {s.file for s in opened} == late and len(opened) < len(files) / 2
    # the files before are not even touched: with rubbish in them the stream still runs
    hadoop = spark._jvm.org.apache.hadoop.fs
    for r in files:
        if r.file not in late:
            path = hadoop.Path(f"{folder}/t/data/{r.file}")
            out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
            out.write(bytearray(b"rubbish"))
            out.close()
    got = taken(spark, store.stream("t", {0: 37, 1: 45}), folder).collect()
    assert sorted((r.partition, r.offset) for r in got) == [(0, o) for o in range(37, 50)] + [(1, o) for o in range(45, 50)]
    assert all(r.topic == "t" and r.value == str(r.offset * 2 + r.partition) and r.key is None for r in got)
    assert {r.timestamp.timestamp() - int(r.value) for r in got} == {1706745600.0}


def test_a_restart_opens_only_what_is_new(spark):
    folder = run_folder(spark, "t_goon")
    store = SegmentTopics(spark, f"{folder}/t")
    store.append(records(spark, 0, 10), 0)
    assert taken(spark, store.stream("t"), folder).count() == 20
    store.append(records(spark, 10, 13), 1)
    assert taken(spark, store.stream("t", {0: 99}), folder).count() == 26  # the checkpoint counts, not the options
    reader = SegmentReader(f"{folder}/t", "t", {})
    assert all(s.first >= 10 for s in reader.partitions({"0": 10, "1": 10}, {"0": 13, "1": 13}))
    assert reader.partitions({"0": 13, "1": 13}, {"0": 13, "1": 13}) == []


def test_a_write_is_made_once_and_seen_whole(spark):
    folder = run_folder(spark, "t_once")
    store = SegmentTopics(spark, f"{folder}/t")
    assert store.read().count() == 0
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "topic STRING, value STRING")
    assert store.append(rows, 0, "s") and not store.append(rows, 0, "s")
    assert store.append(rows, 0, "other") and store.append(rows.where("false"), 1, "s") and not store.append(rows, 1, "s")
    assert sorted((r.topic, r.value) for r in store.read().collect()) == sorted([("a", "1"), ("a", "2"), ("b", "3")] * 2)
    assert store.read("b").count() == 2 and store.read("none").count() == 0
    # offsets go on from write to write
    spans = store.manifest().where("file IS NOT NULL").groupBy("topic", "partition").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n"), F.max("last").alias("last"), F.min("first").alias("first"))
    assert all(r.first == 0 and r.last == r.n - 1 for r in spans.collect())
    # what a writer left that failed before its commit is not seen
    rows.withColumns({"partition": F.lit(0), "write": F.lit("lost")}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "partition", "write").parquet(f"{folder}/t/data")
    assert store.read().count() == 6 and taken(spark, store.stream("a"), folder).count() == 4


def change(kind, table, **data):
    return json.dumps({"type": kind, "table": table, "data": data})


def test_a_replay_while_a_reader_streams(spark):
    """The router's checkpoint is lost after each batch was committed; a reader of the facts runs between."""
    folder = run_folder(spark, "t_exactly")
    store = sinks.DimensionStore(spark, f"{folder}/dims")
    jobs.save_table_lists(changes.table_lists(spark, ["order_info"], ["user_info"]), f"{folder}/lists")
    schema = "value STRING, version BIGINT"

    def feed(n):
        rows = [(change("insert", "order_info", id=n * 10 + i), n) for i in range(5)] + [(change("insert", "user_info", id=n), n)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def route(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        run.run_to_end(spark, jobs.change_router(stream, f"{folder}/lists", f"{folder}/facts", store), f"{folder}/{checkpoint}")

    def read():
        facts = sinks.stream_topic_files(spark, f"{folder}/facts", topics.ORDER_INFO)
        return sorted(json.loads(r.value)["id"] for r in taken(spark, facts, folder).collect())

    feed(0)
    route("c1")
    assert read() == list(range(5))
    feed(1)
    route("c2")  # a new checkpoint: batch 0 comes again, then batch 1
    assert read() == [*range(5), *range(10, 15)]
    route("c3")
    assert read() == [*range(5), *range(10, 15)]
    assert sorted(json.loads(r.value)["id"] for r in sinks.read_topic_files(spark, f"{folder}/facts").collect()) == read()
    assert store.read().count() == 2


@pytest.mark.parametrize("offsets", [{}, {0: 4}, {0: 4, 1: 0, 7: 3}])
def test_offsets_of_some_partitions(spark, offsets):
    folder = run_folder(spark, "t_some")
    store = SegmentTopics(spark, f"{folder}/t")
    store.append(records(spark, 0, 6), 0)
    got = taken(spark, store.stream("t", offsets), folder)
    want = topics.from_offsets(spark.createDataFrame(records(spark, 0, 6).collect(), schemas.TOPIC_RECORD), offsets)
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in want.collect())
