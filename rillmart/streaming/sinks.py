"""Sinks: topics, daily upsert tables, and the dimension log."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from rillmart.operators.dims import dim_latest, dim_table
from rillmart.schemas import struct
from rillmart.sources.segments import SegmentTopics
from rillmart.sources.topics import kafka_sink_options
from rillmart.streaming.log_table import LogTable, Staged, exists, part_folder

TOPIC_VALUE = struct(topic="string", value="string")
KEYED_VALUE = struct(topic="string", key="string", value="string", partition="int")
DIM_RECORD = struct(table_name="string", id="string", key="string", op="string", version="bigint", data="string")


# ---- topics ------------------------------------------------------------------


def topic_files(routed: DataFrame, path: str) -> DataStreamWriter:
    """``(topic, value)`` rows into one folder per topic; the sink's log makes them exactly once."""
    rows = routed.select("topic", "value")
    return rows.writeStream.format("parquet").option("path", path).partitionBy("topic")


def keyed_topic_files(routed: DataFrame, path: str, partitions: int = 4) -> DataStreamWriter:
    """``(topic, key, value)`` rows into one folder per topic and partition.

    Rows of one key share a partition folder. They are placed by a column, not
    by a shuffle, so a hot key is still written by many tasks.
    """
    return (
        keyed(routed, partitions)
        .writeStream.format("parquet")
        .option("path", path)
        .partitionBy("topic", "partition")
    )


def keyed(routed: DataFrame, partitions: int = 4) -> DataFrame:
    partition = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    return routed.select("topic", "key", "value", partition.alias("partition"))


def kafka_topics(routed: DataFrame, servers: str, with_key: bool = False) -> DataStreamWriter:
    """The same rows to Kafka, topic by row; needs the Kafka connector on the class path."""
    columns = ["topic", "key", "value"] if with_key else ["topic", "value"]
    return routed.select(*columns).writeStream.format("kafka").options(**kafka_sink_options(servers))


def read_topic_files(spark: SparkSession, path: str, schema: T.StructType = TOPIC_VALUE) -> DataFrame:
    """What a topic sink has written; of topics with a manifest, what is committed."""
    if exists(spark, f"{path}/manifest"):
        return SegmentTopics(spark, path).read()
    return spark.read.schema(schema).parquet(path)


def stream_topic_files(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """One topic of a topic sink as the next job's stream; topics with a manifest come with offsets and times."""
    if exists(spark, f"{path}/manifest"):
        return SegmentTopics(spark, path).stream(topic)
    return spark.readStream.schema(TOPIC_VALUE).parquet(path).where(F.col("topic") == topic)


# ---- daily tables ---------------------------------------------------------------


class DailyTable:
    """A table with one part per day in which a later write of an id replaces the earlier one.

    Streams and batches may write the same table. Of the rows of a ``(day, id)``, reads keep the one with the highest version,
    then source, then place in its write. The same source and version written again replace what they wrote before. After
    ``fold_every`` writes the days they touched are compacted in place, under whoever reads them (``LogTable``). A read of some
    days lists only their folders.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, doc_id: str, day: str = "dt", fold_every: int = 100
    ):
        self.spark, self.path, self.schema, self.doc_id, self.day = spark, path, schema, doc_id, day
        self.log = LogTable(spark, path, schema, [day], [doc_id], fold_every=fold_every)

    def append(self, df: DataFrame | Staged, version: int, source: str = "batch", rebalance: bool = True) -> None:
        self.log.append(df, version, source, rebalance)

    def stream(self, df: DataFrame, first_version: int = 0, source: str = "stream") -> DataStreamWriter:
        """Each micro-batch is one write, so a batch that is replayed replaces itself."""
        return df.writeStream.foreachBatch(lambda batch, n: self.append(batch, first_version + n, source))

    def writes(self, days: Iterable[str | None] | None = None) -> DataFrame:
        """Every current write, with rows that others replace; of all days or of some. No rows before the first."""
        if days is None:
            return self.log.writes()
        days = sorted(set(days), key=str)
        named = [d for d in days if d is not None]
        wanted = F.col(self.day).isin(named)
        if len(named) < len(days):
            wanted = wanted | F.col(self.day).isNull()
        return self.log.writes([(d,) for d in days]).where(wanted)

    def read(self, day: str | None = None, days: Iterable[str | None] | None = None, few: bool = False) -> DataFrame:
        """The latest rows. With ``few`` a job first finds the ids that were written again, which should be few, and only their rows
        are shuffled."""
        wanted = days if day is None else [day]
        latest = self.log.latest_of_few if few else self.log.latest
        return latest(self.writes(wanted)).select(*self.schema.fieldNames())

    def read_where(self, condition: Column, columns: Iterable[str], day: str | None = None) -> DataFrame:
        """Some columns of the rows of ``read`` that fulfil a condition; of other rows only keys and versions are shuffled."""
        return self.log.latest_where(self.writes(None if day is None else [day]), condition, list(columns))

    def compact(self, target: str | None = None, day: str | None = None) -> DataFrame:
        """Compact in place, all days or one; or with a ``target`` write the kept rows there, replacing only the days written."""
        if target is None:
            self.log.fold(None if day is None else [part_folder([self.day], [day])])
            return self.read(day)
        (
            self.read(day)
            .hint("rebalance", F.col(self.day))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.day)
            .parquet(target)
        )
        return self.spark.read.schema(self.schema).parquet(target)


# ---- dimensions ------------------------------------------------------------------

BUCKETS = 32  # parts of a dimension, by hash of the id
FEW_IDS = 1000  # ids that a lookup names in its filter; more of them are joined


class DimensionStore:
    """All dimension rows by table and bucket of the id; the latest version of an id is what readers see.

    Each batch of a change stream is one write; a replayed batch replaces itself, or is skipped once a snapshot includes it.
    After ``compact_every`` batches the buckets they touched get a snapshot of the latest rows; other buckets stay as they are
    (``LogTable``). A lookup of some ids reads only their buckets and ranks only their rows.
    """

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 100, buckets: int = BUCKETS):
        if compact_every < 1 or buckets < 1:
            raise ValueError("compact_every and buckets must be at least 1")
        self.spark, self.path, self.buckets = spark, path, buckets
        schema = T.StructType([*DIM_RECORD.fields, *struct(bucket="int").fields])
        self.log = LogTable(
            spark, path, schema, ["table_name", "bucket"], ["id"], ["version", "op", "data"], compact_every, in_order=True
        )

    def _bucket(self, identity: Column) -> Column:
        return F.pmod(F.xxhash64(identity), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.select(*DIM_RECORD.fieldNames()).withColumn("bucket", self._bucket(F.col("id")))
        self.log.append(rows, batch_id, "changes")

    def writes(self) -> DataFrame:
        """The current snapshots and the batches after them; no rows before the first write."""
        return self.log.writes().select(*DIM_RECORD.fieldNames())

    def read(self, drop_deleted: bool = False) -> DataFrame:
        """The rows as of now; a running job that calls this in each batch sees new ones."""
        return dim_latest(self.writes(), drop_deleted)

    def lookup(self, table: str, ids: DataFrame, drop_deleted: bool = False) -> DataFrame:
        """The rows of some ids, as of now. ``ids`` has them as its first column, repeated or null as may be."""
        asked = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        few = [r[0] for r in asked.limit(FEW_IDS + 1).collect()]
        if len(few) > FEW_IDS:
            buckets = [r[0] for r in asked.select(self._bucket(F.col("id"))).distinct().collect()]
        else:
            buckets = [r[0] for r in self.spark.createDataFrame([(i,) for i in few], "id STRING").select(self._bucket(F.col("id"))).distinct().collect()]
        found = self.log.writes([(table, b) for b in buckets]).where(F.col("table_name") == table)
        # the filter comes before the ranking; a short one reaches the files
        found = found.where(F.col("id").isin(few)) if len(few) <= FEW_IDS else found.join(asked, "id", "left_semi")
        return dim_latest(found.select(*DIM_RECORD.fieldNames()), drop_deleted)

    def table(self, name: str, schema: T.StructType) -> DimensionLookup:
        return DimensionLookup(self, name, schema)

    def compact(self, batch_id: int | None = None) -> None:
        """Make the latest rows of all buckets that have changed their new snapshots, now."""
        self.log.fold()


class DimensionLookup:
    """One dimension of a store, for jobs: the typed rows of the ids that a batch asks for."""

    def __init__(self, store: DimensionStore, name: str, schema: T.StructType):
        self.store, self.name, self.schema = store, name, schema

    def of(self, ids: DataFrame) -> DataFrame:
        return dim_table(self.store.lookup(self.name, ids), self.name, self.schema)
