"""Topics as segment files with a manifest, read as batches or as streams from given offsets.

Each write gives new files, ``data/topic=<t>/partition=<p>/write=<name>/``, and then one manifest file that lists them with the
offsets they hold: a write is there as a whole or not at all, and files that are there never change. A write has a source
and a number; one that the manifest has already is not made again, so a replayed batch gives each record once.

The streaming source plans from the manifest alone. A stream that starts from offsets, or goes on from its checkpoint, opens
only the files that hold offsets from there on.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rillmart import schemas

FORMAT = "topic_segments"
_MANIFEST = "source STRING, number BIGINT, topic STRING, partition INT, first BIGINT, last BIGINT, at BIGINT, file STRING"


class SegmentTopics:
    """A folder of topics. One writer at a time appends; any number of readers follow.

    Records of a write that have no ``offset`` get the next ones of their topic and partition, in the order of their files.
    """

    def __init__(self, spark: SparkSession, path: str, partitions: int = 4):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions

    # ---- writing ----

    def manifest(self) -> DataFrame:
        from rillmart.streaming.log_table import exists

        if not exists(self.spark, f"{self.path}/manifest"):
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(f"{self.path}/manifest")

    def append(self, records: DataFrame, number: int, source: str = "batch") -> bool:
        """Write ``(topic, value)`` and, if there, ``key``, ``partition``, ``offset`` and ``timestamp``; false if it was written before."""
        known = self.manifest()
        if not known.where((F.col("source") == source) & (F.col("number") == number)).isEmpty():
            return False
        name = f"{source}-{number}-{uuid.uuid4().hex[:12]}"
        has = set(records.columns)
        if "partition" not in has:
            by = F.coalesce(F.col("key"), F.col("value")) if "key" in has else F.col("value")
            records = records.withColumn("partition", F.pmod(F.xxhash64(by), F.lit(self.partitions)).cast("int"))
        columns = [c for c in ("topic", "partition", "offset", "timestamp", "key", "value") if c in {*has, "partition"}]
        rows = records.select(*columns)
        if "offset" in has:  # contiguous files, of any number of tasks
            order = ["topic", "partition", "offset"]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        else:
            rows = rows.hint("rebalance", F.col("topic"), F.col("partition"))
        # a staging folder of its own, and folders of a new name: nothing that is there is touched
        writer = rows.withColumn("write", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("topic", "partition", "write").parquet(f"{self.path}/data")
        self._commit(known, name, number, source, "offset" in has)
        return True

    def _commit(self, known: DataFrame, name: str, number: int, source: str, with_offsets: bool) -> None:
        """One manifest file with a row for each file of the write, which are as many as its tasks and topics."""
        schema = "topic STRING, partition INT, write STRING" + (", offset BIGINT" if with_offsets else "")
        # only this write's folders are listed
        pattern = f"{self.path}/data/topic=*/partition=*/write={name}"
        status = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = status.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(status)
        folders = [f.getPath().toString() for f in found or []]
        now, rows = time.time_ns() // 1_000_000, []
        if folders:
            written = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)
            file = F.col("_metadata.file_path").alias("file")
            sums = [F.min("offset").alias("first"), F.max("offset").alias("last")] if with_offsets else []
            files = written.select("*", file).groupBy("topic", "partition", "file").agg(F.count("*").alias("n"), *sums).collect()
            nexts = {(r["topic"], r["partition"]): r["last"] + 1 for r in known.groupBy("topic", "partition").agg(F.max("last").alias("last")).collect()}
            for f in sorted(files, key=lambda f: f["file"]):
                at = (f["topic"], f["partition"])
                first = f["first"] if with_offsets else nexts.get(at, 0)
                last = f["last"] if with_offsets else first + f["n"] - 1
                nexts[at] = last + 1
                rows.append((source, number, *at, first, last, now, f["file"].partition("/data/")[2]))
        rows = rows or [(source, number, None, None, None, None, now, None)]  # an empty write is a write
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{name}")

    # ---- reading ----

    def read(self, *topics: str) -> DataFrame:
        """All committed records of some topics, or of all: (topic, value)."""
        files = self.manifest().where("file IS NOT NULL")
        if topics:
            files = files.where(F.col("topic").isin(*topics))
        paths = [f"{self.path}/data/{r['file']}" for r in files.select("file").collect()]
        schema = "topic STRING, value STRING"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select("topic", "value")

    def stream(self, topic: str, starting_offsets: dict[int, int] | None = None) -> DataFrame:
        """A topic as a stream of ``TOPIC_RECORD``, from the given offset of each partition, 0 where none is given.

        The offsets matter on the first start; afterwards the checkpoint knows where to go on. Records without a time of their
        own have that of the commit.
        """
        self.spark.dataSource.register(TopicSegments)
        offsets = json.dumps({str(p): o for p, o in (starting_offsets or {}).items()})
        return self.spark.readStream.format(FORMAT).option("path", self.path).option("topic", topic).option("startingOffsets", offsets).load()


# ---- the streaming source ---------------------------------------------------------------------


class Segment(InputPartition):
    """The records of one file with offsets from ``start`` up to ``end``, without it."""

    def __init__(self, file: str, topic: str, partition: int, first: int, at: int, start: int, end: int):
        self.file, self.topic, self.partition, self.first, self.at, self.start, self.end = file, topic, partition, first, at, start, end


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


class SegmentReader(DataSourceStreamReader):
    def __init__(self, path: str, topic: str, starting: dict[str, int]):
        self.path, self.topic, self.starting = path.rstrip("/"), topic, starting
        self.known: dict[str, list[dict]] = {}  # by manifest file, which never changes

    def _files(self) -> list[dict]:
        from pyarrow.fs import FileSelector

        store, root = _store(self.path)
        for found in store.get_file_info(FileSelector(f"{root}/manifest", allow_not_found=True, recursive=True)):
            if found.is_file and found.path.endswith(".json") and "/_" not in found.path[len(root) :] and found.path not in self.known:
                with store.open_input_file(found.path) as lines:
                    rows = map(json.loads, lines.read().decode().splitlines())
                    self.known[found.path] = [r for r in rows if r.get("topic") == self.topic and r.get("file")]
        return [r for rows in self.known.values() for r in rows]

    def initialOffset(self) -> dict:
        return self.starting

    def latestOffset(self) -> dict:
        ends = dict(self.starting)
        for r in self._files():
            p = str(r["partition"])
            ends[p] = max(ends.get(p, 0), r["last"] + 1)
        return ends

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        """Only files that hold offsets of the range."""
        out = []
        for r in self._files():
            p = str(r["partition"])
            low, high = start.get(p, 0), end.get(p, 0)
            if r["last"] >= low and r["first"] < high:
                out.append(Segment(r["file"], r["topic"], r["partition"], r["first"], r["at"], low, high))
        return out

    def read(self, partition: Segment) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, root = _store(self.path)
        with store.open_input_file(f"{root}/data/{partition.file}") as file:
            at = partition.first
            for batch in pq.ParquetFile(file).iter_batches(batch_size=10_000):
                table, n = pa.Table.from_batches([batch]), batch.num_rows
                names = set(table.column_names)
                offset = table["offset"] if "offset" in names else pa.chunked_array([pa.array(range(at, at + n), pa.int64())])
                at += n
                time_type = pa.timestamp("us", "UTC")
                when = table["timestamp"].cast(time_type) if "timestamp" in names else pa.array([partition.at * 1000] * n, pa.int64()).cast(time_type)
                key = table["key"] if "key" in names else pa.nulls(n, pa.string())
                columns = [pa.array([partition.topic] * n, pa.string()), pa.array([partition.partition] * n, pa.int32()), offset, when, key, table["value"]]
                records = pa.table(columns, names=["topic", "partition", "offset", "timestamp", "key", "value"])
                inside = pc.and_(pc.greater_equal(records["offset"], partition.start), pc.less(records["offset"], partition.end))
                yield from records.filter(inside).to_batches()

    def commit(self, end: dict) -> None:
        pass


class TopicSegments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return schemas.TOPIC_RECORD

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options["path"], self.options["topic"], json.loads(self.options.get("startingOffsets") or "{}"))
