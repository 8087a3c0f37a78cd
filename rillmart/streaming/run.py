"""Starting streams: triggers, state settings, bounded runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from rillmart.session import settings

TRIGGER = "5 seconds"  # fixed value: micro-batch interval

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful stream copies when it starts.

    State lives in RocksDB, off the heap, and each batch uploads only its
    changes; both are compressed by zstandard, as state is rows of fixed-width
    words and repeated text. The codec and the number of state partitions are
    fixed by the first start: ``partitions``, or else the session's shuffle
    partitions.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
        "spark.sql.streaming.stateStore.compression.codec": "zstd",
        # One store per join partition instead of four.
        "spark.sql.streaming.join.stateFormatVersion": "3",
        "spark.sql.shuffle.partitions": str(partitions or spark.conf.get("spark.sql.shuffle.partitions")),
    }
    with settings(spark, wanted):
        yield


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    live: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a stream. ``live`` runs every 5 seconds; otherwise it takes what is there and ends.

    The checkpoint holds offsets and state: offsets are planned before a batch
    and committed after its output is written, and a restart goes on from there.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=TRIGGER) if live else writer.trigger(availableNow=True)
    with state_settings(spark, partitions):
        return writer.start()


def run_to_end(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Run a bounded stream to its end; a failure is raised here."""
    query = start(spark, writer, checkpoint, partitions=partitions)
    query.awaitTermination()
    return query
