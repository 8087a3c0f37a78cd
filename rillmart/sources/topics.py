"""Topics as DataFrames: Kafka where the connector is present, else folders of parquet.

A file topic has the columns of Spark's Kafka source (``topic, partition,
offset, timestamp, key, value``), so every transform downstream is the same.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart import schemas

# Topic names.
ODS_LOG = "ODS_BASE_LOG"
ODS_CHANGES = "ODS_BASE_DB"
PAGE_LOG = "DWD_PAGE_LOG_TOPIC"
PAGE_DISPLAY = "DWD_PAGE_DISPLAY_TOPIC"
PAGE_ACTION = "DWD_PAGE_ACTION_TOPIC"
START_LOG = "DWD_START_LOG_TOPIC"
ERROR_LOG = "DWD_ERROR_LOG_TOPIC"
ORDER_INFO = "DWD_ORDER_INFO_I"
ORDER_DETAIL = "DWD_ORDER_DETAIL_I"
# Records that are no JSON object; kept apart instead of failing the run.
CORRUPT = "ODS_CORRUPT_RECORD"


def kafka_source_options(
    servers: str, topic: str, starting_offsets: dict[int, int] | str = "latest"
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting_offsets`` (a word, or offsets by partition) only matters on the
    first start; afterwards the checkpoint knows where to go on.
    """
    if isinstance(starting_offsets, dict):
        starting_offsets = json.dumps({topic: {str(p): o for p, o in sorted(starting_offsets.items())}})
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }


def kafka_sink_options(servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def _text(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
    )


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, starting_offsets: dict[int, int] | str = "latest"
) -> DataFrame:
    """A Kafka topic as a stream; needs the Kafka connector on the class path."""
    options = kafka_source_options(servers, topic, starting_offsets)
    return _text(spark.readStream.format("kafka").options(**options).load())


def file_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of parquet topic records as a stream."""
    reader = spark.readStream.schema(schemas.TOPIC_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def from_offsets(records: DataFrame, starting_offsets: dict[int, int]) -> DataFrame:
    """Records at or after the given offset of their partition; other partitions are read whole."""
    if not starting_offsets:
        return records
    keep = ~F.col("partition").isin(sorted(starting_offsets))
    for partition, offset in sorted(starting_offsets.items()):
        keep = keep | ((F.col("partition") == partition) & (F.col("offset") >= offset))
    return records.where(keep)
