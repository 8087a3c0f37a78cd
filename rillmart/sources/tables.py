"""The given parquet tables, as batches or as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table as an append-only file stream.

    The path is a pattern that matches just the table, because a file stream
    takes a plain path to be a folder, while a table may be one file.
    """
    path = f"{folder.rstrip('/')}/{name}.parque[t]"
    reader = spark.readStream.schema(read_table(spark, folder, name).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
