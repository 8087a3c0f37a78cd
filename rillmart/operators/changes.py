"""Change records: operation codes, fact topics and dimension rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.labels import change_operation, dim_key, fact_topic
from rillmart.functions.records import with_parsed
from rillmart.sources import topics


def table_lists(spark: SparkSession, facts: list[str], dims: list[str]) -> DataFrame:
    """The fact and dimension lists as ``(table_name, kind)`` rows.

    Made from Arrow so that Spark knows their size, and broadcasts them in joins.
    """
    names = pa.table({"table_name": [*facts, *dims], "kind": ["fact"] * len(facts) + ["dim"] * len(dims)})
    return spark.createDataFrame(names)


def parse_changes(records: DataFrame) -> DataFrame:
    """``value`` to ``table_name, change_type, data, op``; other columns stay."""
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = with_parsed(records, "change", F.from_json("value", schemas.CHANGE_RECORD, options))
    return parsed.select(
        *records.columns,
        F.col("change.table").alias("table_name"),
        F.col("change.type").alias("change_type"),
        F.col("change.data").alias("data"),
        change_operation(F.col("change.type")).alias("op"),
        (F.col("change").isNull() | F.col(f"change.{schemas.CORRUPT}").isNotNull()).alias("corrupt"),
    )


def known_changes(changes: DataFrame) -> DataFrame:
    """Drop changes of any other type (table definitions and the like)."""
    return changes.where(F.col("op").isNotNull())


def listed_changes(changes: DataFrame, lists: DataFrame) -> DataFrame:
    """Changes with the ``kind`` of each list that holds their table, from one scan; the rest is dropped."""
    return changes.join(lists.dropDuplicates(["table_name", "kind"]), "table_name")


def in_list(changes: DataFrame, lists: DataFrame, kind: str) -> DataFrame:
    """Changes of the tables in one list."""
    return changes.join(lists.where(F.col("kind") == kind).select("table_name"), "table_name", "left_semi")


def fact_records(changes: DataFrame, lists: DataFrame) -> DataFrame:
    """``(topic, value)`` of every known change of a fact table."""
    facts = in_list(known_changes(changes), lists, "fact")
    return facts.select(fact_topic(F.col("table_name"), F.col("op")).alias("topic"), F.col("data").alias("value"))


def row_id(data: Column) -> Column:
    return F.get_json_object(data, "$.id")


def dim_records(changes: DataFrame, lists: DataFrame, version: str = "version") -> DataFrame:
    """Rows for the dimension store: ``(table_name, id, key, op, version, data)``.

    A delete is a row too; the store decides whether it hides the id.
    """
    dims = in_list(known_changes(changes), lists, "dim")
    identity = row_id(F.col("data"))
    return dims.select(
        "table_name",
        identity.alias("id"),
        dim_key(F.col("table_name"), identity).alias("key"),
        "op",
        F.col(version).alias("version"),
        "data",
    )


def route_changes(changes: DataFrame, lists: DataFrame, version: str = "version") -> DataFrame:
    """All outputs from one scan: ``(target, topic, table_name, id, key, version, op, value)``.

    ``target`` is ``fact`` or ``dim``; a table in both lists gives two rows.
    Corrupt records go to ``corrupt`` untouched, with a topic of their own.
    ``id`` and ``key`` are those of a dimension row.
    """
    fact = F.col("kind") == "fact"
    dim = ~F.col("corrupt") & (F.col("kind") == "dim")
    identity = row_id(F.col("data"))
    listed = changes.join(lists.dropDuplicates(["table_name", "kind"]), "table_name", "left")
    keep = F.col("corrupt") | (F.col("op").isNotNull() & F.col("kind").isNotNull())
    return listed.where(keep).select(
        F.when(F.col("corrupt"), "corrupt").otherwise(F.col("kind")).alias("target"),
        F.when(F.col("corrupt"), topics.CORRUPT)
        .when(fact, fact_topic(F.col("table_name"), F.col("op")))
        .alias("topic"),
        "table_name",
        F.when(dim, identity).alias("id"),
        F.when(dim, dim_key(F.col("table_name"), identity)).alias("key"),
        F.col(version).alias("version"),
        "op",
        F.when(F.col("corrupt"), F.col("value")).otherwise(F.col("data")).alias("value"),
    )
