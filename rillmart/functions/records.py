"""Rows to and from JSON text, and copying columns by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmart import schemas


def with_parsed(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Add a parsed column that is computed once per row.

    Spark moves a filter on a plain column below the projection that makes it,
    and then parses the text in the filter and again above. It does not move
    filters below an explode, so the value goes through one of a single element.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def long_of(text: Column) -> Column:
    """A number read as text, without its fraction; null where it is none."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def to_wire(record: list[tuple[str, str, str]], source: dict[str, Column] | None = None) -> Column:
    """A record as JSON text under its wire names; null fields are left out."""
    pick = source or {name: F.col(name) for name, _, _ in record}
    return F.to_json(F.struct(*[pick[name].alias(wire) for name, wire, _ in record]))


def from_wire(df: DataFrame, record: list[tuple[str, str, str]], *keep: str) -> DataFrame:
    """JSON text in ``value`` back to the record's columns; columns in ``keep`` stay beside them."""
    parsed = with_parsed(df.select("value", *keep), "r", F.from_json("value", schemas.wire_schema(record)))
    return parsed.select(*[F.col(f"r.`{wire}`").alias(name) for name, wire, _ in record], *keep)


def from_rows(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """JSON text in ``value`` to the columns of ``schema``; columns in ``keep`` stay beside them."""
    return with_parsed(df.select("value", *keep), "r", F.from_json("value", schema)).select("r.*", *keep)


def common_fields(source: T.StructType, target: T.StructType) -> list[str]:
    """Names that both schemas hold with the same type, in the target's order."""
    types = {f.name: f.dataType for f in source.fields}
    return [f.name for f in target.fields if types.get(f.name) == f.dataType]


def copy_by_name(source: DataFrame, target: T.StructType) -> DataFrame:
    """Shape ``source`` as ``target``: copy fields equal in name and type, leave the rest null."""
    shared = set(common_fields(source.schema, target))
    return source.select(
        *[
            F.col(f.name) if f.name in shared else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )
