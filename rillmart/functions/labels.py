"""Codes and display labels of the serving queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display labels.
GENDER_LABELS = {"F": "女", "M": "男"}
AGE_LABELS = ("20岁以下", "20到29岁", "30岁以上")
# Request type -> column of the order wide table.
STAT_FIELDS = {"age": "user_age", "gender": "user_gender"}


def stat_field(kind: str) -> str:
    """Column for a request type; an unknown type is an error."""
    try:
        return STAT_FIELDS[kind]
    except KeyError:
        raise ValueError(f"unknown statistic {kind!r}; expected one of {sorted(STAT_FIELDS)}") from None


def stat_field_label(kind: Column) -> Column:
    """The same mapping as a column; unknown types give null."""
    return F.when(kind == "age", "user_age").when(kind == "gender", "user_gender")


def gender_label(gender: Column) -> Column:
    labelled = gender
    for code, label in GENDER_LABELS.items():
        labelled = F.when(gender == code, F.lit(label)).otherwise(labelled)
    return labelled


def change_operation(change_type: Column) -> Column:
    """Change type -> I, U or D; any other type gives null."""
    return (
        F.when(change_type.isin("insert", "bootstrap-insert"), "I")
        .when(change_type == "update", "U")
        .when(change_type == "delete", "D")
    )


def fact_topic(table: Column, op: Column) -> Column:
    return F.concat(F.lit("DWD_"), F.upper(table), F.lit("_"), op)


def dim_key(table: Column, row_id: Column) -> Column:
    return F.concat(F.lit("DIM:"), F.upper(table), F.lit(":"), row_id)
