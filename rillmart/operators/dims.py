"""Dimensions: latest row by id, and lookups from facts.

No join here carries a broadcast hint. Spark broadcasts a dimension whose size
it knows to be under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
otherwise; a hot key of the fact side is then split by adaptive execution,
which may split the left side of a left join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmart import schemas
from rillmart.functions.time import age_years


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the highest ``order`` for each key.

    Spark turns ``row_number() = 1`` into a group limit that also runs before
    the shuffle, so each task sends at most one row per key, however hot.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


FEW_REPEATED = 100_000  # hashes of repeated keys that pass the driver


def keep_latest_of_few(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``keep_latest`` of stored rows of which few share a key: only those are shuffled and ranked.

    A first job counts hashes of the keys. Rows whose hash is there once have no rival and stay as they are; different keys
    of one hash are ranked apart. If over ``FEW_REPEATED`` hashes repeat, all rows are ranked.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    repeated = df.select(hashed).groupBy("_hash").count().where("count > 1").select("_hash").limit(FEW_REPEATED + 1).collect()
    if not repeated:
        return df
    if len(repeated) > FEW_REPEATED:
        return keep_latest(df, keys, order)
    few = df.sparkSession.createDataFrame(repeated, "_hash BIGINT")
    marked = df.withColumn("_hash", hashed)
    rivals = keep_latest(marked.join(few, "_hash", "left_semi"), keys, order)
    return marked.join(few, "_hash", "left_anti").unionByName(rivals).select(df.columns)


def dim_latest(records: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Last write by table and id. A delete writes its row too and stays unless ``drop_deleted``."""
    latest = keep_latest(records, ["table_name", "id"], ["version", "op", "data"])
    return latest.where(F.col("op") != "D") if drop_deleted else latest


def dim_table(latest: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """The typed rows of one dimension."""
    rows = latest.where(F.col("table_name") == table)
    return rows.select(F.from_json("data", schema).alias("row")).select("row.*")


def users(latest: DataFrame) -> DataFrame:
    return dim_table(latest, "user_info", schemas.USER_INFO)


def provinces(latest: DataFrame) -> DataFrame:
    return dim_table(latest, "base_province", schemas.BASE_PROVINCE)


def join_user(facts: DataFrame, users: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Add ``user_gender`` and ``user_age``; a fact without a user keeps nulls."""
    key = facts.schema["user_id"].dataType
    lookup = users.select(
        F.col("id").cast(key).alias("_user"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), as_of).alias("user_age"),
    )
    return facts.join(lookup, F.col("user_id") == F.col("_user"), "left").drop("_user")


def join_province(facts: DataFrame, provinces: DataFrame, iso_3166_2: str = "province_3166_2_code") -> DataFrame:
    """Add the four province columns; a fact without a province keeps nulls."""
    key = facts.schema["province_id"].dataType
    lookup = provinces.select(
        F.col("id").cast(key).alias("_province"),
        F.col("name").alias("province_name"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias(iso_3166_2),
        F.col("area_code").alias("province_area_code"),
    )
    return facts.join(lookup, F.col("province_id") == F.col("_province"), "left").drop("_province")
