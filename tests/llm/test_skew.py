"""A text, an address or a line that half of all rows have: the adaptive plan splits it, and the result is whole."""

import pytest
from pyspark.sql import functions as F

from rillmart.llm import exact_dedup, line_dedup, url_filters


@pytest.fixture
def split_settings(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split(df):
    rows = df.collect()
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


N = 12_000


def test_a_hot_text_is_split(spark, split_settings):
    # equal rows shrink in the shuffle, so more than half of them are needed to stand out here
    text = F.when(F.col("id") % 20 > 0, "the same text").otherwise(F.concat(F.lit("text "), F.col("id")))
    docs = spark.range(N).repartition(16).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows, was = split(exact_dedup.exact_duplicates(docs))
    assert was and len(rows) == N and {r.keep_id for r in rows if r.doc_id % 20} == {N - 1}
    assert sum(r.kept for r in rows) == N // 20 + 1


def test_a_hot_address_is_split(spark, split_settings):
    url = F.when(F.col("id") % 2 == 0, "http://hot.example.net/x").otherwise(F.concat(F.lit("http://h"), F.col("id"), F.lit(".net/")))
    pages = spark.range(N).repartition(16).select(F.col("id").alias("page_id"), url.alias("url"))
    rules = spark.createDataFrame([("net", "/", "block"), ("hot.example.net", "/x", "allow")], "host STRING, path STRING, verdict STRING")
    rows, was = split(url_filters.judge_urls(pages, rules))
    assert was and len(rows) == N
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in rows)


def test_a_hot_line_is_split(spark, split_settings):
    hot = "a line that half of all lines are, of some length"
    lines = F.concat_ws("\n", F.lit(hot), F.concat(F.lit("another line of some length, which is seen once: "), F.col("id")))
    docs = spark.range(N).repartition(16).select(F.col("id").alias("doc_id"), lines.alias("text"))
    rows, was = split(line_dedup.repeated_lines(docs))
    assert was and len(rows) == N and sum(hot in r.text for r in rows) == 1
