"""The corpus pipeline: each stage works on all that the one before kept, with the columns of ``documents``.

Toxicity and language are learned from the rows that reach their stage and have a label or a language. A document goes if
its probability of being toxic is 0.5 or more; if no language has half of the probability, which is so where it has no
letters; or if it is a near copy (five-word shingles, 0.8) of one with a smaller id. Lines that repeat across
documents go from all but one. Every stage takes null and empty texts: these have no language and so go with that stage.

Texts are whole, of any length. Of near copies with equal ids or null ids, and of rows that repeat id and text, one stays; rows that
share an id have one label. Extra columns stay up to packing, except that names with two leading underscores are the
stages' own. An empty table passes every stage and gives no sequences; with no label or no language to learn from, nothing is
toxic, and no text has a language.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm import language_id, line_dedup, minhash_forest, packing, toxicity
from rillmart.session import run_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not len(model.at) and not model.bias:  # nothing was learned, and every document has a probability of one half
        return docs
    return docs.where(toxicity.toxicity(model, F.col("text")) < 0.5)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return docs.where(language_id.language(model, F.col("text"))["score"] >= 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.repeated_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.without_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size = packing.token_count(public_tokenizers.path("word_bpe_49k.json"), F.col("text"))
    return packing.pack_documents(docs.select("doc_id", size.alias("n_tokens")))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None  # toxicity and language are learned models; the operators' own tests compare them with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
