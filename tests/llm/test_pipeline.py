"""The pipeline's stages, each on its own input."""

from collections import Counter

import pytest
from odd import documents, nothing

import corpus_pipeline
from rillmart.session import run_folder

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    start = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        path = run_folder(spark, f"t-{name}")
        stage(spark, docs, FOLDER).write.parquet(path)
        left = spark.read.parquet(path)
        if name != "packing":
            assert left.columns == COLUMNS and left.dtypes == docs.dtypes
            assert left.join(docs, "doc_id").count() == left.count() == left.select("doc_id").distinct().count()
            if name == "lines":
                assert left.count() == docs.count() and left.where("n_chars <> length(text)").count() == 0
            else:
                assert left.exceptAll(docs).count() == 0
            docs = left
        else:
            assert left.select("doc_id").distinct().count() == docs.count()
    assert 0.5 * start < docs.count() < start
    assert corpus_pipeline.run(spark, FOLDER).count() == left.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_documents_and_none(spark, name, stage):
    out = stage(spark, documents(spark), FOLDER)
    rows = out.collect()
    if name == "packing":
        assert Counter(r.doc_id for r in rows).keys() == {r.doc_id for r in documents(spark).select("doc_id").collect()}
    else:
        assert out.columns == documents(spark).columns
    if name == "language":
        assert all(any(c.isalpha() for c in r.text) for r in rows) and len(rows) >= 16
    assert stage(spark, nothing(spark), FOLDER).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    folder = run_folder(spark, "t-unlabelled")
    spark.read.parquet(f"{FOLDER}/labels.parquet").where("false").write.parquet(f"{folder}/labels.parquet")
    docs = documents(spark)
    assert corpus_pipeline.drop_toxic(spark, docs, folder).count() == docs.count()
