"""Stages keep the columns, act on rows as they say, and pass odd rows and empty tables."""

import corpus_pipeline as pipeline
from tests.compare import compare

from millrace.llm.queries import oracles, registered

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, step in pipeline.STAGES:
        out = step(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == docs.columns and out.count() <= docs.count()
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = pipeline.run(spark, FOLDER).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.collect()}
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, id int"
    rows = [(1, None, None, "a", 0, "z", 1), (1, None, None, "a", 0, "z", 1), (4, "hello the world of it", None, "b", 3, "q", 2),
            (None, "hello the world of it", "en", "b", 3, "q", 2), (5, "das ist gut", "de", "b", 3, "q", 2), (5, "das ist gut", "de", "b", 3, "q", 2)]
    kept = {"language": 4, "jaccard": 4, "passages": 4, "packing": 6}
    for name, step in pipeline.STAGES:
        assert step(spark, spark.createDataFrame(rows, schema), "").count() == kept[name]
        assert step(spark, spark.createDataFrame([], schema), "").count() == 0


def test_oracles(spark):
    for name, sql in oracles().items():
        assert compare(registered()[name](spark, FOLDER), FOLDER, sql) == ""
