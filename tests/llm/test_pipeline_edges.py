"""The pipeline over awkward rows: nulls, empty and long texts, repeated rows, clashing names, empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

WORDS = "the quick brown fox jumps over a lazy dog while seven other foxes watch from the hill nearby".split()
LONG = " ".join(WORDS[k % len(WORDS)] + str(k % 991) for k in range(40_000))
PLAIN = " ".join(WORDS)
DOCS = [(1, PLAIN, "en", "a"), (2, PLAIN.replace(" ", "  "), "en", "a"), (3, None, None, "a"), (4, "", "en", None), (5, " \n\t", "en", None),
        (6, LONG, "en", "b"), (6, LONG, "en", "b"), (7, LONG + " end", "en", "b"), (None, "entirely other words stand here alone", "de", "c"),
        (8, "x" * 30_000, "en", "c")]


def _tables(spark, tmp_path, docs, labels):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for name in ("row", "uid", "stats", "score", "bloom_hash", "class_id", "gone_id", "kept", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_awkward_rows(spark, tmp_path):
    sf_dir = _tables(spark, tmp_path, DOCS, [])  # no labels: the classifier rejects none
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test-stage")
        left[name] = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
        assert sorted(docs.columns) == sorted(corpus_pipeline.table(spark, sf_dir, "documents").columns)
    assert left["quality classifier"] == sorted(str(d[0]) for d in DOCS)
    assert left["exact dedup"] == sorted(["2", "5", "6", "7", "8", "None"])  # 2 and 5 have more code points
    assert left["MinHash near-dedup"] == sorted(["2", "5", "6", "8", "None"])
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, sf_dir)
    tokens = corpus_pipeline.STAGES[4][1](spark, mixed, sf_dir).collect()
    assert len(tokens) == mixed.count() and {str(t.doc_id) for t in tokens} <= set(left["MinHash near-dedup"])


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 0, 0)]])
def test_an_empty_table(spark, tmp_path, labels):
    sf_dir = _tables(spark, tmp_path, [], labels)
    assert corpus_pipeline.run(spark, sf_dir).collect() == []
