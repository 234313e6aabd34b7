"""The registered queries against DuckDB, and the pipeline against a brute-force version."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from ledgerflow.llm import common, quality_cnn, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", x)[1]) for x in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, duck, name):
    found = duck.sql(queries.ORACLE[name])
    columns, want = found.columns, found.fetchall()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want))


def test_pipeline_stages_do_what_they_say(spark, scratch):
    docs = common.table(spark, SF, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "decontamination", "source_mixing"]
    net = quality_cnn.fit(docs, common.table(spark, SF, "labels"))

    def score(text):
        return net.score(np.concatenate([net.logits(c) for c in quality_cnn.chunked((text or "").encode())]))

    before = {x.doc_id: x for x in docs.collect()}
    after = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        if name != "source_mixing":
            assert docs.columns == columns
            after = {x.doc_id: x for x in docs.collect()}
            assert len(after) == docs.count() and set(after) <= set(before)
        if name == "quality_classifier":
            scores = {i: score(x.text) for i, x in before.items()}
            sure = {i for i, s in scores.items() if abs(s - 0.3) > 1e-4}
            assert {i for i in after if i in sure} == {i for i in sure if scores[i] >= 0.3}
        if name == "decontamination":
            marked = queries.decontaminate.contamination(spark.read.parquet(f"{scratch}/{k - 1}"), common.table(spark, SF, "benchmark"))
            assert set(after) == {x.doc_id for x in marked.where(F.size("found.spans") == 0).collect()}
        if name != "source_mixing":
            before = after
    mix = docs.collect()
    assert {x.doc_id for x in mix} <= set(before)
    words = sum(len(re.findall("[^\x20\x09-\x0D]+", x.text or "")) for x in before.values())
    assert abs(sum(x.words for x in mix) - 1.5 * words) <= 20
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted((x.doc_id, x.epoch, x.words, x.position) for x in again) == sorted((x.doc_id, x.epoch, x.words, x.position) for x in mix)


def test_pipeline_on_awkward_rows(spark, scratch):
    rows = [(i, t, "en", s, 1) for i, (t, s) in enumerate([(None, None), ("", "a"), ("x", None), ("same text here " * 30, "a"), ("same text here " * 30, "b")])]
    rows += [rows[3], (None, "no id " * 20, "en", "a", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(7, "an item")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0), (2, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    mix = corpus_pipeline.run(spark, scratch).collect()
    assert {x.doc_id for x in mix} <= {2, 3, None} and 3 in {x.doc_id for x in mix}
    pages = spark.createDataFrame([(1, "http://a.de/", "<html lang=de>x"), (None, None, None), (2, None, "p" * 150), (3, "u", "p" * 150), (3, "u", "p" * 150)], "page_id long, url string, html string")
    pages.write.parquet(f"{scratch}/pages.parquet")
    for name, f in queries.QUERIES.items():
        if name != "op12_spelling_variants":  # a row for each word
            assert f(spark, scratch).count() == (5 if name in ("op2_language", "op6_warc") else len(rows)), name


def test_empty_tables(spark, scratch):
    for t in ("documents", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{scratch}/{t}.parquet")
    for name, f in queries.QUERIES.items():
        assert f(spark, scratch).count() == 0, name
    assert corpus_pipeline.run(spark, scratch).count() == 0
