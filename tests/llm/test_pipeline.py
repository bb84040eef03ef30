"""The corpus pipeline's stages against brute force over what each has been given."""

import pytest
from test_jaccard import kept_by_brute_force
from test_native import base_spans, shingle_set
from test_tokens import check_packing

import corpus_pipeline
from flowlens.llm import toxicity
from flowlens.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    docs = stages[0]
    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert set(rows(stages[1])) == {d for d, p in predicted.items() if p == 0}


def test_one_document_of_each_group_stays(stages):
    """The stage's own target: components of five-word similarity 0.8 or more."""
    assert set(rows(stages[2])) == kept_by_brute_force(stages[1].collect())


def test_benchmark_documents_go(spark, stages):
    items = [s for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (s := shingle_set(r.text))]
    clean = lambda text: not any(100 * len(shingle_set(text) & s) >= 80 * len(s) for s in items)
    assert set(rows(stages[3])) == {d for d, r in rows(stages[2]).items() if clean(r.text)}


def test_secrets_go_and_documents_stay(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for d, r in after.items():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if r.text != before[d].text:
            assert "[SECRET]" in r.text


def test_all_that_is_left_is_packed(stages):
    whole = check_packing(stages[4].collect(), stages[5].toPandas(), 1024)
    assert sum(1024 - n for n in whole) < 0.02 * sum(whole)


def test_hard_rows(spark, hard, labels, tmp_path):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "item_id long, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (hard, hard.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert {"doc_id", "sequence_id", "ids"} <= set(docs.columns)
