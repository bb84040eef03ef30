"""Quality rules and classifier, toxicity."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import quality_classifier, quality_rules, toxicity

SF = "/root/testdata/sf0.1"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))  # noqa: B905
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


def counted(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_rules.quality(docs, sample_docs=50).collect():
        assert counted(r) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_hard_rows(hard, empty):
    got = quality_rules.quality(hard).collect()
    assert sorted(map(counted, got)) == sorted(brute(r.text) for r in hard.collect())
    assert quality_rules.quality(empty).count() == 0


def test_order_by_rejection_per_cost():
    assert quality_rules.ordered([("a", 1.0, 0.5), ("b", 0.1, 0.4), ("c", 2.0, 0.0), ("d", 0.1, 0.4)]) == ["b", "d", "a", "c"]


def test_cascade_stops_at_the_first_rejection_and_order_does_not_decide(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plain = {r.doc_id: r.kept for r in quality_rules.quality(docs).collect()}
    turned = dict(reversed(quality_rules.RULES.items()))
    assert plain == {r.doc_id: r.kept for r in quality_rules.quality(docs, turned).collect()}


def test_rules_follow_the_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_rules.quality(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.99 and kept[0] < 0.05


def test_classifier_is_right_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_classifier.classify(docs, labels).join(labels, "doc_id").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).select("kept", "quality").collect()
    assert len(rows) > 1000
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.97


def test_sites_shrink_towards_their_host(spark):
    """A site of many bad documents lowers a neutral one; a site of one document says little."""
    bad, good = "$$$ *** ### " * 30, "plain words that differ every time so nothing is repeated here " * 2
    rows = [(i, bad if i % 50 < 49 else good, "p", "bad-host") for i in range(1, 200)]
    rows += [(i, good, "p", "good-host") for i in range(1000, 1200)] + [(5000, good, "p", "lone-host")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(r[0], int(r[1] == good)) for r in rows if r[0] < 5000], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labels).collect()}
    assert got[49].path_share < got[5000].path_share < got[1000].path_share
    assert got[49].score < got[5000].score < got[1000].score


def test_classifier_hard_rows(hard, empty, labels):
    rows = quality_classifier.classify(hard, labels).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.classify(empty, labels).count() == 0
    assert quality_classifier.classify(hard, labels.limit(0)).count() == hard.count()


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in held)
    assert hit / sum(r.toxic for r in held) > 0.7 and hit / sum(r.predicted for r in held) > 0.9


def test_held_out_labels_are_never_read(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet(
        "/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(docs, turned).collect()}
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_composed_machine_tells_readings_apart():
    g = toxicity.Grammar({"=fool": 2.0, "idio": 3.0})
    read = lambda t: [[round(x, 1) for x in c] for c in g.clauses(t)[0]]
    assert read("what a Fool") == [[2.0, 0, 0, 0, 0]]
    assert read("you are a fool") == [[0, 2.0, 0, 0, 0]]
    assert read("you are not a fool") == [[0, 0, 2.0, 0, 0]]
    assert read("it was said by all that the idiots lost") == [[0, 0, 0, 3.0, 0]]
    assert read("I will kill you. A fool") == [[0, 0, 0, 0, 3.0], [2.0, 0, 0, 0, 0]]
    assert read("not. a fool") == [[2.0, 0, 0, 0, 0]]


def test_toxicity_hard_rows(hard, empty, labels):
    rows = toxicity.toxicity(hard, labels).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(hard, labels.limit(0)).count() == hard.count()
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.drop_toxic(hard, labels).columns == hard.columns


@pytest.mark.parametrize("text", ["", "a", "x " * 5])
def test_features_have_one_length(text):
    assert len(quality_classifier.features(text.encode())) == quality_classifier.N_FEATURES
