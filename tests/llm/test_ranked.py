"""Ranked search: equal to scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from flowlens.llm import ranked_search
from flowlens.llm.ranked_search import ranked, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    tf = [(d, Counter(words(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        found = []
        for d, c in tf:
            m = 10 + (90 * sum(c.values()) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in terms if c[w])
            if s > 0:
                found.append((-s, d is None, d))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in df.collect())


def test_terms():
    assert terms_of("Don't ÄB_c 1é\x7f日本 Σς") == [w.encode() for w in words("Don't ÄB_c 1é\x7f日本 Σς")]


@pytest.mark.parametrize("seed,slice_docs,block", [(1, 4096, 10**6), (2, 37, 10**6), (3, 50, 60)])
def test_equals_scoring_all(spark, monkeypatch, seed, slice_docs, block):
    monkeypatch.setattr(ranked_search, "SLICE_DOCS", slice_docs)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    draw = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(80)], k=n))
    docs = [(i, draw(rng.randint(0, 60))) for i in range(600)]
    docs += [(600 + i, docs[5][1]) for i in range(30)] + [(7, docs[7][1]), (None, docs[5][1]), (900, "the " + "w1 " * 5000)]
    items = [(i, draw(rng.randint(1, 20))) for i in range(25)] + [(50, "absent words only"), (51, docs[5][1]), (51, "w3"), (52, "w0")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(ranked(d, spark.createDataFrame(items, "item_id long, text string"), 10, block)) == plain(docs, items)


def test_documents_drop_out_between_owners(spark, monkeypatch):
    """A rare term decides; the owners of frequent terms then get few documents."""
    seen = []
    real = ranked_search.stage
    monkeypatch.setattr(ranked_search, "stage", lambda sums, *a: seen.append(sums) or real(sums, *a))
    docs = [(i, "common words everywhere here " + ("needle pin hook" if i % 40 == 0 else f"other{i % 300}")) for i in range(2000)]
    items = [(1, "common words everywhere needle pin hook"), (2, "here common")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked(d, q)) == plain(docs, items)
    held = [sum(len(r["doc"]) // 4 for r in s.collect()) for s in seen[1:]]
    assert max(held) < 200 + 1


def test_hard_rows(spark, hard, empty):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    items = [(1, "ONE two same"), (2, None), (3, ""), (None, "word id"), (1, "É 日本"), (4, "é same")]
    q = spark.createDataFrame([(*i, 0.5, 1) for i in items], "item_id long, text string, score double, rank int")
    assert got(ranked(hard, q)) == plain(rows, items)
    assert ranked(empty, q).count() == 0 and ranked(hard, q.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert ranked(nothing, q).count() == 0
