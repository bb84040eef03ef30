"""Token operators: equal to the tokenizer's own answer on whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from flowlens.llm import binary_output, packing, token_counts, tokens
from flowlens.llm.common import scratch_path

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BITS = [" ", "  ", "\n", "\t", " ", "\x1c", "a", "b,", "'s", "é", "1", ".", "<|endoftext|>", "<|startoftext|>", "ß",
        "́", "Σ", "日", "\r\n", " ", "foo.", "naïve", "x\n", "don't"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(1500)]


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u2").tolist()


def test_cached_ids_are_the_tokenizers(texts):
    own, encode = tokens.load(BYTE), tokens.ByteIds(BYTE)
    for t in texts * 2:
        assert ids_of(encode(t)) == own.encode(t, add_special_tokens=False).ids, t


def test_full_cache_starts_anew():
    seen = []
    cache = tokens.PartCache(lambda new: [seen.append(p) or len(p) for p in new], {"the": 3}, parts=4)
    for i in range(300):
        assert cache.values(["the", f"w{i}"]) == [3, len(f"w{i}")]
    assert len(cache.kept) <= 6 and "the" in cache.kept and "the" not in seen


def test_counts(spark, texts):
    own = tokens.load(WORD)
    rows = [(i, t) for i, t in enumerate([*texts, None, "x" * 5000])]
    got = {r.doc_id: r for r in token_counts.count_tokens(
        spark.createDataFrame(rows, "doc_id long, text string"), WORD, sample_docs=100, size=50).collect()}
    for i, t in rows:
        n = len(own.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)


def test_counts_of_hard_rows(hard, empty):
    assert token_counts.count_tokens(hard, WORD).count() == hard.count()
    assert token_counts.count_tokens(empty, WORD).count() == 0


@pytest.mark.parametrize("source", ["documents", "hard", "empty"])
def test_files_hold_the_ids(spark, hard, empty, source):
    docs = {"documents": spark.read.parquet(f"{SF}/documents.parquet"), "hard": hard, "empty": empty}[source]
    path = scratch_path(spark, "ids")
    binary_output.write_ids(docs.repartition(5), BYTE, path)
    got = sorted(binary_output.read_ids(spark, path).collect(), key=lambda r: r.start)
    own, start, order = tokens.load(BYTE), 0, []
    want = defaultdict(list)
    for r in docs.collect():
        ids = [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
        want[r.doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == start
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
        order.append(-1 if r.doc_id is None else r.doc_id)
    assert order == sorted(order) and not any(want.values())


def check_packing(docs: list, pieces: pd.DataFrame, window: int):
    own = tokens.load(BYTE)
    left = defaultdict(int)
    for r in docs:
        left[tuple([*own.encode(r.text or "", add_special_tokens=False).ids, 0])] += 1
    whole = []
    assert (pieces["length"] > 0).all()
    for _, g in pieces.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= window
        whole.append(int(g["length"].sum()))
    pieces["at"] = pieces["doc_id"].fillna(-1)
    for _, g in pieces.groupby("at"):
        g = g.sort_values(["start"])
        for r in g.itertuples():
            ids = ids_of(r.ids)
            assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    total = sum(len(k) * n for k, n in left.items())
    assert pieces["length"].sum() == total
    return whole


def test_packing_places_each_id_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs, BYTE, 256, shard_docs=64).toPandas()
    whole = check_packing(docs.collect(), pieces, 256)
    own = tokens.load(BYTE)
    for r in docs.collect():
        g = pieces[pieces["doc_id"] == r.doc_id].sort_values("start")
        got = [i for data in g["ids"] for i in ids_of(data)]
        assert got == [*own.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert g["start"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and set(g["doc_tokens"]) == {len(got)}
    assert sum(256 - n for n in whole) < 0.03 * sum(whole)


def test_packing_of_hard_rows(hard, empty):
    check_packing(hard.collect(), packing.pack(hard, BYTE, 64).toPandas(), 64)
    assert packing.pack(empty, BYTE).count() == 0


def test_neighbours_share_words():
    """A seed's window takes the remainder that shares its rare ids before any other."""
    rests = [np.array(x, "<u2") for x in ([5] * 8 + [900, 901], [5] * 9, [7] * 9, [900, 901, 902])]
    idf = np.zeros(1 << 16)
    idf[[5, 7, 900, 901, 902]] = [0.1, 0.5, 3, 3, 3]
    placed = list(packing.fill(rests, packing.Index(rests, idf, 8.0), 16))
    assert [p[0] for p in placed if p[3] == 0][:3] == [0, 3, 1]


def test_bm25_scores():
    rests = [np.array(x, "<u2") for x in ([1, 1, 2], [2, 3, 4, 4], [9])]
    idf = np.zeros(1 << 16)
    idf[[1, 2, 3, 4, 9]] = [1.0, 0.5, 1.2, 1.1, 2.0]
    mean = 8 / 3
    got = packing.Index(rests, idf, mean).scores(np.array([1, 2, 4], "<u2"))
    for r, s in zip(rests, got, strict=True):
        want = sum(idf[t] * (r == t).sum() * (packing.K1 + 1) / (
            (r == t).sum() + packing.K1 * (1 - packing.B + packing.B * len(r) / mean)) for t in (1, 2, 4))
        assert abs(s - want) < 1e-9


def test_copies_meet_in_one_shard_of_many(spark):
    """Edited copies are dealt by what they hold, however many shards there are."""
    rng = random.Random(5)
    rows = []
    for i in range(200):
        words = [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(10**4)}" for _ in range(60)]
        rows.append((2 * i, " ".join(words)))
        words[rng.randrange(60)] = "edited"
        rows.append((2 * i + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), shard_docs=40).collect()
    shard = {p.doc_id: (p.sequence_id - (1 << 62)) >> 31 for p in pieces}
    assert len(set(shard.values())) == 10
    assert sum(shard[2 * i] == shard[2 * i + 1] for i in range(200)) > 120
