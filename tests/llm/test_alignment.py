"""Token alignment: equal to a plain computation over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from flowlens.llm import alignment, tokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = [" ", "  ", "\n", "\t", " the", "\x1c", "a", "b,", "'s", "é", "1", ".", "<|endoftext|>", "<s>", "</s>", "ß", "<0x0A>",
        "́", "Σ", "日本", "\r\n", " ", " ", "foo.", "naïve", "x\n", "don't", " unbelievable", " tokenization", "😀"]


def plain(rows):
    """What the operator returns, from whole texts and explicit overlaps."""
    import sentencepiece

    tok, sp = tokens.load(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    alphabet = {c: b for b, c in tokens.byte_alphabet().items()}

    def spans(pieces):
        out, at = [], 0
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    aligned, holds = {}, defaultdict(int)
    for _, text in rows:
        if not text or text in aligned:
            continue
        a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        bytes_a = [bytes(alphabet[c] for c in tok.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = b" " + text.encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            aligned[text] = None
            continue
        at, bt = spans(bytes_a), spans(bytes_b)
        links, j0 = [], 0
        for i, (s, e) in enumerate(at):
            while bt[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(bt) and bt[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = {e for _, e in at} & {e for _, e in bt}
        parts = []
        for ids, spans_ in ((a, at), (b, bt)):
            split = [[]]
            for x, (_, e) in zip(ids, spans_):
                split[-1].append(str(x))
                if e in cuts:
                    split.append([])
            parts.append([",".join(x) for x in split if x])
        groups = ["|".join(x) for x in zip(*parts, strict=True)]
        aligned[text] = (len(a), len(b), groups, links)
    for _, text in rows:
        if text and aligned[text]:
            for p in set(aligned[text][3]):
                holds[p] += 1
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    out = []
    for d, text in rows:
        if not text or not aligned[text]:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = aligned[text]
        out.append((d, n_a, n_b, len(groups), len(links), sum(holds[p] == most[p[0]] for p in links), sum(holds[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def got(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert df.columns == names
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_equals_whole_texts(spark, broadcast_pairs):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [" leading", "trailing ", "a▁b", "▁", " ", "  ", None, "", "x" * 3000, "word " * 5000, *texts[:40], *texts[:40]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(alignment.align_documents(docs, A, B, broadcast_pairs)) == Counter(plain(rows))


def test_equals_whole_texts_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(alignment.align_documents(docs, A, B)) == Counter(plain(rows))


def test_hard_rows(hard, empty):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert got(alignment.align_documents(hard, A, B)) == Counter(plain(rows))
    assert alignment.align_documents(empty, A, B).count() == 0


def test_small_cache_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 5)
    own = alignment.Aligner(A, B)
    first = own.values(["a", "bb", " ccc", ".日"])
    for _ in range(3):
        own.values([f"w{i}" for i in range(20)])
        assert own.values(["a", "bb", " ccc", ".日"]) == first
    assert len(own.kept) <= 25 and len(own.older) <= 25
