"""Alignment of two tokenizers' tokens, over distinct texts.

Texts are grouped by their full text, so each different text is tokenized and aligned once; what it holds counts as
often as it occurs. A text, with the space put before it, is cut into units where neither tokenizer lets a token or a
rule reach across: before a space that follows a visible character, between a letter and a mark that no piece joins to
letters, and between a single line break and a letter. Each Python worker keeps the aligned units it has met in a
bounded cache.
"""

from __future__ import annotations

import array
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm import tokens
from flowlens.llm.common import materialize, small_enough, text_of

#: Different id pairs up to which their counts are broadcast (about 40 MB); beyond, they are joined by a shuffle.
BROADCAST_PAIRS = 400_000
#: Aligned units a worker keeps, twice over, the longest it keeps, and texts aligned at a time.
CACHE_UNITS, CACHE_LENGTH, TEXTS = 80_000, 48, 256

_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
_WORD = re.compile(f" ?{_LETTER}+")
_MARKS = "\n!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
ALIGNED = "key binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, links array<int>"


class Aligner:
    """Aligned units: (A tokens, B tokens, groups as text, links as 64-bit ``a << 32 | b``), or None without equal bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.a = tokens.load(path_a)
        self.a.encode_special_tokens = True
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            spec.ParseFromString(f.read())
        spec.normalizer_spec.add_dummy_prefix = False  # units bring their spaces
        self.b = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.alphabet, self.model = tokens.byte_alphabet(), self.a.model.tokenize
        back = {c: b for b, c in self.alphabet.items()}
        spelt = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in spelt]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        joined = {m[0] for i, p in enumerate(pieces) if not self.b.is_byte(i) for m in re.findall(f"(?<={_LETTER})[^\\w▁]", p)}
        marks = "".join(re.escape(c) for c in _MARKS if c not in joined)
        broken = any("\n" in p and len(p) > 1 for p in pieces)
        self.cut = re.compile("(?<=\\S)(?= )" + (f"|(?<={_LETTER})(?=[{marks}])" if marks else "")
                              + ("" if broken else f"|(?<=\\S\n)(?={_LETTER})")).split
        self.kept: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def unit(self, whole: bytes, a: list[int], b: list[int]) -> tuple | None:
        """Value of a unit from its bytes and ids."""
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        if b"".join([bytes_a[i] for i in a]) != whole or b"".join([bytes_b[i] for i in b]) != whole:
            return None
        if len(a) == 1 or len(b) == 1:  # all of it is one group
            links = [x << 32 | y for x in a for y in b]
            return len(a), len(b), ",".join(map(str, a)) + "|" + ",".join(map(str, b)), array.array("q", links).tobytes(), 1
        links, groups, i, j, first_a, first_b = [], [], 0, 0, 0, 0
        end_a, end_b = len(bytes_a[a[0]]), len(bytes_b[b[0]])
        while True:
            links.append(a[i] << 32 | b[j])
            if end_a == end_b:
                i, j = i + 1, j + 1
                groups.append(f"{a[first_a]}|{b[first_b]}" if i - first_a == 1 == j - first_b else
                              ",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
                first_a, first_b = i, j
                if i == len(a):
                    return len(a), len(b), ";".join(groups), array.array("q", links).tobytes(), len(groups)
                end_a, end_b = end_a + len(bytes_a[a[i]]), end_b + len(bytes_b[b[j]])
            elif end_a < end_b:
                i += 1
                end_a += len(bytes_a[a[i]])
            else:
                j += 1
                end_b += len(bytes_b[b[j]])

    def ids_a(self, unit: str, whole: bytes) -> list[int]:
        if _WORD.fullmatch(unit):  # one pre-token, straight to the tokenizer's model
            return [t.id for t in self.model(whole.decode("latin-1").translate(self.alphabet))]
        return self.a.encode(unit, add_special_tokens=False).ids

    def values(self, units: list[str]) -> dict:
        """The value of each of the different ``units``."""
        out, new = {}, []
        for u in units:
            if u in self.kept:
                out[u] = self.kept[u]
            elif u in self.older:
                out[u] = self.kept[u] = self.older[u]
            else:
                new.append(u)
        for u, b in zip(new, self.b.encode(new, num_threads=1) if new else (), strict=True):
            whole = u.encode()
            out[u] = self.unit(whole, self.ids_a(u, whole), b)
            if len(u) <= CACHE_LENGTH:
                self.kept[u] = out[u]
        if len(self.kept) > CACHE_UNITS:  # what is met again moves on, the rest goes with the next change
            self.kept, self.older = {}, self.kept
        return out


_WORKER: dict = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker."""
    if (path_a, path_b) not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _WORKER.clear()
        _WORKER[path_a, path_b] = Aligner(path_a, path_b)
    return _WORKER[path_a, path_b]


def text_key(column: str = "text") -> Column:
    """What stands for a text once texts are distinct: its SHA-256."""
    return F.unhex(F.sha2(F.col(column).cast("binary"), 256))


def align_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each text of ``texts`` (key, copies, text) aligned; those without equal bytes or without tokens are left out."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begin, TEXTS)
                cut = [own.cut(" " + t) for t in part.column(2).to_pylist()]
                value = own.values(list(dict.fromkeys(u for units in cut for u in units)))
                rows: list[tuple] = []
                for r, units in enumerate(cut):
                    found = [value[u] for u in units]
                    if None in found:
                        continue
                    a, b, groups, links, n = zip(*found, strict=True)
                    pairs, times = np.unique(np.frombuffer(b"".join(links), "<i8"), return_counts=True)
                    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                    rows.append((r, sum(a), sum(b), sum(n), digest, pairs, times))
                if rows:
                    at, n_a, n_b, n_groups, digest, pairs, times = zip(*rows, strict=True)
                    kept = part.take(pa.array(at))
                    cuts = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(0), kept.column(1), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(digest),
                         pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(pairs), pa.int64())),
                         pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(times), pa.int32()))],
                        names=[c.split()[0] for c in ALIGNED.split(", ")])

    return texts.select("key", "copies", "text").mapInArrow(align, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold the ids linked) and best (whether no pair of its A id has more)."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair"), "copies").groupBy("pair")
                         .agg(F.sum("copies").alias("n")), "pairs")
    a = F.shiftright("pair", 32).alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("most"))  # a row for each id of A's vocabulary at most
    return counts.select("pair", "n", a).join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    ``path_a`` is a byte-level file of the tokenizers library, ``path_b`` a sentencepiece model that puts a space before
    a text, changes no characters and has no piece with a space after another character. NULL, empty texts and texts whose
    bytes a tokenizer does not give back have zeros and ''. Repeated rows each give a row and each count as a document;
    other columns are left out.
    """
    texts = (docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
             .groupBy("text").agg(F.count("*").alias("copies")).select(text_key().alias("key"), "copies", "text"))
    aligned = materialize(align_texts(texts, path_a, path_b), "aligned")
    counts = small_enough(materialize(pair_counts(aligned), "pair-counts"), broadcast_pairs)
    own = ["key", "n_a", "n_b", "n_groups", "groups_sha256"]
    held = aligned.select(*own, F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(*own, F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
    measured = (held.join(counts, "pair").groupBy(*own)
                .agg(F.sum("links").alias("n_links"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                     F.sum(F.col("links") * F.col("n")).alias("count_sum")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).select("doc_id", text_key().alias("key"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return (rows.join(measured, "key", "left")
            .select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
                    F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
