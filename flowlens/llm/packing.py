"""Packing by lexical retrieval: neighbours found by BM25 fill each seed document's window.

Every document is its token ids and one end id. Its full windows are sequences of their own; what is left
over is retrieved: remainders are dealt by content over shards of bounded size, so that those with the same
weightiest shared terms meet, and each shard holds an inverted index over its remainders, weighted with document
frequencies counted over all remainders. A seed's window takes its
best unused neighbours; the last of them is cut to fill the window, and its rest is the next seed. So only
the last window of a shard is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import tokens
from flowlens.llm.common import materialize, text_of

END_ID = 0
VOCABULARY = 1 << 16
#: Remainders a shard holds on average, terms a seed asks for, and the usual BM25 constants.
SHARD_DOCS = 2_048
QUERY_TERMS = 24
#: Weightiest terms, of 16 bits each, that order the remainders for dealing.
KEY_TERMS = 4
K1, B = 1.2, 0.75

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")
#: terms and tf: the different ids of the remainder and their numbers, as 16-bit integers.
ENCODED = "uid long, doc_id long, doc_tokens long, windows array<binary>, rest binary, terms binary, tf binary"


def encode_documents(docs: DataFrame, tokenizer: str, window: int) -> DataFrame:
    """One row for each document: its full windows and its remainder, as 16-bit ids, and a row number."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, row = tokens.byte_ids(tokenizer), np.array([END_ID], "<u2").tobytes(), 0
        base, size = TaskContext.get().partitionId() << 33, 2 * window
        for b in batches:
            out: dict[str, list] = {"uid": [], "doc_tokens": [], "windows": [], "rest": [], "terms": [], "tf": []}
            for t in b.column(1).to_pylist():
                data = ids(t) + end
                full = len(data) // size * size
                out["uid"].append(base + row)
                out["doc_tokens"].append(len(data) // 2)
                out["windows"].append([data[i:i + size] for i in range(0, full, size)])
                out["rest"].append(data[full:])
                terms, tf = np.unique(np.frombuffer(data[full:], "<u2"), return_counts=True)
                out["terms"].append(terms.tobytes())
                out["tf"].append(tf.astype("<u2").tobytes())
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["uid"], pa.int64()), b.column(0), pa.array(out["doc_tokens"], pa.int64()),
                 pa.array(out["windows"], pa.list_(pa.binary())), *(pa.array(out[c], pa.binary()) for c in ("rest", "terms", "tf"))],
                names=["uid", "doc_id", "doc_tokens", "windows", "rest", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(encode, ENCODED)


def term_statistics(rests: DataFrame, window: int) -> tuple[np.ndarray, int, float]:
    """Remainders that hold each id, their number and mean length, over all remainders.

    Counted per partition, then summed by id: the result has one row for each id of the vocabulary at most.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(VOCABULARY, "i8"), 0, 0
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2"), minlength=VOCABULARY)
            n, length = n + b.num_rows, length + int((b.column(1).to_numpy() % window).sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array(np.concatenate([held, [-1, -2]]), pa.int64()),
            "n": pa.array(np.concatenate([df[held], [n, length]]), pa.int64())})

    rows = rests.select("terms", "doc_tokens").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.collect()}
    n, length = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(VOCABULARY, "i8")
    df[list(found)] = list(found.values())
    return df, n, length / n if n else 0.0


def content_keys(rests: DataFrame, df: np.ndarray, idf: np.ndarray) -> DataFrame:
    """``rests`` with ``key``: the weightiest terms that other remainders hold too, the first in the highest bits."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = []
            for held, times in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                terms, tf = np.frombuffer(held, "<u2"), np.frombuffer(times, "<u2")
                weight = np.where(df[terms] > 1, -idf[terms] * np.sqrt(tf), np.inf)
                top = [t for t in terms[np.argsort(weight, kind="stable")[:KEY_TERMS]].tolist() if df[t] > 1]
                keys.append(int.from_bytes(b"".join(t.to_bytes(2, "big") for t in top).ljust(8, b"\0"), "big", signed=True))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(keys, pa.int64())],
                                             names=["uid", "doc_id", "doc_tokens", "rest", "key"])

    return rests.select("uid", "doc_id", "doc_tokens", "rest", "terms", "tf").mapInArrow(keyed, "uid long, doc_id long, doc_tokens long, rest binary, key long")


def dealt(keyed: DataFrame, shards: int) -> DataFrame:
    """``keyed`` with ``shard``: ranges of keys of about equal size; a key that fills several is dealt over them."""
    if shards == 1:
        return keyed.withColumn("shard", F.lit(0).cast("long"))
    places = [i / shards for i in range(1, shards)]
    cuts = keyed.agg(F.percentile_approx("key", places, max(10_000, 50 * shards)).alias("cuts")).first()["cuts"]
    shared = keyed.sparkSession.sparkContext.broadcast(np.array(cuts, "i8"))

    @F.pandas_udf("long")
    def shard(key: pd.Series, drawn: pd.Series) -> pd.Series:
        low, high = (np.searchsorted(shared.value, key.to_numpy(), side) for side in ("left", "right"))
        return pd.Series(low + drawn.to_numpy() % (high - low + 1))

    return keyed.withColumn("shard", shard("key", F.xxhash64("uid")))


class Index:
    """Inverted BM25 index over the remainders of a shard."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(r) for r in rests])
        keys = np.concatenate(rests).astype("i8") * len(rests) + np.repeat(np.arange(len(rests)), sizes)
        keys, tf = np.unique(keys, return_counts=True)
        self.idf, self.n, term = idf, len(rests), keys // len(rests)
        self.doc = keys % len(rests)
        self.start = np.searchsorted(term, np.arange(len(idf) + 1))
        norm = K1 * (1 - B + B * sizes[self.doc] / mean)
        self.impact = idf[term] * tf * (K1 + 1) / (tf + norm)

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Scores of all remainders for the terms of ``ids`` that weigh most."""
        terms, tf = np.unique(ids, return_counts=True)
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argsort(-self.idf[terms] * np.sqrt(tf), kind="stable")[:QUERY_TERMS]]
        spans = [slice(self.start[t], self.start[t + 1]) for t in terms.tolist()]
        return np.bincount(np.concatenate([self.doc[s] for s in spans]),
                           weights=np.concatenate([self.impact[s] for s in spans]), minlength=self.n)


def fill(rests: list[np.ndarray], index: Index, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(remainder, first id, length, sequence, offset) of every piece; each id lies in exactly one."""
    unused, first = np.ones(len(rests), bool), 0
    seed: tuple[int, int] | None = None  # a remainder and where its unplaced part begins
    sequence = 0
    while True:
        if seed is None:
            while first < len(rests) and not unused[first]:
                first += 1
            if first == len(rests):
                return
            seed = (first, 0)
            unused[first] = False
        doc, begin = seed
        seed, offset = None, len(rests[doc]) - begin
        yield doc, begin, offset, sequence, 0
        if offset < window:
            scores = np.where(unused, index.scores(rests[doc][begin:]), -1.0)
            while scores[other := int(scores.argmax())] >= 0:
                unused[other], scores[other] = False, -1.0
                length = min(len(rests[other]), window - offset)
                yield other, 0, length, sequence, offset
                offset += length
                if length < len(rests[other]):
                    seed = (other, length)
                if offset == window:
                    break
        sequence += 1


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces of every document in sequences of at most ``window`` ids, with the ids as 16-bit bytes.

    A NULL or empty text is one end id. Repeated rows and rows without an id are packed like any others; ties
    between neighbours go to the smaller doc_id. An empty table gives no pieces. Other columns are left out.
    Documents are encoded once, into a table in the shared folder; row numbers there name the sequences.
    """
    if window > 1 << 16:
        raise ValueError("a window has at most 65,536 ids")
    spark = docs.sparkSession
    encoded = materialize(encode_documents(docs, tokenizer, window), "encoded")
    rests = encoded.where(F.length("rest") > 0)
    df, n, mean = term_statistics(rests, window)
    shards = max(1, -(-n // shard_docs))
    weights = np.log1p((n - df + 0.5) / (df + 0.5))
    idf = spark.sparkContext.broadcast(weights)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, row = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for i, data in enumerate(r["windows"]):
                    rows.append((r["doc_id"], i * window, window, _crc(data), r["doc_tokens"], base + row, 0, data))
                    row += 1
            yield _pieces(rows)

    def of_shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["missing", "doc_id", "uid"])
        parts = [np.frombuffer(x, "<u2") for x in pdf["rest"]]
        index = Index(parts, idf.value, mean)
        ids, missing, total = pdf["doc_id"].tolist(), pdf["missing"].tolist(), pdf["doc_tokens"].tolist()
        rows = []
        for doc, begin, length, sequence, offset in fill(parts, index, window):
            data = parts[doc][begin:begin + length].tobytes()
            rows.append((None if missing[doc] else ids[doc], total[doc] - len(parts[doc]) + begin, length,
                         _crc(data), total[doc], (1 << 62) + (int(key[0]) << 31) + sequence, offset, data))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")], dtype=object)
        out["doc_id"] = pd.array(out["doc_id"], "Int64")
        return out

    windows = encoded.where(F.size("windows") > 0).select("doc_id", "doc_tokens", "windows")
    keyed = content_keys(rests, df, weights)
    placed = dealt(materialize(keyed, "keyed") if shards > 1 else keyed, shards)
    packed = placed.select(
        "shard", "uid", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("missing"),
        "doc_tokens", "rest").groupBy("shard").applyInPandas(of_shard, PIECES)
    return windows.mapInArrow(whole, PIECES).unionByName(packed)


def _crc(data: bytes) -> int:
    return zlib.crc32(np.frombuffer(data, "<u2").astype("<u4").tobytes())


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=[c.split()[0] for c in PIECES.split(", ")])
