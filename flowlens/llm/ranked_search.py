"""Ranked lexical search by pipelined term partitioning.

Documents are read once, in slices; a slice's postings are split by term owner. Owners hold ranges of terms from the
rarest to the most frequent. Bundles of items visit the owners one after the other: in each stage the accumulators of a
slice meet the owner's postings of that slice by a cogroup, integer contributions are added, and the bundle moves on.
No owner holds a term's whole postings in one place, as every slice is a group of its own.

Between stages the tenth best sum so far of each item bounds the result from below. A document that cannot reach
it with all that later owners may add is dropped, and once no new document can, owners only add to those that are left.
That loses none of the highest-scoring documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, scratch_path, text_of

#: Postings that the owners before each cut hold, as shares of all.
OWNER_CUTS = (1 / 32, 1 / 8, 3 / 8)
#: Bytes of text and documents of a slice; pairs of item and term in a block of items.
SLICE_BYTES, SLICE_DOCS, BLOCK_TERMS = 4 << 20, 4_096, 200_000

_ASCII = [c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256)]
TERM_BYTES = bytes(_ASCII)

SLICES = "slice long, docs long, length long, ids binary, missing binary, sizes binary, term binary, doc binary, tf binary"
POSTINGS = "owner int, slice long, ids binary, missing binary, term binary, doc binary, value binary"
SUMS = "slice long, item binary, doc binary, sum binary"


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of other characters than ASCII, with A-Z lower-cased, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split()


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], "i8")


def _binary(*arrays) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


def slices(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Packed term frequencies of slices of documents, for the terms of ``vocabulary`` (term to place)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def pack(number: int, texts: list[list[bytes]], ids: list, known) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], "i8")
        found = np.array([known(w, -1) for t in texts for w in t], "i8")
        keys = (found * len(texts) + np.repeat(np.arange(len(texts)), sizes))[found >= 0]
        keys, tf = np.unique(keys, return_counts=True)
        numbers = [pa.array([x], pa.int64()) for x in (number, int((sizes > 0).sum()), int(sizes.sum()))]
        packed = _binary(np.array([d or 0 for d in ids], "i8"), np.array([d is None for d in ids], "u1"), sizes,
                         (keys // len(texts)).astype("i4"), (keys % len(texts)).astype("i4"), tf.astype("i4"))
        return pa.RecordBatch.from_arrays(numbers + packed, names=[c.split()[0] for c in SLICES.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value.get, TaskContext.get().partitionId() << 33
        texts, ids, size = [], [], 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                if ids and (size + len(t) > SLICE_BYTES or len(ids) == SLICE_DOCS):
                    yield pack(number, texts, ids, known)
                    number, texts, ids, size = number + 1, [], [], 0
                texts.append(terms_of(t))
                ids.append(d)
                size += len(t)
        if ids:
            yield pack(number, texts, ids, known)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(cut, SLICES)


def document_frequencies(cut: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary; each task sends one row for each term at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, "i8")
        for b in batches:
            for data in b.column(0).to_pylist():
                df += np.bincount(np.frombuffer(data, "i4"), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int64()), "n": pa.array(df[held], pa.int64())})

    df = np.zeros(size, "i8")
    for r in cut.select("term").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    return df


def owned_postings(cut: DataFrame, df: np.ndarray, n: int, total: int, owner: np.ndarray, owners: int) -> DataFrame:
    """The contribution of every posting, in one row for each slice and owner, in a table parted by owner."""
    w = weights(df, n)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                term, doc, tf = (np.frombuffer(r[c], "i4") for c in ("term", "doc", "tf"))
                m = 10 + (90 * np.frombuffer(r["sizes"], "i8") * n) // total
                value = w[term] * ((1_000_000_000 * tf.astype("i8")) // (1000 * tf.astype("i8") + 8 * m[doc]))
                for o in range(owners):
                    at = owner[term] == o
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o], pa.int32()), pa.array([r["slice"]], pa.int64()), *(pa.array([r[c]], pa.binary()) for c in ("ids", "missing")),
                         *_binary(term[at], doc[at], value[at])], names=[c.split()[0] for c in POSTINGS.split(", ")])

    path = scratch_path(cut.sparkSession, "postings")
    cut.mapInArrow(split, POSTINGS).write.partitionBy("owner").parquet(path)
    return cut.sparkSession.read.schema(POSTINGS).parquet(path)


def _top(sums: np.ndarray, k: int) -> int:
    """The k-th largest sum, 0 if there are fewer."""
    return int(np.partition(sums, len(sums) - k)[len(sums) - k]) if len(sums) >= k else 0


def least_sums(sums: DataFrame, items: int, k: int) -> np.ndarray:
    """The k-th largest sum of each item over all slices; a task sends k rows an item at most."""
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for b in batches:
            for r in b.to_pylist():
                item, found = np.frombuffer(r["item"], "i4"), np.frombuffer(r["sum"], "i8")
                edges = np.searchsorted(item, np.arange(items + 1))
                for i in np.unique(item).tolist():
                    both = np.concatenate([kept.get(i, found[:0]), found[edges[i]:edges[i + 1]]])
                    kept[i] = np.partition(both, len(both) - k)[-k:] if len(both) > k else both
        if kept:
            yield pa.RecordBatch.from_pydict({"item": pa.array(np.repeat(list(kept), [len(x) for x in kept.values()]), pa.int32()),
                                              "sum": pa.array(np.concatenate(list(kept.values())), pa.int64())})

    order = Window.partitionBy("item").orderBy(F.desc("sum"))
    found = (sums.select("item", "sum").mapInArrow(best, "item int, sum long").withColumn("r", F.row_number().over(order))
             .where(F.col("r") == k).select("item", "sum").collect())  # one row an item of the block at most
    out = np.zeros(items, "i8")
    for r in found:
        out[r["item"]] = r["sum"]
    return out


def stage(sums: DataFrame, postings: DataFrame, terms: list[np.ndarray], first: bool, reach: np.ndarray, later: np.ndarray,
          least: np.ndarray, k: int, last: bool) -> DataFrame:
    """The accumulators of all slices after one more owner.

    ``terms``: the owner's terms of each item; ``reach`` and ``later``: the most that this owner and those after it, or
    only those after it, can add; ``least``: lower bounds of the k-th best sums. The last stage gives doc_id, missing,
    item and sum of each slice's k best instead.
    """
    def visit(bundle: pa.Table, owned: pa.Table) -> pa.Table:
        edges, held = np.zeros(len(terms) + 1, "i8"), (np.zeros(0, "i4"), np.zeros(0, "i8"))
        for r in bundle.to_pylist():
            item = np.frombuffer(r["item"], "i4")
            edges, held = np.searchsorted(item, np.arange(len(terms) + 1)), (np.frombuffer(r["doc"], "i4"), np.frombuffer(r["sum"], "i8"))
        own = owned.to_pylist()[0]  # every slice has one row for each owner
        term, doc, value = np.frombuffer(own["term"], "i4"), np.frombuffer(own["doc"], "i4"), np.frombuffer(own["value"], "i8")
        ids, missing = np.frombuffer(own["ids"], "i8"), np.frombuffer(own["missing"], "u1")
        out: list[tuple] = []
        for i, wanted in enumerate(terms):
            span = slice(edges[i], edges[i + 1])
            docs, sums_ = held[0][span], held[1][span]
            enter = first or reach[i] >= least[i]
            if len(wanted) and (enter or len(docs)):
                full = np.zeros(len(ids), "i8")
                full[docs] = sums_
                lows, highs = np.searchsorted(term, wanted), np.searchsorted(term, wanted, "right")
                for a, b in zip(lows.tolist(), highs.tolist(), strict=True):
                    full[doc[a:b]] += value[a:b]  # a term meets a document once
                docs = np.flatnonzero(full) if enter else docs
                sums_ = full[docs]
            bound = max(int(least[i]), _top(sums_, k)) - int(later[i])
            near = (sums_ >= bound) & (sums_ > 0)
            docs, sums_ = docs[near], sums_[near]
            if last and len(docs) > k:
                best = np.lexsort((ids[docs], missing[docs], -sums_))[:k]
                docs, sums_ = docs[best], sums_[best]
            if len(docs):
                out.append((np.full(len(docs), i, "i4"), docs.astype("i4"), sums_))
        if not out:
            return kind.empty_table()
        item, docs, sums_ = (np.concatenate(x) for x in zip(*out, strict=True))
        if last:
            return pa.Table.from_arrays([pa.array(item), pa.array(ids[docs]), pa.array(missing[docs] > 0), pa.array(sums_)], schema=kind)
        return pa.Table.from_arrays([pa.array([own["slice"]], pa.int64()), *_binary(item, docs, sums_)], schema=kind)

    named = [("item", pa.int32()), ("doc_id", pa.int64()), ("missing", pa.bool_()), ("score", pa.int64())] if last else \
        [("slice", pa.int64()), ("item", pa.binary()), ("doc", pa.binary()), ("sum", pa.binary())]
    kind = pa.schema(named)
    out = "item int, doc_id long, missing boolean, score long" if last else SUMS
    return sums.groupBy("slice").cogroup(postings.groupBy("slice")).applyInArrow(visit, out)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and term of every item, once each; rows with one item_id are one item."""
    low = F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(found).alias("term")).distinct()


def _ranked_block(docs: DataFrame, pairs: list[tuple], k: int) -> DataFrame:
    """The k best documents of a block of items, given as pairs of item_id and term."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for _, t in pairs}))}
    names = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
    place = {i: p for p, i in enumerate(names)}
    of_item: list[list[int]] = [[] for _ in names]
    for i, t in pairs:
        of_item[place[i]].append(vocabulary[t.encode()])

    cut = materialize(slices(docs, vocabulary), "slices")
    n, total = (x or 0 for x in cut.agg(F.sum("docs"), F.sum("length")).first())
    if not n:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    df = document_frequencies(cut, len(vocabulary))
    order = np.argsort(df, kind="stable")
    done, sofar = np.zeros(len(df)), np.cumsum(df[order]) / max(1, df.sum())
    done[order] = np.concatenate([[0.0], sofar[:-1]])
    owner, owners = np.searchsorted(OWNER_CUTS, done, "right"), len(OWNER_CUTS) + 1
    postings = owned_postings(cut, df, n, total, owner, owners)
    # A contribution is below the weight times the most that a tf can give.
    most = weights(df, n) * 1_000_000
    sums, least = spark.createDataFrame([], SUMS), np.zeros(len(names), "i8")
    for o in range(owners):
        terms = [np.array([t for t in x if owner[t] == o], "i8") for x in of_item]
        reach = np.array([sum(int(most[t]) for t in x if owner[t] >= o) for x in of_item], "i8")
        later = np.array([sum(int(most[t]) for t in x if owner[t] > o) for x in of_item], "i8")
        last = o == owners - 1
        sums = materialize(stage(sums, postings.where(F.col("owner") == o).drop("owner"), terms, o == 0, reach, later, least, k, last), "sums")
        if not last:
            least = np.maximum(least, least_sums(sums, len(names), k))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "missing", "doc_id")
    known = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return (sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(F.broadcast(known), "item").select("item_id", "rank", F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "score"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` highest-scoring documents of each item, those above 0.

    Items are taken in blocks of about ``block_terms`` terms, so what is broadcast and carried stays bounded for any
    number of them; each block meets all documents. Equal scores are ranked by doc_id, a row without one after the
    others. NULL and empty texts have no terms; items without terms and empty tables give no rows; repeated rows are
    documents of their own; rows of one item_id are one item; other columns are left out.
    """
    pairs = materialize(item_terms(items), "item-terms")
    blocks = max(1, -(-pairs.count() // block_terms))
    out = None
    for b in range(blocks):
        block = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found = _ranked_block(docs, [(r["item_id"], r["term"]) for r in block.collect()], k)
        out = found if out is None else out.unionByName(found)
    return out
