"""Token counts by a map-side lookup in two tiers.

The first tier is a compact table of frequent pre-tokens and their token counts, counted on a bounded sample
and broadcast. What it misses goes through the worker's own bounded cache to the tokenizer. The corpus'
pre-tokens are never shuffled; both tiers only save time, the counts are the tokenizer's own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import tokens
from flowlens.llm.common import sampled, text_of

#: Documents sampled for the frequent table, and the entries it may hold (bounds the broadcast to a few MB).
SAMPLE_DOCS = 2_000
TABLE_PARTS = 32_768

_CACHES: dict = {}


def frequent_parts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = TABLE_PARTS) -> list[str]:
    """The most frequent pre-tokens of a bounded sample; only the sample's own counts are moved."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(p for p in tokens.word_parts(t) if len(p) <= tokens.CACHE_LENGTH)
        top = seen.most_common(size)
        yield pa.RecordBatch.from_pydict({"part": pa.array([p for p, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    part = sampled(docs.select(text_of().alias("text")), sample_docs).mapInArrow(count, "part string, n long")
    rows = part.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(size).collect()
    return [r["part"] for r in rows]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, sample_docs: int = SAMPLE_DOCS,
                 size: int = TABLE_PARTS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    ``tokenizer`` is a file for the tokenizers library whose pre-tokens end at white space. A NULL or empty
    text has no bytes and no tokens; repeated rows each give a row; other columns are left out.
    """
    spark = docs.sparkSession
    tok, parts = tokens.load(tokenizer), frequent_parts(docs, sample_docs, size)
    lengths = [len(e.ids) for e in tok.encode_batch(parts, add_special_tokens=False)] if parts else []
    table = spark.sparkContext.broadcast(dict(zip(parts, lengths, strict=True)))

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, table.id if hasattr(table, "id") else id(table))
        if key not in _CACHES:
            own = tokens.load(tokenizer)
            encode = lambda new: [len(e.ids) for e in own.encode_batch_fast(new, add_special_tokens=False)]
            _CACHES.clear()
            _CACHES[key] = tokens.PartCache(encode, table.value)
        cache = _CACHES[key]
        for b in batches:
            n = [sum(cache.values(tokens.word_parts(t))) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    texts = docs.select(F.col("doc_id").cast("long"), F.octet_length(text_of()).cast("long").alias("n_bytes"),
                        text_of().alias("text"))
    return texts.mapInArrow(lookup, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
