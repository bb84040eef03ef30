"""Benchmark decontamination: short test items inside long documents.

Items are partitioned by the size of their shingle sets. In a partition every item is indexed by its smallest
shingle hashes, one more than an item of that size may miss: a document that contains enough of an item holds
at least one of them, so the search loses nothing, however long the document. Candidates are then verified by
exact containment of the shingles themselves. An item of fewer words than a shingle is one shingle of its own length,
and documents are cut into shingles of all lengths that occur. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import free_names, materialize, small_enough, text_of

SHINGLE = 5
#: Least containment, in percent.
CONTAINMENT = 80
#: Rows of the item index up to which it is broadcast (24 bytes each); a larger one is joined by a shuffle.
INDEX_ROWS = 500_000


def word_list(text: Column) -> Column:
    """Words of letters and digits in lower case; punctuation and case do not hide a copy."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, n: int = SHINGLE) -> Column:
    """Distinct runs of ``n`` words; fewer words are one shingle, none give none."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def shingle_lengths(index: DataFrame) -> list[int]:
    """Numbers of words in the shingles of the items: ``SHINGLE`` at most, and those of shorter items."""
    return sorted(r.run for r in index.select("run").distinct().collect())


def document_shingles(words: Column, lengths: list[int]) -> Column:
    """Distinct runs of each of the ``lengths``; a text of fewer words has no run of that length."""
    runs = [F.when(F.size(words) >= n, shingles(words, n)).otherwise(F.array().cast("array<string>")) for n in lengths]
    return F.concat(*runs) if runs else F.array().cast("array<string>")


def _with_words(docs: DataFrame) -> DataFrame:
    return docs.withColumn("words", word_list(text_of()))


def index_items(items: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """(item_id, item, n, run, shingle, hash, indexed) of every shingle.

    ``item`` tells texts of one id apart, ``run`` is the number of words in a shingle of the item.
    """
    sets = (_with_words(items.select("item_id", text_of().alias("text")).distinct())
            .select("item_id", F.xxhash64("text").alias("item"), F.least(F.size("words"), F.lit(SHINGLE)).alias("run"),
                    shingles(F.col("words")).alias("s"))
            .where(F.size("s") > 0)
            .select("item_id", "item", F.size("s").alias("n"), "run", F.explode("s").alias("shingle")))
    # Sizes from a power of two up to the next are one partition; its largest size sets what may be missing.
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("long") - 1
    depth = F.floor(largest * (100 - containment) / 100) + 1
    smallest = Window.partitionBy("item_id", "item").orderBy("hash", "shingle")
    return (sets.withColumn("hash", F.xxhash64("shingle"))
            .withColumn("indexed", F.row_number().over(smallest) <= depth))


def search(docs: DataFrame, index: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, h, item_id, item): pairs that share an indexed shingle; ``h`` is the hash of the text."""
    hashes = (_with_words(docs.select("doc_id", text_of().alias("text")))
              .select("doc_id", F.xxhash64("text").alias("h"),
                      F.explode(F.transform(document_shingles(F.col("words"), lengths), lambda s: F.xxhash64(s))).alias("hash")))
    keys = index.where("indexed").select("hash", "item_id", "item")
    return hashes.join(small_enough(keys, INDEX_ROWS), "hash").select("doc_id", "h", "item_id", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, containment: int = CONTAINMENT) -> DataFrame:
    """(doc_id, h, item_id, n_item, n_found): documents that hold at least ``containment`` % of an item's shingles.

    ``h`` is the hash of the document's text. Items and texts without words are never found; an item of fewer
    words than a shingle is found wherever its words follow each other. Repeated rows give one row; where one item
    id has several texts, the text contained best counts. Other columns, of any name, are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    index = materialize(index_items(items, containment), "items")
    lengths = shingle_lengths(index)
    pairs = materialize(search(docs, index, lengths), "candidates")
    texts = (docs.withColumn("h", F.xxhash64("text")).alias("d")
             .join(small_enough(pairs.select("doc_id", "h").distinct()).alias("c"),
                   F.expr("d.doc_id <=> c.doc_id AND d.h = c.h"), "left_semi").distinct())
    held = (_with_words(texts).select("doc_id", "h", F.explode(document_shingles(F.col("words"), lengths)).alias("shingle"))
            .join(small_enough(index.select("shingle", "item_id", "item", "n")), "shingle")
            .groupBy("doc_id", "h", "item_id", "item", "n").agg(F.count("*").alias("n_found")))
    best = F.max(F.struct((F.col("n_found") / F.col("n")).alias("share"), "n", "n_found")).alias("b")
    return (held.alias("f").join(pairs.alias("p"), F.expr(
                "f.doc_id <=> p.doc_id AND f.h = p.h AND f.item_id <=> p.item_id AND f.item = p.item"), "left_semi")
            .where(F.col("n_found") * 100 >= F.col("n") * containment)
            .groupBy("doc_id", "h", "item_id").agg(best)
            .select("doc_id", "h", "item_id", F.col("b.n").cast("long").alias("n_item"), F.col("b.n_found")))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_found and containment of every contaminated pair."""
    return (contamination(docs, items).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct((F.col("n_found") / F.col("n_item")).alias("containment"), "n_item", "n_found")).alias("b"))
            .select("doc_id", "item_id", "b.n_item", "b.n_found", "b.containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item; extra columns may have any name."""
    key, text = free_names(docs, "_id", "_h")
    leaks = small_enough(materialize(contamination(docs, items).select("doc_id", "h").distinct(), "leaks"))
    leaks = leaks.select(F.col("doc_id").alias(key), F.col("h").alias(text))
    found = (F.xxhash64(text_of()) == F.col(text)) & F.col("doc_id").cast("long").eqNullSafe(F.col(key))
    return docs.join(leaks, found, "left_anti")
