"""Shared helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.sources.storage import materialize, scratch_path

__all__ = ["crc_fold", "free_names", "materialize", "plain_names", "sampled", "scratch_path", "small_enough", "table", "text_of"]

#: Rows up to which a side of a join may be broadcast.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, or an empty one for NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many more underscores in front as keep it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def plain_names(df: DataFrame, *kept: str) -> DataFrame:
    """``df`` with its columns named in_0, in_1, …, but for those in ``kept``: none clashes with an operator's own."""
    return df.toDF(*[c if c in kept else f"in_{i}" for i, c in enumerate(df.columns)])


def crc_fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 3


def sampled(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of their values; all rows if there are no more.

    For estimates that never decide a result.
    """
    n = df.count()
    if n <= rows:
        return df
    share = int(rows / n * 2**31)
    return df.where(F.pmod(F.xxhash64(*df.columns), F.lit(2**31)) < share)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``rows`` narrow rows; otherwise left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
