"""Column expressions for matches of a pattern and their places, in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches (or one group of them), in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def places(text: Column, pattern: str) -> Column:
    """Start and end of each match: what lies between matches tells where they stand.

    Texts without a match are told by one search.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches(text, pattern).alias("hit"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return F.when(x["hit"].isNull(), acc).otherwise(F.struct(
            end.alias("at"),
            F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out")))

    empty = F.array().cast(SPAN)
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(empty)
