"""Ordered work without a single-task sort.

Running totals, neighbours and ranks need an order over the whole table. Here the
order is cut into slices at fitted boundaries; windows run inside a slice, and a
small table of slice totals carries state from one slice to the next. One value or
one source with a third of all rows is spread over as many slices as its share.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

INF = float("inf")
ROWS_PER_SLICE = 2_000_000
MAX_SLICES = 4096
SAMPLE_PER_SLICE = 500


def slice_bounds(df: DataFrame, value: Column, rows_per_slice: int = ROWS_PER_SLICE,
                 extra=()) -> tuple[int, list, list[list]]:
    """Row count and boundaries that cut ``value`` into slices of about equal row count.

    A count decides how many slices are needed; one is the common case on small data.
    Otherwise a sample of a few hundred rows per slice places the boundaries, also for
    ``extra`` columns. Where they lie decides how even the slices are, never a result.
    Repeated boundaries mark a value that fills more than one slice.
    """
    columns = [value, *extra]
    named = df.select(*[c.alias(f"b{i}") for i, c in enumerate(columns)])
    rows = named.agg(F.count("b0")).first()[0]
    slices = min(MAX_SLICES, math.ceil(rows / rows_per_slice)) if rows else 1
    if slices == 1:
        return rows, [], [[] for _ in extra]
    share = min(1.0, SAMPLE_PER_SLICE * slices / rows)
    picked = named.where("b0 is not null").sample(share, seed=42) if share < 1 else named
    # Literal text, as thousands of single literal columns are slow to build.
    steps = ", ".join(f"{i / slices!r}D" for i in range(1, slices))
    accuracy = max(10_000, 20 * slices)
    found = picked.agg(*[F.expr(f"percentile_approx(b{i}, array({steps}), {accuracy})").alias(f"b{i}")
                         for i in range(len(columns))]).first()
    bounds = [list(found[f"b{i}"] or []) for i in range(len(columns))]
    return rows, bounds[0], bounds[1:]


def with_slice(df: DataFrame, source: str, bounds, out: str) -> DataFrame:
    """Add the slice number of a numeric column (binary search in the JVM); NULL is slice 0."""
    cuts = sorted(set(float(b) for b in bounds))
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splitter = Bucketizer(splits=[-INF, *cuts, INF], inputCol=source, outputCol=out, handleInvalid="keep")
    typed = df.withColumn(source, F.col(source).cast("double"))
    return splitter.transform(typed).withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(0)))


def running_sums(df: DataFrame, order: str, sums: dict[str, Column], descending: bool = False,
                 rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per distinct value of ``order`` with its own and its running sums.

    ``sums`` maps names to summands. Output: order, name, cum_name for each. Equal
    values collapse before the shuffle, so a hot value is one row when it arrives.
    """
    raw = df.select(F.col(order).cast("double").alias(order),
                    *[c.alias(n) for n, c in sums.items()]).where(F.col(order).isNotNull())
    _, bounds, _ = slice_bounds(raw, F.col(order), rows_per_slice)
    raw = with_slice(raw, order, bounds, "_slice")
    direction = F.desc if descending else F.asc
    totals = [F.sum(n).alias(n) for n in sums]
    table = raw.groupBy("_slice", order).agg(*totals)
    inside = (Window.partitionBy("_slice").orderBy(direction(order))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    table = table.select("*", *[F.sum(n).over(inside).alias(f"cum_{n}") for n in sums])
    if bounds:
        # At most MAX_SLICES rows, so one task can order them and every task can hold them.
        before = (Window.partitionBy(F.lit(0)).orderBy(direction("_slice"))
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = (raw.groupBy("_slice").agg(*totals)
                   .select("_slice", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"off_{n}")
                                       for n in sums]))
        table = table.join(F.broadcast(offsets), "_slice")
        table = table.select(order, *sums, *[(F.col(f"cum_{n}") + F.col(f"off_{n}")).alias(f"cum_{n}")
                                             for n in sums])
    return table.select(order, *sums, *[f"cum_{n}" for n in sums])
