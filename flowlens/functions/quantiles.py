"""Exact quantiles in two passes, whatever the number of rows or groups.

An approximate summary per group brackets each wanted order statistic; its error is bounded, so the bracket
surely holds the rank. A counting pass then keeps one row for each value inside a bracket and mere counts
outside. A bracket is cut into ``PIECES`` pieces; running counts over pieces find those that hold a wanted rank,
and only the values of such a piece are put in order. Brackets stay in a table that is joined by group; nothing
reaches the driver, and neither a group nor a bracket is gathered whole.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.sources.storage import materialize

#: An approximate rank is off by at most the group's rows divided by this.
ACCURACY = 10_000
#: Groups of so few rows are one bracket: their ranks lie too close for approximate ones.
WHOLE_ROWS = 100_000
#: Pieces of a bracket, evenly spaced on a logarithmic scale.
PIECES = 1024
#: Numbers of all columns that a task of ``column_quantiles`` puts in order at once, and the values it tells of each column.
CHUNK_VALUES = 4_000_000
POINTS = 1024


def melt(df: DataFrame, columns, keep=()) -> DataFrame:
    """Long form (keep..., feature, value): features become rows of one job."""
    names = list(columns)
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in names])
    return typed.unpivot(typed.columns[:len(keep)], names, "feature", "value")


def _same(keys: list[str], left: str, right: str) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return test


def _spread(value: Column) -> Column:
    """A scale that rises with the value, finite also for endless ones."""
    return F.greatest(F.least(F.signum(value) * F.log1p(F.abs(value)), F.lit(710.0)), F.lit(-710.0))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], extra=(),
                    accuracy: int = ACCURACY, whole_rows: int = WHOLE_ROWS, few_groups: bool = False) -> DataFrame:
    """Linear-interpolation quantiles per group: keys..., n, q (array, one per prob), and ``extra`` aggregates.

    NULL and NaN do not count; q is NULL where nothing counts. Equal neighbours give their value, also infinite
    ones. ``few_groups`` says that the groups are few by their kind, such as one for each column of a table: what is
    known of them is then broadcast, and rows do not move to meet it. Without keys that is always so.
    """
    small = F.broadcast if few_groups or not keys else (lambda table: table)
    probs = [float(p) for p in probs]
    names = keys or ["_all"]
    v = F.col(value).cast("double")
    data = df.withColumn("_v", F.when(~F.isnan(v), v))
    if not keys:
        data = data.withColumn("_all", F.lit(0))

    # First pass. Twice the error on either side, in rising order, so that the brackets' ends rise as well.
    rising, margin = sorted(set(probs)), 2.0 / accuracy
    lows, highs = [max(p - margin, 0.0) for p in rising], [min(p + margin, 1.0) for p in rising]
    summary = F.percentile_approx("_v", F.array(*map(F.lit, [*lows, *highs])), accuracy)
    groups = data.groupBy(*names).agg(F.count("_v").alias("n"), summary.alias("_c"), F.min("_v").alias("_min"),
                                      F.max("_v").alias("_max"), *extra)
    # Where a group has fewer rows than the summary tells apart, a bracket would be narrower than a rank.
    few, least, most = F.col("n") <= max(whole_rows, 10 * accuracy), F.col("_min"), F.col("_max")
    low = F.array(*[least if p == 0 else F.col("_c")[i] for i, p in enumerate(lows)])
    high = F.array(*[most if p == 1 else F.col("_c")[len(rising) + i] for i, p in enumerate(highs)])
    at = F.array(*[F.lit(p) * (F.col("n") - 1) for p in probs])
    ranks = F.array_distinct(F.flatten(F.transform("_at", lambda a: F.array(F.floor(a), F.ceil(a)))))
    groups = (groups.withColumn("_los", F.when(few, F.array(least)).otherwise(low))
              .withColumn("_his", F.when(few, F.array(most)).otherwise(high))
              .withColumn("_at", at).withColumn("_ranks", ranks))
    # Kept, as a summary depends on the order in which tasks' parts meet: made twice, brackets and pieces would not fit.
    groups = materialize(groups, "brackets")

    # Second pass: one row for each value inside a bracket, one for each stretch between them.
    brackets = groups.select(*names, "_los", "_his", "_ranks")
    below = [F.coalesce((F.get("_his", F.lit(i)) < F.col("_v")).cast("int"), F.lit(0)) for i in range(len(rising))]
    # A plain sum is compiled, a lambda is not; many brackets would make it too long.
    slot = functools.reduce(operator.add, below) if len(below) <= 16 else F.expr("size(filter(_his, h -> h < _v))")
    rows = (data.select(*names, "_v").where("_v IS NOT NULL").alias("d")
            .join(small(brackets).alias("b"), _same(names, "d", "b"))
            .select(*[F.col(f"d.{k}") for k in names], "_v", "_los", "_his", slot.alias("_slot")))
    begin, end = _spread(F.try_element_at("_los", F.col("_slot") + 1)), _spread(F.try_element_at("_his", F.col("_slot") + 1))
    inside = F.coalesce(F.col("_v") >= F.try_element_at("_los", F.col("_slot") + 1), F.lit(False))
    piece = F.when(end > begin, F.least(F.floor((_spread(F.col("_v")) - begin) / (end - begin) * PIECES), F.lit(PIECES - 1))).otherwise(0)
    counts = (rows.groupBy(*names, "_slot", F.when(inside, piece).otherwise(-1).cast("int").alias("_piece"),
                           F.when(inside, F.col("_v")).alias("_value"))
              .agg(F.count(F.lit(1)).alias("_n")))

    # At most PIECES + 1 rows a bracket are put in order for a group, then the values of the pieces that are hit.
    upto = Window.partitionBy(*names).orderBy("_slot", "_piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = (counts.groupBy(*names, "_slot", "_piece").agg(F.sum("_n").alias("_n")).withColumn("_upto", F.sum("_n").over(upto)))
    hit = F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_n")))
    sought = (pieces.alias("e").join(small(groups.select(*names, "_ranks")).alias("g"), _same(names, "e", "g"))
              .select(*[F.col(f"e.{k}") for k in names], "_slot", "_piece", (F.col("_upto") - F.col("_n")).alias("_before"),
                      hit.alias("_ranks")).where(F.size("_ranks") > 0))
    order = Window.partitionBy(*names, "_slot", "_piece").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = (counts.alias("c").join(small(sought).alias("s"), _same([*names, "_slot", "_piece"], "c", "s"))
              .select(*[F.col(f"c.{k}") for k in (*names, "_slot", "_piece", "_value", "_n")], "_before", "_ranks")
              .withColumn("_upto", F.col("_before") + F.sum("_n").over(order)))
    found = within.select(*names, "_value", F.explode(hit).alias("_rank"))
    value_of = F.when(F.col("_value").isNull(), F.raise_error(F.lit("a quantile lies outside its bracket"))).otherwise(F.col("_value"))
    ranked = found.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_rank", value_of.alias("x")))).alias("_m"))

    def between(a: Column) -> Column:
        x, y = F.element_at("_m", F.floor(a)), F.element_at("_m", F.ceil(a))
        return F.when(x == y, x).otherwise(x + (y - x) * (a - F.floor(a)))

    added = [c for c in groups.columns if c not in (*names, "n", "_c", "_min", "_max", "_los", "_his", "_at", "_ranks")]
    return (groups.alias("g").join(small(ranked).alias("r"), _same(names, "g", "r"), "left")
            .select(*[F.col(f"g.{k}") for k in keys], "n", F.when(F.col("n") > 0, F.transform("_at", between)).alias("q"),
                    *added))


def exact_quantile(df: DataFrame, value: str, prob: float, **kw) -> float | None:
    """One quantile of one column as a Python number (a fitted threshold)."""
    row = exact_quantiles(df, [], value, [prob], **kw).first()
    return row["q"][0] if row and row["q"] else None


def column_quantiles(df: DataFrame, columns, probs: list[float], chunk_values: int = CHUNK_VALUES,
                     points: int = POINTS) -> dict[str, list[float] | None]:
    """Exact quantiles of a few columns of one table as Python numbers; NULL and NaN do not count.

    As ``exact_quantiles`` of the molten columns would give them, but columns stay side by side and are put in order as
    arrays. First pass: of each sorted chunk of rows every step-th value is told. Fewer than ``step`` values of a chunk lie
    between two of them, so the sums of steps bracket each rank for certain, whatever the values. Second pass: values
    inside a bracket are counted one by one, those below it as one number. A column without a value has None; a table
    without rows has no column.
    """
    names, probs = list(columns), [float(p) for p in probs]
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    width, chunk = len(names), max(1, chunk_values // max(1, len(names)))

    def tell(batches):
        held, filled = np.empty((width, chunk)), 0

        def told():
            kept, counts, steps = [np.zeros(1)], [filled], [1]  # the rows, as one more column
            for i in range(width):
                values = held[i, :filled]
                values.sort()  # NaN comes last
                n = filled - int(np.count_nonzero(np.isnan(values)))
                step = max(1, n // points)
                kept.append(values[:n][step - 1::step] + 0.0)  # -0.0 becomes 0.0
                counts.append(n)
                steps.append(step)
            ends = np.cumsum([0, *map(len, kept)])
            return pa.RecordBatch.from_arrays([
                pa.array([width, *range(width)], pa.int32()), pa.array(counts, pa.int64()), pa.array(steps, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept)))],
                names=["col", "n", "step", "points"])

        for batch in batches:
            arrays, at = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], 0
            while at < batch.num_rows:
                size = min(chunk - filled, batch.num_rows - at)
                for i, a in enumerate(arrays):
                    held[i, filled:filled + size] = a[at:at + size]
                at, filled = at + size, filled + size
                if filled == chunk:
                    yield told()
                    filled = 0
        if filled:
            yield told()

    first, whole = F.col("pos") == 0, Window.partitionBy("col")
    upto = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = (data.mapInArrow(tell, "col int, n long, step long, points array<double>")
            .select("col", "n", "step", F.posexplode("points").alias("pos", "v")).groupBy("col", "v")
            .agg(F.sum("step").alias("w"), F.sum(F.when(first, F.col("n"))).alias("n"), F.sum(F.when(first, F.col("step") - 1)).alias("slack"))
            .select("col", "v", "w", F.sum("w").over(upto).alias("upto"), F.sum("n").over(whole).alias("n"),
                    F.sum("slack").over(whole).alias("slack")))
    at = [F.lit(p) * (F.col("n") - 1) for p in probs]
    known = {r["col"]: r for r in told.groupBy("col").agg(
        F.max("n").alias("n"), F.max("slack").alias("slack"),
        F.array(*[F.max(F.when(F.col("upto") - F.col("w") + F.col("slack") <= F.floor(a), F.col("v"))) for a in at]).alias("los"),
        F.array(*[F.min(F.when(F.col("upto") > F.ceil(a), F.col("v"))) for a in at]).alias("his")).collect()}
    if width not in known:
        return {}

    # A place is a column and a prob; known without a second pass where the bracket's ends are the values sought.
    ends, sought = {}, []
    for i, j in ((i, j) for i in range(width) if i in known for j in range(len(probs))):
        r, a = known[i], probs[j] * (known[i]["n"] - 1)
        low = -math.inf if r["los"][j] is None else r["los"][j]
        high = math.inf if r["his"][j] is None else r["his"][j]
        if r["slack"] == 0 or low == high:
            ends[i, j] = [low, high]
        else:
            sought.append((i, j, low, high, math.floor(a), math.ceil(a)))
    if sought:
        used = sorted({s[0] for s in sought})
        found = data.select(*[f"c{i}" for i in used]).mapInArrow(
            _counter([(used.index(i), *rest) for i, _, *rest in sought]), "place int, low long, high long, v double, n long")
        order = Window.partitionBy("place").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = lambda r: (F.col(r) < F.col("upto")) & (F.col(r) >= F.col("upto") - F.col("n"))
        for r in (found.groupBy("place", "low", "high", "v").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(order))
                  .where(F.col("v").isNotNull()).select("place", "v", hit("low").alias("low"), hit("high").alias("high"))
                  .where("low OR high").collect()):
            pair = ends.setdefault(sought[r["place"]][:2], [None, None])
            pair[:] = [r["v"] if r["low"] else pair[0], r["v"] if r["high"] else pair[1]]

    def value(i: int, j: int) -> float:
        x, y = ends.get((i, j), (None, None))
        if x is None or y is None:
            raise ValueError("a quantile lies outside its bracket")
        a = probs[j] * (known[i]["n"] - 1)
        return x if x == y else x + (y - x) * (a - math.floor(a))

    return {c: [value(i, j) for j in range(len(probs))] if i in known else None for i, c in enumerate(names)}


def _counter(places: list[tuple]):
    """Counts of the values inside each bracket (column, low, high, ranks...), and of those below it, without a value."""
    def count(batches):
        def rows(place, values, numbers):
            lows, highs = (np.array([p[k] for p in places], np.int64)[place] for k in (3, 4))
            return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(lows), pa.array(highs), values,
                                               pa.array(numbers, pa.int64())], names=["place", "low", "high", "v", "n"])

        below = np.zeros(len(places), np.int64)
        for batch in batches:
            arrays, inside = [c.to_numpy(zero_copy_only=False) for c in batch.columns], []
            for k, (i, low, high, *_) in enumerate(places):
                v = arrays[i]
                below[k] += np.count_nonzero(v < low)
                inside.append(np.unique(v[(v >= low) & (v <= high)] + 0.0, return_counts=True))
            sizes = [len(v) for v, _ in inside]
            yield rows(np.repeat(np.arange(len(places)), sizes), pa.array(np.concatenate([v for v, _ in inside])),
                       np.concatenate([n for _, n in inside]))
        if below.any():
            yield rows(np.arange(len(places)), pa.nulls(len(places), pa.float64()), below)

    return count
