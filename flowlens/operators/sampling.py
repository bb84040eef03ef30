"""Reproducible samples and splits.

Rows are ordered by a hash of their key. A sample or split of an exact size takes the rows up to a rank in
that order, per stratum. Counts of hash prefixes tell in which prefix a wanted rank lies; rows of other
prefixes are told by a filter, and only the few rows of that prefix are ranked one by one. Strata and their
cuts stay in tables that are joined, so their number does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hex digits of a prefix: 65,536 prefixes for each stratum.
DIGITS = 4
NONE, ALL = "", "g"  # sort before and after every hex digest
#: Rows up to which a table moves to its cuts, in the order of rows that this gives; beyond, the cuts of few strata are broadcast.
MOVED_ROWS = 200_000


def key_hash(key: str = "flow_id", seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def strata(df: DataFrame, label: str | None) -> DataFrame:
    """(_l, n): rows per stratum; one stratum without a label."""
    return df.groupBy(_stratum(df, label).alias("_l")).agg(F.count(F.lit(1)).alias("n"))


def _stratum(df: DataFrame, label: str | None) -> Column:
    return F.col(label) if label else F.lit(0)


def hash_prefix(key: str = "flow_id", seed: int = 42) -> Column:
    """The first digits of a row's hash; rows without a key come first."""
    return F.coalesce(F.substring(key_hash(key, seed), 1, DIGITS), F.lit(NONE))


def rank_cuts(df: DataFrame, key: str, label: str | None, sizes: DataFrame, seed: int) -> DataFrame:
    """(_l, _k, _p, _before): for each size of a stratum the prefix that holds the row of that rank, and the rows before it.

    ``sizes`` has _l, n and _sizes. The prefix is NONE for no rows, ALL for all rows of a stratum.
    """
    upto = Window.partitionBy("_l").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (df.groupBy(_stratum(df, label).alias("_l"), hash_prefix(key, seed).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_upto", F.sum("_c").over(upto)))
    wanted = sizes.select("_l", "n", F.explode("_sizes").alias("_k"))
    within = wanted.where("_k > 0 AND _k < n").alias("w").join(
        counts.alias("c"), F.expr("w._l <=> c._l AND w._k <= c._upto AND w._k > c._upto - c._c"))
    return within.select(F.col("w._l").alias("_l"), "_k", "_p", (F.col("_upto") - F.col("_c")).alias("_before")).unionByName(
        wanted.where("_k <= 0 OR _k >= n").select(
            "_l", "_k", F.when(F.col("_k") <= 0, NONE).otherwise(ALL).alias("_p"), F.lit(0).cast("long").alias("_before")))


def place_by_rank(df: DataFrame, key: str, label: str | None, sizes: DataFrame, seed: int, out: str,
                  few_strata: bool = False) -> DataFrame:
    """Add ``out``: how many of the stratum's sizes lie below the row's rank.

    ``sizes`` has _l, n and _sizes, a rising array. Equal hashes are told apart by the other columns, and
    equal rows by chance, so the places are exact also where keys repeat. Rows of strata without sizes go.
    ``few_strata`` says that the strata are few by their kind, such as the two of a 0/1 label, as without a label: the
    cuts of a large table are then broadcast, else all rows would move to one task for each stratum.
    """
    few = (few_strata or label is None) and df.count() > MOVED_ROWS
    small = F.broadcast if few else (lambda table: table)
    stratum, h, prefix = _stratum(df, label), key_hash(key, seed), hash_prefix(key, seed)
    cuts = rank_cuts(df, key, label, sizes, seed)
    cuts = cuts.groupBy(F.col("_l").alias("_cl")).agg(F.array_sort(F.collect_list(F.struct("_k", "_p", "_before"))).alias("_cuts"))
    rows = (df.withColumns({"_sl": stratum, "_h": h, "_hp": prefix})
            .join(small(cuts), F.col("_sl").eqNullSafe(F.col("_cl"))))
    at_cut = F.exists("_cuts", lambda c: (c["_p"] == F.col("_hp")) & (c["_k"] > 0))
    apart = rows.where(~at_cut).withColumn(out, F.size(F.filter("_cuts", lambda c: (c["_p"] < F.col("_hp")) | (c["_k"] <= 0))))
    order = Window.partitionBy("_sl", "_hp").orderBy("_h", F.xxhash64(*df.columns))
    rank = F.filter("_cuts", lambda c: c["_p"] == F.col("_hp"))[0]["_before"] + F.row_number().over(order)
    ranked = rows.where(at_cut).withColumn("_rank", rank).withColumn(
        out, F.size(F.filter("_cuts", lambda c: c["_k"] < F.col("_rank"))))
    return apart.select(*df.columns, out).unionByName(ranked.select(*df.columns, out))


def take_per_stratum(df: DataFrame, key: str, label: str | None, sizes: DataFrame, seed: int) -> DataFrame:
    """The first rows of every stratum in hash order; ``sizes`` has _l, n and k."""
    wanted = sizes.select("_l", "n", F.array(F.col("k").cast("long")).alias("_sizes"))
    return place_by_rank(df, key, label, wanted, seed, "_place").where("_place = 0").drop("_place")


def split(df: DataFrame, key: str = "flow_id", label: str | None = None, test: float = 0.2, val: float = 0.0,
          seed: int = 42, exact: bool = True, few_strata: bool = False) -> DataFrame:
    """Add ``split``: 'test', then 'val' as a fraction of the rest, else 'train'.

    Exact sizes per stratum, or with ``exact=False`` by hash value alone (no fitting job). ``few_strata`` as in
    ``place_by_rank``.
    """
    if not exact:
        place = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))
        return df.withColumn("split", F.when(place < test, "test")
                             .when(place < test + (1 - test) * val, "val").otherwise("train"))
    share = lambda n, f: F.floor(n * F.lit(f) + 0.5).cast("long")
    sizes = strata(df, label).withColumn("_first", share(F.col("n"), test))
    second = F.col("_first") + share(F.col("n") - F.col("_first"), val)
    sizes = sizes.select("_l", "n", F.array("_first", second).alias("_sizes"))
    placed = place_by_rank(df, key, label, sizes, seed, "_place", few_strata)
    name = F.when(F.col("_place") == 0, "test").when(F.col("_place") == 1, "val").otherwise("train")
    return placed.withColumn("split", name).drop("_place")


def sample_n(df: DataFrame, key: str = "flow_id", n: int = 100_000, seed: int = 42) -> DataFrame:
    """A uniform sample of n rows (all rows if there are fewer)."""
    return take_per_stratum(df, key, None, strata(df, None).withColumn("k", F.lit(n)), seed)


def quotas(counts: DataFrame, n: int) -> DataFrame:
    """Adds k: shares of n proportional to the counts; leftovers go to the largest remainders."""
    every = Window.partitionBy(F.lit(0))  # one row for each stratum
    exact = F.lit(n) * F.col("n") / F.sum("n").over(every)
    table = counts.withColumn("_exact", exact).withColumn("_down", F.floor("_exact"))
    turn = F.row_number().over(every.orderBy(F.col("_down") - F.col("_exact"), F.col("_l").cast("string")))
    extra = (turn <= F.lit(n) - F.sum("_down").over(every)).cast("long")
    k = F.when(F.sum("n").over(every) <= n, F.col("n")).otherwise(F.col("_down") + extra)
    return table.select("_l", "n", k.alias("k"))


def stratified_sample(df: DataFrame, label: str = "label_binary", n: int = 50_000, key: str = "flow_id",
                      seed: int = 42) -> DataFrame:
    """Exactly n rows with the class shares of the table."""
    return take_per_stratum(df, key, label, quotas(strata(df, label), n), seed)


def capped_sample(df: DataFrame, label: str = "label_binary", cap: int = 50_000, key: str = "flow_id",
                  seed: int = 42) -> DataFrame:
    """All rows up to the cap, else class-proportional with a top-up, normal rows first."""
    total, normal, anomaly = df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    if total <= cap:
        return df
    both = normal + anomaly
    sizes = {0: min(int(cap * (normal / both)), normal), 1: min(int(cap * (anomaly / both)), anomaly)}
    for l, n in ((0, normal), (1, anomaly)):
        sizes[l] += min(max(cap - sum(sizes.values()), 0), n - sizes[l])
    k = F.when(F.col("_l") == 0, sizes[0]).when(F.col("_l") == 1, sizes[1])
    return take_per_stratum(df, key, label, strata(df, label).withColumn("k", k).where("k IS NOT NULL"), seed)
