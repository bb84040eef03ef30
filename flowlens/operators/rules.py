"""Mining false positives into allow-list rules, and applying the rules.

A rule set is a table of any size. Flows meet the rules of their protocol, port and address by joins on
these keys, one row for each key, and check their conditions there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.functions.catalog import BEHAVIORAL_FEATURES, SERVICE_PORTS
from flowlens.functions.columns import ratio_or_zero, require
from flowlens.functions.quantiles import exact_quantile, exact_quantiles, melt
from flowlens.sources.stores import RULE_SCHEMA, rule_fields

MAX_RULES = 2_000
# What a behavioural bound needs to be found.
MIN_VALUES, MIN_FN_VALUES, MAX_CONDITIONS = 10, 5, 5
PROBS = [0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95]
FN_LIMIT = 0.10
#: Rules (a few hundred bytes each) that are a constant of the plan, and those that are sent to every task.
LITERAL_RULES, BROADCAST_RULES = 200, 50_000


def outcome(df: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """Add ``outcome``: tp, fp, fn or tn."""
    attack, flagged = F.col(y) == 1, F.col(p) == 1
    return df.withColumn("outcome", F.when(attack & flagged, "tp").when(attack, "fn")
                         .when(flagged, "fp").otherwise("tn"))


def backfill(df: DataFrame, clean_df: DataFrame, key: str = "flow_id",
             columns=("Proto", "DstAddr", "Dport", "SrcAddr")) -> DataFrame:
    """Fill missing flow columns (or cells) from the cleaned table by row key."""
    columns = [c for c in columns if c in clean_df.columns]
    other = clean_df.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = df.join(other, F.col(key) == F.col("_k"), "left")
    kept = [c for c in df.columns if c not in columns]
    return joined.select(*kept, *[
        F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in df.columns else F.col(f"_{c}").alias(c) for c in columns])


def combo_keys() -> tuple[Column, Column]:
    return F.lower("Proto").alias("proto"), F.col("Dport").cast("double").alias("port")


def fp_patterns(df: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """False positives by protocol (5), port (10) and protocol with port (10), with their share."""
    proto, port = combo_keys()
    rows = df.where((F.col(y) == 0) & (F.col(p) == 1)).select(proto, port)
    total = rows.count()
    counts = rows.groupBy("proto", "port").count()
    name = F.col("port").cast("string")
    levels = F.array(F.struct(F.lit("proto").alias("pattern"), F.col("proto").alias("value")),
                     F.struct(F.lit("port").alias("pattern"), name.alias("value")),
                     F.struct(F.lit("proto_port").alias("pattern"), F.concat("proto", F.lit("/"), name).alias("value")))
    table = (counts.select("count", F.explode(levels).alias("l")).select("count", "l.*")
             .where("value is not null").groupBy("pattern", "value").agg(F.sum("count").alias("n")))
    # Ranked per bucket first, so no task sees all distinct ports.
    first = Window.partitionBy("pattern", F.pmod(F.xxhash64("value"), F.lit(256))).orderBy(F.desc("n"), "value")
    last = Window.partitionBy("pattern").orderBy(F.desc("n"), "value")
    top = (table.withColumn("place", F.row_number().over(first)).where("place <= 10")
           .withColumn("place", F.row_number().over(last)))
    limit = F.when(F.col("pattern") == "proto", 5).otherwise(10)
    return (top.where(F.col("place") <= limit)
            .withColumn("share", ratio_or_zero(F.col("n"), F.lit(total))).select("pattern", "value", "n", "share"))


def combo_counts(df: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """False positives, normal flows, attacks and misses per protocol and port, missing keys included.

    The one pass over the flows that all shares are computed from. Protocols are lower-cased
    before grouping; the map side combines, so a hot combination is a few rows when it moves.
    """
    require(df, ["Proto", "Dport"])
    proto, port = combo_keys()
    rows = df.select(proto, port, (F.col(y) == 1).alias("a"), (F.col(p) == 1).alias("f"))
    return rows.groupBy("proto", "port").agg(
        F.count_if(~F.col("a") & F.col("f")).alias("fp"), F.count_if(~F.col("a")).alias("normal"),
        F.count_if("a").alias("attack"), F.count_if(F.col("a") & ~F.col("f")).alias("fn"))


def class_totals(counts: DataFrame) -> dict:
    """Rows per outcome group: four numbers."""
    row = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("fp", "normal", "attack", "fn")]).first()
    return row.asDict()


def combo_stats(df: DataFrame | None, y: str = "label_binary", p: str = "y_pred", keys=("proto", "port"),
                counts: DataFrame | None = None, totals: dict | None = None) -> DataFrame:
    """Share of all false positives, normal flows and attacks per protocol and port (or port).

    Only combinations with a false positive remain. ``counts`` and ``totals`` reuse a pass
    made before.
    """
    counts = combo_counts(df, y, p) if counts is None else counts
    totals = totals or class_totals(counts)
    for k in keys:
        counts = counts.where(F.col(k).isNotNull())
    names = ("fp", "normal", "attack")
    stats = counts.groupBy(*keys).agg(*[F.sum(n).alias(f"{n}_count") for n in names]).where("fp_count > 0")
    return stats.withColumns({f"{n}_ratio": ratio_or_zero(F.col(f"{n}_count"), F.lit(totals[n])) for n in names})


def combo_score(stats: DataFrame, min_samples: int = 50) -> DataFrame:
    """Importance of a combination; few samples lower it in proportion."""
    zero, one = F.lit(0.0), F.lit(1.0)
    score = (0.4 * F.least(F.col("fp_ratio") * 10, one) + 0.3 * F.least(F.col("normal_ratio") * 20, one)
             + 0.3 * F.greatest(zero, 1 - F.col("attack_ratio") * 10))
    few = F.when(F.col("fp_count") < min_samples, F.col("fp_count") / F.lit(float(min_samples))).otherwise(one)
    return stats.withColumn("score", score * few)


def candidates(stats: DataFrame, method: str = "threshold", fp_threshold: float = 0.05, top_n: int = 20,
               score_threshold: float = 0.3, normal_threshold: float = 0.01, min_samples: int = 50) -> DataFrame:
    """Combinations worth a rule: by false-positive share, by rank of score, or by score.

    All must be common in normal traffic, which bounds how many there can be.
    """
    scored = combo_score(stats, min_samples)
    if method == "threshold":
        chosen = scored.where(F.col("fp_ratio") > fp_threshold)
    elif method == "topn":
        chosen = scored.orderBy(F.desc("score"), "proto", "port").limit(top_n)
    elif method == "score":
        chosen = scored.where(F.col("score") > score_threshold)
    else:
        raise ValueError(f"unknown method: {method!r}")
    return chosen.where(F.col("normal_ratio") > normal_threshold)


def behavioral_columns(df: DataFrame, features=None) -> list[str]:
    """The behavioural features the table has, under their own or their log name."""
    found = [(f if f in df.columns else f"log_{f}") for f in (features or BEHAVIORAL_FEATURES)]
    return [c for c in found if c in df.columns]


def behavioral_bounds(df: DataFrame, combos: DataFrame, features=None, y: str = "label_binary",
                      p: str = "y_pred", limit: int = MAX_CONDITIONS, **kw) -> DataFrame:
    """Upper bounds that separate normal from attack flows, per combination and feature.

    One job over all combinations: features and classes become rows of a long table whose
    groups are summarised by exact quantiles. Output: proto, port, feature, place, bound.
    """
    columns = behavioral_columns(df, features)
    combos = combos.select(F.col("proto").cast("string").alias("proto"), F.col("port").cast("double").alias("port")).distinct()
    proto, port = combo_keys()
    attack, flagged = F.col(y) == 1, F.col(p) == 1
    groups = F.array_compact(F.array(F.when(~attack, "normal").otherwise("attack"),
                                     F.when(attack & ~flagged, "fn")))
    rows = df.select(proto, port, groups.alias("groups"), *columns).join(combos, ["proto", "port"])
    rows = rows.withColumn("grp", F.explode("groups")).drop("groups")
    long = melt(rows, columns, ["proto", "port", "grp"]).where("value is not null")
    keys = ["proto", "port", "feature"]
    found = exact_quantiles(long, [*keys, "grp"], "value", PROBS, **kw)
    wide = found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("grp") == g, F.struct("n", "q"))).alias(g) for g in ("normal", "attack", "fn")])
    at = {prob: i for i, prob in enumerate(PROBS)}

    def q(group, prob):
        return F.col(f"{group}.q")[at[prob]]

    enough = (F.col("normal.n") > MIN_VALUES) & (F.col("attack.n") > MIN_VALUES)
    apart = ((q("attack", 0.50) > q("normal", 0.75) * 1.2) | (q("attack", 0.25) > q("normal", 0.90))
             | (q("attack", 0.10) > q("normal", 0.95)))
    bound = F.when(q("attack", 0.05) > 0, F.least(q("normal", 0.95), q("attack", 0.05))).otherwise(q("normal", 0.95))
    wide = wide.where(enough & apart).withColumn("b", bound)
    # The smallest of the most frequent values, by counting.
    modes = (long.where("grp = 'normal'").groupBy(*keys, "value").count()
             .groupBy(*keys).agg(F.max(F.struct("count", (-F.col("value")).alias("v"))).alias("m"))
             .select(*keys, (-F.col("m.v")).alias("mode")))
    wide = wide.join(modes, keys)
    has_fn = F.coalesce(F.col("fn.n") > MIN_FN_VALUES, F.lit(False))
    b = F.col("b")
    tight = (F.when(has_fn & (q("fn", 0.05) < b), F.least(b, q("fn", 0.05) * 0.9))
             .when(has_fn & (q("fn", 0.10) < b), F.least(b, q("fn", 0.10) * 0.9)).otherwise(b))
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    kept = wide.select(*keys, place.alias("place"), tight.alias("bound"), "mode").where(F.col("bound") > F.col("mode"))
    first = Window.partitionBy("proto", "port").orderBy("place")
    return (kept.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= limit)
            .select("proto", "port", "feature", F.col("rank").alias("place"), "bound"))


def condition_lists(bounds: DataFrame) -> DataFrame:
    """One row per combination with its conditions in feature order (at most five each)."""
    one = F.struct("place", "feature", F.lit("max").alias("op"), "bound")
    ordered = F.array_sort(F.collect_list(one))
    return bounds.groupBy("proto", "port").agg(F.transform(
        ordered, lambda c: F.struct(c["feature"], c["op"], c["bound"])).alias("conditions"))


def port_name(port: Column) -> Column:
    return F.when(port == F.floor(port), F.floor(port).cast("string")).otherwise(port.cast("string"))


def combo_rules(chosen: DataFrame, bounds: DataFrame) -> DataFrame:
    """A behavioural rule where bounds were found, a plain protocol-port rule elsewhere."""
    joined = chosen.join(F.broadcast(condition_lists(bounds)), ["proto", "port"], "left")
    behaves = F.col("conditions").isNotNull()
    name = F.concat(F.upper("proto"), F.lit("/"), port_name(F.col("port")), F.when(behaves, " (behavioral)").otherwise(""))
    return joined.select(
        name.alias("name"), F.when(behaves, "proto_port_behavioral").otherwise("proto_port").alias("type"),
        "proto", "port", "conditions", "fp_ratio", "normal_ratio", "attack_ratio",
        F.lit(0).alias("source"), F.col("score").alias("weight"))


def service_table(spark) -> DataFrame:
    return spark.createDataFrame([(float(p), s) for p, s in SERVICE_PORTS.items()], "port double, service string")


def service_port_stats(df: DataFrame | None, y: str = "label_binary", p: str = "y_pred",
                       counts: DataFrame | None = None, totals: dict | None = None) -> DataFrame:
    """Shares per well-known service port with the protocol most of its false positives use."""
    counts = combo_counts(df, y, p) if counts is None else counts
    totals = totals or class_totals(counts)
    services = F.broadcast(service_table(counts.sparkSession))  # ten rows
    stats = combo_stats(None, keys=("port",), counts=counts, totals=totals).join(services, "port")
    # A service port has one row per protocol.
    first = Window.partitionBy("port").orderBy(F.desc("fp"), "proto")
    modal = (counts.where("fp > 0 and proto is not null").join(services, "port")
             .withColumn("r", F.row_number().over(first)).where("r = 1")
             .select("port", F.col("proto").alias("modal_proto")))
    return stats.join(F.broadcast(modal), "port", "left")


def service_candidates(counts: DataFrame, fp_threshold: float, normal_threshold: float, attack_threshold: float,
                       totals: dict) -> tuple[DataFrame, DataFrame]:
    """Service ports safe enough for a plain rule, and those that need bounds; ten rows at most."""
    stats = service_port_stats(None, counts=counts, totals=totals).where(
        (F.col("fp_ratio") > fp_threshold) & (F.col("normal_ratio") > normal_threshold))
    # Kept as literals so that later steps do not count again.
    stats = counts.sparkSession.createDataFrame(stats.collect(), stats.schema)
    attack = F.col("attack_ratio")
    risky = stats.where((attack >= attack_threshold) & (attack < 2 * attack_threshold) & F.col("modal_proto").isNotNull())
    return stats.where(attack < attack_threshold), risky


def service_rules(plain: DataFrame, risky: DataFrame, bounds: DataFrame, attack_threshold: float) -> DataFrame:
    """Plain rules where attacks are rare, behavioural ones up to twice the threshold.

    Without bounds a plain rule is still made while attacks stay below 1.5 times the threshold.
    """
    none = F.lit(None).cast("array<struct<feature:string,op:string,bound:double>>")
    found = condition_lists(bounds).withColumnRenamed("proto", "modal_proto")
    risky = risky.join(F.broadcast(found), ["modal_proto", "port"], "left")
    risky = risky.where(F.col("conditions").isNotNull() | (F.col("attack_ratio") < 1.5 * attack_threshold))
    both = plain.withColumn("conditions", none).unionByName(risky.select(*plain.columns, "conditions"))
    behaves = F.col("conditions").isNotNull()
    name = F.concat("service", F.lit(" (Port "), port_name(F.col("port")), F.when(behaves, ", behavioral)").otherwise(")"))
    return both.select(
        name.alias("name"), F.when(behaves, "port_behavioral").otherwise("port").alias("type"),
        F.lit(None).cast("string").alias("proto"), "port", "conditions", "fp_ratio", "normal_ratio", "attack_ratio",
        F.lit(1).alias("source"), F.col("fp_ratio").alias("weight"))


def service_port_rules(df: DataFrame, y: str = "label_binary", p: str = "y_pred", fp_threshold: float = 0.05,
                       normal_threshold: float = 0.01, attack_threshold: float = 0.03, features=None) -> DataFrame:
    """Rules for well-known ports."""
    counts = combo_counts(df, y, p)
    totals = class_totals(counts)
    plain, risky = service_candidates(counts, fp_threshold, normal_threshold, attack_threshold, totals)
    combos = risky.select(F.col("modal_proto").alias("proto"), "port")
    bounds = behavioral_bounds(df, combos, features, y, p)
    return service_rules(plain, risky, bounds, attack_threshold)


# Per kind of rule: the columns that must equal those of the flow. Fixed values; other kinds match nothing.
RULE_KEYS = {
    "proto_port": ("proto", "port"), "proto_port_behavioral": ("proto", "port"), "port": ("port",),
    "port_behavioral": ("port",), "proto_ip": ("proto", "ip"), "proto_port_ip": ("proto", "port", "ip"),
    "proto_port_range": ("proto",),
}
FLOW_COLUMNS = {"proto": "Proto", "port": "Dport", "ip": "DstAddr"}


def text_key(values) -> Column:
    """One string for the values of a key; NULL if one is."""
    return F.concat(*[x for v in values for x in (v.cast("string"), F.lit("\x01"))])


def rule_map(grouped: DataFrame, keys, lists: str) -> Column:
    """A constant map from the text of a key to its rules, for at most ``LITERAL_RULES`` rules."""
    pairs = grouped.select(text_key([F.col(k) for k in keys]).alias("key"), lists).where("key is not null")
    table = pairs.agg(F.map_from_entries(F.collect_list(F.struct("key", lists))).alias("m"))
    return F.from_json(F.lit(table.select(F.to_json("m")).first()[0]), table.schema["m"].dataType)


def with_hits(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``_hits``: the rules (id, type, own score threshold) that cover a flow.

    Rules of one key are gathered into one row, so a flow stays one row in every join, and the number of rules
    is open. Few rules are a constant map in the flows' own projection; up to ``BROADCAST_RULES`` their table is sent to
    the flows; beyond, a join by key meets them, whose hot keys adaptive execution splits on the flows' side. Conditions are checked against a map of the flow's features.
    """
    have = set(rules.columns)
    field = lambda n, t: (F.col(n) if n in have else F.lit(None)).cast(t).alias(n)
    table = rules.select(*[field(n, t) for n, t in rule_fields()])
    used = table.agg(F.count("*").alias("n"), F.collect_set("type").alias("kinds"), F.array_distinct(F.flatten(F.collect_set(
        F.transform("conditions", lambda c: c["feature"])))).alias("features")).first()
    # Seven kinds and the features of the flow at most.
    kinds, features = set(used["kinds"]) & set(RULE_KEYS), sorted(used["features"] or [])
    lists, out = [], df
    for keys in sorted({RULE_KEYS[k] for k in kinds}):
        mine = sorted(k for k in kinds if RULE_KEYS[k] == keys)
        if any(FLOW_COLUMNS[k] not in df.columns for k in keys) or ("proto_port_range" in mine and "Dport" not in df.columns):
            continue
        name = "_r_" + "_".join(keys)
        grouped = table.where(F.col("type").isin(mine)).groupBy(*[F.col(k).alias(f"{name}_{k}") for k in keys]).agg(
            F.collect_list(F.struct("rule_id", "type", "port_min", "port_max", "conditions", "anomaly_score_threshold")).alias(name))
        flow = [F.lower("Proto") if k == "proto" else F.col("Dport").cast("double") if k == "port" else F.col("DstAddr") for k in keys]
        kind = grouped.schema[name].dataType
        if used["n"] <= LITERAL_RULES:
            found = F.try_element_at(rule_map(grouped, [f"{name}_{k}" for k in keys], name), text_key(flow))
        else:
            same = F.lit(True)
            for k, x in zip(keys, flow, strict=True):
                same = same & (x == F.col(f"{name}_{k}"))
            out, found = out.join(F.broadcast(grouped) if used["n"] <= BROADCAST_RULES else grouped, same, "left"), F.col(name)
        lists.append(F.coalesce(found, F.array().cast(kind)))
    if not lists:
        none = F.array().cast("array<struct<rule_id:bigint,type:string,anomaly_score_threshold:double>>")
        return df.withColumn("_hits", none)
    port = F.col("Dport").cast("double") if "Dport" in df.columns else F.lit(None).cast("double")
    hits = F.filter(F.concat(*lists), lambda r: (
        (r["type"] != "proto_port_range") | F.coalesce(port.between(r["port_min"], r["port_max"]), F.lit(False)))
        & F.forall(F.coalesce(r["conditions"], F.array().cast(table.schema["conditions"].dataType)),
                   lambda c: condition_test(c, features, df.columns)))
    found = F.transform(
        hits, lambda r: F.struct(r["rule_id"].alias("rule_id"), r["type"].alias("type"),
                                 r["anomaly_score_threshold"].alias("anomaly_score_threshold")))
    return out.withColumn("_hits", F.array_sort(found)).select(*df.columns, "_hits")


def condition_test(condition: Column, features, columns) -> Column:
    """A bound on one of ``features``; a missing value passes, a feature without a column is ignored."""
    numbers = [c for c in features if c in columns or f"log_{c}" in columns]
    pairs = [x for c in numbers for x in (F.lit(c), F.nanvl(
        F.col(c if c in columns else f"log_{c}").cast("double"), F.lit(None).cast("double")))]
    if not pairs:
        return F.lit(True)
    value = F.try_element_at(F.create_map(*pairs), condition["feature"])
    return F.coalesce(F.when(condition["op"] == "max", value < condition["bound"]).otherwise(value > condition["bound"]), F.lit(True))


def rule_match(rules: DataFrame, df: DataFrame) -> DataFrame:
    """Add ``rule_ids``: the rules that cover a flow."""
    return with_hits(df, rules).withColumn("rule_ids", F.transform("_hits", lambda r: r["rule_id"].cast("long"))).drop("_hits")


def fn_coverage(df: DataFrame, rules: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """Missed attacks each rule covers, and their share of all missed attacks."""
    missed = df.where((F.col(y) == 1) & (F.col(p) == 0))
    total = missed.count()
    counts = (with_hits(missed, rules).select(F.explode("_hits.rule_id").alias("_id")).groupBy("_id")
              .agg(F.count(F.lit(1)).alias("_n")))
    matched = F.coalesce("_n", F.lit(0)).cast("long")
    return (rules.select(F.col("rule_id").cast("long")).join(counts, F.col("rule_id") == F.col("_id"), "left")
            .select("rule_id", matched.alias("matched_fn"), (matched / total if total else F.lit(0.0)).alias("fn_share")))


def validate_rules(df: DataFrame, rules: DataFrame, y: str = "label_binary", p: str = "y_pred",
                   limit: float = FN_LIMIT) -> DataFrame:
    """The rules that cover at most ``limit`` of the missed attacks."""
    coverage = fn_coverage(df, rules, y, p).where(F.col("fn_share") <= limit)
    return rules.join(F.broadcast(coverage.select("rule_id")), "rule_id", "left_semi")  # one row per rule


def as_rules(df: DataFrame) -> DataFrame:
    """Fill in the unused columns of the stored rule form."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in rule_fields()])


def mine_rules(df: DataFrame, y: str = "label_binary", p: str = "y_pred", method: str = "threshold",
               fp_threshold: float = 0.05, normal_threshold: float = 0.01, attack_threshold: float = 0.03,
               top_n: int = 20, score_threshold: float = 0.3, min_samples: int = 50, features=None,
               score_gate: float | None = None, limit: float = FN_LIMIT) -> DataFrame:
    """Mine, synthesise and safety-check allow-list rules; the result is a finished small table."""
    spark = df.sparkSession
    counts = combo_counts(df, y, p).persist()  # one row per protocol and port, read by four reports
    try:
        totals = class_totals(counts)
        if not totals["fp"]:
            return spark.createDataFrame([], RULE_SCHEMA)
        chosen = candidates(combo_stats(None, counts=counts, totals=totals), method, fp_threshold, top_n,
                            score_threshold, normal_threshold, min_samples)
        # Fewer rows than 1 / normal_threshold: kept as literals so that they are counted once.
        chosen = spark.createDataFrame(chosen.limit(MAX_RULES + 1).collect(), chosen.schema)
        plain, risky = service_candidates(counts, fp_threshold, normal_threshold, attack_threshold, totals)
    finally:
        counts.unpersist()
    sized = ["proto", "port", "normal_count", "attack_count"]
    combos = chosen.select(*sized).unionByName(risky.withColumn("proto", F.col("modal_proto")).select(*sized))
    bounds = behavioral_bounds(df, combos, features, y, p)
    bounds = spark.createDataFrame(bounds.collect(), bounds.schema)  # five per combination at most
    made = combo_rules(chosen, bounds).unionByName(service_rules(plain, risky, bounds, attack_threshold))
    rows = made.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    services = [float(x) for x in SERVICE_PORTS]

    def place(r):
        # Candidates by score (or share), then service ports in their listed order.
        rank = services.index(r["port"]) if r["source"] else -(r["weight"] if method != "threshold" else r["fp_ratio"])
        return (r["source"], rank, r["proto"] or "", r["port"])

    rows = [{**r.asDict(recursive=True), "rule_id": i, "anomaly_score_threshold": score_gate}
            for i, r in enumerate(sorted(rows, key=place))]
    names = [n for n, _ in rule_fields()]
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RULE_SCHEMA)
    return validate_rules(df, table, y, p, limit)


def global_gate(df: DataFrame, score: str = "anomaly_score", p: str = "y_pred", percentile: float = 75.0) -> float | None:
    """Score below which a flagged row counts as uncertain."""
    return exact_quantile(df.where(F.col(p) == 1), score, percentile / 100)


def apply_rules(df: DataFrame, rules: DataFrame, p: str = "y_pred", score: str | None = None,
                percentile: float = 75.0, out: str = "y_final") -> DataFrame:
    """Add ``allowed`` (some rule covers the row) and the corrected prediction.

    With a score column, a rule only acts on flagged rows below its own score threshold,
    or below the given percentile of the flagged rows' scores.
    """
    gate = global_gate(df, score, p, percentile) if score else None

    def acts(rule: Column) -> Column:
        if score is None:
            return F.lit(True)
        limit = F.coalesce(rule["anomaly_score_threshold"], F.lit(gate).cast("double"))
        return limit.isNull() | (F.col(p) != 1) | F.coalesce(F.col(score) < limit, F.lit(False))

    allowed = F.coalesce(F.exists("_hits", acts), F.lit(False))
    return with_hits(df, rules).withColumn("allowed", allowed).withColumn(
        out, F.when(F.col("allowed") & (F.col(p) == 1), 0).otherwise(F.col(p)).cast("int")).drop("_hits")


def effect_stats(df: DataFrame, y: str = "label_binary", p: str = "y_pred", out: str = "y_final") -> DataFrame:
    """Flagged rows before and after, rows covered, false positives rescued, attacks let through."""
    changed = (F.col(p) == 1) & (F.col(out) == 0)
    return df.agg(
        F.count_if(F.col(p) == 1).alias("original_anomalies"), F.count_if(F.col(out) == 1).alias("filtered_anomalies"),
        F.count_if(changed).alias("reduced_anomalies"), F.count_if("allowed").alias("matched_rows"),
        F.count_if(changed & (F.col(y) == 0)).alias("rescued_fp"),
        F.count_if(changed & (F.col(y) == 1)).alias("wrongly_allowed"))


def rule_stats(rules: DataFrame, df: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """Rules per type with the estimated and the exact false-positive reduction and coverage.

    The estimate adds up overlapping rules; the exact columns count each row once.
    """
    per_kind = {r["type"]: r for r in rules.groupBy("type").agg(
        F.count(F.lit(1)).alias("rules"), F.sum("fp_ratio").alias("share")).collect()}
    kinds = sorted(per_kind)
    fp = (F.col(y) == 0) & (F.col(p) == 1)
    covered = {k: F.array_contains(F.col("_hits.type"), k) for k in kinds}
    measured = with_hits(df, rules).agg(F.count(F.lit(1)).alias("rows"), F.count_if(fp).alias("fp"), *[
        F.struct(F.count_if(t), F.count_if(t & fp)).alias(k) for k, t in covered.items()]).first()
    total = measured["rows"]
    table = [(k, per_kind[k]["rules"], int((per_kind[k]["share"] or 0.0) * measured["fp"] + 1e-9), measured[k][1],
              measured[k][0] / total if total else 0.0) for k in kinds]
    return df.sparkSession.createDataFrame(
        table, "type string, rules long, estimated_fp_reduction long, exact_fp_reduction long, coverage double")
