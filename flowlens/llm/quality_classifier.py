"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model of a text's own features gives each document its evidence. Hosts and their paths get
posterior shares of good documents from grouped sums: a host is shrunk towards the global share, a path
towards its host, the more the fewer documents it has; how much follows from how far groups differ. The
score adds a document's evidence and its path's log-odds, without the document's own part in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import crc_fold, materialize, sampled, small_enough, text_of
from flowlens.llm.quality_rules import Text
from flowlens.llm.toxicity import fit_weights

#: Labelled rows that the document model is fitted on.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5
#: Bounds of a group's prior weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6


def features(data: bytes) -> list[float]:
    t = Text(data)
    n = max(1, t.n)
    return [float(np.log1p(t.n)), t.symbols() / n, t.repeat_words() / n, t.dup_lines() / (data.count(b"\n") + 1),
            t.word_chars() / n, len(set(t.words)) / n, sum(w.isupper() and len(w) > 1 for w in t.words) / n,
            sum(w.isascii() and w.upper() == w.lower() for w in t.words) / n]


N_FEATURES = len(features(b""))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = pa.array([features(d) for d in b.column(b.num_columns - 1).to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), x],
                                         names=[*b.schema.names[:-1], "x"])


def fit(described: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights over raw features (bias first) from a bounded sample of labelled rows outside the held-out third,
    and the share of good ones among them. With one kind of label only, or none, features have no weight."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
             .where("doc_id IS NOT NULL AND quality IN (0, 1)").where(crc_fold() != 1)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    got = described.join(F.broadcast(sampled(known, rows)), "doc_id").select("quality", "x").toPandas()
    share = min(max(float(got["quality"].mean()) if len(got) else 0.5, 1e-3), 1 - 1e-3)
    if got["quality"].nunique() < 2:
        return np.r_[np.log(share / (1 - share)), np.zeros(N_FEATURES)], share
    x, y = np.stack(got["x"]), got["quality"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    mean, scale, w = fit_weights(x[order], y[order])
    slope = w[1:] / scale
    return np.r_[w[0] - (mean * slope).sum(), slope], share


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _prior_weight(groups: DataFrame, good: str, n: str, centre: Column) -> float:
    """Documents a group's prior is worth, by the method of moments over the groups."""
    mean = F.col(good) / F.col(n)
    r = groups.agg(F.sum(n).alias("n"), F.count("*").alias("g"), F.sum(F.col(n) * F.pow(mean - centre, 2)).alias("apart"),
                   F.sum(F.col(n) * mean * (1 - mean)).alias("inside"), F.sum(F.pow(F.col(n), 2)).alias("squares")).first()
    if not r["n"] or r["g"] < 2 or r["n"] <= r["g"]:
        return MOST_WEIGHT
    inside = r["inside"] / (r["n"] - r["g"])
    between = (r["apart"] - (r["g"] - 1) * inside) / (r["n"] - r["squares"] / r["n"])
    return MOST_WEIGHT if between <= 0 else float(min(max(inside / between, LEAST_WEIGHT), MOST_WEIGHT))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, evidence, host_share, path_share, score (0 to 1, higher is better) and kept of every row.

    ``host`` and ``path`` name the columns of the site and of its section; NULL is a site or section of its
    own. A NULL or empty text has zero features. Repeated rows each give a row; labels of the held-out third
    are never used; other columns are left out.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("host"),
                      F.coalesce(F.col(path).cast("string"), F.lit("\0")).alias("path"),
                      text_of().cast("binary").alias("data"))
    described = materialize(own.mapInArrow(_described, "doc_id long, host string, path string, x array<double>"), "described")
    weights, share = fit(described, labels)
    terms = [F.col("x")[i] * float(w) for i, w in enumerate(weights[1:])]
    evidence = sum(terms, F.lit(float(weights[0])))
    rows = described.select("doc_id", "host", "path", F.greatest(F.least(evidence, F.lit(30.0)), F.lit(-30.0)).alias("evidence"))
    rows = rows.withColumn("good", 1 / (1 + F.exp(-F.col("evidence"))))
    paths = materialize(rows.groupBy("host", "path").agg(F.sum("good").alias("path_good"), F.count("*").alias("path_n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n"))
    total = hosts.agg(F.sum("host_good") / F.sum("host_n")).first()[0]
    centre = min(max(total if total is not None else share, 1e-3), 1 - 1e-3)
    host_weight = _prior_weight(hosts, "host_good", "host_n", F.lit(centre))
    sites = paths.join(hosts, "host")
    path_weight = _prior_weight(sites, "path_good", "path_n", F.col("host_good") / F.col("host_n"))
    # A document's own share leaves its site before the site speaks about it.
    host_share = (F.col("host_good") - F.col("good") + host_weight * centre) / (F.col("host_n") - 1 + host_weight)
    path_share = (F.col("path_good") - F.col("good") + path_weight * F.col("host_share")) / (F.col("path_n") - 1 + path_weight)
    inside = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-3)), F.lit(1e-3))
    joined = (rows.join(small_enough(sites), ["host", "path"])
              .withColumn("host_share", inside(host_share)).withColumn("path_share", inside(path_share)))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_share")) - _logit(F.lit(centre)))))
    return (joined.select("doc_id", "evidence", "host_share", "path_share", score.alias("score"))
            .withColumn("kept", F.col("score") >= threshold))
