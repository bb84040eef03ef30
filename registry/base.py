"""Registration helpers and the flow view over the given event table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The same text runs in both engines.
FLOWS_SQL = """
SELECT event_id AS flow_id, ts AS StartTime, value / 10 AS Dur,
  CASE event_type WHEN 'view' THEN 'udp' WHEN 'error' THEN 'UDP' WHEN 'signup' THEN 'icmp'
                  WHEN 'click' THEN 'TCP' ELSE 'tcp' END AS Proto,
  concat('h', CAST(user_id % 12 AS STRING)) AS SrcAddr,
  1024 + event_id % 60000 AS Sport,
  concat('h', CAST(k % 12 AS STRING)) AS DstAddr,
  CASE CAST(k % 5 AS INT) WHEN 0 THEN 53 WHEN 1 THEN 80 WHEN 2 THEN 443 WHEN 3 THEN 22 ELSE 123 END AS Dport,
  CASE CAST(k % 4 AS INT) WHEN 0 THEN 'CON' WHEN 1 THEN 'RST' WHEN 2 THEN 'INT' ELSE 'FSPA_FSPA' END AS State,
  1 + k % 20 AS TotPkts,
  CASE WHEN is_bot THEN bytes0 * 5 ELSE bytes0 END AS TotBytes,
  CAST(floor((CASE WHEN is_bot THEN bytes0 * 5 ELSE bytes0 END) * (1 + k % 10) / CAST(11 AS DOUBLE)) AS BIGINT) AS SrcBytes,
  CASE WHEN is_bot THEN 'flow=From-Botnet-V50-1' WHEN event_type = 'signup' THEN 'flow=From-Normal-V50'
       ELSE 'flow=Background' END AS Label
FROM (SELECT *, (event_type = 'error' AND k % 3 = 0) AS is_bot,
             CAST(floor(value * 100) AS BIGINT) AS bytes0
      FROM (SELECT event_id, ts, user_id, event_type, value,
                   CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM {events}) AS e) AS b
"""

# Same view with missing and damaged cells, for the null and edge cases.
GAPPY_SQL = """
SELECT flow_id, CASE WHEN flow_id % 53 = 0 THEN NULL ELSE StartTime END AS StartTime, Dur, Proto,
  CASE WHEN flow_id % 59 = 0 THEN NULL ELSE SrcAddr END AS SrcAddr, Sport,
  CASE WHEN flow_id % 61 = 0 THEN NULL ELSE DstAddr END AS DstAddr,
  CASE WHEN flow_id % 67 = 0 THEN NULL ELSE Dport END AS Dport,
  State, TotPkts, CASE WHEN flow_id % 71 = 0 THEN NULL ELSE TotBytes END AS TotBytes, SrcBytes, Label
FROM ({flows}) AS f
"""

FLOWS = FLOWS_SQL.replace("{events}", "events")
GAPPY = GAPPY_SQL.replace("{flows}", FLOWS)
LABELLED = (
    "SELECT *, CASE WHEN Label LIKE '%Botnet%' THEN 1 ELSE 0 END AS label_binary, "
    "CASE WHEN TotBytes > 10000 THEN 1 ELSE 0 END AS y_pred, "
    f"CAST(TotBytes AS DOUBLE) AS anomaly_score FROM ({FLOWS}) AS f"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLOWS_SQL, events=table(spark, sf_dir, "events"))


def gappy_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GAPPY_SQL.replace("({flows})", "{flows}"), flows=flows(spark, sf_dir))


def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with the true label and a simple deterministic detector."""
    from pyspark.sql import functions as F

    from flowlens.operators.labels import binary_label

    return binary_label(flows(spark, sf_dir)).withColumns({
        "y_pred": (F.col("TotBytes") > 10000).cast("int"),
        "anomaly_score": F.col("TotBytes").cast("double"),
    })


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use {flows}, {gappy} and {scored} as table expressions."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = functools.wraps(fn)(lambda spark, sf_dir: fn(spark, sf_dir))
        if sql is not None:
            text = sql
            for mark, body in (("{flows}", FLOWS), ("{gappy}", GAPPY), ("{scored}", LABELLED)):
                text = text.replace(mark, f"({body})")
            SQL[name] = text
        return fn
    return register
