"""A fitted model and its rules over a stream, and running streams to completion."""

from __future__ import annotations

import json
import warnings
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.operators.rules import apply_rules
from flowlens.operators.transform import apply_for_unsupervised
from flowlens.sources.storage import scratch_path
from flowlens.streaming.windows import END


def score_stream(flows: DataFrame, model, rules: DataFrame, threshold: float, fitted: dict | None = None) -> DataFrame:
    """Score, flag and clear flows of a stream with fixed models: a projection without state.

    The raw score is negated, so a higher ``anomaly_score`` is more anomalous.
    """
    packed = flows.withColumn("_kept", F.struct(*flows.columns))
    inputs = apply_for_unsupervised(packed, fitted) if fitted else packed
    scored = model.transform(inputs).select("_kept.*", (-F.col("raw_score")).alias("anomaly_score"))
    flagged = scored.withColumn("y_pred", F.coalesce(F.col("anomaly_score") >= threshold, F.lit(False)).cast("int"))
    return apply_rules(flagged, rules)


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A file stream; without a bound one trigger reads all files, so none of a replay's rows is late."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, **values):
    """Settings of the session while a stream runs; what was set before comes back."""
    values = {"spark.sql.streaming.numRecentProgressUpdates": "1000000", STATE_STORE: ROCKS, **values}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(df: DataFrame, out: str, state: str) -> int:
    """Process what input there is; rows that were dropped behind the watermark."""
    with settings(df.sparkSession):
        run = (df.writeStream.format("parquet").outputMode("append").option("path", out)
               .option("checkpointLocation", state).trigger(availableNow=True).start())
        run.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in run.recentProgress for s in json.loads(p.json)["stateOperators"])


def run_counted(df: DataFrame, name: str = "stream") -> tuple[DataFrame, int]:
    """Process all available input once; the output as a table, and the rows dropped behind the watermark.

    Rows are counted as they reach the state: those of one group and task are one row where they are summed up before.
    """
    spark = df.sparkSession
    out = scratch_path(spark, name)
    dropped = _run(df, out, scratch_path(spark, f"{name}-state"))
    return spark.read.schema(df.schema).parquet(out), dropped


def run_available(df: DataFrame, name: str = "stream") -> DataFrame:
    """Process all available input once and read the output back; a warning tells of rows dropped behind the watermark."""
    out, dropped = run_counted(df, name)
    _tell(name, dropped)
    return out


def _tell(name: str, dropped: int) -> None:
    if dropped:
        warnings.warn(f"{name}: the watermark dropped {dropped} rows", stacklevel=3)


def replay(spark: SparkSession, path: str, schema, build, time: str = "StartTime", name: str = "replay",
           files_per_trigger: int | None = None) -> DataFrame:
    """``build(stream)`` over all files of a path, until every open window has left; the output as a table.

    When all files are read, one row that holds nothing but a time beyond all others moves the watermark on. The
    query goes on from its checkpoint to take it, as after any restart.
    """
    closing, out, state = (scratch_path(spark, f"{name}-{x}") for x in ("closing", "out", "state"))
    spark.createDataFrame([], schema).write.parquet(closing)
    end = spark.range(1).select(*[(F.lit(END) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    dropped = 0
    for last in (False, True):
        if last:
            end.write.mode("append").parquet(closing)
        stream = read_stream(spark, path, schema, files_per_trigger).unionByName(read_stream(spark, closing, schema))
        df = build(stream)
        dropped += _run(df, out, state)
    _tell(name, dropped)
    return spark.read.schema(df.schema).parquet(out)
