"""Seconds since the previous flow of the same source, over a stream, in event order.

Flows are gathered in slices of time and leave once the watermark has passed their slice, so their order of arrival
does not matter. Gaps inside a slice need nothing else. The first flow of a slice looks up the last time of its
source's earlier slices, one number of state that is moved on by one row for each source and slice: a source with a
third of all flows is spread over tasks by its slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowlens.streaming.windows import kept, spelled, timed

OUTPUT = "SrcAddr string, flow_id long, StartTime timestamp, time_since_last_flow double"


class Stitch(StatefulProcessor):
    """The gap of the first flow of each slice, from the last time its source has been seen."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        slices = pd.concat(list(rows)).sort_values("first")  # a row for each slice that has closed just now
        before = slices["last"].shift(1)
        before.iloc[0] = self.last.get()[0] if self.last.exists() else slices["first"].iloc[0]
        newest = int(slices["last"].iloc[-1])
        self.last.update((newest,))
        if self.keep_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(newest // 1000 + self.keep_ms)
        yield pd.DataFrame({"SrcAddr": key[0], "flow_id": slices["flow_id"], "StartTime": slices["StartTime"],
                            "time_since_last_flow": (slices["first"] - before.astype("int64")) / 1e6})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_intervals(df: DataFrame, late: str = "10 minutes", slice: str = "1min", keep_minutes: int | None = None) -> DataFrame:
    """One row per flow with the gap to its source's previous flow in event order (0 for the first).

    A flow leaves when its slice of time has closed; flows later than ``late`` are dropped, as the stream's progress
    reports. ``keep_minutes`` forgets sources that have been silent so long; their next flow counts as a first one.
    Stateful processors need the RocksDB state store, which ``replay`` and ``run_available`` set while they run.
    """
    rows = kept(timed(df, late), "SrcAddr").select("SrcAddr", "flow_id", "StartTime")
    slices = rows.groupBy(F.window("StartTime", spelled(slice)).alias("w"), "SrcAddr")
    inside = slices.agg(F.sort_array(F.collect_list(F.struct("StartTime", "flow_id"))).alias("f"))
    gaps = F.transform("f", lambda x, i: F.struct(
        x["flow_id"].alias("flow_id"), x["StartTime"].alias("StartTime"),
        ((F.unix_micros(x["StartTime"]) - F.unix_micros(F.get("f", i - 1)["StartTime"])) / 1e6).alias("time_since_last_flow")))
    later = inside.select("SrcAddr", F.explode(F.filter(gaps, lambda g: g["time_since_last_flow"].isNotNull())).alias("g")).select("SrcAddr", "g.*")
    borders = slices.agg(F.min(F.struct("StartTime", "flow_id")).alias("f"), F.max("StartTime").alias("l")).select(
        "SrcAddr", "f.flow_id", "f.StartTime", F.unix_micros("f.StartTime").alias("first"), F.unix_micros("l").alias("last"))
    first = borders.groupBy("SrcAddr").transformWithStateInPandas(
        Stitch(None if keep_minutes is None else keep_minutes * 60_000), OUTPUT, "append",
        "None" if keep_minutes is None else "EventTime")
    return later.unionByName(first)
