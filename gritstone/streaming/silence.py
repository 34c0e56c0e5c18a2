"""Silent tags as a stream: keyed state with event-time timers, begun from the register."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gritstone.functions.expressions import micros
from gritstone.operators.readings import with_tag

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOUND = "tag_id STRING, asset_id STRING, last_us BIGINT, stale_us BIGINT"


class SilenceWatch(StatefulProcessor):
    """Per tag: the open runs of readings that are less than ``stale_us`` apart, and one timer at the earliest end.

    A run is over once the watermark is ``stale_us`` past its last reading: later rows cannot join it any more, so each
    silence is told once and only open runs stay in the state. The register's row is a run without a reading.
    """

    def __init__(self, stale_us: int) -> None:
        self.stale_us = stale_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.asset = handle.getValueState("asset", "asset_id STRING")
        self.timer = handle.getValueState("timer", "at_ms BIGINT")
        self.runs = handle.getListState("runs", "first_us BIGINT, last_us BIGINT, spoken BOOLEAN")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.asset.update((row["asset_id"],))
        since = int(row["since_us"])
        self._keep([(since, since, False)])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = [tuple(r) for r in self.runs.get()] if self.runs.exists() else []
        moments: list[int] = []
        for part in rows:
            moments += part["us"].tolist()
            self.asset.update((part["asset_id"].iloc[-1],))
        # Spoken in time: the register's own run is not a silence.
        runs = [r for r in runs if r[2] or all(m >= r[1] + self.stale_us for m in moments)]
        waiting = [r for r in runs if not r[2]]
        merged: list[list[int]] = []
        for first, last in sorted([(r[0], r[1]) for r in runs if r[2]] + [(m, m) for m in moments]):
            if merged and first < merged[-1][1] + self.stale_us:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        self._keep(waiting + [(first, last, True) for first, last in merged])
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        runs = [tuple(r) for r in self.runs.get()] if self.runs.exists() else []
        over = [r for r in runs if r[1] + self.stale_us <= now]
        self.timer.clear()
        self._keep([r for r in runs if r[1] + self.stale_us > now])
        if over:
            asset = self.asset.get()[0]
            yield pd.DataFrame({
                "tag_id": key[0], "asset_id": asset, "last_us": pd.array([r[1] if r[2] else None for r in over], dtype="Int64"),
                "stale_us": [r[1] + self.stale_us for r in over],
            })

    def _keep(self, runs: list[tuple[int, int, bool]]) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        if not runs:
            self.runs.clear()
            return
        self.runs.put(runs)
        due = -(-(min(r[1] for r in runs) + self.stale_us) // 1000)
        self.timer.update((due,))
        self.handle.registerTimer(due)


def stream_stale_tags(
    readings: DataFrame, tags: DataFrame, since: str, stale_seconds: int = 120, measure: str | None = "mass_flow",
) -> DataFrame:
    """A row per silence of at least ``stale_seconds``, in append mode, once the watermark has passed its ``stale_from``.

    The register is the initial state: each of its tags is watched from ``since`` on, so a tag that never speaks is told
    as well, with NULL as ``last_seen``. The watermark, and with it the detection, advances with the readings
    of all tags. Equals ``alerts.stale_tags`` with the same ``since`` up to the watermark. A tag registered after the
    first batch is watched from its first reading on.

    Event-time timers need the RocksDB state store; the session is set to it before the stream starts.
    """
    spark = readings.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    wanted = tags.where(F.col("measure") == measure) if measure else tags
    start = micros(F.lit(since).cast("timestamp"))
    register = wanted.groupBy("tag_id").agg(F.min("asset_id").alias("asset_id")).withColumn("since_us", start)
    samples = with_tag(readings.select("tag_id", "source_ts"), wanted, ["asset_id"]).withColumn("us", micros("source_ts"))
    found = samples.groupBy("tag_id").transformWithStateInPandas(
        SilenceWatch(stale_seconds * 1_000_000), FOUND, "Append", "EventTime", initialState=register.groupBy("tag_id"))
    return found.select(
        "tag_id", "asset_id", F.timestamp_micros("last_us").alias("last_seen"), F.timestamp_micros("stale_us").alias("stale_from"))
