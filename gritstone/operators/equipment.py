"""Run state, availability and starts per asset and window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gritstone.functions.expressions import percent
from gritstone.functions.slices import HOUR, previous_row, sliced
from gritstone.operators.readings import with_tag


def run_state_samples(readings: DataFrame, tags: DataFrame) -> DataFrame:
    """GOOD samples of tags that report a run status.

    An asset may carry further state tags (which pile it feeds); only tags whose
    states include RUNNING say whether it runs.
    """
    run_tags = tags.where(
        (F.col("instrument_type") == "ZI") & (F.col("measure") == "state")
        & F.array_contains(F.split("enum_values", "[|]"), "RUNNING")
    )
    good = readings.where(F.col("quality") == "GOOD").select("tag_id", "source_ts", "seq", "value_text")
    return with_tag(good, run_tags, ["asset_id"]).withColumnRenamed("value_text", "state")


def state_transitions(samples: DataFrame, slice_seconds: int = HOUR) -> DataFrame:
    """Add the previous state of the asset and whether this sample is a start.

    The first sample of an asset has no previous state and is not a start.
    """
    stitched = previous_row(
        sliced(samples, seconds=slice_seconds), ["asset_id"], ["source_ts", "seq", "tag_id"],
        {"state": "prev_state"},
    )
    return stitched.withColumn(
        "is_start",
        F.coalesce((F.col("state") == "RUNNING") & (F.col("prev_state") != "RUNNING"), F.lit(False)),
    )


def equipment_state_1m(
    readings: DataFrame, tags: DataFrame, tag_1m: DataFrame, grain: str = "1 minute",
    slice_seconds: int = HOUR,
) -> DataFrame:
    """Samples per state (seconds at 1 Hz), availability, starts, current and throughput."""
    transitions = state_transitions(run_state_samples(readings, tags), slice_seconds)
    states = (
        transitions.groupBy("asset_id", F.window("source_ts", grain).alias("_w"))
        .agg(
            F.max_by("state", F.struct("source_ts", "seq", "tag_id")).alias("state"),
            F.count_if(F.col("state") == "RUNNING").alias("run_seconds"),
            F.count_if(F.col("state") == "STOPPED").alias("stop_seconds"),
            F.count_if(F.col("state") == "FAULT").alias("fault_seconds"),
            F.count_if("is_start").alias("starts"),
        )
    )
    load_tags = tags.where(F.col("instrument_type").isin("II", "WI"))
    is_current, is_flow = F.col("instrument_type") == "II", F.col("instrument_type") == "WI"
    load = (
        with_tag(
            tag_1m.select("tag_id", "window_start", "avg_value", "max_value"), load_tags,
            ["asset_id", "instrument_type"],
        )
        .groupBy("asset_id", "window_start")
        .agg(
            F.avg(F.when(is_current, F.col("avg_value"))).alias("avg_current_a"),
            F.max(F.when(is_current, F.col("max_value"))).alias("max_current_a"),
            F.avg(F.when(is_flow, F.col("avg_value"))).alias("throughput_tph"),
        )
    )
    timed = F.col("run_seconds") + F.col("stop_seconds") + F.col("fault_seconds")
    return (
        states.select("*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))
        .join(load, ["asset_id", "window_start"], "left")
        .select(
            "asset_id", "window_start", "window_end", "state", "run_seconds", "stop_seconds",
            "fault_seconds", percent(F.col("run_seconds"), timed).alias("availability_pct"),
            "avg_current_a", "max_current_a", "starts", "throughput_tph",
        )
    )


def run_minutes_10m(equipment: DataFrame, grain: str = "10 minutes") -> DataFrame:
    """Minutes actually running per asset, re-aggregated from the finer state windows."""
    return (
        equipment.groupBy("asset_id", F.window("window_start", grain).alias("_w"))
        .agg((F.sum("run_seconds") / F.lit(60.0)).alias("run_minutes"))
        .select("asset_id", F.col("_w.start").alias("window_start"), "run_minutes")
    )
