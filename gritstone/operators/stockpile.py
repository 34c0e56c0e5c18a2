"""State of each product stockpile from the stacker's instruments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gritstone.functions.expressions import whole_seconds
from gritstone.functions.slices import HOUR, adjacent_rows, last_known, running_total, sliced
from gritstone.session import materialize


@dataclass(frozen=True)
class StackerTags:
    """The instruments of the stacker and its product sampler."""

    stacker_id: str = "STK-STK01"
    pile: str = "STK-STK01-ZI02"
    rate: str = "STK-STK01-WI01"
    fe: str = "LAB-PRD01-QI01"
    sio2: str = "LAB-PRD01-QI02"
    idle: str = "IDLE"


def pile_runs(readings: DataFrame, tags: StackerTags, slice_seconds: int = HOUR) -> DataFrame:
    """Indicator samples with the time they cover and the number of their run.

    A run is a stretch of equal states; the last sample counts one second.
    """
    indicator = sliced(
        readings.where((F.col("tag_id") == tags.pile) & (F.col("quality") == "GOOD")).select(
            F.lit(tags.stacker_id).alias("stacker_id"), F.col("value_text").alias("stockpile_id"),
            "source_ts", "seq",
        ),
        seconds=slice_seconds,
    )
    keys, order = ["stacker_id"], ["source_ts", "seq"]
    compared = adjacent_rows(
        indicator, keys, order, {"stockpile_id": "prev_pile"}, {"source_ts": "next_ts"}
    ).withColumn("_change", F.when(F.col("prev_pile") == F.col("stockpile_id"), 0).otherwise(1))
    end = F.coalesce("next_ts", F.col("source_ts") + F.expr("INTERVAL 1 SECOND"))
    return running_total(compared, keys, order, "_change", "run_id").withColumn("end_ts", end)


def grade_while_stacking(
    readings: DataFrame, runs: DataFrame, tags: StackerTags, slice_seconds: int = HOUR,
) -> DataFrame:
    """Mean lab grades per pile: each assay belongs to the indicator interval it falls in.

    An as-of lookup (the last indicator at or before the assay, if its interval
    is still open) in place of a range join without an equal key.
    """
    states = runs.select(
        "stacker_id", "source_ts", F.lit(0).alias("_kind"), "seq",
        F.struct("stockpile_id", "end_ts").alias("_state"),
        F.lit(None).cast("string").alias("tag_id"), F.lit(None).cast("double").alias("value"),
    )
    assays = readings.where(
        F.col("tag_id").isin(tags.fe, tags.sio2) & (F.col("quality") == "GOOD")
    ).select(
        F.lit(tags.stacker_id).alias("stacker_id"), "source_ts", F.lit(1).alias("_kind"), "seq",
        F.lit(None).cast(states.schema["_state"].dataType).alias("_state"), "tag_id", "value",
    )
    merged = last_known(
        sliced(states.unionByName(assays), seconds=slice_seconds), ["stacker_id"],
        ["source_ts", "_kind", "seq"], "_state", "_at",
    )
    return (
        merged.where(
            (F.col("_kind") == 1) & (F.col("source_ts") < F.col("_at.end_ts"))
            & (F.col("_at.stockpile_id") != tags.idle)
        )
        .groupBy(F.col("_at.stockpile_id").alias("stockpile_id"))
        .agg(
            F.avg(F.when(F.col("tag_id") == tags.fe, F.col("value"))).alias("avg_fe_pct"),
            F.avg(F.when(F.col("tag_id") == tags.sio2, F.col("value"))).alias("avg_sio2_pct"),
        )
    )


def active_pile(readings: DataFrame, tags: StackerTags) -> DataFrame:
    """One row: what the indicator says now."""
    return readings.where((F.col("tag_id") == tags.pile) & (F.col("quality") == "GOOD")).agg(
        F.max_by("value_text", F.struct("source_ts", "seq")).alias("active_id")
    )


def stacked_tonnes(readings: DataFrame, runs: DataFrame, tags: StackerTags) -> DataFrame:
    """Rate integrated over the interval each indicator sample covers, per pile."""
    rate = readings.where((F.col("tag_id") == tags.rate) & (F.col("quality") == "GOOD")).select(
        "source_ts", F.col("value").alias("tph")
    )
    tonnes = F.col("tph") * whole_seconds("source_ts", "end_ts") / F.lit(3600.0)
    per_run = (
        runs.where(F.col("stockpile_id") != tags.idle)
        .join(rate, "source_ts")
        .groupBy("stockpile_id", "run_id")
        .agg(F.sum(tonnes).alias("tonnes"), F.max("source_ts").alias("last_ts"))
    )
    return per_run.groupBy("stockpile_id").agg(
        F.sum("tonnes").alias("tonnes"), F.max("last_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("campaigns"),
    )


def latest_campaign(runs: DataFrame, tags: StackerTags) -> DataFrame:
    """When the most recent uninterrupted campaign of each pile began."""
    per_run = (
        runs.where(F.col("stockpile_id") != tags.idle)
        .groupBy("stockpile_id", "run_id")
        .agg(F.min("source_ts").alias("started"))
    )
    return per_run.groupBy("stockpile_id").agg(
        F.max_by("started", "run_id").alias("stack_started_at")
    )


def stockpile_state(
    readings: DataFrame, tags: StackerTags = StackerTags(), slice_seconds: int = HOUR,
) -> DataFrame:
    """Current state per pile; nothing is reclaimed, so stacked equals on the ground."""
    # Used three times below and built from several passes over one tag.
    runs = materialize(pile_runs(readings, tags, slice_seconds))
    is_active = F.col("stockpile_id") == active_pile(readings, tags).scalar()
    return (
        stacked_tonnes(readings, runs, tags)
        .join(grade_while_stacking(readings, runs, tags, slice_seconds), "stockpile_id", "left")
        .join(latest_campaign(runs, tags), "stockpile_id", "left")
        .select(
            "stockpile_id", F.col("last_ts").alias("as_at"), is_active.alias("is_stacking"),
            F.lit(tags.stacker_id).alias("stacker_id"),
            F.round("tonnes", 1).alias("tonnes_stacked_cum"),
            F.round("tonnes", 1).alias("tonnes_on_ground"),
            F.round("avg_fe_pct", 2).alias("avg_fe_pct"),
            F.round("avg_sio2_pct", 2).alias("avg_sio2_pct"), "stack_started_at", "campaigns",
        )
    )
