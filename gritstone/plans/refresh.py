"""End-to-end plans: the analytics refresh, the alert run and the maintenance model run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gritstone.functions.slices import HOUR
from gritstone.operators import alerts, balance, equipment, history, pdm, stockpile, vibration
from gritstone.operators.readings import tag_reading_1m
from gritstone.session import materialize
from gritstone.sources.sinks import append_unseen, overwrite_table
from gritstone.sources.upsert import upsert


@dataclass(frozen=True)
class Dimensions:
    tags: DataFrame
    nodes: DataFrame
    arcs: DataFrame
    rules: DataFrame


@dataclass(frozen=True)
class Grain:
    fine: str = "1 minute"
    feature: str = "10 minutes"
    short_lag: int = 6
    long_lag: int = 144
    slice_seconds: int = HOUR


def analytics(
    readings: DataFrame, dims: Dimensions, grain: Grain = Grain(), tag_1m: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every derived dataset by name. Pass a written ``tag_1m`` to compute it only once."""
    if tag_1m is None:
        tag_1m = tag_reading_1m(readings, grain.fine)
    incidence = balance.reconciled_incidence(tag_1m, dims.arcs, dims.nodes, dims.tags)
    states = equipment.equipment_state_1m(
        readings, dims.tags, tag_1m, grain.fine, grain.slice_seconds
    )
    return {
        "tag_reading_1m": tag_1m,
        "mass_flow_1m": balance.mass_flow_final(incidence),
        "mass_balance_node_1m": balance.mass_balance_node_1m(incidence),
        "equipment_state_1m": states,
        "desands_balance_1m": balance.desands_balance_1m(tag_1m),
        "vibration_features_10m": vibration.vibration_features_10m(
            readings, dims.tags, equipment.run_minutes_10m(states, grain.feature), grain.feature,
            grain.short_lag, grain.long_lag,
        ),
    }


def refresh(
    readings: DataFrame, dims: Dimensions, out: str, days: list[str] | None = None,
    grain: Grain = Grain(),
) -> None:
    """Write all datasets, by day. With ``days`` only those days are written.

    Lags, states and bin levels reach back as far as a tag was silent, so all earlier
    readings count: only those after the last of ``days`` are left out, and the
    result equals that of a full refresh. Minute aggregates are written first
    and the other datasets read them back; adaptive execution sizes the files.
    """
    spark = readings.sparkSession
    if days:
        # A bound on the column itself, so it reaches the scan.
        ts_type = readings.schema["source_ts"].dataType
        after = F.date_add(F.lit(max(days)).cast("date"), 1).cast(ts_type)
        readings = readings.where(F.col("source_ts") < after)

    def write(name: str, df: DataFrame) -> None:
        dated = df.withColumn("day", F.col("window_start").cast("date"))
        if days:
            dated = dated.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
        overwrite_table(dated.hint("rebalance", F.col("day")), f"{out}/{name}", ["day"])

    tag_1m = tag_reading_1m(readings, grain.fine)
    if days:
        stored = materialize(tag_1m)
        write("tag_reading_1m", stored)
    else:
        write("tag_reading_1m", tag_1m)
        stored = spark.read.parquet(f"{out}/tag_reading_1m").drop("day")
    for name, df in analytics(readings, dims, grain, stored).items():
        if name != "tag_reading_1m":
            write(name, df)


def refresh_stockpiles(
    readings: DataFrame, path: str, tags: stockpile.StackerTags = stockpile.StackerTags(),
) -> list[int]:
    state = materialize(stockpile.stockpile_state(readings, tags).drop("campaigns"))
    return upsert(state, path, ["stockpile_id"])


def refresh_alerts(readings: DataFrame, dims: Dimensions, path: str, gap_seconds: int = 60) -> list[int]:
    """Readings to alert table; returns the partitions of the table that were written."""
    return upsert(
        materialize(alerts.derive_alerts(readings, dims.tags, dims.rules, gap_seconds)), path, ["alert_id"]
    )


def apply_alert_feed(feed: DataFrame, path: str) -> list[int]:
    """Project the newest state of each alert from its change feed into the alert table."""
    return upsert(materialize(history.latest_images(feed, "alert_id")), path, ["alert_id"])


def score_fleet(
    spark: SparkSession, features: DataFrame, model: pdm.PdmModel, path: str, model_name: str,
    model_version: str, scored_at: str | None = None, days: int = 30,
) -> DataFrame:
    """Calibrate on the history, score the recent windows, append unseen predictions."""
    dated = vibration.days_to_fail(features).where(F.col("days_to_fail").isNotNull())
    calibration = materialize(pdm.rul_calibration(model.probabilities(dated)))
    recent = materialize(pdm.scorable(pdm.recent_window(features, days)))
    scored = materialize(model.probabilities(pdm.fill_context(recent)))
    rows = pdm.predictions(scored, calibration, model_name, model_version, scored_at)
    append_unseen(rows, path, "prediction_id", "feature_window_end")
    return rows
