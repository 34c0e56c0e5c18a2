"""Ten-minute vibration features and the labels attached to them.

After aggregation there is one row per sensor and window. Trends run over blocks
of a sensor's rows, labels over slices of time, so no sensor is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.functions.expressions import epoch_seconds, iso_zone, percent
from gritstone.functions.slices import BLOCK_ROWS, DAY, NUMBER, OWN, block_window, sliced, surrounding_events, with_preceding
from gritstone.operators.readings import with_tag
from gritstone.schemas import VIBRATION_FEATURE_COLUMNS
from gritstone.session import materialize

WEEK = 7 * DAY
SENSOR_KEYS = ["asset_id", "sensor_no"]


def vib_stats_10m(readings: DataFrame, tags: DataFrame, grain: str = "10 minutes") -> DataFrame:
    """Mean, sample deviation and count per asset, instrument, number and window."""
    wanted = tags.where(F.col("instrument_type").isin("VI", "VP", "VK"))
    good = readings.where(F.col("quality") == "GOOD").select("tag_id", "source_ts", "value")
    return (
        with_tag(good, wanted, ["asset_id", "instrument_type", "nominal"])
        .withColumn("sensor_no", F.regexp_extract("tag_id", "([0-9]+)$", 1))
        .groupBy(
            *SENSOR_KEYS, "instrument_type", "nominal", F.window("source_ts", grain).alias("_w")
        )
        .agg(
            F.avg("value").alias("av"), F.stddev("value").alias("sd"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            *SENSOR_KEYS, "instrument_type", "nominal", F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"), "av", "sd", "n",
        )
    )


def vib_triplet(stats: DataFrame) -> DataFrame:
    """RMS, peak and kurtosis of one sensor side by side; windows lacking one are dropped.

    One conditional aggregation instead of two self-joins.
    """
    def of(code: str, column: str) -> Column:
        return F.max(F.when(F.col("instrument_type") == code, F.col(column)))

    wide = stats.groupBy(*SENSOR_KEYS, "window_start", "window_end").agg(
        of("VI", "av").alias("rms_mm_s"), of("VP", "av").alias("peak_mm_s"),
        of("VK", "av").alias("kurtosis"), of("VI", "sd").alias("stddev_mm_s"),
        of("VI", "n").alias("sample_count"), of("VP", "n").alias("_vp"), of("VK", "n").alias("_vk"),
        of("VI", "nominal").alias("nominal"),
    )
    return wide.where(
        F.col("sample_count").isNotNull() & F.col("_vp").isNotNull() & F.col("_vk").isNotNull()
    ).select(
        "asset_id", "sensor_no", F.concat("asset_id", F.lit("-VI"), "sensor_no").alias("tag_id"),
        "window_start", "window_end", "rms_mm_s", "peak_mm_s",
        F.try_divide("peak_mm_s", "rms_mm_s").alias("crest_factor"), "kurtosis", "stddev_mm_s",
        "sample_count", percent(F.col("rms_mm_s"), F.col("nominal")).alias("rms_pct_of_baseline"),
    )


def context_10m(readings: DataFrame, tags: DataFrame, grain: str = "10 minutes") -> DataFrame:
    """Mean temperature, motor current and throughput per asset and window."""
    wanted = tags.where(F.col("instrument_type").isin("TI", "II", "WI"))
    good = readings.where(F.col("quality") == "GOOD").select("tag_id", "source_ts", "value")

    def mean_of(code: str) -> Column:
        return F.avg(F.when(F.col("instrument_type") == code, F.col("value")))

    return (
        with_tag(good, wanted, ["asset_id", "instrument_type"])
        .groupBy("asset_id", F.window("source_ts", grain).alias("_w"))
        .agg(
            mean_of("TI").alias("bearing_temp_c"), mean_of("II").alias("motor_current_a"),
            mean_of("WI").alias("throughput_tph"),
        )
        .select(
            "asset_id", F.col("_w.start").alias("window_start"), "bearing_temp_c",
            "motor_current_a", "throughput_tph",
        )
    )


def rms_trends(features: DataFrame, short_lag: int = 6, long_lag: int = 144, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """RMS change over both lags and the slope per day over the trailing ``long_lag`` windows.

    Lags count rows, not time. The features are read twice: pass a stored table.
    """
    blocks = with_preceding(sliced(features, "window_start", WEEK), ["tag_id"], ["window_start"], max(short_lag, long_lag), block_rows)
    over_time = block_window(["tag_id"])
    trailing = over_time.rowsBetween(-(long_lag - 1), 0)
    rms = F.col("rms_mm_s")
    slope = F.regr_slope(rms, epoch_seconds("window_start")).over(trailing) * F.lit(86400.0)
    return blocks.select(
        *features.columns, OWN, (rms - F.lag(rms, short_lag).over(over_time)).alias("rms_delta_1h"),
        (rms - F.lag(rms, long_lag).over(over_time)).alias("rms_delta_24h"),
        F.when(F.count(rms).over(trailing) >= 2, slope).alias("rms_slope_24h"),
    ).where(OWN).drop(OWN)


def vibration_features_10m(
    readings: DataFrame, tags: DataFrame, run_minutes: DataFrame, grain: str = "10 minutes",
    short_lag: int = 6, long_lag: int = 144,
) -> DataFrame:
    """The 21-column live feature row; maintenance hours and label exist only in hindsight."""
    triplet = vib_triplet(vib_stats_10m(readings, tags, grain))
    joined = triplet.join(
        context_10m(readings, tags, grain), ["asset_id", "window_start"], "left"
    ).join(run_minutes, ["asset_id", "window_start"], "left")
    return rms_trends(materialize(joined), short_lag, long_lag).withColumns({
        "hours_since_maintenance": F.lit(None).cast("double"),
        "iso_10816_zone": iso_zone("rms_mm_s"),
        "label_failure_30d": F.lit(None).cast("boolean"),
    }).select(*VIBRATION_FEATURE_COLUMNS)


def trend_history(
    features: DataFrame, short_rows: int = 6, long_rows: int = 144, base_rows: int = 1008, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """History variant: change against the first row of each frame, slope per hour, own baseline.

    The features are read twice: pass a stored table.
    """
    series = sliced(features.select("tag_id", "window_start", "rms_mm_s"), "window_start", WEEK)
    blocks = with_preceding(series, ["tag_id"], ["window_start"], max(short_rows, long_rows, base_rows), block_rows)
    over_time = block_window(["tag_id"])
    rms = F.col("rms_mm_s")
    # Rows numbered up to the longest frame all lie in a key's first block, whose first row is the first of the series.
    first = F.first(rms).over(over_time.rowsBetween(Window.unboundedPreceding, 0))

    def first_of(rows: int) -> Column:
        """First value of a frame of ``rows`` preceding rows, clipped at the series start."""
        return F.when(F.col(NUMBER) > rows, F.lag(rms, rows).over(over_time)).otherwise(first)

    short, long = rms - first_of(short_rows), rms - first_of(long_rows)
    return blocks.select(
        "tag_id", "window_start", "rms_mm_s", OWN, short.alias("rms_delta_1h"),
        long.alias("rms_delta_24h"), (long / F.lit(24.0)).alias("rms_slope_24h"),
        percent(rms, F.avg(rms).over(over_time.rowsBetween(-base_rows, 0))).alias("rms_pct_of_baseline"),
    ).where(OWN).drop(OWN)


def _with_events(features: DataFrame, failures: DataFrame, slice_seconds: int) -> DataFrame:
    """Last failure at or before and next failure at or after each window, per tag."""
    return surrounding_events(features, failures, ["tag_id"], "window_start", "failed_at", "last_failure", "next_failure", slice_seconds)


def failure_labels(
    features: DataFrame, failures: DataFrame, horizon_days: float = 30.0, slice_seconds: int = WEEK,
) -> DataFrame:
    """Attach one failure per window (one within the horizon ahead, else the nearest) and label it."""
    dated = _with_events(features, failures, slice_seconds)
    day = F.lit(86400.0)
    now = epoch_seconds("window_start")
    ahead = (epoch_seconds("next_failure") - now) / day
    behind = (epoch_seconds("last_failure") - now) / day
    prefer_ahead = (
        (ahead <= horizon_days) | F.col("last_failure").isNull()
        | F.coalesce(ahead <= -behind, F.lit(False))
    )
    days = F.when(F.col("next_failure").isNotNull() & prefer_ahead, ahead).otherwise(behind)
    return dated.withColumn("days_to_fail", days).withColumn(
        "label_failure_30d",
        F.coalesce(F.col("days_to_fail").between(0.0, horizon_days), F.lit(False)),
    ).drop("last_failure", "next_failure")


def hours_since_reset(features: DataFrame, failures: DataFrame, slice_seconds: int = WEEK) -> DataFrame:
    """Hours since the last repair, or since the sensor's first window before any repair.

    Counted from the first window at or after the repair: one row per repair, found by a grouped minimum.
    """
    dated = materialize(_with_events(features, failures, slice_seconds))
    origin = dated.groupBy(F.col("tag_id").alias("_tag"), F.col("last_failure").alias("_repair")).agg(F.min("window_start").alias("_origin"))
    same = (F.col("tag_id") == F.col("_tag")) & F.col("last_failure").eqNullSafe(F.col("_repair"))
    hours = (epoch_seconds("window_start") - epoch_seconds("_origin")) / F.lit(3600.0)
    return dated.join(origin, same).withColumn("hours_since_maintenance", hours).select(*features.columns, "hours_since_maintenance")


def days_to_fail(features: DataFrame) -> DataFrame:
    """Days from each window to the last labelled window of its tag."""
    last = (
        features.where("label_failure_30d").groupBy("tag_id")
        .agg(F.max("window_start").alias("_fail"))
    )
    days = (epoch_seconds("_fail") - epoch_seconds("window_start")) / F.lit(86400.0)
    kept = [c for c in features.columns if c != "days_to_fail"]
    return features.select(*kept).join(last, "tag_id", "left").withColumn("days_to_fail", days).drop("_fail")


def failure_peaks(features: DataFrame) -> DataFrame:
    """Per failed sensor: when it failed and its highest values up to then."""
    last = (
        features.where("label_failure_30d").groupBy("tag_id")
        .agg(F.max("window_start").alias("failed_at"))
    )
    return (
        features.join(last, "tag_id")
        .where(F.col("window_start") <= F.col("failed_at"))
        .groupBy("asset_id", "tag_id", "failed_at")
        .agg(*_peaks())
    )


def labelled_peaks(features: DataFrame) -> DataFrame:
    """Highest values over labelled windows per asset."""
    return features.where("label_failure_30d").groupBy("asset_id").agg(*_peaks())


def _peaks() -> list[Column]:
    return [
        F.round(F.max("rms_mm_s"), 2).alias("peak_rms"),
        F.round(F.max("crest_factor"), 2).alias("peak_crest"),
        F.round(F.max("kurtosis"), 2).alias("peak_kurt"),
    ]


def label_profile(features: DataFrame) -> DataFrame:
    """Mean features of failing and healthy windows."""
    return features.groupBy("label_failure_30d").agg(
        F.count(F.lit(1)).alias("windows"), F.round(F.avg("rms_mm_s"), 2).alias("avg_rms"),
        F.round(F.avg("crest_factor"), 2).alias("avg_crest"),
        F.round(F.avg("kurtosis"), 2).alias("avg_kurt"),
        F.round(F.avg("bearing_temp_c"), 1).alias("avg_temp"),
    )


def phase_profile(
    features: DataFrame, bounds: tuple[float, float, float] = (12.0, 30.0, 60.0),
) -> DataFrame:
    """Mean features before, early in and late in the approach to a failure.

    Takes rows with ``days_to_fail``; a shared bound counts for the earlier name below.
    """
    late, early, base = bounds
    d = F.col("days_to_fail")
    phase = (
        F.when(d.between(late, early), "1 phase1")
        .when(d.between(0.0, late), "2 phase2")
        .when(d.between(early, base), "0 baseline")
    )
    return (
        features.withColumn("phase", phase).where(F.col("phase").isNotNull())
        .groupBy("phase")
        .agg(
            F.count(F.lit(1)).alias("windows"), F.round(F.avg("rms_mm_s"), 2).alias("avg_rms"),
            F.round(F.avg("crest_factor"), 2).alias("avg_crest"),
            F.round(F.avg("kurtosis"), 2).alias("avg_kurt"),
        )
    )
