"""The plant's streaming jobs. State lives on the executors; nothing is collected.

Event time must be TIMESTAMP: a watermark on TIMESTAMP_NTZ is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gritstone.functions.expressions import alert_message, limit_class, stable_id, two_decimals
from gritstone.operators.alerts import LIMIT_COLUMNS, most_specific_rule
from gritstone.operators.readings import tag_reading_1m, with_tag
from gritstone.schemas import ALERT_COLUMNS
from gritstone.sources.upsert import upsert


def event_time(readings: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Readings with their sample time as a watermarked TIMESTAMP."""
    return readings.withColumn("source_ts", F.col("source_ts").cast("timestamp")).withWatermark(
        "source_ts", delay
    )


def _query_id(batch: DataFrame) -> str:
    """The id that a stream keeps in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def deduplicated(readings: DataFrame) -> DataFrame:
    """Drop repeats of an event id; state is kept only as long as the watermark."""
    return readings.dropDuplicatesWithinWatermark(["event_id"])


def stream_tag_1m(readings: DataFrame, grain: str = "1 minute") -> DataFrame:
    """The batch minute aggregate on a watermarked stream: a window is emitted once closed."""
    return tag_reading_1m(readings, grain)


def stream_current(readings: DataFrame, path: str, checkpoint: str):
    """Keep the newest reading per tag; a late row never replaces a newer one.

    A micro-batch rewrites only the partitions of the tags it holds. The newest ``seq`` wins whatever
    comes twice, so a replayed batch or a stream with a new checkpoint leaves the same table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        upsert(batch, path, ["tag_id"], by=["seq"])
        batch.unpersist()

    return readings.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint
    ).foreachBatch(write)


def stream_limit_alerts(readings: DataFrame, tags: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per reading that breaks a limit or quality rule: a stateless stream-static join."""
    limits = tags.select("tag_id", "value_class", *LIMIT_COLUMNS)
    broken = F.when(F.col("quality") != "GOOD", "quality").when(
        F.col("value_class") == "analog", limit_class()
    )
    columns = ["event_id", "tag_id", "source_ts", "value", "quality"]
    classed = readings.select(*columns).join(limits, "tag_id").withColumn("rule_type", broken).where(
        F.col("rule_type").isNotNull()
    )
    matched = classed.join(most_specific_rule(tags, rules), ["tag_id", "rule_type"])
    is_quality = F.col("rule_type") == "quality"
    is_trip = F.col("rule_type") == "limit_trip"
    shown = F.when(is_quality, F.col("quality")).otherwise(two_decimals(F.col("value")))
    return matched.select(
        stable_id("event_id", "rule_id").alias("alert_id"), F.col("source_ts").alias("raised_at"),
        "tag_id", "asset_id", "area_code", F.lit(None).cast("string").alias("node_id"), "rule_id",
        "rule_name", "rule_type", "severity",
        F.when(~is_quality, F.col("value")).alias("trigger_value"),
        F.when(is_quality, F.col("quality")).alias("trigger_text"),
        F.when(is_trip, F.col("lo_lo")).when(~is_quality, F.col("lo")).alias("limit_low"),
        F.when(is_trip, F.col("hi_hi")).when(~is_quality, F.col("hi")).alias("limit_high"),
        alert_message(
            F.col("message_template"), F.col("tag_id"), F.col("asset_name"), shown,
            F.when(is_quality, F.lit("")).otherwise(F.col("unit")), F.lit(""),
        ).alias("message"),
        F.lit("PENDING").alias("delivery_status"), F.lit(0).alias("delivery_attempts"),
        F.lit(None).cast("timestamp").alias("delivered_at"),
        F.lit(None).cast("int").alias("http_status"),
        F.lit(None).cast("string").alias("acknowledged_by"),
        F.lit(None).cast("timestamp").alias("acknowledged_at"),
    ).select(*ALERT_COLUMNS)


def stream_rate_of_change(
    readings: DataFrame, tags: DataFrame, measure: str = "temperature",
    window: str = "10 minutes", step: str = "1 minute",
) -> DataFrame:
    """Rise within each sliding window; filter ``rise`` on the way to the sink.

    Readings collapse to one row per step first, so the overlap of the windows multiplies steps and not readings. In
    append mode a step leaves its state once the watermark has passed it, and so does a window.
    """
    wanted = tags.where(F.col("measure") == measure)
    good = with_tag(readings.where(F.col("quality") == "GOOD"), wanted, ["asset_id"])
    steps = good.groupBy("tag_id", "asset_id", F.window("source_ts", step).alias("_step")).agg(
        F.min("source_ts").alias("_first_ts"), F.max("source_ts").alias("_last_ts"),
        F.min_by("value", "source_ts").alias("_first"), F.max_by("value", "source_ts").alias("_last"),
    )
    ends = steps.groupBy("tag_id", "asset_id", F.window(F.window_time("_step"), window, step).alias("_w")).agg(
        F.min_by("_first", "_first_ts").alias("first_value"), F.max_by("_last", "_last_ts").alias("last_value"),
    )
    return ends.select(
        "tag_id", "asset_id", F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"), "first_value", "last_value",
        (F.col("last_value") - F.col("first_value")).alias("rise"),
    )


def _just_under(seconds: int) -> str:
    """A session gap one microsecond short: sessions that touch at their gap are merged."""
    return f"{int(seconds) - 1} seconds 999999 microseconds"


def stream_episodes(readings: DataFrame, tags: DataFrame, gap_seconds: int = 60) -> DataFrame:
    """Alarm episodes as sessions.

    The batch rule starts a new episode after more than ``gap_seconds`` whole
    seconds, which is at least one second more.
    """
    analog = tags.where(F.col("value_class") == "analog")
    classed = with_tag(
        readings.where(F.col("quality") == "GOOD"), analog, LIMIT_COLUMNS
    ).withColumn("rule_type", limit_class()).where(F.col("rule_type").isNotNull())
    v = F.col("value")
    return classed.groupBy(
        "tag_id", "rule_type",
        F.session_window("source_ts", _just_under(gap_seconds + 1)).alias("_s"),
    ).agg(
        F.min("source_ts").alias("raised_at"), F.max("source_ts").alias("ended_at"),
        F.count(F.lit(1)).alias("samples"),
        F.max(F.when(v > F.col("hi"), v)).alias("peak_high"),
        F.min(F.when(v < F.col("lo"), v)).alias("peak_low"),
    ).drop("_s")


def stream_alert_sink(alerts: DataFrame, path: str, checkpoint: str):
    """Append alerts as PENDING to the outbox; ids repeat on replay, so readers see one each.

    Each micro-batch of each stream owns one folder and overwrites it when replayed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates(["alert_id"]).write.mode("overwrite").parquet(
            f"{path}/stream={_query_id(batch)}/batch={batch_id}")

    return alerts.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint
    ).foreachBatch(write)
