"""Alarm episodes from rules held as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gritstone.functions.expressions import (
    alert_message, limit_class, micros, stable_id, two_decimals, whole_seconds,
)
from gritstone.functions.slices import BLOCK_ROWS, DAY, HOUR, OWN, SLICE, block_window, next_row, sliced, with_preceding, with_reach
from gritstone.operators.readings import with_tag
from gritstone.schemas import ALERT_COLUMNS
from gritstone.session import materialize

TAG_COLUMNS = ["asset_id", "asset_name", "asset_type", "area_code", "measure", "unit"]
LIMIT_COLUMNS = ["lo_lo", "lo", "hi", "hi_hi"]
EPISODE_KEYS = ["tag_id", "rule_type"]


def limit_breaches(readings: DataFrame, tags: DataFrame) -> DataFrame:
    """GOOD analog readings beyond a limit, classed as trip or warning."""
    analog = tags.where(F.col("value_class") == "analog")
    good = readings.where(F.col("quality") == "GOOD").select("tag_id", "source_ts", "seq", "value")
    classed = with_tag(good, analog, LIMIT_COLUMNS).withColumn("rule_type", limit_class())
    return classed.where(F.col("rule_type").isNotNull())


def alert_episodes(
    breaches: DataFrame, gap_seconds: int = 60, slice_seconds: int = HOUR,
) -> DataFrame:
    """Collapse breach samples: a new episode starts after a gap longer than ``gap_seconds``.

    Two steps, so a tag in permanent alarm is not one task's work: samples
    collapse to part-episodes inside each time slice, then the few parts of a
    tag are joined where the gap across the slice edge is short enough.
    """
    within = Window.partitionBy(*EPISODE_KEYS, SLICE).orderBy("source_ts", "seq")
    gap = whole_seconds(F.lag("source_ts").over(within), F.col("source_ts"))
    marked = sliced(breaches, seconds=slice_seconds).withColumn(
        "_new", F.when(gap.isNull() | (gap > gap_seconds), 1).otherwise(0)
    )
    numbered = marked.withColumn(
        "_part", F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    v = F.col("value")
    parts = numbered.groupBy(*EPISODE_KEYS, SLICE, "_part").agg(
        F.min("source_ts").alias("raised_at"), F.max("source_ts").alias("ended_at"),
        F.count(F.lit(1)).alias("samples"),
        F.max(F.when(v > F.col("hi"), v)).alias("peak_high"),
        F.min(F.when(v < F.col("lo"), v)).alias("peak_low"),
        *[F.max(c).alias(c) for c in LIMIT_COLUMNS],
    )
    # Parts of one tag lie at least gap_seconds or a slice edge apart, so there
    # are at most a few per covered minute.
    across = Window.partitionBy(*EPISODE_KEYS).orderBy("raised_at")
    apart = whole_seconds(F.lag("ended_at").over(across), F.col("raised_at"))
    joined = parts.withColumn(
        "_new", F.when(apart.isNull() | (apart > gap_seconds), 1).otherwise(0)
    ).withColumn("episode_no", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    return joined.groupBy(*EPISODE_KEYS, "episode_no").agg(
        F.min("raised_at").alias("raised_at"), F.max("ended_at").alias("ended_at"),
        F.sum("samples").alias("samples"), F.max("peak_high").alias("peak_high"),
        F.min("peak_low").alias("peak_low"), *[F.max(c).alias(c) for c in LIMIT_COLUMNS],
    )


def rules_by_tag(tags: DataFrame, rules: DataFrame) -> DataFrame:
    """All enabled rules that apply to each tag, through an equal key per scope.

    ``all OR asset_type OR measure OR tag`` becomes four scope keys per tag, so
    the match is an equi-join instead of a nested loop.
    """
    def scope(kind: str, value) -> "F.Column":
        return F.struct(F.lit(kind).alias("scope_type"), value.alias("scope_value"))

    scopes = F.array(
        scope("all", F.lit("")), scope("asset_type", F.col("asset_type")),
        scope("measure", F.col("measure")), scope("tag", F.col("tag_id")),
    )
    keyed = tags.select("tag_id", *TAG_COLUMNS, F.explode(scopes).alias("_s")).select(
        "tag_id", *TAG_COLUMNS, "_s.*"
    )
    enabled = rules.where("enabled").withColumn(
        "scope_value",
        F.when(F.col("scope_type") == "all", F.lit("")).otherwise(F.col("scope_value")),
    )
    return keyed.join(enabled, ["scope_type", "scope_value"])


def most_specific_rule(tags: DataFrame, rules: DataFrame) -> DataFrame:
    """One rule per (tag, rule type): tag before asset type or measure before all, then id.

    The choice depends on the tag alone, so it is made on the register and not
    once per episode.
    """
    rank = F.when(F.col("scope_type") == "tag", 0).when(F.col("scope_type") == "all", 2).otherwise(1)
    best_first = Window.partitionBy("tag_id", "rule_type").orderBy(rank, "rule_id")
    return materialize(
        rules_by_tag(tags, rules)
        .withColumn("_rn", F.row_number().over(best_first))
        .where(F.col("_rn") == 1)
        .select(
            "tag_id", "rule_type", *TAG_COLUMNS, "rule_id", "rule_name", "severity",
            "window_seconds", "message_template",
        )
    )


def matched_episodes(episodes: DataFrame, tags: DataFrame, rules: DataFrame) -> DataFrame:
    return episodes.join(most_specific_rule(tags, rules), EPISODE_KEYS).withColumn(
        "trigger_value", F.coalesce("peak_high", "peak_low")
    )


def alerts_from_episodes(
    matched: DataFrame, delivery_status: str = "DELIVERED",
) -> DataFrame:
    """Alert rows with filled message, limits by rule type and a repeatable id."""
    delivered = delivery_status == "DELIVERED"
    is_trip = F.col("rule_type") == "limit_trip"
    rows = matched.select(
        stable_id("tag_id", "rule_type", micros("raised_at")).alias("alert_id"), "raised_at", "tag_id",
        "asset_id", "area_code", F.lit(None).cast("string").alias("node_id"), "rule_id",
        "rule_name", "rule_type", "severity", "trigger_value",
        F.lit(None).cast("string").alias("trigger_text"),
        F.when(is_trip, F.col("lo_lo")).otherwise(F.col("lo")).alias("limit_low"),
        F.when(is_trip, F.col("hi_hi")).otherwise(F.col("hi")).alias("limit_high"),
        alert_message(
            F.col("message_template"), F.col("tag_id"), F.col("asset_name"),
            two_decimals(F.col("trigger_value")), F.col("unit"), F.lit(""),
        ).alias("message"),
        F.lit(delivery_status).alias("delivery_status"),
        F.lit(1 if delivered else 0).alias("delivery_attempts"),
        (F.col("ended_at") if delivered else F.lit(None).cast(matched.schema["ended_at"].dataType)).alias("delivered_at"),
        F.lit(200 if delivered else None).cast("int").alias("http_status"),
        F.lit(None).cast("string").alias("acknowledged_by"),
        F.lit(None).cast(matched.schema["raised_at"].dataType).alias("acknowledged_at"),
    )
    return rows.select(*ALERT_COLUMNS)


def derive_alerts(
    readings: DataFrame, tags: DataFrame, rules: DataFrame, gap_seconds: int = 60,
    slice_seconds: int = HOUR,
) -> DataFrame:
    """Readings to alerts: classify, collapse, match the most specific rule, fill the message."""
    episodes = alert_episodes(limit_breaches(readings, tags), gap_seconds, slice_seconds)
    return alerts_from_episodes(matched_episodes(episodes, tags, rules))


def rate_of_change(
    readings: DataFrame, tags: DataFrame, min_rise: float, measure: str | None = "temperature",
    window: str = "10 minutes", step: str = "1 minute",
) -> DataFrame:
    """Rise from the first to the last GOOD value of each sliding window.

    Readings collapse to one row per step first, so the overlap of the sliding
    windows multiplies the small rows and not the raw ones.
    """
    wanted = tags.where(F.col("measure") == measure) if measure else tags
    steps = (
        with_tag(readings.where(F.col("quality") == "GOOD"), wanted, ["asset_id", "asset_name"])
        .groupBy("tag_id", "asset_id", "asset_name", F.window("source_ts", step).alias("_s"))
        .agg(
            F.min("source_ts").alias("first_ts"), F.max("source_ts").alias("last_ts"),
            F.min_by("value", "source_ts").alias("first_value"),
            F.max_by("value", "source_ts").alias("last_value"),
        )
        .withColumn("step_start", F.col("_s.start"))
    )
    windows = steps.groupBy(
        "tag_id", "asset_id", "asset_name", F.window("step_start", window, step).alias("_w")
    ).agg(
        F.min_by("first_value", "first_ts").alias("first_value"),
        F.max_by("last_value", "last_ts").alias("last_value"),
    )
    rise = F.col("last_value") - F.col("first_value")
    return windows.select(
        "tag_id", "asset_id", "asset_name", F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"), "first_value", "last_value", rise.alias("rise"),
    ).where(F.col("rise") > min_rise)


def stale_tags(
    readings: DataFrame, tags: DataFrame, horizon: str, stale_seconds: int = 120,
    measure: str | None = "mass_flow", slice_seconds: int = HOUR, since: str | None = None,
) -> DataFrame:
    """Silences of at least ``stale_seconds``; ``horizon`` closes the last one of each tag.

    The register is watched from ``since`` on: a tag that has not spoken by then is silent from there until its first
    reading, and one that never speaks until the horizon; ``last_seen`` is NULL in both. Without ``since`` the watch of
    a tag begins with its first reading, and a tag without readings has none.

    The readings are read once. Inside a slice a silence is seen at once; only the first and last
    rows of the slices and the silences go on to the step across slices.
    """
    wanted = tags.where(F.col("measure") == measure) if measure else tags
    samples = sliced(with_tag(readings.select("tag_id", "source_ts", "seq"), wanted, []), seconds=slice_seconds)
    ts_type = readings.schema["source_ts"].dataType
    order = ["source_ts", "seq"]
    inside = Window.partitionBy("tag_id", SLICE).orderBy(*order)
    ends = samples.select(
        "tag_id", SLICE, *order, F.lag("source_ts").over(inside).alias("_before"), F.lead("source_ts").over(inside).alias("_after"),
    ).where(
        F.col("_before").isNull() | F.col("_after").isNull() | (whole_seconds(F.col("source_ts"), F.col("_after")) >= stale_seconds)
    ).select("tag_id", *order, "_after")
    if since is not None:
        start = F.lit(since).cast(ts_type)
        seq_type = readings.schema["seq"].dataType
        watched = wanted.select("tag_id", F.lit(None).cast(ts_type).alias("source_ts"), F.lit(None).cast(seq_type).alias("seq"), F.lit(None).cast(ts_type).alias("_after"))
        ends = ends.unionByName(watched)
    across = Window.partitionBy("tag_id").orderBy(*order)  # a few rows per slice; a row of the register sorts first
    next_ts = F.coalesce("_after", F.lead("source_ts").over(across))
    followed = ends.select("tag_id", "source_ts", next_ts.alias("next_ts"))
    begun = F.coalesce("source_ts", start) if since is not None else F.col("source_ts")
    silent = whole_seconds(begun, F.coalesce("next_ts", F.lit(horizon).cast(ts_type)))
    return with_tag(followed.withColumn("silent_seconds", silent).where(F.col("silent_seconds") >= stale_seconds), wanted, ["asset_id", "asset_name"]).select(
        "tag_id", "asset_id", "asset_name", F.col("source_ts").alias("last_seen"), "next_ts", "silent_seconds")


def running_empty(
    equipment: DataFrame, tags: DataFrame, asset_type: str | None = "conveyor", seconds: int = 60,
    grain_seconds: int = 60, slice_seconds: int = DAY,
) -> DataFrame:
    """Assets RUNNING whose flow stays below the low limit for ``seconds``."""
    chosen = tags.where(F.col("asset_type") == asset_type) if asset_type else tags
    belts = chosen.where(F.col("instrument_type") == "WI").groupBy("asset_id").agg(F.max("asset_name").alias("asset_name"), F.min("lo").alias("lo"))
    needed = max(1, -(-seconds // grain_seconds))
    reach = (needed - 1) * grain_seconds
    recent = Window.partitionBy("asset_id", SLICE).orderBy(F.unix_seconds(F.col("window_start").cast("timestamp"))).rangeBetween(-reach, 0)
    empty = (F.col("state") == "RUNNING") & (F.col("throughput_tph") < F.col("lo"))
    return (
        with_reach(equipment.join(belts, "asset_id"), "window_start", reach, slice_seconds)
        .withColumn("_empty", F.count_if(empty).over(recent))
        .where(OWN).where(F.col("_empty") >= needed)
        .select("asset_id", "asset_name", "window_start", "window_end", "throughput_tph", "lo")
    )


def imbalance_sustained(
    balance: DataFrame, windows: int = 5, threshold_pct: float = 5.0, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Nodes whose mean imbalance over the last ``windows`` windows exceeds the threshold.

    Windows are counted, not timed. The unit rows are stored: numbering them and cutting them into blocks reads them twice.
    """
    units = materialize(balance.where(F.col("balance_role") == "unit").select("node_id", "window_start", "window_end", "imbalance_pct"))
    blocks = with_preceding(sliced(units, "window_start", DAY), ["node_id"], ["window_start"], windows - 1, block_rows)
    recent = block_window(["node_id"]).rowsBetween(-(windows - 1), 0)
    return (
        blocks.select(
            "node_id", "window_start", "window_end", OWN,
            F.avg("imbalance_pct").over(recent).alias("mean_imbalance_pct"),
            F.count("imbalance_pct").over(recent).alias("windows_counted"),
        )
        .where(OWN).drop(OWN)
        .where((F.col("windows_counted") == windows) & (F.abs("mean_imbalance_pct") > threshold_pct))
    )


def quality_breaches(readings: DataFrame, tags: DataFrame) -> DataFrame:
    """Readings whose quality is not GOOD, ready for the quality rules."""
    bad = readings.where(F.col("quality") != "GOOD")
    return bad.join(tags.select("tag_id"), "tag_id", "left_semi").withColumn(
        "rule_type", F.lit("quality")
    )


TIMED_RULES = ["rate_of_change", "stale", "deviation", "imbalance"]


def timed_rule_alerts(
    readings: DataFrame, tags: DataFrame, rules: DataFrame, equipment: DataFrame,
    balance: DataFrame, horizon: str, min_rise: float, max_imbalance_pct: float = 5.0,
    grain_seconds: int = 60, slice_seconds: int = HOUR,
) -> DataFrame:
    """Alerts of the rules that look at a stretch of time, for whatever their scope covers.

    One detection per kind of rule and length of time, over all tags that such rules
    apply to; its rows then meet their rules by tag (asset for ``deviation``, every
    node for ``imbalance``). ``equipment`` and ``balance`` are the per-window datasets of the same grain.
    """
    wanted = rules.where(F.col("enabled") & F.col("rule_type").isin(TIMED_RULES))
    described = ["rule_id", "rule_name", "rule_type", "severity", "message_template", "window_seconds"]
    applies = materialize(rules_by_tag(tags, wanted).select("tag_id", "asset_id", *described).distinct())
    nobody = F.lit(None).cast("string")

    def detected(kind: str, seconds: int) -> DataFrame:
        own = applies.where((F.col("rule_type") == kind) & (F.col("window_seconds") == seconds))
        watched = tags.join(own.select("tag_id").distinct(), "tag_id", "left_semi")
        told = own.select("tag_id", *described)
        if kind == "rate_of_change":
            found = rate_of_change(readings, watched, min_rise, None, f"{seconds} seconds", f"{grain_seconds} seconds")
            return found.join(told, "tag_id").select("tag_id", "asset_id", "asset_name", nobody.alias("node_id"), F.col("window_end").alias("raised_at"), F.col("rise").alias("trigger_value"), *described)
        if kind == "stale":
            found = stale_tags(readings, watched, horizon, seconds, None, slice_seconds)
            since = F.col("last_seen") + F.expr(f"INTERVAL {int(seconds)} SECONDS")
            return found.join(told, "tag_id").select("tag_id", "asset_id", "asset_name", nobody.alias("node_id"), since.alias("raised_at"), F.col("silent_seconds").cast("double").alias("trigger_value"), *described)
        if kind == "deviation":
            assets = own.select("asset_id", *described).distinct()
            belts = tags.join(assets.select("asset_id").distinct(), "asset_id", "left_semi")
            found = running_empty(equipment, belts, None, seconds, grain_seconds).join(assets, "asset_id")
            return found.select(nobody.alias("tag_id"), "asset_id", "asset_name", nobody.alias("node_id"), F.col("window_start").alias("raised_at"), F.col("throughput_tph").alias("trigger_value"), *described)
        every = wanted.where((F.col("rule_type") == kind) & (F.col("window_seconds") == seconds)).select(*described)
        found = imbalance_sustained(balance, max(1, seconds // grain_seconds), max_imbalance_pct)
        met = found.withColumn("_kind", F.lit(kind)).join(every, F.col("_kind") == F.col("rule_type"))
        return met.select(nobody.alias("tag_id"), nobody.alias("asset_id"), nobody.alias("asset_name"), "node_id", F.col("window_end").alias("raised_at"), F.col("mean_imbalance_pct").alias("trigger_value"), *described)

    kinds = wanted.select("rule_type", "window_seconds").distinct().orderBy("rule_type", "window_seconds").collect()
    if not kinds:
        raise ValueError("no enabled rule looks at a stretch of time")
    found = reduce(DataFrame.unionByName, [detected(row["rule_type"], row["window_seconds"]) for row in kinds])
    ts_type = found.schema["raised_at"].dataType
    return found.select(
        stable_id(F.col("rule_id"), F.coalesce("tag_id", "asset_id", "node_id"), micros("raised_at")).alias("alert_id"),
        "raised_at", "tag_id", "asset_id", F.element_at(F.split("asset_id", "-"), 1).alias("area_code"), "node_id",
        "rule_id", "rule_name", "rule_type", "severity", "trigger_value", nobody.alias("trigger_text"),
        F.lit(None).cast("double").alias("limit_low"), F.lit(None).cast("double").alias("limit_high"),
        alert_message(
            F.col("message_template"), F.col("tag_id"), F.col("asset_name"), two_decimals(F.col("trigger_value")),
            F.lit(""), F.col("node_id"),
        ).alias("message"),
        F.lit("PENDING").alias("delivery_status"), F.lit(0).alias("delivery_attempts"),
        F.lit(None).cast(ts_type).alias("delivered_at"), F.lit(None).cast("int").alias("http_status"),
        nobody.alias("acknowledged_by"), F.lit(None).cast(ts_type).alias("acknowledged_at"),
    ).select(*ALERT_COLUMNS)
