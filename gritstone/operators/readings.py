"""Per-tag operators on raw readings: aggregates, snapshots, overlays and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.functions.expressions import good_only, percent
from gritstone.functions.slices import HOUR, last_known, sliced


def with_tag(readings: DataFrame, tags: DataFrame, columns: list[str]) -> DataFrame:
    """Attach register columns. The register is small; the optimizer broadcasts it by size."""
    return readings.join(tags.select("tag_id", *columns), "tag_id")


def tag_reading_1m(readings: DataFrame, grain: str = "1 minute") -> DataFrame:
    """Per tag and window: statistics of GOOD values, first and last of any quality, counts."""
    good = good_only()
    is_good = F.col("quality") == "GOOD"
    return (
        readings.groupBy("tag_id", F.window("source_ts", grain).alias("_w"))
        .agg(
            F.avg(good).alias("avg_value"),
            F.min(good).alias("min_value"),
            F.max(good).alias("max_value"),
            F.stddev(good).alias("stddev_value"),
            F.min_by("value", "source_ts").alias("first_value"),
            F.max_by("value", "source_ts").alias("last_value"),
            F.count(F.lit(1)).alias("sample_count"),
            F.count_if(is_good).alias("good_count"),
        )
        .select(
            "tag_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
            "avg_value", "min_value", "max_value", "stddev_value", "first_value", "last_value",
            "sample_count", "good_count",
            percent(F.col("good_count"), F.col("sample_count")).alias("good_pct"),
        )
    )


def snapshot_as_of(readings: DataFrame, at: str, lookback_seconds: int = 1800) -> DataFrame:
    """Newest reading per tag in ``(at - lookback, at]``, ties by ``seq``.

    The time bound reaches the scan, so only the files of the look-back are read.
    """
    ts_type = readings.schema["source_ts"].dataType
    upper = F.lit(at).cast(ts_type)
    recent = readings.where(
        (F.col("source_ts") > upper - F.expr(f"INTERVAL {int(lookback_seconds)} SECONDS"))
        & (F.col("source_ts") <= upper)
    )
    rest = [c for c in readings.columns if c != "tag_id"]
    newest = recent.groupBy("tag_id").agg(
        F.max_by(F.struct(*rest), F.struct("source_ts", "seq")).alias("_row")
    )
    return newest.select("tag_id", *[f"_row.{c}" for c in rest])


def override_values(readings: DataFrame, factors: DataFrame) -> DataFrame:
    """Multiply values of tags listed in ``factors(tag_id, multiplier)``."""
    return (
        readings.join(factors.select("tag_id", "multiplier"), "tag_id", "left")
        .withColumn("value", F.col("value") * F.coalesce("multiplier", F.lit(1.0)))
        .drop("multiplier")
    )


def disjoint_segments(intervals: DataFrame) -> DataFrame:
    """Turn overlapping intervals of a tag into segments that never overlap.

    At each instant the interval that started last applies; once it ends, the
    open interval with the latest end does. Works on the interval table only.
    """
    payload = F.struct("value", "quality")
    by_start = Window.partitionBy("tag_id").orderBy("t_start", "t_end")
    so_far = by_start.rowsBetween(Window.unboundedPreceding, 0)
    ordered = intervals.select(
        "tag_id", "t_start", "t_end", payload.alias("_own"),
        F.lead("t_start").over(by_start).alias("_next"),
        F.max("t_end").over(so_far).alias("_cover_end"),
        F.max_by(payload, F.struct("t_end", "t_start")).over(so_far).alias("_cover"),
    )
    segments = ordered.select(
        "tag_id", "_next",
        F.explode(
            F.array(
                F.struct(
                    F.col("t_start").alias("s"), F.lit(True).alias("closed"),
                    F.col("t_end").alias("e"), F.col("_own").alias("p"),
                ),
                F.struct(
                    F.col("t_end").alias("s"), F.lit(False).alias("closed"),
                    F.col("_cover_end").alias("e"), F.col("_cover").alias("p"),
                ),
            )
        ).alias("g"),
    )
    return segments.where(
        ((F.col("g.s") < F.col("g.e")) | (F.col("g.closed") & (F.col("g.s") == F.col("g.e"))))
        & (F.col("_next").isNull() | (F.col("g.s") < F.col("_next")))
    ).select(
        "tag_id", F.col("g.s").alias("seg_start"), F.col("g.closed").alias("seg_closed"),
        F.col("g.e").alias("seg_end"), F.col("_next").alias("seg_before"),
        F.col("g.p.value").alias("seg_value"), F.col("g.p.quality").alias("seg_quality"),
    )


#: Cells of level k are RADIX ** k slices wide. With hours the widest cells span two centuries; longer intervals take several.
RADIX, LEVELS = 8, 8


def covering_cells(first: Column, last: Column) -> Column:
    """The fewest aligned cells that tile the slices first..last, as an array of (level, cell).

    At each level what the next one cannot take is left at both ends: less than RADIX cells a side, so an interval of
    n slices has at most 2 * (RADIX - 1) * log(n) cells. Ten years of hours are fewer than 100.
    """
    def cells(level: Column) -> Column:
        width = F.pow(F.lit(float(RADIX)), level)
        start, end = F.ceil(first / width), F.floor((last + 1) / width)
        above, above_end = F.ceil(first / (width * RADIX)) * RADIX, F.floor((last + 1) / (width * RADIX)) * RADIX
        taken = (above < above_end) & (level < LEVELS - 1)
        none = F.array().cast("array<bigint>")
        left = F.when(taken & (start < above), F.sequence(start, above - 1)).when(~taken & (start < end), F.sequence(start, end - 1)).otherwise(none)
        right = F.when(taken & (above_end < end), F.sequence(above_end, end - 1)).otherwise(none)
        return F.transform(F.concat(left, right), lambda c: F.struct(level.alias("level"), c.alias("cell")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), cells))


def overlay_intervals(readings: DataFrame, intervals: DataFrame, slice_seconds: int = HOUR) -> DataFrame:
    """Force value and quality inside ``intervals(tag_id, t_start, t_end, value, quality)``.

    A NULL override leaves the column alone. Segments are disjoint, so only the one that started last can hold a
    reading. Readings and starts of segments of a (tag, slice) are ordered together and a slice knows the last start
    before it, so readings are moved once and never meet segments in pairs, however many there are in a slice.
    """
    ts_type = readings.schema["source_ts"].dataType
    segments = disjoint_segments(intervals).where(F.col("tag_id").isNotNull() & F.col("seg_start").isNotNull())
    segment = F.struct("seg_end", "seg_before", "seg_value", "seg_quality")
    # At one moment a segment that holds its start comes before the readings, one that does not after them.
    marks = segments.select(
        "tag_id", F.col("seg_start").cast(ts_type).alias("_t"), F.when(F.col("seg_closed"), 0).otherwise(2).alias("_kind"),
        segment.alias("_seg"), F.lit(None).cast(readings.schema).alias("_row"))
    rows = readings.select(
        "tag_id", F.col("source_ts").alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema["_seg"].dataType).alias("_seg"),
        F.struct("*").alias("_row"))
    both = sliced(rows.unionByName(marks), "_t", slice_seconds)
    found = last_known(both, ["tag_id"], ["_t", "_kind"], "_seg", "_met").where(F.col("_row").isNotNull())
    inside = (F.col("_t") <= F.col("_met.seg_end")) & (F.col("_met.seg_before").isNull() | (F.col("_t") < F.col("_met.seg_before")))
    overridden = {
        c: F.coalesce(F.when(inside, F.col(f"_met.seg_{c}")), F.col(f"_row.{c}")).alias(c) for c in ("value", "quality")}
    return found.select(*[overridden.get(c, F.col("_row")[c].alias(c)) for c in readings.columns])


def quality_distribution(readings: DataFrame) -> DataFrame:
    """Count and share per quality. The share is taken over the few aggregated rows."""
    counts = readings.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    return counts.select(
        "quality", "n",
        F.round(percent(F.col("n"), F.sum("n").over(everything)), 3).alias("pct"),
    )


def breach_counts(readings: DataFrame, tags: DataFrame) -> DataFrame:
    """Trip and warning breach rows and breaching tags; warning bands include their ends."""
    limits = with_tag(
        readings.select("tag_id", "value"),
        tags.where(F.col("value_class") == "analog"), ["lo_lo", "lo", "hi", "hi_hi"],
    )
    v = F.col("value")
    trip = (v > F.col("hi_hi")) | (v < F.col("lo_lo"))
    warn = v.between(F.col("hi"), F.col("hi_hi")) | v.between(F.col("lo_lo"), F.col("lo"))
    out = (v > F.col("hi")) | (v < F.col("lo"))
    per_tag = limits.groupBy("tag_id").agg(
        F.count_if(trip).alias("trip"), F.count_if(warn).alias("warn"), F.max(out).alias("out")
    )
    return per_tag.agg(
        F.sum("trip").alias("trip_breaches"), F.sum("warn").alias("warn_breaches"),
        F.count_if("out").alias("tags_excursed"),
    )


def table_profile(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows, distinct tags and covered time per named (table, start column, end column)."""
    parts = [
        df.groupBy("tag_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("mn"), F.max(end).alias("mx"))
        .agg(
            F.sum("n").alias("row_count"), F.count("tag_id").alias("tags"),
            F.min("mn").alias("first_ts"), F.max("mx").alias("last_ts"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "tags", "first_ts", "last_ts")
        for name, (df, start, end) in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def fresh_count(readings: DataFrame, now: str, minutes: int = 30) -> DataFrame:
    """Rows newer than ``now`` minus some minutes."""
    bound = F.lit(now).cast(readings.schema["source_ts"].dataType)
    return readings.where(
        F.col("source_ts") >= bound - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    ).agg(F.count(F.lit(1)).alias("rows_recent"))


def asset_panel(tags: DataFrame, asset_id: str) -> DataFrame:
    """Alarm limits of every instrument of one asset."""
    return (
        tags.where(F.col("asset_id") == asset_id)
        .select(
            "tag_id", "asset_name", "area_name", "measure", "instrument_type", "unit", "nominal",
            F.col("lo_lo").alias("trip_low"), F.col("lo").alias("warn_low"),
            F.col("hi").alias("warn_high"), F.col("hi_hi").alias("trip_high"), "is_pdm",
        )
        .orderBy("instrument_type", "tag_id")
    )
