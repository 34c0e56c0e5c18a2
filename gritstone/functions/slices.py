"""Ordered operations over long series, split by time so no key needs one task.

A plain window function partitioned by tag puts all readings of a tag in one
task, and one tag may hold a third of all rows. Here each series is cut into
slices of its ordering column. The window runs per (key, slice); what has to
cross a slice edge is one row per (key, slice), carried over with a second,
tiny window and joined back on the same (key, slice) the data is already
partitioned by. Results equal the plain window.

Keys must not be NULL. ``order`` must be total within a key for repeatable
results and must sort in slice order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.functions.expressions import micros

SLICE = "_slice"
NUMBER, BLOCK, OWN = "_number", "_block", "_is_own"
HOUR, DAY = 3600, 86400
BLOCK_ROWS = 4096


def sliced(df: DataFrame, ts: str = "source_ts", seconds: int = HOUR) -> DataFrame:
    """Add the slice number of a timestamp column."""
    return df.withColumn(SLICE, F.floor(micros(ts) / F.lit(seconds * 1_000_000)))


def sliced_by_number(df: DataFrame, number: str, width: int) -> DataFrame:
    """Add the slice number of an integer ordering column."""
    return df.withColumn(SLICE, F.floor(F.col(number) / F.lit(width)))


def adjacent_rows(
    df: DataFrame, keys: list[str], order: list[str], previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Like ``lag(col, 1)`` and ``lead(col, 1)``; each map goes from source to output column.

    Both directions share one edge aggregation, so the input is read twice in all.
    """
    wanted = {
        "_prev": (previous or {}, F.max_by, F.lag), "_next": (following or {}, F.min_by, F.lead),
    }
    wanted = {name: spec for name, spec in wanted.items() if spec[0]}

    def fields(cols: dict[str, str]) -> Column:
        return F.struct(*[F.col(c) for c in cols])

    position = F.struct(*order)
    edge = df.groupBy(*keys, SLICE).agg(*[
        pick(fields(cols), position).alias(name) for name, (cols, pick, _) in wanted.items()
    ])
    carry = edge.select(*keys, SLICE, *[
        shift(name, 1).over(_across(keys)).alias(f"{name}_carry")
        for name, (_, _, shift) in wanted.items()
    ])
    local = df.select("*", *[
        shift(fields(cols), 1).over(_within(keys, order)).alias(f"{name}_local")
        for name, (cols, _, shift) in wanted.items()
    ])
    joined = local.join(carry, [*keys, SLICE], "left").withColumns({
        name: F.coalesce(f"{name}_local", f"{name}_carry") for name in wanted
    })
    return joined.select(*df.columns, *[
        F.col(f"{name}.{c}").alias(out)
        for name, (cols, _, _) in wanted.items() for c, out in cols.items()
    ])


def previous_row(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str]) -> DataFrame:
    return adjacent_rows(df, keys, order, previous=cols)


def next_row(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str]) -> DataFrame:
    return adjacent_rows(df, keys, order, following=cols)


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Like ``sum(value)`` over all rows up to and including the current one."""
    inner = _within(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    totals = df.groupBy(*keys, SLICE).agg(F.sum(value).alias("_total"))
    before = totals.select(
        *keys, SLICE,
        F.sum("_total").over(_across(keys).rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
    )
    local = df.withColumn("_local", F.sum(value).over(inner))
    return (
        local.join(before, [*keys, SLICE], "left")
        .withColumn(out, F.coalesce("_before", F.lit(0)) + F.coalesce("_local", F.lit(0)))
        .drop("_local", "_before")
    )


def last_known(df: DataFrame, keys: list[str], order: list[str], payload: str, out: str) -> DataFrame:
    """Like ``last(payload, ignoreNulls)`` up to the current row: the as-of value."""
    inner = _within(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        df.where(F.col(payload).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(F.max_by(payload, F.struct(*order)).alias("_edge"))
    )
    # Slices without a payload still need the carried value, so every slice is listed.
    spine = df.select(*keys, SLICE).distinct().join(edge, [*keys, SLICE], "left")
    carry = spine.select(
        *keys, SLICE,
        F.last("_edge", ignorenulls=True)
        .over(_across(keys).rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
    )
    local = df.withColumn("_local", F.last(payload, ignorenulls=True).over(inner))
    return (
        local.join(carry, [*keys, SLICE], "left")
        .withColumn(out, F.coalesce("_local", "_carry"))
        .drop("_local", "_carry")
    )


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str = NUMBER) -> DataFrame:
    """Like ``row_number()`` over the whole key, from 1."""
    return running_total(df.withColumn("_one", F.lit(1)), keys, order, "_one", out).drop("_one")


def with_preceding(df: DataFrame, keys: list[str], order: list[str], rows: int, width: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of consecutive rows of a key, each with the ``rows`` rows before it, however long ago they were.

    Rows are numbered through the slices first and cut by their number, so a silence of any length changes nothing and a
    row is copied once at most. Frames of up to ``rows`` preceding rows over ``block_window`` equal the frames over the
    whole key in the rows where OWN holds; the others are copies. Adds NUMBER, BLOCK and OWN.
    """
    width = max(width, rows, 1)
    before = F.col(NUMBER) - 1
    own = F.floor(before / width)
    reaches = before % width >= width - rows
    counted = numbered(df, keys, order).withColumn("_own_block", own)
    blocks = F.when(reaches, F.array("_own_block", F.col("_own_block") + 1)).otherwise(F.array("_own_block"))
    return counted.withColumn(BLOCK, F.explode(blocks)).withColumn(OWN, F.col(BLOCK) == F.col("_own_block")).drop("_own_block")


def block_window(keys: list[str]):
    return Window.partitionBy(*keys, BLOCK).orderBy(NUMBER)


def with_reach(df: DataFrame, ts: str, reach: int, seconds: int = DAY) -> DataFrame:
    """Time slices, each with the rows of the ``reach`` seconds before it, for frames by time.

    Frames that reach back no further equal those over the whole key where OWN holds. Adds SLICE and OWN.
    """
    width = max(seconds, reach) * 1_000_000
    own = F.floor(micros(ts) / F.lit(width))
    reaches = F.pmod(micros(ts), F.lit(width)) >= width - reach * 1_000_000
    parts = F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn(SLICE, F.explode(parts)).withColumn(OWN, F.col(SLICE) == own)


def surrounding_events(
    df: DataFrame, events: DataFrame, keys: list[str], ts: str, event_ts: str, last: str, following: str, seconds: int = 7 * DAY,
) -> DataFrame:
    """Add the time of the last event at or before each row and of the next one at or after it.

    Rows and events of a (key, slice) are ordered together, once each way. What a slice has to know of the others is
    one last and one first event, carried along the slices of the key, so neither a key with many rows nor one
    with many events becomes one task, and rows never meet events in pairs.
    """
    ts_type = df.schema[ts].dataType
    moment = F.col(event_ts).cast(ts_type)
    rows = df.select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(ts_type).alias("_f"), F.struct("*").alias("_row"))
    marks = events.where(moment.isNotNull()).select(
        *keys, moment.alias("_t"), F.lit(0).alias("_kind"), moment.alias("_f"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    both = sliced(rows.unionByName(marks), "_t", seconds)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    # The way back is a window in falling order: a frame that shrinks towards the end would be rescanned for every row.
    after = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carry = both.groupBy(*keys, SLICE).agg(F.max("_f").alias("_max"), F.min("_f").alias("_min")).select(
        *keys, SLICE, F.last("_max", ignorenulls=True).over(before).alias("_earlier"), F.last("_min", ignorenulls=True).over(after).alias("_later"))
    grown = (Window.unboundedPreceding, Window.currentRow)
    up = _within(keys, ["_t", "_kind"]).rowsBetween(*grown)
    down = Window.partitionBy(*keys, SLICE).orderBy(F.desc("_t"), "_kind").rowsBetween(*grown)
    local = both.select(*keys, SLICE, "_row", F.last("_f", ignorenulls=True).over(up).alias("_up"), F.last("_f", ignorenulls=True).over(down).alias("_down"))
    return local.where(F.col("_row").isNotNull()).join(carry, [*keys, SLICE]).select(
        "_row.*", F.coalesce("_up", "_earlier").alias(last), F.coalesce("_down", "_later").alias(following))


def _within(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def _across(keys: list[str]):
    """One row per (key, slice): its size is the covered time, not the data."""
    partition: list[str | Column] = list(keys) or [F.lit(0)]
    return Window.partitionBy(*partition).orderBy(SLICE)
