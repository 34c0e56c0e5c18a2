"""Change-feed handling: newest image per key and validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gritstone.functions.slices import next_row, sliced_by_number
from gritstone.schemas import CHANGE_FEED_COLUMNS
from gritstone.sources.readings import after_images

FEED_ORDER = ["_pg_lsn", "_sort_by"]


def latest_images(feed: DataFrame, key: str) -> DataFrame:
    """Newest state per key by log position, never by clock.

    An aggregate rather than a ranked window: partial results combine before
    the shuffle, so a key with very many changes costs one row per task.
    """
    rest = [c for c in feed.columns if c != key and c not in CHANGE_FEED_COLUMNS]
    newest = after_images(feed).groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(*FEED_ORDER)).alias("_row")
    )
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def scd2_history(feed: DataFrame, key: str, slice_width: int = 1_000_000) -> DataFrame:
    """Every state with the log interval in which it held; the open one ends NULL.

    A delete closes the interval before it and opens none. The feed is cut into
    ranges of ``slice_width`` log positions so one busy key spreads over tasks.
    """
    changes = feed.where(F.col("_pg_change_type") != "update_preimage")
    stitched = next_row(
        sliced_by_number(changes, "_pg_lsn", slice_width), [key], FEED_ORDER,
        {"_pg_lsn": "valid_to"},
    )
    rest = [c for c in feed.columns if c not in CHANGE_FEED_COLUMNS]
    return stitched.where(F.col("_pg_change_type") != "delete").select(
        *rest, F.col("_pg_lsn").alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
