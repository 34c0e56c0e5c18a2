"""Data checks: keys, references, allowed values and instrument pairing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gritstone.operators.balance import slurry_pairs
from gritstone.schemas import NOTE_KINDS, ORDER_PRIORITIES, ORDER_STATUSES


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose reference is set but does not exist."""
    keys = parent.select(F.col(parent_key or child_key).alias("_parent"))
    return child.where(F.col(child_key).isNotNull()).join(
        keys, F.col(child_key) == F.col("_parent"), "left_anti"
    )


def _counted(df: DataFrame, **counts: Column) -> DataFrame:
    """One row (check_name, violations) per named aggregate, all from one pass."""
    found = df.agg(*[F.coalesce(count, F.lit(0)).cast("long").alias(name) for name, count in counts.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in counts])
    return found.select(F.inline(rows))


def constraint_check(orders: DataFrame, notes: DataFrame, alerts: DataFrame | None = None) -> DataFrame:
    """Violations per constraint of the work-order tables; a clean table counts zero.

    The order columns are checked in the same pass that counts equal keys.
    """
    def broken(condition: Column) -> Column:
        return F.count_if(~F.coalesce(condition, F.lit(True)))

    by_key = orders.groupBy("work_order_id").agg(
        F.count(F.lit(1)).alias("n"), broken(F.col("status").isin(ORDER_STATUSES)).alias("status"),
        broken(F.col("priority").isin(ORDER_PRIORITIES)).alias("priority"),
        broken((F.col("status") == "CLOSED") == F.col("closed_at").isNotNull()).alias("closed"),
    )
    result = _counted(
        by_key, order_key_unique=F.count_if(F.col("n") > 1), order_status=F.sum("status"),
        order_priority=F.sum("priority"), closed_has_timestamp=F.sum("closed"),
    )
    result = result.unionByName(_counted(notes, note_kind=broken(F.col("note_kind").isin(NOTE_KINDS))))
    result = result.unionByName(_counted(orphans(notes, orders, "work_order_id"), note_order_exists=F.count(F.lit(1))))
    if alerts is not None:
        result = result.unionByName(_counted(orphans(orders, alerts, "alert_id"), order_alert_exists=F.count(F.lit(1))))
    return result


def slurry_partner_check(arcs: DataFrame, tags: DataFrame) -> DataFrame:
    """Slurry arcs whose flow tag has no density partner."""
    slurry = arcs.where(F.col("measure_method") == "slurry_flow_density")
    return slurry.join(
        slurry_pairs(tags), F.col("measure_tag_id") == F.col("flow_tag_id"), "left_anti"
    ).select("arc_id", "measure_tag_id")
