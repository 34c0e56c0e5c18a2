"""Keyed upsert on a parquet table that is partitioned by a hash of its key.

Only the partitions that hold a key of the source are read, merged and replaced, by Spark's dynamic partition overwrite; the
others keep their files. A job that is lost before its commit leaves the table as it was. Merging the same rows
again gives the same rows, so a repeated job or micro-batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gritstone.sources.sinks import child_names, overwrite_table

#: The partition column's name carries the number of partitions, which a table keeps for good.
PART_OF = "key_part_of_"
PARTS = 64


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """One row per key out of both sides.

    Without ``by`` the source replaces the target (MERGE, update all columns).
    With ``by`` the greatest ``by`` wins and the target wins ties, so late or
    repeated rows never replace newer ones.
    """
    columns = target.columns
    both = target.withColumn("_from_source", F.lit(False)).unionByName(
        source.select(*columns).withColumn("_from_source", F.lit(True))
    )
    order: list[Column] = (
        [*[F.col(c) for c in by], ~F.col("_from_source")] if by else [F.col("_from_source")]
    )
    rest = [c for c in columns if c not in keys]
    newest = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"), F.count_if("_from_source").alias("_n")
    )
    if not by:  # as a MERGE does: which of two equal keys would win is chance
        twice = F.raise_error(F.lit(f"several source rows for one {', '.join(keys)}"))
        newest = newest.withColumn("_row", F.when(F.col("_n") <= 1, F.col("_row")).otherwise(twice))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*columns)


def _part_column(spark: SparkSession, path: str) -> str | None:
    """Name of the table's partition column; None where there is no table yet."""
    found = [name.split("=")[0] for name in child_names(spark, path) if name.startswith(PART_OF)]
    return found[0] if found else None


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's rows, or None when there is none."""
    part = _part_column(spark, path)
    return spark.read.parquet(path).drop(part) if part else None


def upsert(source: DataFrame, path: str, keys: list[str], by: list[str] | None = None, parts: int = PARTS) -> list[int]:
    """Merge ``source`` into the table at ``path``; returns the partitions written.

    ``parts`` counts for a new table only. The source is read twice, for its partitions and for its rows.
    """
    spark = source.sparkSession
    part = _part_column(spark, path)
    exists = part is not None
    part = part or f"{PART_OF}{parts}"
    count = int(part.removeprefix(PART_OF))
    place = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    touched = sorted(row[0] for row in source.select(place.alias("p")).distinct().collect())  # at most ``count``
    if not touched:
        return []
    current = spark.read.parquet(path).where(F.col(part).isin(touched)).drop(part) if exists else source.limit(0)
    merged = merge_rows(current, source, keys, by).withColumn(part, place)
    overwrite_table(merged.hint("rebalance", F.col(part)), path, [part])
    return touched
