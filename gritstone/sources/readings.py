"""The one seam every operator reads through, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gritstone.schemas import VIBRATION_FEATURE_COLUMNS

READING_COLUMNS = [
    "event_id", "tag_id", "source_ts", "value", "value_text", "quality", "unit", "seq", "ingest_ts",
]
AFTER_IMAGES = ["insert", "update_postimage"]


def reading_view(readings: DataFrame) -> DataFrame:
    """The nine shared columns; which producer wrote a row is not part of the contract."""
    return readings.select(*READING_COLUMNS)


def after_images(feed: DataFrame) -> DataFrame:
    """Rows of a change feed that hold a new state. A plain filter, so streams can use it."""
    return feed.where(F.col("_pg_change_type").isin(AFTER_IMAGES))


def readings_from_feed(feed: DataFrame) -> DataFrame:
    return reading_view(after_images(feed))


def union_features(history: DataFrame, live: DataFrame) -> DataFrame:
    """Stored feature history and live features share one column list."""
    return history.select(*VIBRATION_FEATURE_COLUMNS).unionByName(
        live.select(*VIBRATION_FEATURE_COLUMNS)
    )


def read_stream(
    spark: SparkSession, path: str, schema: StructType, columns: list[str],
    where: Column | None = None, files_per_trigger: int | None = None, glob: str | None = None,
) -> DataFrame:
    """Stream a parquet folder through a projection and an optional filter."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns)
