"""Reference tables from CSV, typed by contract and never by inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_dim(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every column arrives as text; empty text is NULL; casts are explicit."""
    as_text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = spark.read.csv(path, header=True, schema=as_text)
    return raw.select(
        *[F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
