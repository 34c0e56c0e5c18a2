"""Writers: full refresh, insert-only append, JSON rows and clustered layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh. With partitions, only the partitions present in ``df`` are replaced."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def unseen_rows(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target does not hold yet."""
    return rows.join(target.select(key), key, "left_anti")


def append_unseen(rows: DataFrame, path: str, key: str, time: str | None = None) -> None:
    """Append the rows whose ``key`` the table does not hold.

    With ``time`` the table is partitioned by that column's day, and only the days that occur in ``rows`` are read of it: a key
    must then always come with the same day.
    """
    spark = rows.sparkSession
    dated = rows.withColumn("day", F.col(time).cast("date")) if time else rows
    fresh = dated
    if child_names(spark, path):
        held = spark.read.schema(dated.schema).parquet(path)
        if time:
            days = [row["day"] for row in dated.select("day").distinct().collect()]
            held = held.where(F.col("day").isin([F.lit(day) for day in days]))
        fresh = unseen_rows(held, dated, key)
    writer = fresh.write.mode("append")
    (writer.partitionBy("day") if time else writer).parquet(path)


def rows_to_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def layout_by_key(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """Cluster rows so parquet min/max statistics prune by key and time.

    The range split includes the time column, so one heavy tag spreads over
    many files instead of one.
    """
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder. Spark's own marker files are left out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []
    return [name for name in names if not name.startswith(("_", "."))]
