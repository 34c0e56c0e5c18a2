"""Session settings and the lineage cut used by the plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(app: str = "gritstone", **conf: str) -> SparkSession:
    """Session with UTC and adaptive execution; cluster sizing stays with the caller.

    Small sides are never force-broadcast in this package: Catalyst and AQE
    broadcast a side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it otherwise.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a folder of its own; on a
    cluster a folder of one machine would lose rows, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gritstone-")
        context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder and read it back.

    Lost executors lose nothing, later reads prune columns and rows, and the
    planner knows the size. The tables are named ``gritstone-table-*``; they
    may be deleted once the run is over.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gritstone-table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

