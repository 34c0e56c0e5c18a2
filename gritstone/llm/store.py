"""Intermediate tables in the folder that all executors share, and Arrow batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text bytes (characters, for estimates) handed to a batch function at once.
BATCH_CHARS = 4_000_000


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder only in local mode, where it is unset in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="gritstone-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write the frame as Parquet (with these options) into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(frame.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``chars`` of text each, so a task's memory does not follow its longest rows."""
    lengths = batch.column(text).nbytes / max(1, batch.num_rows)
    step = max(1, int(chars / max(1.0, lengths)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_text(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """Run ``work`` on every Arrow batch of the frame, a few megabytes of text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return frame.mapInArrow(run, schema)
