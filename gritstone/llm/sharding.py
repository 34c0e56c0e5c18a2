"""A uniform shuffle of rows into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn first: the matrix whose row sums are the
partitions' sizes and whose column sums are the shards' sizes follows the multivariate hypergeometric law,
as under a uniform permutation of all rows. Each partition is then permuted locally and cut by its
row of the matrix, the pieces are exchanged, and each shard is permuted again.

The matrix is drawn in two levels, first for groups of GROUP partitions (on the driver, one number for each group and
shard), then inside each group (in a task), so no table that follows the number of partitions meets in one place.
Rows are numbered in a stored table before anything is drawn; draws depend on seed and place only, so a
repeated task makes the same rows. A shard is ordered by random buckets of about BUCKET_ROWS rows, so no
task sorts a whole shard.

Shard sizes differ by one row at most (law ``rows``). Null and empty texts are rows like any other; repeated rows
are placed independently. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.llm.store import shared_folder, stored

GROUP = 1024
BUCKET_ROWS = 100_000
ADDED = ("shard", "slot")


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """Good items among ``taken`` of good + bad, by inversion outwards from the mode, for any population size."""
    low, high = max(0, taken - bad), min(taken, good)
    if low == high:
        return low
    mode = min(high, max(low, (taken + 1) * (good + 1) // (good + bad + 2)))

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(choose(good, mode) + choose(bad, taken - mode) - choose(good + bad, taken))
    left, up, down, p_up, p_down = rng.random() - at_mode, mode, mode, at_mode, at_mode
    found = mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) / (up + 1) * (taken - up) / (bad - taken + up + 1)
            up += 1
            left -= p_up
            found = up
        if left > 0 and down > low:
            p_down *= down / (good - down + 1) * (bad - taken + down) / (taken - down + 1)
            down -= 1
            left -= p_down
            found = down
    return found


def draw_matrix(rng: np.random.Generator, rows: list[int], columns: list[int]) -> list[list[int]]:
    """A matrix with these row and column sums, as a uniform permutation would fill it."""
    left, out = list(columns), []
    for size in rows:
        row, taken, total = [], size, sum(left)
        for k, free in enumerate(left):
            total -= free
            n = draw_hypergeometric(rng, free, total, taken)
            row.append(n)
            taken -= n
            left[k] -= n
        out.append(row)
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def communication(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, shard, low, high): ranks low <= rank < high of a partition's permutation go to that shard.

    ``sizes`` has part and n, one row per input partition.
    """
    spark = sizes.sparkSession
    grouped = sizes.withColumn("team", F.floor(F.col("part") / GROUP).cast("int"))
    teams = grouped.groupBy("team").agg(F.sum("n").alias("n")).orderBy("team").collect()  # one in GROUP partitions
    total = sum(row["n"] for row in teams)
    drawn = draw_matrix(np.random.default_rng([seed, 0]), [row["n"] for row in teams], shard_sizes(total, shards))
    quota = spark.createDataFrame(
        [(row["team"], counts) for row, counts in zip(teams, drawn)], "team int, quota array<bigint>")

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        rng = np.random.default_rng([seed, 1, int(pdf["team"].iloc[0])])
        matrix = np.array(draw_matrix(rng, pdf["n"].tolist(), [int(x) for x in pdf["quota"].iloc[0]]), dtype=np.int64)
        ends = matrix.cumsum(axis=1)
        return pd.DataFrame({
            "part": np.repeat(pdf["part"].to_numpy(), shards), "shard": np.tile(np.arange(shards, dtype=np.int32), len(pdf)),
            "low": (ends - matrix).ravel(), "high": ends.ravel(),
        })

    return grouped.join(quota, "team").groupBy("team").applyInPandas(inside, "part int, shard int, low bigint, high bigint")


def _random(seed: int, label: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(label), "part", "row")


def hypergeometric_shuffle(frame: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows and columns of ``frame`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Columns of these names in the input are replaced.
    """
    kept = frame.drop(*ADDED)
    payload = F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("payload")
    rows = stored(kept.select(payload, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "rows")
    matrix = stored(communication(rows.groupBy("part").agg(F.count("*").alias("n")), shards, seed), "matrix")
    local = rows.select("part", "row", F.row_number().over(Window.partitionBy("part").orderBy(_random(seed, 2), "row")).alias("rank"))
    cells = matrix.where("low < high").groupBy("part").agg(F.sort_array(F.collect_list(F.struct("high", "shard"))).alias("cells"))
    sent = local.join(cells, "part").select(
        "part", "row", F.filter("cells", lambda c: c["high"] >= F.col("rank"))[0]["shard"].alias("shard"))
    n_buckets = matrix.agg(F.ceil(F.sum(F.col("high") - F.col("low")) / (shards * BUCKET_ROWS)).alias("buckets"))
    buckets = n_buckets.first()["buckets"] or 1
    spread = stored(sent.withColumn("bucket", F.pmod(_random(seed, 3), F.lit(buckets))), "sent")
    starts = spread.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    again = spread.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(_random(seed, 4), "part", "row")))
    placed = again.join(starts, ["shard", "bucket"]).select(
        "part", "row", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"))
    return rows.join(placed, ["part", "row"]).select("payload.*", "shard", "slot")


def write_shards(frame: DataFrame, name: str = "shards") -> str:
    """Write shuffled rows as one folder per shard, each file in slot order; returns the folder."""
    path = f"{shared_folder(frame.sparkSession)}/{name}"
    frame.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
