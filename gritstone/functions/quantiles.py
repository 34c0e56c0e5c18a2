"""Exact interpolated quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here the wanted ranks are searched in three rounds of
narrowing value buckets, each a grouped count that combines before the shuffle. Buckets are defined by the
values alone, so a bucket that holds a rank is never missed, and rounds and bounds are the same for any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.session import materialize

#: Buckets of the first round for each power of two of the value; parts of a bucket in the second.
PARTS_OF_A_POWER, PARTS_OF_A_BUCKET = 1024, 1 << 20
LOWEST_POWER, INFINITE, NAN = 1075, 1 << 39, 1 << 40


def _bucket(v: Column) -> Column:
    """A number that grows with the value: by sign and binary logarithm, about a thousandth of the value wide."""
    size = F.abs(v)
    finite = F.floor((F.log2(size) + F.lit(float(LOWEST_POWER))) * F.lit(float(PARTS_OF_A_POWER))) + 1
    magnitude = F.when(size == F.lit(float("inf")), F.lit(INFINITE)).otherwise(finite)
    return F.when(F.isnan(v), F.lit(NAN)).when(v == 0, F.lit(0)).when(v > 0, magnitude).otherwise(-magnitude).cast("long")


def _part(v: Column) -> Column:
    """Where the value lies between the least and greatest of its bucket, in PARTS_OF_A_BUCKET steps; grows with the value."""
    low, high = F.col("_least"), F.col("_most")
    return F.when(high > low, F.floor((v - low) / (high - low) * F.lit(float(PARTS_OF_A_BUCKET)))).otherwise(F.lit(0)).cast("long")


def _wanted(ranks: Column, before: Column, count: Column) -> Column:
    """Of the wanted ranks those that fall among ``count`` rows with ``before`` rows below them."""
    return F.filter(ranks, lambda r: (r >= before) & (r < before + count))


def interpolated_quantiles(
    df: DataFrame, value: str, probabilities: list[float], groups: list[str] | None = None,
) -> DataFrame:
    """Rows (groups, position, probability, quantile), linear between neighbouring ranks. NULLs are ignored, NaN is the greatest.

    The input is read three times. Round one counts rows by value bucket, round two by parts of the buckets that hold a
    wanted rank, round three by value in the parts that hold one: at most 2^22 different doubles are left in such
    a part. What passes from round to round is one stored row per wanted rank and group.
    """
    groups = groups or []
    p = [float(x) for x in probabilities]
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_bucket", _bucket(F.col("_v")))

    def cumulated(counts: DataFrame, keys: list[str], by: str) -> DataFrame:
        upwards = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("_below", F.coalesce(F.sum("_count").over(upwards), F.lit(0)))

    def hit(counts: DataFrame, ranks: Column, before: Column, columns: list[str | Column]) -> DataFrame:
        """One row per bucket and wanted rank in it."""
        return counts.withColumn("_rank", F.explode(_wanted(ranks, before, F.col("_count")))).select(*groups, "_rank", *columns)

    def ends(n: Column) -> Column:
        """The two ranks next to each probability's place among n rows."""
        places = [(n - 1) * F.lit(x) for x in p]
        return F.array_distinct(F.array(*[f(place).cast("long") for place in places for f in (F.floor, F.ceil)]))

    first = rows.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    first = cumulated(first, groups, "_bucket").withColumn("_n", F.sum("_count").over(Window.partitionBy(*groups)))
    one = materialize(hit(first, ends(F.col("_n")), F.col("_below"), ["_n", "_bucket", "_least", "_most", F.col("_below").alias("_base")]))

    def within(found: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        """The buckets found, and the ranks wanted in each."""
        held = found.groupBy(*groups, *keys, "_base").agg(F.collect_set("_rank").alias("_ranks"), F.first("_least").alias("_least"), F.first("_most").alias("_most"))
        return held.drop("_ranks"), held.select(*groups, *keys, "_base", "_ranks")

    buckets, ranks = within(one, ["_bucket"])
    inside = rows.join(buckets, [*groups, "_bucket"]).withColumn("_part", _part(F.col("_v")))
    keys = [*groups, "_bucket"]
    second = cumulated(inside.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_low")), keys, "_part").join(ranks, keys)
    two = materialize(hit(second, F.col("_ranks"), F.col("_base") + F.col("_below"), ["_bucket", "_part", (F.col("_base") + F.col("_below")).alias("_base")]))
    parts = two.groupBy(*keys, "_part", "_base").agg(F.collect_set("_rank").alias("_ranks"))
    keys = [*groups, "_bucket", "_part"]
    again = inside.drop("_base").join(parts.select(*keys).distinct(), keys)
    third = cumulated(again.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_count")), keys, "_v").join(parts, keys)
    found = hit(third, F.col("_ranks"), F.col("_base") + F.col("_below"), ["_v"])

    sizes = one.groupBy(*groups).agg(F.max("_n").alias("_n")) if groups else one.agg(F.max("_n").alias("_n"))
    known = found.groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    if groups:
        answers = known.join(sizes, groups)
    else:
        answers = known.withColumn("_n", sizes.select("_n").scalar())
    place = (F.col("_n") - 1) * F.col("probability")
    low, high = (F.element_at("_at", f(place).cast("long")) for f in (F.floor, F.ceil))
    quantile = F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))
    return (
        answers.where(F.size("_at") > 0)
        .select(*groups, "_n", "_at", F.posexplode(F.array(*[F.lit(x) for x in p])).alias("position", "probability"))
        .select(*groups, "position", "probability", quantile.alias("quantile"))
    )


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the median of each column, NULLs ignored."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])
        ).alias("_p")
    ).select("_p.*")
    found = interpolated_quantiles(long, "v", [0.5], ["name"])
    return found.agg(*[
        F.max(F.when(F.col("name") == c, F.col("quantile"))).alias(c) for c in columns
    ])
