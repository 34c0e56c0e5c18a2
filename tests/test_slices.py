"""Sliced operations equal the plain windows, also when one key holds most rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from gritstone.functions import slices
from gritstone.functions.quantiles import interpolated_quantiles, medians
from tests.helpers import at


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = []
    for n in range(1500):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}"
        value = None if rng.random() < 0.2 else float(rng.randrange(50))
        rows.append((key, n, at(rng.randrange(40_000) * 1.0), value))
    return spark.createDataFrame(rows, "key string, seq long, source_ts timestamp, value double").cache()


ORDER = ["source_ts", "seq"]


def same(left, right):
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("seconds", [600, 3600])
def test_adjacent_rows(series, seconds):
    plain = Window.partitionBy("key").orderBy(*ORDER)
    got = slices.adjacent_rows(
        slices.sliced(series, seconds=seconds), ["key"], ORDER, {"value": "before"},
        {"value": "after", "source_ts": "after_ts"},
    ).drop(slices.SLICE)
    want = series.withColumns({
        "before": F.lag("value").over(plain), "after": F.lead("value").over(plain),
        "after_ts": F.lead("source_ts").over(plain),
    })
    same(got, want)


def test_running_total_and_last_known(series):
    plain = Window.partitionBy("key").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    cut = slices.sliced(series, seconds=900)
    total = slices.running_total(cut, ["key"], ORDER, "value", "total").drop(slices.SLICE)
    same(total, series.withColumn("total", F.coalesce(F.sum("value").over(plain), F.lit(0.0))))
    known = slices.last_known(cut, ["key"], ORDER, "value", "known").drop(slices.SLICE)
    same(known, series.withColumn("known", F.last("value", ignorenulls=True).over(plain)))


def test_no_window_holds_a_whole_key(spark, series):
    cut = slices.sliced(series, seconds=600)
    largest = cut.groupBy("key", slices.SLICE).count().agg(F.max("count")).first()[0]
    hot = series.where("key = 'hot'").count()
    assert largest < hot / 10


def test_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(5, 2, 4000), np.full(2500, 5.0), rng.exponential(100, 50)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    probabilities = list(np.linspace(0.5, 0.995, 60)) + [0.0, 1.0, 0.013]
    got = {r["position"]: r["quantile"] for r in interpolated_quantiles(df, "v", probabilities).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(probabilities))], np.quantile(values, probabilities), rtol=1e-12)


def test_quantiles_of_groups_and_odd_values(spark):
    rng = np.random.default_rng(4)
    series = {
        "dense": 1.0 + rng.random(3000) * 1e-9, "wide": rng.normal(size=2000) * 10.0 ** rng.integers(-300, 300, 2000), "one": np.array([7.5]),
        "same": np.full(500, -3.25), "signs": np.array([-0.0, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]), "ints": rng.integers(-40, 40, 900).astype(float),
    }
    frame = spark.createDataFrame([(k, float(v)) for k, values in series.items() for v in values] + [("none", None)], "k string, v double").repartition(6)
    probabilities = [0.0, 0.25, 0.5, 0.501, 0.999, 1.0]
    got = {(r["k"], r["probability"]): r["quantile"] for r in interpolated_quantiles(frame, "v", probabilities, ["k"]).collect()}
    assert len(got) == len(series) * len(probabilities)
    for k, values in series.items():
        if k == "signs":
            assert got[k, 0.0] == -1.7e308 and got[k, 1.0] == 1.7e308 and got[k, 0.5] == 0.0
        else:
            np.testing.assert_allclose([got[k, p] for p in probabilities], np.quantile(values, probabilities), rtol=1e-12)
    odd = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), float("-inf"), 1.0, None)], "v double")
    found = [r["quantile"] for r in interpolated_quantiles(odd, "v", [0.0, 1 / 3, 2 / 3, 1.0]).orderBy("position").collect()]
    assert found[:3] == [float("-inf"), 1.0, float("inf")] and np.isnan(found[3])
    assert interpolated_quantiles(odd.limit(0), "v", [0.5]).count() == 0


def test_quantile_plan(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    plan = interpolated_quantiles(df, "v", [0.1, 0.9])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "raise_error" not in plan


def test_medians_ignore_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, 2.0), (2.0, 8.0), (None, None)], "a double, b double")
    assert medians(df, ["a", "b"]).first().asDict() == {"a": 2.0, "b": 5.0}


@pytest.fixture(scope="module")
def gappy(spark):
    """Series with silences much longer than a slice; one key holds most rows."""
    rng, rows = random.Random(11), []
    for key, n in (("hot", 400), ("a", 60), ("b", 3), ("c", 1)):
        second = 0
        for k in range(n):
            second += rng.choice([600, 600, 600, 1200, 90_000, 2_000_000])
            rows.append((key, k, at(second), rng.random()))
    return spark.createDataFrame(rows, "key string, seq long, source_ts timestamp, value double").cache()


@pytest.mark.parametrize("reach, width", [(5, 7), (5, 5), (6, 2), (3, 1000), (1, 1)])
def test_blocks_with_preceding_rows(gappy, reach, width):
    blocks = slices.with_preceding(slices.sliced(gappy, seconds=7200), ["key"], ["source_ts"], reach, width)
    over, plain = slices.block_window(["key"]), Window.partitionBy("key").orderBy("source_ts")

    def frames(window):
        return {"before": F.lag("value", reach).over(window), "mean": F.avg("value").over(window.rowsBetween(-reach, 0)),
                "n": F.count("value").over(window.rowsBetween(-reach, 0))}

    got = blocks.withColumns(frames(over)).where(slices.OWN)
    same(got.select(*gappy.columns, *frames(over)), gappy.withColumns(frames(plain)))
    sizes = blocks.groupBy("key", slices.BLOCK).count().agg(F.max("count")).first()[0]
    assert sizes <= max(width, reach) + reach
    assert got.agg(F.max(slices.NUMBER)).first()[0] == 400


@pytest.mark.parametrize("reach, seconds", [(0, 3600), (1800, 3600), (100_000, 3600)])
def test_slices_with_reach(gappy, reach, seconds):
    order = F.unix_seconds("source_ts")
    frame = lambda w: {"n": F.count("value").over(w.orderBy(order).rangeBetween(-reach, 0)), "least": F.min("value").over(w.orderBy(order).rangeBetween(-reach, 0))}
    cut = slices.with_reach(gappy, "source_ts", reach, seconds)
    got = cut.withColumns(frame(Window.partitionBy("key", slices.SLICE))).where(slices.OWN).select(*gappy.columns, "n", "least")
    same(got, gappy.withColumns(frame(Window.partitionBy("key"))))


@pytest.mark.parametrize("seconds", [3600, 86_400, 400 * 86_400])
def test_surrounding_events(spark, gappy, seconds):
    rng = random.Random(5)
    held = [r for r in gappy.collect() if r["key"] != "c"]
    events = [(r["key"], r["source_ts"]) for r in rng.sample(held, 60)] + [("hot", at(-5.0)), ("a", at(10**9)), ("b", None), ("other", at(3.0))]
    table = spark.createDataFrame(events, "key string, happened timestamp")
    got = slices.surrounding_events(gappy, table, ["key"], "source_ts", "happened", "last", "next", seconds)
    assert got.columns == [*gappy.columns, "last", "next"]
    for r in got.collect():
        own = [t for k, t in events if k == r["key"] and t is not None]
        assert r["last"] == max((t for t in own if t <= r["source_ts"]), default=None)
        assert r["next"] == min((t for t in own if t >= r["source_ts"]), default=None)
    assert got.count() == gappy.count()
