from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from gritstone.operators import vibration
from gritstone.schemas import DIM_TAG, VIBRATION_FEATURE_COLUMNS
from tests.helpers import START, at, reading, readings, rows_by, tag

STEP = 600


def sensor(no="01", nominal=4.0):
    return [tag(f"A-CR01-{code}{no}", "crusher", "vibration", nominal=nominal) for code in ("VI", "VP", "VK")]


def no_run(spark):
    return spark.createDataFrame([], "asset_id string, window_start timestamp, run_minutes double")


def test_trends_of_a_linear_rise(spark):
    rows = []
    for n in range(150):
        rms = 2.0 + 0.01 * n
        rows += [
            reading("A-CR01-VI01", n * STEP, rms), reading("A-CR01-VP01", n * STEP, 3.5 * rms),
            reading("A-CR01-VK01", n * STEP, 3.0), reading("A-CR01-VI02", n * STEP, rms),
        ]
    tags = spark.createDataFrame(sensor() + [tag("A-CR01-VI02", "crusher", "vibration", nominal=4.0)], DIM_TAG)
    df = vibration.vibration_features_10m(readings(spark, rows), tags, no_run(spark))
    assert df.columns == VIBRATION_FEATURE_COLUMNS
    got = sorted(df.collect(), key=lambda r: r["window_start"])
    assert len(got) == 150  # the sensor without peak and kurtosis gives no row
    assert {r["tag_id"] for r in got} == {"A-CR01-VI01"}
    assert [r["rms_delta_1h"] is None for r in got[:8]] == [True] * 6 + [False] * 2
    assert got[6]["rms_delta_1h"] == pytest.approx(0.06)
    assert got[143]["rms_delta_24h"] is None and got[144]["rms_delta_24h"] == pytest.approx(1.44)
    assert got[0]["rms_slope_24h"] is None
    assert all(r["rms_slope_24h"] == pytest.approx(1.44) for r in got[1:])
    assert all(r["crest_factor"] == pytest.approx(3.5) for r in got)
    assert got[0]["rms_pct_of_baseline"] == pytest.approx(50.0)
    assert got[0]["hours_since_maintenance"] is None and got[0]["label_failure_30d"] is None


def test_zone_edges(spark):
    from gritstone.functions.expressions import iso_zone

    df = spark.createDataFrame([(v,) for v in (2.79, 2.8, 7.1, 10.99, 11.0)], "rms double")
    assert [r[0] for r in df.select(iso_zone("rms")).collect()] == ["A", "B", "C", "C", "D"]


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(2)
    rows = [
        (t, f"A-{t}", at(86400 * n), rng.choice([None, rng.random() * 10]), 3.0, 4.0, 50.0)
        for t in ("VI01", "VI02", "VI03") for n in range(60)
    ]
    return spark.createDataFrame(
        rows, "tag_id string, asset_id string, window_start timestamp, rms_mm_s double, "
        "crest_factor double, kurtosis double, bearing_temp_c double",
    ).cache()


FAILS = [("VI01", 20.5), ("VI01", 24.0), ("VI01", 58.0), ("VI02", 5.0)]


def test_labels_equal_brute_force(spark, features):
    failures = spark.createDataFrame([(t, at(86400 * d)) for t, d in FAILS], "tag_id string, failed_at timestamp")
    got = rows_by(vibration.failure_labels(features, failures, 30.0), "tag_id", "window_start")
    for (t, ts), row in got.items():
        day = (ts - START).days
        gaps = [d - day for tt, d in FAILS if tt == t]
        if not gaps:
            assert row["days_to_fail"] is None and row["label_failure_30d"] is False
            continue
        best = min(gaps, key=lambda g: (not 0 <= g <= 30, abs(g), -g))
        assert row["days_to_fail"] == pytest.approx(best)
        assert row["label_failure_30d"] == (0 <= best <= 30)
    hours = rows_by(vibration.hours_since_reset(features, failures), "tag_id", "window_start")
    assert hours["VI01", at(86400 * 23)]["hours_since_maintenance"] == pytest.approx(48.0)  # since day 21
    assert hours["VI01", at(86400 * 24)]["hours_since_maintenance"] == 0.0
    assert hours["VI03", at(86400 * 10)]["hours_since_maintenance"] == pytest.approx(240.0)


def test_trend_history_equals_sliding_frames(features):
    w = Window.partitionBy("tag_id").orderBy("window_start")
    rms = F.col("rms_mm_s")
    want = features.select(
        "tag_id", "window_start", (rms - F.first(rms).over(w.rowsBetween(-3, 0))).alias("a"),
        (100 * rms / F.avg(rms).over(w.rowsBetween(-9, 0))).alias("b"),
    )
    got = vibration.trend_history(features, 3, 5, 9).select(
        "tag_id", "window_start", F.col("rms_delta_1h").alias("a"), F.col("rms_pct_of_baseline").alias("b")
    )
    left, right = rows_by(got, "tag_id", "window_start"), rows_by(want, "tag_id", "window_start")
    for key, row in right.items():
        for c in "ab":
            assert left[key][c] == (None if row[c] is None else pytest.approx(row[c])), (key, c)


def test_trend_history_forgets_a_nan(spark):
    rows = [("VI01", at(60 * n), float("nan") if n == 4 else float(n % 5 + 1)) for n in range(40)]
    got = vibration.trend_history(spark.createDataFrame(rows, "tag_id string, window_start timestamp, rms_mm_s double"), 3, 5, 9)
    spoiled = [n for n, r in enumerate(sorted(got.collect(), key=lambda r: r["window_start"])) if r["rms_pct_of_baseline"] != r["rms_pct_of_baseline"]]
    assert spoiled == list(range(4, 14))


def test_days_to_fail_and_peaks(spark, features):
    failures = spark.createDataFrame([("VI01", at(86400 * 30))], "tag_id string, failed_at timestamp")
    labelled = vibration.failure_labels(features, failures, 10.0)
    days = rows_by(vibration.days_to_fail(labelled), "tag_id", "window_start")
    assert days["VI01", at(86400 * 25)]["days_to_fail"] == pytest.approx(5.0)
    assert days["VI02", at(86400 * 25)]["days_to_fail"] is None
    peak = vibration.failure_peaks(labelled).collect()
    assert [(r["tag_id"], r["failed_at"]) for r in peak] == [("VI01", at(86400 * 30))]
    profile = rows_by(vibration.label_profile(labelled), "label_failure_30d")
    assert (profile[True]["windows"], profile[False]["windows"]) == (11, 169)
