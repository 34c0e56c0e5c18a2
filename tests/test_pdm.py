from __future__ import annotations

import json
import random
import tempfile
from pathlib import Path

import numpy as np
import pytest

from gritstone.operators import pdm
from gritstone.plans.refresh import score_fleet
from gritstone.session import materialize
from tests.helpers import at, rows_by

SCORED = "asset_id string, tag_id string, window_start timestamp, days_to_fail double, label boolean, failure_prob_30d double, model_flag boolean, rms_flag boolean, rms_threshold_mm_s double"


def scored_rows(spark, rows):
    return spark.createDataFrame(
        [(a, a, at(n), d, lab, p, p >= 0.5, rms, 7.1) for n, (a, d, lab, p, rms) in enumerate(rows)], SCORED
    )


def test_metrics_of_twenty_hand_scored_rows(spark):
    """Six hits, two misses, three false alarms, nine quiet rows."""
    rows = [("X", 20.0, True, 0.9 - 0.01 * n, n < 2) for n in range(6)]
    rows += [("X", 5.0, True, 0.2 + 0.1 * n, True) for n in range(2)]
    rows += [("X", None, False, 0.95, False), ("X", None, False, 0.6, False), ("X", None, False, 0.55, True)]
    rows += [("X", None, False, 0.1, False)] * 9
    got = pdm.evaluation(scored_rows(spark, rows)).first()
    assert (got["test_rows"], got["model_precision"], got["model_recall"]) == (20, 0.667, 0.75)
    assert got["model_f1"] == pytest.approx(0.706) and got["rms_f1"] == pytest.approx(0.615)
    # Average precision by its definition over distinct scores.
    pairs = sorted(((p, lab) for _, _, lab, p, _ in rows), reverse=True)
    hits = area = 0
    for k, (p, lab) in enumerate(pairs, 1):
        if lab:
            hits += 1
            area += hits / k
    assert got["model_pr_auc"] == pytest.approx(area / 8, abs=5e-4)
    early = pdm.phase1_recall(scored_rows(spark, rows)).first()
    assert (early["phase1_rows"], early["model_recall_phase1"], early["rms_recall_phase1"]) == (6, 1.0, 0.333)


def test_equal_scores_are_one_step(spark):
    rows = [("X", None, lab, 0.5, False) for lab in (True, False, False, True)]
    assert pdm.average_precision(scored_rows(spark, rows)).first()["model_pr_auc"] == pytest.approx(0.5)


def test_rul_bins(spark):
    rows = [("X", 10.0, True, 0.25, False), ("X", 20.0, True, 0.2, False), ("X", 2.0, True, 0.5, False), ("X", 4.0, True, 0.59, False), ("X", 1.0, True, 0.7, False)]
    got = {r["bin"]: r["rul_days"] for r in pdm.rul_calibration(scored_rows(spark, rows)).collect()}
    want = {0: 15, 1: 15, 2: 15, 3: 11, 4: 7, 5: 3, 6: 2, 7: 1, 8: 1, 9: 1}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_probability_one_is_in_the_last_bin(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.0999, 0.1, 0.9, 1.0)], "failure_prob_30d double")
    assert [r[0] for r in df.select(pdm.probability_bin()).collect()] == [0, 0, 1, 9, 9]


@pytest.fixture(scope="module")
def fleet(spark):
    """Three sensors, two of which fail: kurtosis and crest move early, RMS late."""
    rng = random.Random(1)
    rows = []
    for asset, fails in (("A", True), ("B", True), ("C", False)):
        for n in range(240):
            left = (240 - n) / 4.0
            bad = fails and left <= 30
            early = bad and left > 12
            rms = 3.0 + (0.2 * (12 - left) if bad and not early else 0.0) + rng.random() * 0.3
            crest = (5.0 if bad else 3.5) + rng.random() * 0.2
            kurt = (6.0 if bad else 3.1) + rng.random() * 0.2
            rows.append((asset, f"{asset}-VI01", at(n * 21600), at(n * 21600 + 600), rms, rms * crest, crest, kurt, 2.0, 100.0, None if n % 7 == 0 else 50.0, 60.0, 2000.0, bad))
    return materialize(spark.createDataFrame(
        rows, "asset_id string, tag_id string, window_start timestamp, window_end timestamp, rms_mm_s double, peak_mm_s double, "
        "crest_factor double, kurtosis double, stddev_mm_s double, rms_pct_of_baseline double, bearing_temp_c double, "
        "motor_current_a double, throughput_tph double, label_failure_30d boolean",
    ))


SMALL = pdm.BoostingSettings(rounds=5, depth=3)


def test_baseline_equals_brute_force(fleet):
    rows = fleet.collect()
    rms = np.array([r["rms_mm_s"] for r in rows])
    label = np.array([r["label_failure_30d"] for r in rows])
    best = (-1.0, None)
    for t in np.quantile(rms, np.linspace(0.5, 0.995, 60)):
        flag = rms >= t
        f1 = 2 * (flag & label).sum() / (flag.sum() + label.sum())
        if f1 > best[0] + 1e-12:
            best = (f1, t)
    got = pdm.rms_threshold_baseline(fleet).first()
    assert (got["best_f1"], got["rms_threshold_mm_s"]) == (pytest.approx(best[0]), pytest.approx(best[1]))


def test_model_beats_the_rms_rule_early(fleet):
    path = tempfile.mkdtemp(prefix="gritstone-test-")
    scored = pdm.cross_fit(fleet, path, SMALL)
    kept = sorted(str(f) for f in Path(path).rglob("*.parquet"))
    assert len({f.split("fold=")[1][0] for f in kept}) == 2 and set(scored.columns) == set(SCORED.replace(" ", ",").split(",")[0::3])
    assert pdm.cross_fit(fleet, path, SMALL).count() == scored.count() == 480  # nothing is fitted again
    assert sorted(str(f) for f in Path(path).rglob("*.parquet")) == kept
    report = rows_by(pdm.evaluation(scored), "held_out_asset")
    assert set(report) == {"A", "B"}
    for row in report.values():
        assert row["model_f1"] > row["rms_f1"] and row["model_pr_auc"] > 0.9
    for row in pdm.phase1_recall(scored).collect():
        assert row["model_recall_phase1"] > 0.9 > row["rms_recall_phase1"]


def test_score_and_save(spark, fleet):
    path = tempfile.mkdtemp(prefix="gritstone-test-")
    model = pdm.train(fleet, SMALL)
    model.save(f"{path}/model")
    again = pdm.PdmModel.load(spark, f"{path}/model")
    rows = score_fleet(spark, fleet, again, f"{path}/out", "vibration", "1", str(at(0)))
    score_fleet(spark, fleet, again, f"{path}/out", "vibration", "1", str(at(0)))
    stored = spark.read.parquet(f"{path}/out")
    assert stored.count() == rows.count() == stored.select("prediction_id").distinct().count()
    for row in stored.collect():
        assert 0 <= row["failure_prob_30d"] <= 1 and row["predicted_rul_hours"] is not None
        assert row["health_index"] == pytest.approx(100 * (1 - row["failure_prob_30d"]), abs=0.051)
        parsed = json.loads(row["top_features"])
        assert len(parsed) == 3 and set(parsed[0]) == {"feature", "deviation_from_fleet_median"}
        assert abs(parsed[0]["deviation_from_fleet_median"]) >= abs(parsed[1]["deviation_from_fleet_median"]) - 1e-3
    peaks = rows_by(pdm.peak_risk(stored), "tag_id")
    assert peaks["A-VI01"]["failure_prob_30d"] > 0.5 > peaks["C-VI01"]["failure_prob_30d"]
    assert pdm.flagged_sensors(pdm.peak_risk(stored)).first()["sensors"] == 3


def test_rows_without_a_core_feature_are_not_scored(fleet):
    from pyspark.sql import functions as F

    broken = fleet.withColumn("kurtosis", F.when(F.col("asset_id") != "C", F.col("kurtosis")))
    assert {r["asset_id"] for r in pdm.scorable(broken).collect()} == {"A", "B"}
    assert pdm.fill_context(fleet).where("bearing_temp_c is null").count() == 0


def test_folds_and_fit_sample(spark, fleet):
    rows = [(f"X{n}", n % 4 == 0) for n in range(40)]
    table = spark.createDataFrame(rows, "asset_id string, label_failure_30d boolean")
    found = {r["asset_id"]: r["fold"] for r in pdm.asset_folds(table, 5).collect()}
    assert sorted(found) == sorted(a for a, _ in rows)
    assert all(sum(1 for a, failed in rows if failed and found[a] == k) == 2 and sum(f == k for f in found.values()) == 8 for k in range(5))
    drawn = pdm.fit_sample(fleet, 200)
    assert 120 < drawn.count() < 280 and sorted(map(str, drawn.collect())) == sorted(map(str, pdm.fit_sample(fleet, 200).collect()))
    assert pdm.fit_sample(fleet, 720).count() == 720
    with pytest.raises(ValueError, match="no asset"):
        pdm.cross_fit(fleet.where("asset_id = 'C'"), tempfile.mkdtemp(prefix="gritstone-test-"), SMALL)
