"""Known answers of the design fixture and the edges of the reconciliation."""

from __future__ import annotations

import pytest

from gritstone.operators import balance, checks
from gritstone.operators.readings import tag_reading_1m
from tests import plant
from tests.helpers import reading, readings, rows_by

MINUTE = 60


def design_rows(minutes=5, change=None):
    """Every tag at nominal each 10 s; ``change`` maps (tag, second, value) to a row, None or True."""
    rows = []
    for tag_id, value in plant.NOMINAL.items():
        for second in range(0, minutes * MINUTE, 10):
            row = reading(tag_id, second, value)
            if change is not None:
                row = change(tag_id, second, value, row)
            if row is not None:
                rows.append(row)
    return rows


def run(spark, rows):
    tag_1m = tag_reading_1m(readings(spark, rows))
    incidence = balance.reconciled_incidence(
        tag_1m, plant.arcs(spark), plant.nodes(spark), plant.tags(spark)
    )
    nodes = rows_by(balance.mass_balance_node_1m(incidence), "node_id", "window_start")
    return incidence, {(n, t.minute): r for (n, t), r in nodes.items()}


def arc_rows(incidence):
    found = rows_by(balance.mass_flow_final(incidence), "arc_id", "window_start")
    return {(a, t.minute): r for (a, t), r in found.items()}


def test_design_point(spark):
    incidence, nodes = run(spark, design_rows())
    assert len(nodes) == 13 * 5
    flows = arc_rows(incidence)
    assert len(flows) == 15 * 5
    inferred = {
        r["window_start"].minute: r for r in balance.arc_infer(incidence).collect()
    }
    for minute in range(5):
        assert flows["A11", minute]["measured_tph"] == pytest.approx(400.066, abs=1e-3)
        assert flows["A12", minute]["measured_tph"] == pytest.approx(2099.587, abs=1e-3)
        assert flows["A02", minute]["measured_tph"] == pytest.approx(2500)
        assert flows["A02", minute]["is_reconciled"]
        assert inferred[minute]["inferred_from_node_id"] == "N02"
        assert inferred[minute]["candidate_count"] == 2
        assert inferred[minute]["inference_spread_tph"] == pytest.approx(0)
        assert nodes["N02", minute]["status"] == "ESTIMATED"
        for node in ("N03", "N04", "N05", "N06", "N07", "N08", "N11"):
            assert nodes[node, minute]["status"] == "BALANCED"
            assert nodes[node, minute]["imbalance_tph"] == pytest.approx(0)
        assert nodes["N07", minute]["mass_in_tph"] == pytest.approx(1150)
        assert nodes["N09", minute]["imbalance_tph"] == pytest.approx(0.347, abs=1e-3)
        assert nodes["N10", minute]["imbalance_tph"] == pytest.approx(-0.413, abs=1e-3)
        for node in ("N01", "N12", "N13"):
            assert nodes[node, minute]["status"] == "NOT_APPLICABLE"
            assert nodes[node, minute]["imbalance_tph"] is None
        assert nodes["N04", minute]["accumulation_tph"] == pytest.approx(0)
        assert nodes["N09", minute]["arcs_in_total"] == 2  # water never counts


def test_bad_rows_are_not_absent_rows(spark):
    def bad(tag_id, second, value, row):
        is_hit = tag_id == "CV-CV001-WI01" and 60 <= second < 120
        return reading(tag_id, second, value, quality="BAD") if is_hit else row

    _, nodes = run(spark, design_rows(3, bad))
    assert nodes["N03", 1]["status"] == nodes["N04", 1]["status"] == "INSUFFICIENT_DATA"
    assert nodes["N03", 0]["status"] == nodes["N03", 2]["status"] == "BALANCED"

    def absent(tag_id, second, value, row):
        return None if tag_id == "CV-CV001-WI01" and 60 <= second < 120 else row

    incidence, nodes = run(spark, design_rows(3, absent))
    inferred = {(r["arc_id"], r["window_start"].minute): r["inferred_from_node_id"] for r in balance.arc_infer(incidence).collect()}
    assert inferred["A02", 1] == "N02" and inferred["A03", 1] == "N04"
    assert nodes["N04", 1]["status"] == "ESTIMATED"
    assert nodes["N03", 1]["status"] == "BALANCED"


@pytest.mark.parametrize("factor, status", [(1.03, "DRIFT"), (1.06, "ALARM")])
def test_offset(spark, factor, status):
    def shift(tag_id, second, value, row):
        return reading(tag_id, second, value * factor) if tag_id == "CV-CV002-WI01" else row

    _, nodes = run(spark, design_rows(1, shift))
    assert nodes["N04", 0]["status"] == nodes["N05", 0]["status"] == status


def test_level_change_is_storage(spark):
    def ramp(tag_id, second, value, row):
        if tag_id == "CRU-SGB01-LI01":
            return reading(tag_id, second, 55.0 if second < 60 else 56.0)
        if tag_id == "CV-CV001-WI01" and second >= 60:
            return reading(tag_id, second, value + 510.0)
        return row

    _, nodes = run(spark, design_rows(2, ramp))
    assert nodes["N04", 1]["accumulation_tph"] == pytest.approx(510)
    assert nodes["N04", 1]["imbalance_tph"] == pytest.approx(0)


def test_gap_does_not_inflate_storage(spark):
    def ramp(tag_id, second, value, row):
        if 60 <= second < 180:
            return None
        return reading(tag_id, second, 55.0 + second / 60.0) if tag_id == "CRU-SGB01-LI01" else row

    rows = [r for r in design_rows(4, ramp)]
    tag_1m = tag_reading_1m(readings(spark, rows))
    steps = balance.node_accumulation(tag_1m, plant.nodes(spark)).where("node_id = 'N04'").collect()
    change = [r["accumulation_tph"] for r in sorted(steps, key=lambda r: r["window_start"])]
    assert change[0] is None
    assert change[1] == pytest.approx(3.0 / 100 * 850 * 60 / 3)


def test_zero_inflow_is_alarm(spark):
    def stop(tag_id, second, value, row):
        return reading(tag_id, second, 0.0) if tag_id == "CV-CV006-WI01" else row

    _, nodes = run(spark, design_rows(1, stop))
    assert nodes["N08", 0]["mass_in_tph"] == 0
    assert nodes["N08", 0]["imbalance_pct"] is None
    assert nodes["N08", 0]["status"] == "ALARM"


def test_two_unknowns_stay_unknown(spark):
    def lost(tag_id, second, value, row):
        return None if tag_id in ("CV-CV003-WI01", "CV-CV004-WI01", "CV-CV005-WI01") else row

    incidence, nodes = run(spark, design_rows(1, lost))
    flows = arc_rows(incidence)
    assert flows["A05", 0]["measured_tph"] is None
    assert nodes["N06", 0]["status"] == "INSUFFICIENT_DATA"


def test_zero_density_does_not_raise(spark):
    def zero(tag_id, second, value, row):
        return reading(tag_id, second, 0.0) if tag_id.startswith("DSD-CYC01-DI") else row

    incidence, _ = run(spark, design_rows(1, zero))
    assert arc_rows(incidence)["A11", 0]["measured_tph"] < 0


def test_no_further_shuffle_after_the_window_partitioning(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tag_1m = tag_reading_1m(readings(spark, design_rows(1)))
        path = f"{__import__('tempfile').mkdtemp()}/t1"
        tag_1m.write.parquet(path)
        from gritstone.session import materialize

        incidence = balance.reconciled_incidence(
            spark.read.parquet(path), materialize(plant.arcs(spark)), materialize(plant.nodes(spark)),
            materialize(plant.tags(spark)),
        )
        plan = balance.mass_balance_node_1m(incidence)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    top = plan[: plan.index("REPARTITION_BY_COL")]
    assert top.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_checks_of_the_design(spark):
    closed = balance.design_closure(plant.arcs(spark), plant.nodes(spark)).collect()
    assert len(closed) == 13 and all(r["closes"] for r in closed)
    wet = balance.wet_dry_check(plant.tags(spark), 2500.0).first()
    assert wet["reconciles"] and wet["feed_solids_tph"] == pytest.approx(2501.205, abs=1e-3)
    assert checks.slurry_partner_check(plant.arcs(spark), plant.tags(spark)).count() == 0
    without = plant.tags(spark).where("tag_id <> 'DSD-CYC01-DI02'")
    assert [r["arc_id"] for r in checks.slurry_partner_check(plant.arcs(spark), without).collect()] == ["A11"]


def test_arc_against_design(spark):
    incidence, _ = run(spark, design_rows(1))
    report = rows_by(balance.arc_vs_design(balance.mass_flow_final(incidence)), "arc_id")
    assert all(r["within_tolerance"] for a, r in report.items() if a != "A15")
    assert report["A15"]["measured_tph"] is None
