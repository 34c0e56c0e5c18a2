from __future__ import annotations

import random

import pytest

from gritstone.operators import equipment, stockpile
from gritstone.operators.readings import tag_reading_1m
from gritstone.schemas import DIM_TAG
from tests.helpers import at, reading, readings, rows_by, tag

RUN = "RUNNING|STOPPED|FAULT"
TAGS = stockpile.StackerTags()


def test_equipment_state(spark):
    tags = spark.createDataFrame([
        tag("A-CV01-ZI01", measure="state", enum=RUN), tag("A-CV01-ZI02", measure="state", enum="IDLE|SP01"),
        tag("A-CV01-II01", measure="motor_current"), tag("A-CV01-WI01"),
    ], DIM_TAG)
    states = ["RUNNING"] * 20 + ["STOPPED"] * 50 + ["RUNNING"] * 30 + ["FAULT"] * 20
    rows = [reading("A-CV01-ZI01", s, text=t) for s, t in enumerate(states)]
    rows += [reading("A-CV01-ZI02", s, text="SP01") for s in range(120)]
    rows += [reading("A-CV01-II01", s, 10.0 + s) for s in range(120)]
    rows += [reading("A-CV01-WI01", s, 500.0) for s in range(120)]
    data = readings(spark, rows)
    got = rows_by(equipment.equipment_state_1m(data, tags, tag_reading_1m(data), slice_seconds=45), "window_start")
    first, second = got[at(0)], got[at(60)]
    assert (first["run_seconds"], first["stop_seconds"], first["fault_seconds"], first["starts"]) == (20, 40, 0, 0)
    assert (second["run_seconds"], second["stop_seconds"], second["fault_seconds"], second["starts"]) == (30, 10, 20, 1)
    assert (first["state"], second["state"]) == ("STOPPED", "FAULT")
    assert second["availability_pct"] == pytest.approx(50.0)
    assert (first["max_current_a"], first["throughput_tph"]) == (69.0, 500.0)
    ten = equipment.run_minutes_10m(equipment.equipment_state_1m(data, tags, tag_reading_1m(data))).first()
    assert ten["run_minutes"] == pytest.approx(50 / 60)


def test_stockpile_campaigns(spark):
    """IDLE, SP01, SP01, IDLE, SP02, SP01 with irregular gaps at 3600 t/h: tonnes are seconds."""
    steps = [(0, "IDLE"), (10, "SP01"), (25, "SP01"), (40, "IDLE"), (100, "SP02"), (4000, "SP01")]
    rows = [reading(TAGS.pile, s, text=t) for s, t in steps] + [reading(TAGS.rate, s, 3600.0) for s, _ in steps]
    rows += [
        reading(TAGS.fe, 10, 60.0), reading(TAGS.fe, 39, 62.0), reading(TAGS.fe, 40, 99.0),
        reading(TAGS.fe, 4000.5, 64.0), reading(TAGS.fe, 4001, 99.0), reading(TAGS.sio2, 3999, 3.0),
        reading(TAGS.fe, 30, 99.0, quality="BAD"),
    ]
    for slice_seconds in (20, 3600):
        got = rows_by(stockpile.stockpile_state(readings(spark, rows), slice_seconds=slice_seconds), "stockpile_id")
        assert set(got) == {"SP01", "SP02"}
        assert got["SP01"]["tonnes_stacked_cum"] == pytest.approx(31.0)
        assert got["SP02"]["tonnes_stacked_cum"] == pytest.approx(3900.0)
        assert (got["SP01"]["campaigns"], got["SP01"]["stack_started_at"]) == (2, at(4000))
        assert (got["SP01"]["is_stacking"], got["SP02"]["is_stacking"]) == (True, False)
        assert got["SP01"]["avg_fe_pct"] == pytest.approx(62.0)
        assert (got["SP02"]["avg_fe_pct"], got["SP02"]["avg_sio2_pct"]) == (None, 3.0)


def test_grade_equals_range_join(spark):
    rng = random.Random(11)
    rows = [reading(TAGS.pile, s, text=rng.choice(["IDLE", "SP01", "SP02"])) for s in rng.sample(range(9000), 200)]
    rows += [reading(TAGS.fe, s + 0.5, float(rng.randrange(50, 70))) for s in rng.sample(range(9000), 150)]
    data = readings(spark, rows)
    runs = stockpile.pile_runs(data, TAGS, 600)
    got = rows_by(stockpile.grade_while_stacking(data, runs, TAGS, 600), "stockpile_id")
    piles = sorted((r[2], r[4]) for r in rows if r[1] == TAGS.pile)
    sums = {}
    for row in rows:
        if row[1] != TAGS.fe:
            continue
        inside = [k for k, (ts, _) in enumerate(piles) if ts <= row[2]]
        if not inside:
            continue
        k = inside[-1]
        open_until = piles[k + 1][0] if k + 1 < len(piles) else piles[k][0].replace(microsecond=0) + (at(1) - at(0))
        if row[2] < open_until and piles[k][1] != "IDLE":
            sums.setdefault(piles[k][1], []).append(row[3])
    assert {k: pytest.approx(sum(v) / len(v)) for k, v in sums.items()} == {k: r["avg_fe_pct"] for k, r in got.items()}
