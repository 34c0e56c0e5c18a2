from __future__ import annotations

import random

from gritstone.operators import alerts
from gritstone.schemas import DIM_TAG
from tests import plant
from tests.helpers import at, reading, readings, rows_by, tag

LIMITS = (0.0, 10.0, 20.0, 30.0)


def register(spark):
    return spark.createDataFrame([
        tag("A-CV01-WI01", limits=LIMITS), tag("A-CR01-PI01", "crusher", "pressure", limits=LIMITS),
        tag("A-BN01-LI01", "bin", "level", limits=LIMITS),
        tag("A-SC01-VI01", "screen", "vibration", limits=LIMITS),
        tag("A-CV01-ZI01", measure="state", enum="RUNNING|STOPPED|FAULT"),
    ], DIM_TAG)


def episodes_of(spark, rows, gap=60, slice_seconds=3600):
    breaches = alerts.limit_breaches(readings(spark, rows), register(spark))
    found = alerts.alert_episodes(breaches, gap, slice_seconds).collect()
    return sorted((r["rule_type"], r["raised_at"], r["ended_at"], r["samples"]) for r in found)


def test_short_gap_joins_and_long_gap_parts(spark):
    rows = [reading("A-CV01-WI01", s, 25.0) for s in (0, 1, 2, 3, 4, 34, 124)]
    assert episodes_of(spark, rows) == [
        ("limit_warn", at(0), at(34), 6), ("limit_warn", at(124), at(124), 1),
    ]


def test_gap_is_counted_in_whole_seconds(spark):
    rows = [reading("A-CV01-WI01", s, 25.0) for s in (0, 60.9)]
    assert len(episodes_of(spark, rows)) == 1
    rows = [reading("A-CV01-WI01", s, 25.0) for s in (0, 61)]
    assert len(episodes_of(spark, rows)) == 2


def test_limits_are_strict_and_only_good_counts(spark):
    rows = [
        reading("A-CV01-WI01", 0, 20.0), reading("A-CV01-WI01", 1, 10.0),
        reading("A-CV01-WI01", 2, 25.0, quality="BAD"), reading("A-CV01-WI01", 3, 30.0),
        reading("A-CV01-WI01", 4, -1.0),
    ]
    assert [e[0] for e in episodes_of(spark, rows)] == ["limit_trip", "limit_warn"]


def test_trip_inside_a_warning(spark):
    def sample(trip):
        return [reading("A-CV01-WI01", s, 35.0 if s in trip else 25.0) for s in range(0, 200, 5)]

    short = episodes_of(spark, sample(range(50, 100)))
    assert [e[0] for e in short] == ["limit_trip", "limit_warn"]
    long = episodes_of(spark, sample(range(50, 130)))
    assert [e[0] for e in long] == ["limit_trip", "limit_warn", "limit_warn"]


def test_slices_do_not_change_episodes(spark):
    rng = random.Random(5)
    rows = [reading("A-CV01-WI01", s, rng.choice([15.0, 25.0, 35.0, 5.0])) for s in sorted(rng.sample(range(20_000), 700))]
    whole = episodes_of(spark, rows, slice_seconds=10_000_000)
    assert len(whole) > 50
    assert episodes_of(spark, rows, slice_seconds=300) == whole
    # Brute force over the sorted samples.
    expected, last, count = [], {}, {}
    for row in rows:
        value, ts = row[3], row[2]
        kind = "limit_trip" if value > 30 or value < 0 else "limit_warn" if value > 20 or value < 10 else None
        if kind is None:
            continue
        if kind in last and int((ts - last[kind]).total_seconds()) <= 60:
            count[kind][2:] = [ts, count[kind][3] + 1]
        else:
            count[kind] = [kind, ts, ts, 1]
            expected.append(count[kind])
        last[kind] = ts
    assert sorted(map(tuple, expected)) == whole


def test_rule_choice_is_by_scope(spark):
    rows = [
        reading("A-CV01-WI01", 0, 35.0), reading("A-CR01-PI01", 0, 35.0), reading("A-BN01-LI01", 0, 25.0),
        reading("A-SC01-VI01", 0, 25.0), reading("A-CV01-WI01", 500, 5.0),
    ]
    found = alerts.derive_alerts(readings(spark, rows), register(spark), plant.rules(spark)).collect()
    chosen = {(r["tag_id"], r["rule_type"]): r for r in found}
    assert {k: r["rule_id"] for k, r in chosen.items()} == {
        ("A-CV01-WI01", "limit_trip"): "R01", ("A-CR01-PI01", "limit_trip"): "R07",
        ("A-BN01-LI01", "limit_warn"): "R08", ("A-SC01-VI01", "limit_warn"): "R03",
        ("A-CV01-WI01", "limit_warn"): "R02",
    }
    trip = chosen["A-CV01-WI01", "limit_trip"]
    assert trip["message"] == "name A-CV01: A-CV01-WI01 reads 35.00 u, past its stop limit"
    assert (trip["limit_low"], trip["limit_high"]) == (0.0, 30.0)
    assert (chosen["A-CV01-WI01", "limit_warn"]["limit_low"], chosen["A-CV01-WI01", "limit_warn"]["trigger_value"]) == (10.0, 5.0)
    assert len({r["alert_id"] for r in found}) == len(found)


def test_stale_and_rate_of_change(spark):
    tags = spark.createDataFrame([tag("A-CV01-WI01"), tag("A-CR01-TI01", "crusher", "temperature")], DIM_TAG)
    rows = [reading("A-CV01-WI01", s, 1.0) for s in (0, 60, 179, 300, 3700)]
    stale = alerts.stale_tags(readings(spark, rows), tags, str(at(3900)), 120, slice_seconds=600).collect()
    assert sorted((r["last_seen"], r["silent_seconds"]) for r in stale) == [(at(179), 121), (at(300), 3400), (at(3700), 200)]
    registered = tags.unionByName(spark.createDataFrame([tag("A-CV09-WI01")], tags.schema))
    for since, silent in ((-300, [(None, 300), (at(179), 121)]), (-100, [(at(179), 121)])):
        watched = alerts.stale_tags(readings(spark, rows), registered, str(at(3900)), 120, slice_seconds=600, since=str(at(since))).collect()
        assert [(r["last_seen"], r["silent_seconds"]) for r in watched if r["tag_id"] == "A-CV09-WI01"] == [(None, 3900 - since)]
        spoken = {(r["last_seen"], r["silent_seconds"]) for r in watched if r["tag_id"] != "A-CV09-WI01"}
        assert set(silent) <= spoken and len(spoken) == len(stale) + (since == -300)
    warm = [reading("A-CR01-TI01", 30 * n, 50.0 + (n if n > 20 else 0)) for n in range(30)]
    rises = rows_by(alerts.rate_of_change(readings(spark, warm), tags, 20.0), "window_start")
    assert rises and all(r["rise"] > 20 for r in rises.values())


def test_timed_rules_follow_their_scope(spark):
    from gritstone.schemas import DIM_RULE

    tags = spark.createDataFrame([tag("A-CV01-WI01"), tag("A-BN01-LI01", "bin", "level")], DIM_TAG)
    scopes = [("all", None), ("tag", "A-BN01-LI01"), ("asset_type", "bin"), ("measure", "mass_flow")]
    rules = spark.createDataFrame([(f"S{n}", "x", kind, value, "stale", "HIGH", 120, "{tag_id}", True) for n, (kind, value) in enumerate(scopes)], DIM_RULE)
    rows = [reading(t, s, 1.0) for t in ("A-CV01-WI01", "A-BN01-LI01") for s in (0, 400, 410)]
    states = spark.createDataFrame([], "asset_id string, window_start timestamp, window_end timestamp, state string, throughput_tph double")
    nodes = spark.createDataFrame([], "node_id string, window_start timestamp, window_end timestamp, balance_role string, imbalance_pct double")
    found = alerts.timed_rule_alerts(readings(spark, rows), tags, rules, states, nodes, str(at(500)), 1.0).collect()
    assert sorted((r["rule_id"], r["tag_id"]) for r in found) == [
        ("S0", "A-BN01-LI01"), ("S0", "A-CV01-WI01"), ("S1", "A-BN01-LI01"), ("S2", "A-BN01-LI01"), ("S3", "A-CV01-WI01")]


def test_sustained_imbalance_needs_full_windows(spark):
    rows = [("N1", at(60 * n), at(60 * n + 60), "unit", 6.0 if n >= 3 else 0.0) for n in range(10)]
    balance = spark.createDataFrame(rows, "node_id string, window_start timestamp, window_end timestamp, balance_role string, imbalance_pct double")
    hit = alerts.imbalance_sustained(balance).collect()
    assert sorted(r["window_start"] for r in hit) == [at(60 * n) for n in range(7, 10)]


def test_running_empty(spark):
    tags = spark.createDataFrame([tag("A-CV01-WI01", limits=LIMITS)], DIM_TAG)
    rows = [("A-CV01", at(60 * n), at(60 * n + 60), s, f) for n, (s, f) in enumerate([("RUNNING", 5.0), ("RUNNING", 15.0), ("STOPPED", 5.0), ("RUNNING", 4.0), ("RUNNING", 3.0)])]
    states = spark.createDataFrame(rows, "asset_id string, window_start timestamp, window_end timestamp, state string, throughput_tph double")
    assert sorted(r["window_start"] for r in alerts.running_empty(states, tags).collect()) == [at(0), at(180), at(240)]
    assert [r["window_start"] for r in alerts.running_empty(states, tags, seconds=120).collect()] == [at(240)]
