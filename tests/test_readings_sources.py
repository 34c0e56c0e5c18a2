from __future__ import annotations

import random
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gritstone.operators import history, readings as rd
from gritstone.schemas import DIM_RULE, DIM_TAG
from gritstone.sources import dims, readings as seam, sinks, upsert
from tests.helpers import at, reading, readings, rows_by, tag


def folder():
    return tempfile.mkdtemp(prefix="gritstone-test-")


def test_dims_are_typed_and_empty_text_is_null(spark):
    path = folder() + "/rules"
    header = "rule_id,rule_name,scope_type,scope_value,rule_type,severity,window_seconds,message_template,enabled"
    lines = [header, "R01,Trip,all,,limit_trip,CRITICAL,0,{tag_id} high,True", "R02,Warn,measure,flow,limit_warn,,60,x,False"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    got = rows_by(dims.read_dim(spark, path, DIM_RULE), "rule_id")
    assert got["R01"]["scope_value"] is None and got["R01"]["enabled"] is True
    assert got["R02"]["severity"] is None and got["R02"]["window_seconds"] == 60


def test_seam_drops_the_producer(spark):
    df = seam.reading_view(readings(spark, [reading("T", 0, 1.0)]))
    assert len(df.columns) == 9 and "producer" not in df.columns


def test_minute_aggregate(spark):
    rows = [reading("T", 0, 1.0), reading("T", 30, 3.0), reading("T", 50, 100.0, quality="BAD"), reading("T", 60, 5.0), reading("Z", 5, text="RUNNING")]
    got = rows_by(rd.tag_reading_1m(readings(spark, rows)), "tag_id", "window_start")
    first = got["T", at(0)]
    assert (first["avg_value"], first["last_value"], first["sample_count"], first["good_count"]) == (2.0, 100.0, 3, 2)
    assert first["stddev_value"] == pytest.approx(2 ** 0.5) and first["good_pct"] == pytest.approx(200 / 3)
    assert got["T", at(60)]["stddev_value"] is None
    assert got["Z", at(0)]["avg_value"] is None and got["Z", at(0)]["sample_count"] == 1


def test_snapshot_bounds_and_ties(spark):
    rows = [reading("A", 0, 1.0), reading("A", 1800, 2.0, seq=5), reading("A", 1800, 3.0, seq=6), reading("A", 1801, 9.0), reading("B", 0, 4.0), reading("C", 1, 5.0)]
    got = rows_by(rd.snapshot_as_of(readings(spark, rows), str(at(1800)), 1800), "tag_id")
    assert {k: r["value"] for k, r in got.items()} == {"A": 3.0, "C": 5.0}


def test_overlay_equals_brute_force(spark):
    rng = random.Random(4)
    intervals = []
    for _ in range(40):
        start = rng.randrange(0, 9000)
        intervals.append((rng.choice("AB"), at(start), at(start + rng.choice([0, 10, 300, 2000])), float(rng.randrange(100, 200)), rng.choice([None, "STALE"])))
    intervals += [("B", at(-400_000_000), at(3000), 7.0, None), ("C", at(2000), at(400_000_000), 8.0, "BAD"), ("A", at(9500), at(900_000), 9.0, None)]
    rows = [reading(rng.choice("ABC"), s, 1.0) for s in range(0, 10_000, 13)]
    rows += [reading("A", 9990 + k, 1.0) for k in range(3)]
    table = spark.createDataFrame(intervals, "tag_id string, t_start timestamp, t_end timestamp, value double, quality string")
    for seconds in (500, 3600, 1):
        out = rd.overlay_intervals(readings(spark, rows), table, seconds)
        got = rows_by(out, "event_id")
        assert out.count() == len(rows)
        for row in rows:
            mine = [i for i in intervals if i[0] == row[1] and i[1] <= row[2]]
            value, quality = row[3], row[5]
            if mine:
                last = max(mine, key=lambda i: (i[1], i[2]))
                if row[2] > last[2]:
                    last = max(mine, key=lambda i: (i[2], i[1]))
                if row[2] <= last[2]:
                    value, quality = last[3], last[4] or quality
            assert (got[row[0]]["value"], got[row[0]]["quality"]) == (value, quality)


def test_overlay_of_a_crowded_slice_makes_no_pairs(spark):
    intervals = [("A", at(2 * k), at(2 * k + 1), float(k), "STALE") for k in range(400)] + [("A", at(100), at(100), -1.0, None), (None, at(0), at(900), -2.0, "BAD")]
    table = spark.createDataFrame(intervals, "tag_id string, t_start timestamp, t_end timestamp, value double, quality string")
    rows = [reading("A", s, 1.0) for s in range(0, 900)] + [reading("B", 5, 1.0)]
    out = rd.overlay_intervals(readings(spark, rows), table, 3600)
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert joins and not [line for line in joins if ">=" in line or "<=" in line or "seg" in line]
    got = rows_by(out, "event_id")
    for row in rows:
        k = int((row[2] - at(0)).total_seconds()) // 2
        held = row[1] == "A" and k < 400 and k * 2 <= (row[2] - at(0)).total_seconds() <= k * 2 + 1
        assert got[row[0]]["value"] == (intervals[k][3] if held else 1.0) or row[2] == at(100)


@pytest.mark.parametrize("first, last", [(0, 0), (-5, 3), (7, 64), (8, 63), (1, 87_600), (-87_601, 3), (-(10**9), 10**9 + 1)])
def test_covering_cells_tile_an_interval(spark, first, last):
    cells = spark.range(1).select(rd.covering_cells(F.lit(first).cast("long"), F.lit(last).cast("long")).alias("c")).first()["c"]
    spans = sorted((c["cell"] * rd.RADIX ** c["level"], (c["cell"] + 1) * rd.RADIX ** c["level"] - 1) for c in cells)
    assert spans[0][0] == first and spans[-1][1] == last
    assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    if last - first <= 87_600:
        assert len(spans) < 100


def test_override_and_profiles(spark):
    rows = [reading("A", 0, 2.0), reading("B", 0, 2.0), reading("A", 1, None), reading("A", 2, 2.0, quality="BAD")]
    factors = spark.createDataFrame([("A", 3.0)], "tag_id string, multiplier double")
    out = rd.override_values(readings(spark, rows), factors)
    assert sorted((r["tag_id"], r["value"]) for r in out.collect() if r["value"] is not None) == [("A", 6.0), ("A", 6.0), ("B", 2.0)]
    shares = rows_by(rd.quality_distribution(readings(spark, rows)), "quality")
    assert (shares["GOOD"]["n"], shares["GOOD"]["pct"]) == (3, 75.0)
    tags = spark.createDataFrame([("A", *tag("X-A01", limits=(0.0, 1.0, 2.0, 3.0))[1:])], DIM_TAG)
    counts = rd.breach_counts(readings(spark, rows), tags).first()
    assert (counts["trip_breaches"], counts["warn_breaches"], counts["tags_excursed"]) == (0, 2, 0)
    assert rd.fresh_count(readings(spark, rows), str(at(1800)), 30).first()["rows_recent"] == 4


def test_newest_wins_upsert(spark):
    path = folder() + "/current"
    def batch(*rows):
        return spark.createDataFrame(rows, "tag_id string, seq long, value double")

    upsert.upsert(batch(("A", 5, 1.0), ("B", 1, 1.0)), path, ["tag_id"], by=["seq"])
    upsert.upsert(batch(("A", 4, 2.0), ("B", 1, 3.0), ("C", 1, 4.0), ("C", 2, 5.0)), path, ["tag_id"], by=["seq"])
    got = rows_by(upsert.read_current(spark, path), "tag_id")
    assert {k: r["value"] for k, r in got.items()} == {"A": 1.0, "B": 1.0, "C": 5.0}
    upsert.upsert(batch(("A", 6, 9.0)), path, ["tag_id"], by=["seq"])
    assert rows_by(upsert.read_current(spark, path), "tag_id")["A"]["value"] == 9.0


def test_merge_replaces(spark):
    path = folder() + "/alerts"
    rows = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "id string, n int, t string")
    upsert.upsert(rows, path, ["id"])
    upsert.upsert(spark.createDataFrame([("a", 7, "y")], rows.schema), path, ["id"])
    got = rows_by(upsert.read_current(spark, path), "id")
    assert (got["a"]["n"], got["b"]["n"]) == (7, 2)
    assert upsert.upsert(rows.limit(0), path, ["id"]) == [] and upsert.upsert(rows.limit(0), folder() + "/none", ["id"]) == []
    assert upsert.read_current(spark, folder() + "/none") is None
    with pytest.raises(Exception, match="several source rows"):
        upsert.upsert(spark.createDataFrame([("b", 3, "y"), ("b", 4, "z")], rows.schema), path, ["id"])
    assert rows_by(upsert.read_current(spark, path), "id")["b"]["n"] == 2


def test_upsert_leaves_other_partitions_alone(spark):
    path = folder() + "/table"
    first = spark.range(500).selectExpr("concat('k', id) AS id", "id AS n")
    upsert.upsert(first, path, ["id"], parts=16)

    def files():
        found = {}
        for p in Path(path).glob("key_part_of_16=*/*.parquet"):
            found.setdefault(int(p.parent.name.split("=")[1]), set()).add((p.name, p.stat().st_mtime_ns))
        return found

    before = files()
    changed = spark.createDataFrame([("k3", -1), ("k77", -2), ("new", -3)], first.schema)
    touched = upsert.upsert(changed, path, ["id"])
    after = files()
    assert 0 < len(touched) <= 3 and len(before) == 16
    assert all(before[k] == after[k] for k in before if k not in touched) and all(before[k] != after[k] for k in touched)
    got = {r["id"]: r["n"] for r in upsert.read_current(spark, path).collect()}
    assert got == {**{f"k{k}": k for k in range(500)}, "k3": -1, "k77": -2, "new": -3}
    assert upsert.upsert(changed, path, ["id"]) == touched and {r["id"]: r["n"] for r in upsert.read_current(spark, path).collect()} == got


def test_append_reads_only_the_days_it_writes(spark):
    path = folder() + "/predictions"
    rows = spark.createDataFrame([("p1", at(0), 1), ("p2", at(90_000), 2)], "id string, at timestamp, n int")
    sinks.append_unseen(rows, path, "id", "at")
    (Path(path) / "day=1999-01-01").mkdir()
    (Path(path) / "day=1999-01-01" / "part-0.parquet").write_bytes(b"not a table")  # another day: must not be read
    more = spark.createDataFrame([("p2", at(90_000), 9), ("p3", at(90_001), 3)], rows.schema)
    sinks.append_unseen(more, path, "id", "at")
    sinks.append_unseen(more, path, "id", "at")
    held = spark.read.schema("id string, at timestamp, n int, day date").parquet(path)
    assert sorted((r["id"], r["n"]) for r in held.where("day > '2000-01-01'").collect()) == [("p1", 1), ("p2", 2), ("p3", 3)]


def test_sinks(spark):
    path = folder() + "/predictions"
    rows = spark.createDataFrame([("p1", 1.0), ("p2", 2.0)], "prediction_id string, p double")
    sinks.append_unseen(rows, path, "prediction_id")
    sinks.append_unseen(rows.unionByName(spark.createDataFrame([("p3", 3.0)], rows.schema)), path, "prediction_id")
    assert sorted(r["prediction_id"] for r in spark.read.parquet(path).collect()) == ["p1", "p2", "p3"]
    assert sinks.rows_to_json(rows).first()["json"] == '{"prediction_id":"p1","p":1.0}'
    days = folder() + "/days"
    sinks.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), days, ["day"])
    sinks.overwrite_table(spark.createDataFrame([(3, "a")], "v int, day string"), days, ["day"])
    assert sorted(r["v"] for r in spark.read.parquet(days).collect()) == [2, 3]


def test_layout_spreads_a_heavy_tag(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("tag_id"), F.col("id").alias("source_ts"))
    laid = sinks.layout_by_key(rows, ["tag_id", "source_ts"], 8)
    parts = laid.where("tag_id = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4


FEED = [
    ("insert", 30630096, 8, "OPEN", None), ("update_preimage", 30635096, 22, "OPEN", None),
    ("update_postimage", 30635096, 23, "IN_PROGRESS", None), ("update_preimage", 30636928, 24, "IN_PROGRESS", None),
    ("update_postimage", 30636928, 25, "CLOSED", 195),
]


def test_change_feed(spark):
    feed = spark.createDataFrame(
        [("WO-1", s, d, k, lsn, 0, at(0), n) for k, lsn, n, s, d in FEED] + [("WO-2", "OPEN", 1, "insert", 5, 0, at(0), 1), ("WO-2", "OPEN", 1, "delete", 9, 0, at(0), 2)],
        "work_order_id string, status string, downtime_minutes int, _pg_change_type string, _pg_lsn long, _pg_xid int, _timestamp timestamp, _sort_by long",
    )
    latest = rows_by(history.latest_images(feed, "work_order_id"), "work_order_id")
    assert (latest["WO-1"]["status"], latest["WO-1"]["downtime_minutes"]) == ("CLOSED", 195)
    for width in (1000, 10_000_000):
        full = history.scd2_history(feed, "work_order_id", width).collect()
        states = sorted((r["work_order_id"], r["valid_from"], r["valid_to"], r["status"], r["is_current"]) for r in full if r["work_order_id"] == "WO-1" and r["valid_to"])
        assert states == [("WO-1", 30630096, 30635096, "OPEN", False), ("WO-1", 30635096, 30636928, "IN_PROGRESS", False)]
        assert [(r["status"], r["valid_from"]) for r in full if r["is_current"]] == [("CLOSED", 30636928)]
        assert [(r["valid_from"], r["valid_to"]) for r in full if r["work_order_id"] == "WO-2"] == [(5, 9)]
