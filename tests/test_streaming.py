"""Streams fed in several files: batch results, late rows, repeats and replays."""

from __future__ import annotations

import random
import tempfile

import pytest

from gritstone.operators import alerts
from gritstone.operators.readings import tag_reading_1m
from gritstone.schemas import DIM_TAG, TAG_READING
from gritstone.sources.readings import read_stream
from gritstone.sources.upsert import read_current, upsert
from gritstone.streaming import jobs
from gritstone.streaming.silence import stream_stale_tags
from tests import plant
from tests.helpers import at, reading, readings, rows_by, tag

LIMITS = (0.0, 10.0, 20.0, 30.0)


def folder():
    return tempfile.mkdtemp(prefix="gritstone-test-")


@pytest.fixture(scope="module")
def tags(spark):
    return spark.createDataFrame([
        tag("A-CV01-WI01", limits=LIMITS), tag("A-CR01-TI01", "crusher", "temperature", limits=LIMITS),
    ], DIM_TAG)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    return [
        reading(rng.choice(["A-CV01-WI01", "A-CR01-TI01"]), s, rng.choice([15.0, 25.0, 35.0]),
                quality=rng.choice(["GOOD"] * 9 + ["BAD"]))
        for s in sorted(rng.sample(range(6000), 500))
    ]


def feed(spark, batches):
    path = folder()
    for n, batch in enumerate(batches):
        readings(spark, batch).coalesce(1).write.mode("append").parquet(f"{path}/f")
    return f"{path}/f"


def source(spark, path, delay="2 hours"):
    stream = read_stream(spark, path, TAG_READING, TAG_READING.names, files_per_trigger=1)
    return jobs.event_time(stream, delay)


def drain(spark, df, mode):
    """Run over all files; complete results replace each other, appended ones add up."""
    out = folder() + "/out"
    if mode == "append":
        writer = df.writeStream.format("parquet").option("path", out)
    else:
        writer = df.writeStream.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out))
    writer.outputMode(mode).option("checkpointLocation", folder()).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def as_set(df, *columns):
    return sorted(str([r[c] for c in columns]) for r in df.collect())


def test_minute_aggregate_equals_batch(spark, rows):
    path = feed(spark, [rows[:200], rows[200:350], rows[350:]])
    columns = ("tag_id", "window_start", "avg_value", "min_value", "first_value", "last_value", "sample_count", "good_count")
    want = tag_reading_1m(readings(spark, rows))
    assert as_set(drain(spark, jobs.stream_tag_1m(source(spark, path)), "complete"), *columns) == as_set(want, *columns)
    # Append mode emits a window once the watermark has passed its end.
    closed = drain(spark, jobs.stream_tag_1m(source(spark, path, "0 seconds")), "append")
    got = as_set(closed, *columns)
    assert 0 < len(got) < want.count() and set(got) <= set(as_set(want, *columns))


def test_repeats_are_dropped_across_batches(spark, rows):
    path = feed(spark, [rows[:300], rows[100:400], rows[400:] + rows[:10]])
    out = drain(spark, jobs.deduplicated(source(spark, path)).select("event_id"), "append")
    assert sorted(r["event_id"] for r in out.collect()) == sorted(r[0] for r in rows)


def test_late_rows_do_not_replace_newer_ones(spark):
    path = feed(spark, [[reading("A", 100, 1.0), reading("B", 5, 1.0)], [reading("A", 50, 9.0), reading("C", 1, 2.0)], [reading("B", 7, 3.0)]])
    out, checkpoint = folder(), folder()
    jobs.stream_current(source(spark, path), out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = rows_by(read_current(spark, out), "tag_id")
    assert {k: r["value"] for k, r in got.items()} == {"A": 1.0, "B": 3.0, "C": 2.0}


def test_a_stream_with_a_new_checkpoint_goes_on(spark):
    out, outbox = folder(), folder()
    tags = spark.createDataFrame([tag("A-CV01-WI01", limits=(0.0, 10.0, 20.0, 30.0))], DIM_TAG)
    for seconds, value in ((0, 41.0), (10, 42.0), (20, 43.0)):
        path = feed(spark, [[reading("A-CV01-WI01", seconds, value)]])
        jobs.stream_current(source(spark, path), out, folder()).trigger(availableNow=True).start().awaitTermination()
        found = jobs.stream_limit_alerts(source(spark, path), tags, plant.rules(spark))
        jobs.stream_alert_sink(found, outbox, folder()).trigger(availableNow=True).start().awaitTermination()
        assert [r["value"] for r in read_current(spark, out).collect()] == [value]
    assert sorted(r["trigger_value"] for r in spark.read.parquet(outbox).collect()) == [41.0, 42.0, 43.0]


def test_a_replayed_batch_changes_nothing(spark):
    path = folder()
    for seq, value in [(1, 1.0), (2, 2.0), (2, 2.0), (1, 1.0)]:
        batch = spark.createDataFrame([("A", seq, value)], "tag_id string, seq long, value double")
        upsert(batch, path, ["tag_id"], by=["seq"])
    assert [(r["seq"], r["value"]) for r in read_current(spark, path).collect()] == [(2, 2.0)]


def test_limit_alerts_and_outbox(spark, rows, tags):
    path = feed(spark, [rows[:250], rows[250:]])
    found = jobs.stream_limit_alerts(source(spark, path), tags, plant.rules(spark))
    out, checkpoint = folder(), folder()
    jobs.stream_alert_sink(found, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).collect()
    want = [r for r in rows if r[5] != "GOOD" or r[3] > 20]
    assert len(got) == len(want) == len({r["alert_id"] for r in got})
    assert {r["delivery_status"] for r in got} == {"PENDING"}
    by_type = {r["rule_type"]: r for r in got if r["tag_id"] == "A-CV01-WI01"}
    assert by_type["quality"]["trigger_text"] == "BAD" and by_type["quality"]["message"] == "A-CV01-WI01 sends BAD"
    assert by_type["limit_trip"]["severity"] == "CRITICAL"


@pytest.mark.parametrize("gap", [60, 5])
def test_episodes_equal_batch(spark, rows, tags, gap):
    path = feed(spark, [rows[:250], rows[250:]])
    columns = ("tag_id", "rule_type", "raised_at", "ended_at", "samples", "peak_high")
    got = drain(spark, jobs.stream_episodes(source(spark, path), tags, gap), "complete")
    want = alerts.alert_episodes(alerts.limit_breaches(readings(spark, rows), tags), gap)
    assert as_set(got, *columns) == as_set(want, *columns)


LAST = 100_000


def closing(rows):
    """Files in order of time, some rows a file late, and one row that moves the watermark past the rest."""
    late = rows[180:200]
    end = [reading("A-CR01-TI01", LAST, 15.0)]
    return [rows[:180], rows[200:350] + late, rows[350:], end]


def run_append(spark, path, build, delay="1 hour"):
    """The appended rows, and the rows left in the state of the last batch."""
    df, out = build(source(spark, path, delay)), folder() + "/out"
    query = df.writeStream.format("parquet").option("path", out).outputMode("append").option(
        "checkpointLocation", folder()).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(out), [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]


def test_silences_equal_batch(spark, rows):
    tags = spark.createDataFrame([tag("A-CV01-WI01"), tag("A-CV02-WI01"), tag("A-CR01-TI01", "crusher", "temperature")], DIM_TAG)
    path, since = feed(spark, closing(rows)), str(at(-200))
    got, left = run_append(spark, path, lambda r: stream_stale_tags(r, tags, since, 30))
    want = alerts.stale_tags(readings(spark, rows), tags, str(at(LAST)), 30, since=since)
    assert as_set(got, "tag_id", "last_seen") == as_set(want, "tag_id", "last_seen")
    found = got.collect()
    assert [(r["last_seen"], r["stale_from"]) for r in found if r["tag_id"] == "A-CV02-WI01"] == [(None, at(-170))]
    assert len(found) == len(want.collect()) > 10


def test_rows_behind_the_watermark_break_no_silence(spark):
    tags = spark.createDataFrame([tag("A-CV01-WI01"), tag("A-CR01-TI01", "crusher", "temperature")], DIM_TAG)
    name, other = "A-CV01-WI01", "A-CR01-TI01"
    batches = [[reading(name, s, 1.0) for s in (0, 20, 40)], [reading(other, 500, 1.0)], [reading(other, 510, 1.0)], [reading(name, 100, 9.0), reading(name, 600, 1.0)], [reading(other, 900, 1.0)]]
    got, _ = run_append(spark, feed(spark, batches), lambda r: stream_stale_tags(r, tags, str(at(-10)), 60), "100 seconds")
    assert sorted(r["last_seen"] for r in got.collect()) == [at(40), at(600)]


def test_rise_equals_batch(spark, rows, tags):
    got, left = run_append(spark, feed(spark, closing(rows)), lambda r: jobs.stream_rate_of_change(r, tags))
    want = alerts.rate_of_change(readings(spark, rows), tags, 0.0)
    columns = ("tag_id", "window_start", "first_value", "last_value", "rise")
    assert as_set(got.where("rise > 0"), *columns) == as_set(want, *columns) and got.count()
    assert sorted(left) == [0, 1]


def test_closed_windows_and_sessions_leave_the_state(spark, rows, tags):
    path = feed(spark, closing(rows))
    columns = ("tag_id", "window_start", "avg_value", "first_value", "last_value", "sample_count", "good_count")
    got, left = run_append(spark, path, jobs.stream_tag_1m)
    want = tag_reading_1m(readings(spark, rows))
    assert as_set(got, *columns) == as_set(want, *columns) and left == [1]
    columns = ("tag_id", "rule_type", "raised_at", "ended_at", "samples", "peak_high")
    got, left = run_append(spark, path, lambda r: jobs.stream_episodes(r, tags, 60))
    want = alerts.alert_episodes(alerts.limit_breaches(readings(spark, rows), tags), 60)
    assert as_set(got, *columns) == as_set(want, *columns) and left == [0]
