from __future__ import annotations

import tempfile

from gritstone.plans import refresh as plans
from gritstone.schemas import DIM_TAG
from tests import plant
from tests.helpers import at, reading, readings, rows_by, tag

DAY = 86400


def dims(spark):
    extra = [tag("CV-CV001-ZI01", measure="state", enum="RUNNING|STOPPED|FAULT")]
    extra += [tag(f"A-CR01-{c}01", "crusher", "vibration", nominal=4.0) for c in ("VI", "VP", "VK")]
    tags = plant.tags(spark).unionByName(spark.createDataFrame(extra, DIM_TAG))
    return plans.Dimensions(tags, plant.nodes(spark), plant.arcs(spark), plant.rules(spark))


def plant_rows(days):
    rows = []
    for day in days:
        for second in range(0, 180, 30):
            s = day * DAY + second
            rows += [reading(t, s, v) for t, v in plant.NOMINAL.items()]
            rows += [reading(f"A-CR01-{c}01", s, v) for c, v in (("VI", 4.0), ("VP", 14.0), ("VK", 3.0))]
            rows.append(reading("CV-CV001-ZI01", s, text="RUNNING" if second else "STOPPED"))
    return rows


def test_refresh_all_then_one_day(spark):
    out = tempfile.mkdtemp(prefix="gritstone-test-")
    plans.refresh(readings(spark, plant_rows([0, 1])), dims(spark), out)
    names = ["tag_reading_1m", "mass_flow_1m", "mass_balance_node_1m", "equipment_state_1m", "desands_balance_1m", "vibration_features_10m"]
    before = {n: spark.read.parquet(f"{out}/{n}").count() for n in names}
    assert before["mass_balance_node_1m"] == 13 * 6 and before["equipment_state_1m"] == 6
    assert before["desands_balance_1m"] == 6 and before["vibration_features_10m"] == 2
    plans.refresh(readings(spark, plant_rows([0, 1, 2])), dims(spark), out, days=[str(at(2 * DAY).date())])
    after = {n: spark.read.parquet(f"{out}/{n}").count() for n in names}
    assert all(after[n] * 2 == before[n] * 3 for n in names)
    states = {(r["node_id"], r["status"]) for r in spark.read.parquet(f"{out}/mass_balance_node_1m").collect()}
    assert ("N02", "ESTIMATED") in states and ("N04", "BALANCED") in states


def test_one_day_after_a_long_pause_equals_the_full_refresh(spark):
    rows = plant_rows([0])
    rows += [reading("CV-CV001-ZI01", 9 * DAY + 30, text="RUNNING"), reading("CRU-SGB01-LI01", 9 * DAY + 30, 60.0)]
    rows += [reading("CV-CV001-ZI01", 200, text="STOPPED"), reading("CV-CV001-WI01", 9 * DAY + 30, 2500.0)]
    full, part = tempfile.mkdtemp(prefix="gritstone-test-"), tempfile.mkdtemp(prefix="gritstone-test-")
    plans.refresh(readings(spark, rows), dims(spark), full)
    plans.refresh(readings(spark, rows), dims(spark), part, days=[str(at(9 * DAY).date())])
    for name in ("equipment_state_1m", "mass_balance_node_1m", "mass_flow_1m", "tag_reading_1m"):
        day = [spark.read.parquet(f"{out}/{name}").where(f"day = '{at(9 * DAY).date()}'").collect() for out in (full, part)]
        assert sorted(map(str, day[0])) == sorted(map(str, day[1])) and day[0]
    state = spark.read.parquet(f"{part}/equipment_state_1m").where("asset_id = 'CV-CV001'").first()
    assert state["starts"] == 1


def test_alert_table_follows_its_feed(spark):
    path = tempfile.mkdtemp(prefix="gritstone-test-")
    table = dims(spark)
    limits = spark.createDataFrame([tag("B-CV01-WI01", limits=(0.0, 10.0, 20.0, 30.0))], DIM_TAG)
    table = plans.Dimensions(limits, table.nodes, table.arcs, table.rules)
    rows = [reading("B-CV01-WI01", s, 25.0) for s in (0, 1, 500)]
    plans.refresh_alerts(readings(spark, rows), table, path)
    plans.refresh_alerts(readings(spark, rows), table, path)  # repeatable ids: no new alerts
    from gritstone.sources.upsert import read_current

    alerts = read_current(spark, path)
    assert alerts.count() == 2
    from pyspark.sql import functions as F

    feed = alerts.limit(1).withColumn("acknowledged_by", F.lit("op")).withColumns({
        "_pg_change_type": F.lit("update_postimage"), "_pg_lsn": F.lit(5), "_pg_xid": F.lit(1),
        "_timestamp": F.lit(None).cast("timestamp"), "_sort_by": F.lit(1),
    })
    plans.apply_alert_feed(feed, path)
    got = read_current(spark, path)
    assert got.count() == 2 and got.where("acknowledged_by = 'op'").count() == 1


def test_stockpile_table(spark):
    path = tempfile.mkdtemp(prefix="gritstone-test-")
    rows = [reading("STK-STK01-ZI02", s, text="SP01") for s in (0, 10)] + [reading("STK-STK01-WI01", s, 3600.0) for s in (0, 10)]
    plans.refresh_stockpiles(readings(spark, rows), path)
    plans.refresh_stockpiles(readings(spark, rows + [reading("STK-STK01-ZI02", 20, text="SP02"), reading("STK-STK01-WI01", 20, 3600.0)]), path)
    from gritstone.sources.upsert import read_current

    got = rows_by(read_current(spark, path), "stockpile_id")
    assert {k: r["tonnes_on_ground"] for k, r in got.items()} == {"SP01": 20.0, "SP02": 1.0}
