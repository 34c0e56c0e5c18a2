"""Every registered query with its independent SQL, under the name used in the survey."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from gritstone.functions import expressions as ex
from gritstone.functions.stemming import stem_ctes, with_stems
from gritstone.operators import (
    alerts, balance, checks, equipment, history, pdm, readings as rd, search, stockpile, vibration,
    workorders as wo,
)
from gritstone.plans.refresh import score_fleet
from gritstone.schemas import schema_of
from gritstone.session import materialize, shared_folder
from gritstone.sources import dims as dim_source, readings as seam, sinks, upsert as up
from gritstone.streaming import jobs
from gritstone.streaming.silence import stream_stale_tags
from parity.inputs import (
    BASE_ROWS, EPISODE_GAP, GRAIN, GRAIN_SECONDS, LONG_LAG, LONG_SLICE_SECONDS,
    SHORT_LAG, SLICE_SECONDS, Inputs, readings_from_events, with_ctes,
)
from parity.plant import BELT_TAG, CREW, FE_TAG, PILE_TAG, SIO2_TAG, WASH_TAGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STACKER = stockpile.StackerTags("YRD-BLD02", PILE_TAG, BELT_TAG, FE_TAG, SIO2_TAG)
QUESTION = "What did we find on the mentan, thtion and erble with queaux from the thor"
AT = "2024-01-16 00:00:00"
HORIZON = "2024-02-01 00:00:00"
FEED_SLICE = 1000


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a function of Inputs; doubles are rounded on both sides."""
    def wrap(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return rounded(fn(Inputs(spark, sf)), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles to nine places, then to ``digits``, so a tie falls the same way in SQL.

    Adding zero turns a negative zero into zero.
    """
    return df.select(*[
        (F.round(F.round(F.col(f.name).cast("double"), 9), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def sel(plain: str, doubles: str = "", digits: int = 6) -> str:
    """SQL select list: plain columns as they are, doubles rounded like ``rounded``."""
    parts = plain.split()
    parts += [f"{half_up(d, digits)} AS {d}" for d in doubles.split()]
    return ", ".join(parts)


def half_up(expression: str, digits: int) -> str:
    """Decimal rounding of a double, half away from zero as Spark rounds."""
    return f"(CAST(round(CAST({expression} AS DECIMAL(30, 9)), {digits}) AS DOUBLE) + 0e0)"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for queries that write and read back."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


T1_PLAIN = "tag_id window_start window_end sample_count good_count"
T1_DOUBLES = "avg_value min_value max_value stddev_value first_value last_value good_pct"
T1_SQL = with_ctes(f"SELECT {sel(T1_PLAIN, T1_DOUBLES)} FROM t1", "t1")


# ---- sources and sinks ---------------------------------------------------------------------

@query("load_dims", "SELECT c_custkey, c_name, nullif(c_nationkey, 0) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "dims")
    customer = i.table("customer").withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(0)))
    customer.write.csv(path, header=True, mode="overwrite")
    schema = schema_of(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )
    return dim_source.read_dim(i.spark, path, schema)


READING_PLAIN = "event_id tag_id source_ts value_text quality unit seq ingest_ts"


@query("tag_readings", with_ctes(f"SELECT {sel(READING_PLAIN, 'value')} FROM r", "r"))
def _(i: Inputs) -> DataFrame:
    return seam.reading_view(i.readings)


@query("cdc_readings", with_ctes(
    "SELECT alert_id, delivery_status, trigger_value, _pg_change_type, _pg_lsn, _sort_by FROM feed "
    "WHERE _pg_change_type IN ('insert', 'update_postimage')", "feed"))
def _(i: Inputs) -> DataFrame:
    return seam.after_images(i.feed).drop("_pg_xid", "_timestamp")


FEATURE_PLAIN = "asset_id tag_id window_start window_end sample_count iso_10816_zone label_failure_30d"
FEATURE_DOUBLES = (
    "rms_mm_s peak_mm_s crest_factor kurtosis stddev_mm_s rms_delta_1h rms_delta_24h rms_slope_24h "
    "rms_pct_of_baseline bearing_temp_c motor_current_a throughput_tph run_minutes hours_since_maintenance"
)


@query("features_union", with_ctes(
    f"SELECT {sel(FEATURE_PLAIN, FEATURE_DOUBLES)} FROM lab UNION ALL "
    f"SELECT {sel(FEATURE_PLAIN, FEATURE_DOUBLES)} FROM feat", "lab", "feat"))
def _(i: Inputs) -> DataFrame:
    return seam.union_features(i.labelled, i.features)


@query("overwrite_table", T1_SQL)
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "table")
    dated = i.tag_1m.withColumn("day", F.col("window_start").cast("date"))
    sinks.overwrite_table(dated, path, ["day"])
    return i.spark.read.parquet(path).drop("day")


LATEST_SQL = """SELECT alert_id, arg_max(delivery_status, _sort_by) AS delivery_status,
  arg_max(trigger_value, _sort_by) AS trigger_value FROM feed
  WHERE _pg_change_type IN ('insert', 'update_postimage') GROUP BY alert_id"""


@query("alert_merge", with_ctes(
    f"""SELECT coalesce(s.alert_id, t.alert_id) AS alert_id,
      CASE WHEN s.alert_id IS NULL THEN t.delivery_status ELSE s.delivery_status END AS delivery_status,
      {half_up('CASE WHEN s.alert_id IS NULL THEN t.trigger_value ELSE s.trigger_value END', 6)} AS trigger_value
    FROM (SELECT 'A-' || c_custkey AS alert_id, c_mktsegment AS delivery_status, c_acctbal AS trigger_value FROM customer) t
    FULL JOIN s ON s.alert_id = t.alert_id""", "feed", extra={"s": LATEST_SQL}))
def _(i: Inputs) -> DataFrame:
    target = i.table("customer").select(
        F.concat(F.lit("A-"), "c_custkey").alias("alert_id"),
        F.col("c_mktsegment").alias("delivery_status"), F.col("c_acctbal").alias("trigger_value"),
    )
    return merged(i, target, history.latest_images(i.feed, "alert_id"), "alert_id")


def merged(i: Inputs, target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The table after both have been written to it, one after the other."""
    path = scratch(i.spark, "merged")
    up.upsert(target, path, [key])
    up.upsert(materialize(source.select(*target.columns)), path, [key])
    return up.read_current(i.spark, path)


STOCK_CTES = {
    "ticks": f"""SELECT row_number() OVER (ORDER BY source_ts) AS k, source_ts, value_text AS stockpile_id
      FROM r WHERE tag_id = '{PILE_TAG}' AND quality = 'GOOD'""",
    "runs": """SELECT a.stockpile_id, a.source_ts, coalesce(b.source_ts, a.source_ts + INTERVAL 1 SECOND) AS end_ts,
      count(*) FILTER (z.stockpile_id IS DISTINCT FROM a.stockpile_id) OVER (ORDER BY a.k) AS run_id
      FROM ticks a LEFT JOIN ticks b ON b.k = a.k + 1 LEFT JOIN ticks z ON z.k = a.k - 1""",
    "piled": "FROM runs WHERE stockpile_id <> 'IDLE'",
    "stacked": f"""SELECT stockpile_id, sum(value * floor(epoch(end_ts - source_ts))) / 3600e0 AS tonnes, max(source_ts) AS last_ts,
      count(DISTINCT run_id) AS campaigns
      FROM piled JOIN (SELECT source_ts, value FROM r WHERE tag_id = '{BELT_TAG}' AND quality = 'GOOD') USING (source_ts) GROUP BY 1""",
    "latest": """SELECT stockpile_id, arg_max(began, run_id) AS stack_started_at
      FROM (SELECT stockpile_id, run_id, min(source_ts) AS began FROM piled GROUP BY ALL) GROUP BY 1""",
    "grade": f"""SELECT i.stockpile_id, avg(CASE q.tag_id WHEN '{FE_TAG}' THEN q.value END) AS avg_fe_pct,
      avg(CASE q.tag_id WHEN '{SIO2_TAG}' THEN q.value END) AS avg_sio2_pct
      FROM (FROM r WHERE tag_id IN ('{FE_TAG}', '{SIO2_TAG}') AND quality = 'GOOD') q ASOF JOIN runs i ON q.source_ts >= i.source_ts
      WHERE q.source_ts < i.end_ts AND i.stockpile_id <> 'IDLE' GROUP BY 1""",
    "active": "SELECT arg_max(stockpile_id, source_ts) AS stockpile_id FROM ticks",
}


def stock_sql(body: str) -> str:
    return with_ctes(body, "r", extra=STOCK_CTES)


STATE_SQL = f"""SELECT s.stockpile_id, s.last_ts AS as_at, s.stockpile_id = (SELECT stockpile_id FROM active) AS is_stacking,
  'YRD-BLD02' AS stacker_id, {half_up('s.tonnes', 1)} AS tonnes_stacked_cum, {half_up('s.tonnes', 1)} AS tonnes_on_ground,
  {half_up('g.avg_fe_pct', 2)} AS avg_fe_pct, {half_up('g.avg_sio2_pct', 2)} AS avg_sio2_pct, l.stack_started_at
  FROM stacked s LEFT JOIN grade g ON g.stockpile_id = s.stockpile_id LEFT JOIN latest l ON l.stockpile_id = s.stockpile_id"""


def stock(i: Inputs) -> DataFrame:
    return stockpile.stockpile_state(i.readings, STACKER, LONG_SLICE_SECONDS)


def runs(i: Inputs) -> DataFrame:
    return stockpile.pile_runs(i.readings, STACKER, LONG_SLICE_SECONDS)


@query("stockpile_merge", with_ctes(
    """SELECT coalesce(s.stockpile_id, t.stockpile_id) AS stockpile_id,
      CASE WHEN s.stockpile_id IS NULL THEN t.tonnes_on_ground ELSE s.tonnes_on_ground END AS tonnes_on_ground
    FROM (SELECT 'SP0' || (o_orderkey % 6) AS stockpile_id, CAST(count(*) AS DOUBLE) AS tonnes_on_ground FROM orders GROUP BY 1) t
    FULL JOIN st s ON s.stockpile_id = t.stockpile_id""", "r", extra={**STOCK_CTES, "st": STATE_SQL}))
def _(i: Inputs) -> DataFrame:
    target = i.table("orders").groupBy(
        F.concat(F.lit("SP0"), F.col("o_orderkey") % 6).alias("stockpile_id")
    ).agg(F.count(F.lit(1)).cast("double").alias("tonnes_on_ground"))
    return merged(i, target, stock(i), "stockpile_id")


@query("prediction_append", with_ctes(
    "SELECT alert_id, severity, raised_at, trigger_value FROM al", "al"))
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "predictions")
    seen = i.alert_rows.join(i.orders.select("alert_id"), "alert_id", "left_semi")
    sinks.append_unseen(seen, path, "alert_id", "raised_at")
    for _ in range(2):  # the second time nothing is new
        sinks.append_unseen(i.alert_rows, path, "alert_id", "raised_at")
    return i.spark.read.parquet(path).drop("day")


CURRENT_SQL = with_ctes(
    f"SELECT {sel('tag_id event_id source_ts value_text quality seq', 'value')} FROM r "
    "QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY seq DESC) = 1", "r")


@query("current_upsert", CURRENT_SQL)
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "current")
    rows = i.readings.select("tag_id", "event_id", "source_ts", "value", "value_text", "quality", "seq")
    up.upsert(rows.where(F.col("quality") == "GOOD"), path, ["tag_id"], by=["seq"])
    up.upsert(rows, path, ["tag_id"], by=["seq"])
    return up.read_current(i.spark, path)


@query("rows_to_json", """SELECT CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
  'c_mktsegment': c_mktsegment}) AS VARCHAR) AS json FROM customer""")
def _(i: Inputs) -> DataFrame:
    return sinks.rows_to_json(i.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@query("layout_by_key", with_ctes(f"SELECT {sel('tag_id source_ts seq quality', 'value')} FROM r", "r"))
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "layout")
    rows = i.readings.select("tag_id", "source_ts", "seq", "quality", "value")
    sinks.layout_by_key(rows, ["tag_id", "source_ts"]).write.mode("overwrite").parquet(path)
    return i.spark.read.parquet(path)


# ---- projections and predicates ------------------------------------------------------------

@query("good_only", with_ctes(
    f"SELECT event_id, quality, {half_up('''CASE WHEN quality = 'GOOD' THEN value END''', 6)} AS good_value FROM r", "r"))
def _(i: Inputs) -> DataFrame:
    return i.readings.select("event_id", "quality", ex.good_only().alias("good_value"))


ARC_PLAIN = "arc_id window_start window_end from_node_id to_node_id stream_type measure_method is_estimated"


@query("solids_arcs", with_ctes(f"SELECT {sel(ARC_PLAIN, 'measured_tph design_tph')} FROM solids", "solids"))
def _(i: Inputs) -> DataFrame:
    flows = balance.mass_flow_1m(i.tag_1m, i.arcs, i.tags).where(ex.is_solids_arc())
    return flows.select(*ARC_PLAIN.split(), "measured_tph", "design_tph")


@query("slurry_tph", with_ctes(
    f"SELECT {sel('arc_id window_start', 'measured_tph')} FROM mf WHERE measure_method = 'slurry_flow_density'", "mf"))
def _(i: Inputs) -> DataFrame:
    flows = balance.mass_flow_1m(i.tag_1m, i.arcs, i.tags)
    return flows.where(F.col("measure_method") == "slurry_flow_density").select(
        "arc_id", "window_start", "measured_tph"
    )


@query("balance_status", with_ctes("SELECT node_id, status, count(*) AS windows FROM mb GROUP BY ALL", "mb"))
def _(i: Inputs) -> DataFrame:
    return balance.mass_balance_node_1m(i.incidence).groupBy("node_id", "status").agg(
        F.count(F.lit(1)).alias("windows")
    )


@query("iso_zone", with_ctes("SELECT tag_id, window_start, iso_10816_zone FROM feat", "feat"))
def _(i: Inputs) -> DataFrame:
    return vibration.vib_triplet(vibration.vib_stats_10m(i.readings, i.tags, GRAIN)).select(
        "tag_id", "window_start", ex.iso_zone("rms_mm_s").alias("iso_10816_zone")
    )


BREACH_CTE = {
    "br": """SELECT r.tag_id, r.source_ts, r.seq, r.value, t.lo_lo, t.lo, t.hi, t.hi_hi,
      [NULL, 'limit_warn', 'limit_trip'][1 + (r.value NOT BETWEEN t.lo AND t.hi)::INT + (r.value NOT BETWEEN t.lo_lo AND t.hi_hi)::INT] AS rule_type
      FROM r JOIN tags t ON t.tag_id = r.tag_id WHERE t.value_class = 'analog' AND r.quality = 'GOOD'""",
    # An episode begins where the gap before it is empty; a breach belongs to the newest beginning.
    "quiet": f"""SELECT tag_id, rule_type, source_ts, count(*) OVER (PARTITION BY tag_id, rule_type ORDER BY source_ts
        RANGE BETWEEN INTERVAL {(EPISODE_GAP + 1) * 1_000_000 - 1} MICROSECONDS PRECEDING AND CURRENT ROW) = 1 AS begins
      FROM (SELECT DISTINCT tag_id, rule_type, source_ts FROM br WHERE rule_type IS NOT NULL)""",
    "heads": """SELECT tag_id, rule_type, source_ts AS opened, row_number() OVER (PARTITION BY tag_id, rule_type ORDER BY source_ts) AS episode_no
      FROM quiet WHERE begins""",
    "ep": """SELECT h.tag_id, h.rule_type, h.episode_no, min(b.source_ts) AS raised_at, max(b.source_ts) AS ended_at, count(*) AS samples,
      nullif(max(CASE WHEN b.value > b.hi THEN b.value ELSE '-inf' END), '-inf') AS peak_high,
      nullif(min(CASE WHEN b.value < b.lo THEN b.value ELSE 'inf' END), 'inf') AS peak_low,
      any_value(b.lo_lo) AS lo_lo, any_value(b.lo) AS lo, any_value(b.hi) AS hi, any_value(b.hi_hi) AS hi_hi
      FROM br b ASOF JOIN heads h ON b.tag_id = h.tag_id AND b.rule_type = h.rule_type AND b.source_ts >= h.opened GROUP BY ALL""",
    "matches": """SELECT e.*, t.asset_id, t.asset_name, t.asset_type, t.area_code, t.measure, t.unit, u.rule_id, u.rule_name,
      u.severity, u.scope_type, u.message_template, coalesce(e.peak_high, e.peak_low) AS trigger_value
      FROM ep e JOIN tags t USING (tag_id) JOIN (FROM rules WHERE enabled) u ON u.rule_type = e.rule_type
       AND concat_ws('=', u.scope_type, nullif(u.scope_value, '')) IN ('all', 'asset_type=' || t.asset_type, 'measure=' || t.measure, 'tag=' || t.tag_id)""",
    "best": """SELECT DISTINCT ON (tag_id, rule_type, episode_no) * FROM matches
      ORDER BY tag_id, rule_type, episode_no, (scope_type = 'all')::INT - (scope_type = 'tag')::INT, rule_id""",
}


def alert_sql(body: str) -> str:
    return with_ctes(body, "r", "tags", "rules", extra=BREACH_CTE)


def episodes(i: Inputs) -> DataFrame:
    return alerts.alert_episodes(
        alerts.limit_breaches(i.readings, i.tags), EPISODE_GAP, LONG_SLICE_SECONDS
    )


@query("limit_class", alert_sql(f"SELECT {sel('tag_id source_ts seq rule_type', 'value')} FROM br WHERE rule_type IS NOT NULL"))
def _(i: Inputs) -> DataFrame:
    return alerts.limit_breaches(i.readings, i.tags).select("tag_id", "source_ts", "seq", "rule_type", "value")


@query("recent_window_filter", with_ctes(
    f"SELECT {sel('tag_id window_start', 'rms_mm_s')} FROM feat WHERE window_start >= (SELECT max(window_start) FROM feat) - INTERVAL 7 DAYS", "feat"))
def _(i: Inputs) -> DataFrame:
    return pdm.recent_window(i.features, 7).select("tag_id", "window_start", "rms_mm_s")


@query("asset_panel", with_ctes(
    f"""SELECT t.tag_id, t.asset_name, t.area_name, t.measure, t.instrument_type, t.unit, t.nominal, t.lo_lo AS trip_low,
      t.lo AS warn_low, t.hi AS warn_high, t.hi_hi AS trip_high, t.is_pdm, {half_up('c.v', 6)} AS value
    FROM tags t LEFT JOIN (SELECT tag_id, arg_max_null(value, seq) AS v FROM r GROUP BY tag_id) c ON c.tag_id = t.tag_id
    WHERE t.asset_id = 'GYR-JAW04'""", "tags", "r"))
def _(i: Inputs) -> DataFrame:
    newest = i.readings.groupBy("tag_id").agg(F.max_by("value", "seq").alias("value"))
    return rd.asset_panel(i.tags, "GYR-JAW04").join(newest, "tag_id", "left")


ACTION_SQL = f"""CASE WHEN p >= 0.7 THEN '{ex.ACT_NOW_TEXT}' WHEN p >= 0.3 THEN '{ex.WATCH_TEXT}' ELSE '{ex.NO_ACTION_TEXT}' END"""


@query("recommended_action", f"SELECT event_id, {ACTION_SQL} AS recommended_action FROM (SELECT event_id, value / 100e0 AS p FROM events)")
def _(i: Inputs) -> DataFrame:
    return i.table("events").select(
        "event_id", ex.recommended_action(F.col("value") / 100.0).alias("recommended_action")
    )


MESSAGE_SQL = """replace(replace(replace(replace(replace(message_template, '{tag_id}', tag_id), '{asset_name}', asset_name),
  '{value}', printf('%.2f', trigger_value)), '{unit}', unit), '{node_id}', '')"""


@query("alert_message", alert_sql(
    f"SELECT sha256(tag_id || '|' || rule_type || '|' || epoch_us(raised_at)) AS alert_id, {MESSAGE_SQL} AS message FROM best"))
def _(i: Inputs) -> DataFrame:
    return alerts.derive_alerts(i.readings, i.tags, i.rules, EPISODE_GAP, LONG_SLICE_SECONDS).select(
        "alert_id", "message"
    )


# ---- joins ---------------------------------------------------------------------------------

@query("readings_with_tag", with_ctes(
    f"SELECT r.event_id, r.tag_id, r.quality, t.asset_id, t.measure, {half_up('r.value', 6)} AS value FROM r JOIN tags t ON t.tag_id = r.tag_id", "r", "tags"))
def _(i: Inputs) -> DataFrame:
    return rd.with_tag(i.readings, i.tags, ["asset_id", "measure"]).select(
        "event_id", "tag_id", "quality", "asset_id", "measure", "value"
    )


@query("slurry_pair", with_ctes(
    f"""SELECT p.flow_tag_id, p.density_tag_id, f.window_start, {half_up('f.avg_value', 6)} AS flow, {half_up('d.avg_value', 6)} AS density
    FROM pairs p JOIN t1 f ON f.tag_id = p.flow_tag_id JOIN t1 d ON d.tag_id = p.density_tag_id AND d.window_start = f.window_start""", "pairs", "t1"))
def _(i: Inputs) -> DataFrame:
    t1 = i.tag_1m.select("tag_id", "window_start", "avg_value")
    pairs = balance.slurry_pairs(i.tags)
    flow = t1.withColumnsRenamed({"tag_id": "flow_tag_id", "avg_value": "flow"})
    density = t1.withColumnsRenamed({"tag_id": "density_tag_id", "avg_value": "density"})
    return flow.join(pairs, "flow_tag_id").join(density, ["density_tag_id", "window_start"]).select(
        "flow_tag_id", "density_tag_id", "window_start", "flow", "density"
    )


@query("arc_window_spine", with_ctes("SELECT arc_id, window_start, window_end, measure_tag_id FROM spine", "spine"))
def _(i: Inputs) -> DataFrame:
    return balance.arc_window_spine(i.tag_1m, i.arcs).select(
        "arc_id", "window_start", "window_end", "measure_tag_id"
    )


ARC_DOUBLES = "measured_tph design_tph deviation_pct good_sample_pct"


@query("mass_flow_1m", with_ctes(
    f"SELECT {sel(ARC_PLAIN, ARC_DOUBLES)} FROM (SELECT *, 1e2 * (measured_tph - design_tph) / nullif(design_tph, 0) AS deviation_pct FROM mf)", "mf"))
def _(i: Inputs) -> DataFrame:
    return balance.mass_flow_1m(i.tag_1m, i.arcs, i.tags)


@query("node_arc_incidence", with_ctes(
    """SELECT n.node_id, s.arc_id, s.window_start, CASE WHEN s.to_node_id = n.node_id THEN 'in' ELSE 'out' END AS side
    FROM nodes n JOIN solids s ON n.node_id IN (s.from_node_id, s.to_node_id)""", "nodes", "solids"))
def _(i: Inputs) -> DataFrame:
    return i.incidence.where(F.col("side").isin("in", "out")).select("node_id", "arc_id", "window_start", "side")


@query("node_flow", with_ctes(
    "SELECT node_id, window_start, arcs_in_measured, arcs_in_total, arcs_out_measured, arcs_out_total, "
    + sel("", "mass_in_tph mass_out_tph data_quality_pct") + " FROM flow", "flow"))
def _(i: Inputs) -> DataFrame:
    return balance.node_flow(i.incidence).select(
        "node_id", "window_start", "arcs_in_measured", "arcs_in_total", "arcs_out_measured",
        "arcs_out_total", "mass_in_tph", "mass_out_tph", "data_quality_pct",
    )


@query("used_for_inference", with_ctes("SELECT node_id, window_start, used_for_inference FROM closing", "closing"))
def _(i: Inputs) -> DataFrame:
    return balance.node_flow(i.incidence).select("node_id", "window_start", "used_for_inference")


@query("vib_triplet", with_ctes(
    f"SELECT {sel('asset_id tag_id window_start sample_count', 'rms_mm_s peak_mm_s crest_factor kurtosis stddev_mm_s rms_pct_of_baseline')} FROM trip", "trip"))
def _(i: Inputs) -> DataFrame:
    return vibration.vib_triplet(vibration.vib_stats_10m(i.readings, i.tags, GRAIN)).select(
        "asset_id", "tag_id", "window_start", "sample_count", "rms_mm_s", "peak_mm_s",
        "crest_factor", "kurtosis", "stddev_mm_s", "rms_pct_of_baseline",
    )


@query("grade_interval_join", stock_sql(f"SELECT {sel('stockpile_id', 'avg_fe_pct avg_sio2_pct')} FROM grade"))
def _(i: Inputs) -> DataFrame:
    return stockpile.grade_while_stacking(i.readings, runs(i), STACKER, LONG_SLICE_SECONDS)


@query("equal_ts_join", stock_sql(
    f"SELECT stockpile_id, last_ts, campaigns, {half_up('tonnes', 3)} AS tonnes FROM stacked"), digits=3)
def _(i: Inputs) -> DataFrame:
    return stockpile.stacked_tonnes(i.readings, runs(i), STACKER)


@query("rule_match", alert_sql(f"SELECT {sel('tag_id rule_type episode_no rule_id scope_type severity', 'trigger_value')} FROM matches"))
def _(i: Inputs) -> DataFrame:
    return episodes(i).join(alerts.rules_by_tag(i.tags, i.rules), ["tag_id", "rule_type"]).select(
        "tag_id", "rule_type", "episode_no", "rule_id", "scope_type", "severity",
        F.coalesce("peak_high", "peak_low").alias("trigger_value"),
    )


@query("latest_run_subquery", stock_sql("SELECT * FROM latest"))
def _(i: Inputs) -> DataFrame:
    return stockpile.latest_campaign(runs(i), STACKER)


@query("active_flag", stock_sql("SELECT stockpile_id, stockpile_id = (SELECT stockpile_id FROM active) AS is_stacking FROM stacked"))
def _(i: Inputs) -> DataFrame:
    active = stockpile.active_pile(i.readings, STACKER).scalar()
    return stockpile.stacked_tonnes(i.readings, runs(i), STACKER).select(
        "stockpile_id", (F.col("stockpile_id") == active).alias("is_stacking")
    )


INTERVAL_CTES = {
    "iv": """SELECT t.tag_id, e.ts AS t_start, e.ts + to_hours(CAST(floor(e.value) AS INTEGER)) AS t_end,
      e.value AS v, CASE WHEN e.event_id % 2 = 0 THEN 'STALE' END AS q
      FROM events e JOIN tags t ON t.tag_no = e.event_id % (SELECT count(*) FROM tags) WHERE e.event_type = 'purchase'""",
    "hit": """SELECT r.event_id, i.v, i.q FROM r JOIN iv i ON i.tag_id = r.tag_id AND r.source_ts BETWEEN i.t_start AND i.t_end
      QUALIFY row_number() OVER (PARTITION BY r.event_id ORDER BY
        i.t_start = (SELECT max(j.t_start) FROM iv j WHERE j.tag_id = r.tag_id AND j.t_start <= r.source_ts) DESC,
        i.t_end DESC, i.t_start DESC) = 1""",
}


@query("interval_overlay", with_ctes(
    f"""SELECT r.event_id, r.tag_id, {half_up('coalesce(h.v, r.value)', 6)} AS value, coalesce(h.q, r.quality) AS quality
    FROM r LEFT JOIN hit h ON h.event_id = r.event_id""", "r", "tags", extra=INTERVAL_CTES))
def _(i: Inputs) -> DataFrame:
    n_tags = i.tags.agg(F.count(F.lit(1))).scalar()
    bought = i.table("events").where(F.col("event_type") == "purchase").withColumn(
        "tag_no", (F.col("event_id") % n_tags).cast("int")
    )
    hours = F.make_interval(hours=F.floor("value").cast("int"))
    intervals = bought.join(i.tags.select("tag_no", "tag_id"), "tag_no").select(
        "tag_id", F.col("ts").alias("t_start"), (F.col("ts") + hours).alias("t_end"), "value",
        F.when(F.col("event_id") % 2 == 0, "STALE").alias("quality"),
    )
    return rd.overlay_intervals(i.readings, intervals, LONG_SLICE_SECONDS).select(
        "event_id", "tag_id", "value", "quality"
    )


@query("value_override", with_ctes(
    f"""SELECT r.event_id, {half_up('r.value * coalesce(f.m, 1)', 6)} AS value FROM r LEFT JOIN
    (SELECT tag_id, count(*) AS m FROM r WHERE quality = 'BAD' GROUP BY tag_id) f ON f.tag_id = r.tag_id""", "r"))
def _(i: Inputs) -> DataFrame:
    factors = i.readings.where(F.col("quality") == "BAD").groupBy("tag_id").agg(
        F.count(F.lit(1)).cast("double").alias("multiplier")
    )
    return rd.override_values(i.readings, factors).select("event_id", "value")


@query("nearest_event", with_ctes(f"SELECT {sel('tag_id window_start', 'days_to_fail')} FROM near", "near"))
def _(i: Inputs) -> DataFrame:
    return i.labelled.select("tag_id", "window_start", "days_to_fail")


DOWNTIME_SQL = f"""SELECT t.asset_id, max(t.asset_name) AS asset_name, max(t.asset_type) AS asset_type, max(t.area_name) AS area,
  count(DISTINCT w.work_order_id) AS work_orders, count(DISTINCT w.work_order_id) FILTER (w.status <> 'CLOSED') AS still_open,
  CAST(coalesce(sum(w.downtime_minutes), 0) AS BIGINT) AS downtime_minutes,
  string_agg(DISTINCT w.failure_mode, ', ' ORDER BY w.failure_mode) AS failure_modes,
  max(t.hi) FILTER (t.instrument_type = 'VI') AS vib_warn_limit_mm_s, max(t.hi_hi) FILTER (t.instrument_type = 'VI') AS vib_trip_limit_mm_s,
  CAST(coalesce(sum(n.c), 0) AS BIGINT) AS diagnostic_notes,
  {half_up('coalesce(sum(w.downtime_minutes), 0) / 60e0', 1)} AS downtime_hours
  FROM wo w JOIN tags t ON t.tag_id = w.tag_id
  LEFT JOIN (SELECT work_order_id, count(*) AS c FROM notes GROUP BY 1) n ON n.work_order_id = w.work_order_id
  GROUP BY t.asset_id HAVING coalesce(sum(w.downtime_minutes), 0) > 0"""


@query("asset_downtime", with_ctes(DOWNTIME_SQL, "wo", "tags", "notes"))
def _(i: Inputs) -> DataFrame:
    return wo.asset_downtime(i.orders, i.tags, i.notes)


@query("order_tag_notes", with_ctes(
    """SELECT w.work_order_id, w.status, t.measure, count(n.note_kind) AS note_count FROM wo w JOIN tags t ON t.tag_id = w.tag_id
    LEFT JOIN notes n ON n.work_order_id = w.work_order_id GROUP BY ALL""", "wo", "tags", "notes"))
def _(i: Inputs) -> DataFrame:
    per_order = i.notes.groupBy("work_order_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        i.orders.select("work_order_id", "status", "tag_id").join(i.tags.select("tag_id", "measure"), "tag_id")
        .join(per_order, "work_order_id", "left")
        .select("work_order_id", "status", "measure", F.coalesce("n", F.lit(0)).alias("note_count"))
    )


@query("alert_wo_notes", with_ctes(
    """SELECT a.severity, w.work_order_id, w.asset_id, w.failure_mode, count(n.note_kind) AS note_count FROM al a
    JOIN wo w ON w.alert_id = a.alert_id LEFT JOIN notes n ON n.work_order_id = w.work_order_id
    GROUP BY ALL ORDER BY a.severity, w.work_order_id LIMIT 20""", "al", "wo", "notes"))
def _(i: Inputs) -> DataFrame:
    return wo.alert_order_notes(i.alert_rows, i.orders, i.notes)


# ---- aggregations --------------------------------------------------------------------------

@query("tag_reading_1m", T1_SQL)
def _(i: Inputs) -> DataFrame:
    return i.tag_1m


@query("node_balance_inputs", with_ctes(
    f"SELECT {sel('node_id window_start unknown_arcs unknown_arc_id unknown_side', 'known_in known_out')} FROM node_sums", "node_sums"))
def _(i: Inputs) -> DataFrame:
    return balance.node_balance_inputs(i.incidence)


@query("arc_infer", with_ctes(
    f"SELECT {sel('arc_id window_start inferred_from_node_id candidate_count', 'inferred_tph inference_spread_tph')} FROM infer", "infer"))
def _(i: Inputs) -> DataFrame:
    return balance.arc_infer(i.incidence)


@query("mass_flow_final", with_ctes(
    f"SELECT {sel(ARC_PLAIN + ' is_reconciled', 'design_tph measured_tph good_sample_pct')} FROM mff", "mff"))
def _(i: Inputs) -> DataFrame:
    return balance.mass_flow_final(i.incidence)


BALANCE_PLAIN = "node_id window_start window_end balance_role arcs_in_measured arcs_in_total arcs_out_measured arcs_out_total status"
BALANCE_DOUBLES = "mass_in_tph mass_out_tph accumulation_tph imbalance_tph imbalance_pct closure_pct data_quality_pct"


@query("mass_balance_node_1m", with_ctes(f"SELECT {sel(BALANCE_PLAIN, BALANCE_DOUBLES)} FROM mb", "mb"))
def _(i: Inputs) -> DataFrame:
    return balance.mass_balance_node_1m(i.incidence)


@query("equipment_state_1m", with_ctes(
    "SELECT " + sel("asset_id window_start window_end state run_seconds stop_seconds fault_seconds starts",
                    "availability_pct avg_current_a max_current_a throughput_tph") + " FROM eq", "eq"))
def _(i: Inputs) -> DataFrame:
    return i.equipment


def _solids_sql(q: str, rho: str) -> str:
    return f"{q} * {rho} * (4.9e0 * ({rho} - 1) / ({rho} * 3.9e0))"


DESANDS_CTES = {
    "p": "SELECT window_start, window_end, " + ", ".join(
        f"max(avg_value) FILTER (tag_id = '{t}') AS {n}" for n, t in WASH_TAGS.items()
    ) + " FROM t1 WHERE tag_id IN (" + ", ".join(f"'{t}'" for t in WASH_TAGS.values()) + ") GROUP BY ALL",
    "s": "SELECT *, " + ", ".join(
        f"{_solids_sql(x + '_q', x + '_rho')} AS {x}_solids_tph" for x in ("feed", "overflow", "underflow")
    ) + " FROM p",
    "ds": """SELECT window_start, window_end, feed_q AS feed_slurry_m3h, feed_rho AS feed_density_tm3, feed_solids_tph,
      overflow_q AS overflow_slurry_m3h, overflow_rho AS overflow_density_tm3, overflow_solids_tph,
      underflow_q AS underflow_slurry_m3h, underflow_rho AS underflow_density_tm3, underflow_solids_tph,
      water_q AS water_added_m3h, 1e2 * underflow_solids_tph / nullif(feed_solids_tph, 0) AS solids_recovery_pct,
      1e2 * overflow_solids_tph / nullif(feed_solids_tph, 0) AS fines_reject_pct,
      feed_solids_tph - overflow_solids_tph - underflow_solids_tph AS solids_imbalance_tph FROM s""",
}
DESANDS_DOUBLES = (
    "feed_slurry_m3h feed_density_tm3 feed_solids_tph overflow_slurry_m3h overflow_density_tm3 overflow_solids_tph "
    "underflow_slurry_m3h underflow_density_tm3 underflow_solids_tph water_added_m3h solids_recovery_pct fines_reject_pct solids_imbalance_tph"
)


@query("desands_balance_1m", with_ctes(f"SELECT {sel('window_start window_end', DESANDS_DOUBLES)} FROM ds", "t1", extra=DESANDS_CTES))
def _(i: Inputs) -> DataFrame:
    return balance.desands_balance_1m(i.tag_1m, WASH_TAGS)


@query("vib_stats_10m", with_ctes(f"SELECT {sel('asset_id sensor_no instrument_type window_start window_end n', 'nominal av sd')} FROM v", "v"))
def _(i: Inputs) -> DataFrame:
    return vibration.vib_stats_10m(i.readings, i.tags, GRAIN)


@query("context_10m", with_ctes(f"SELECT {sel('asset_id window_start', 'bearing_temp_c motor_current_a throughput_tph')} FROM ctx", "ctx"))
def _(i: Inputs) -> DataFrame:
    return vibration.context_10m(i.readings, i.tags, GRAIN)


@query("run_minutes_10m", with_ctes(
    f"SELECT asset_id, time_bucket(INTERVAL '6 hours', window_start) AS window_start, {half_up('sum(run_seconds) / 60e0', 6)} AS run_minutes FROM eq GROUP BY 1, 2", "eq"))
def _(i: Inputs) -> DataFrame:
    return equipment.run_minutes_10m(i.equipment, "6 hours")


@query("stockpile_state", stock_sql(f"SELECT q.*, s.campaigns FROM ({STATE_SQL}) q JOIN stacked s ON s.stockpile_id = q.stockpile_id"))
def _(i: Inputs) -> DataFrame:
    return stock(i)


@query("alert_episodes", alert_sql(
    f"SELECT {sel('tag_id rule_type episode_no raised_at ended_at samples', 'peak_high peak_low lo_lo lo hi hi_hi')} FROM ep"))
def _(i: Inputs) -> DataFrame:
    return episodes(i)


@query("downtime_by_status", with_ctes(
    "SELECT status, count(*) AS jobs, CAST(coalesce(sum(downtime_minutes), 0) AS BIGINT) AS downtime_minutes FROM wo GROUP BY 1", "wo"))
def _(i: Inputs) -> DataFrame:
    return wo.downtime_by_status(i.orders)


ESCALATION_SQL = f"""SELECT avg(downtime_minutes) AS mean_exact, {half_up('avg(downtime_minutes)', 1)} AS mean_closed,
  CAST(max(downtime_minutes) AS DOUBLE) AS worst_closed, {half_up('max(downtime_minutes) / avg(downtime_minutes)', 2)} AS escalation
  FROM wo WHERE status = 'CLOSED' AND downtime_minutes IS NOT NULL"""


@query("downtime_escalation", with_ctes(
    f"SELECT mean_closed, worst_closed, escalation FROM ({ESCALATION_SQL})", "wo"))
def _(i: Inputs) -> DataFrame:
    return wo.downtime_escalation(i.orders).drop("mean_exact")


PEAKS_SQL = ", ".join(f"{half_up(f'max({c})', 2)} AS {n}" for c, n in (
    ("rms_mm_s", "peak_rms"), ("crest_factor", "peak_crest"), ("kurtosis", "peak_kurt")))


@query("failure_peaks", with_ctes(
    f"""SELECT l.asset_id, l.tag_id, f.failed_at, {PEAKS_SQL} FROM lab l
    JOIN (SELECT tag_id, max(window_start) AS failed_at FROM lab WHERE label_failure_30d GROUP BY 1) f ON f.tag_id = l.tag_id
    WHERE l.window_start <= f.failed_at GROUP BY 1, 2, 3""", "lab"))
def _(i: Inputs) -> DataFrame:
    return vibration.failure_peaks(i.labelled)


@query("labelled_peaks", with_ctes(f"SELECT asset_id, {PEAKS_SQL} FROM lab WHERE label_failure_30d GROUP BY 1", "lab"))
def _(i: Inputs) -> DataFrame:
    return vibration.labelled_peaks(i.labelled)


@query("quality_distribution", with_ctes(
    f"SELECT quality, count(*) AS n, {half_up('1e2 * count(*) / (SELECT count(*) FROM r)', 3)} AS pct FROM r GROUP BY 1", "r"))
def _(i: Inputs) -> DataFrame:
    return rd.quality_distribution(i.readings)


@query("breach_counts", with_ctes(
    """SELECT count(*) FILTER (r.value > t.hi_hi OR r.value < t.lo_lo) AS trip_breaches,
    count(*) FILTER (r.value BETWEEN t.hi AND t.hi_hi OR r.value BETWEEN t.lo_lo AND t.lo) AS warn_breaches,
    count(DISTINCT CASE WHEN r.value > t.hi OR r.value < t.lo THEN r.tag_id END) AS tags_excursed
    FROM r JOIN tags t ON t.tag_id = r.tag_id WHERE t.value_class = 'analog'""", "r", "tags"))
def _(i: Inputs) -> DataFrame:
    return rd.breach_counts(i.readings, i.tags)


MEANS_SQL = ", ".join(f"{half_up(f'avg({c})', d)} AS {n}" for c, n, d in (
    ("rms_mm_s", "avg_rms", 2), ("crest_factor", "avg_crest", 2), ("kurtosis", "avg_kurt", 2)))


@query("label_profile", with_ctes(
    f"SELECT label_failure_30d, count(*) AS windows, {MEANS_SQL}, {half_up('avg(bearing_temp_c)', 1)} AS avg_temp FROM lab GROUP BY 1", "lab"))
def _(i: Inputs) -> DataFrame:
    return vibration.label_profile(i.labelled)


@query("phase_profile", with_ctes(
    f"""SELECT phase, count(*) AS windows, {MEANS_SQL} FROM (SELECT *, CASE WHEN days_to_fail BETWEEN 2 AND 5 THEN '1 phase1'
      WHEN days_to_fail BETWEEN 0 AND 2 THEN '2 phase2' WHEN days_to_fail BETWEEN 5 AND 10 THEN '0 baseline' END AS phase FROM lab)
    WHERE phase IS NOT NULL GROUP BY 1""", "lab"))
def _(i: Inputs) -> DataFrame:
    return vibration.phase_profile(i.labelled, (2.0, 5.0, 10.0))


@query("table_profile", with_ctes(
    """SELECT 'readings' AS table_name, count(*) AS row_count, count(DISTINCT tag_id) AS tags, min(source_ts) AS first_ts, max(source_ts) AS last_ts FROM r
    UNION ALL SELECT 'features', count(*), count(DISTINCT tag_id), min(window_start), max(window_end) FROM feat""", "r", "feat"))
def _(i: Inputs) -> DataFrame:
    return rd.table_profile({
        "readings": (i.readings, "source_ts", "source_ts"),
        "features": (i.features, "window_start", "window_end"),
    })


@query("fresh_count", with_ctes(
    f"SELECT count(*) AS rows_recent FROM r WHERE source_ts >= TIMESTAMP '{AT}' - INTERVAL 30 MINUTES", "r"))
def _(i: Inputs) -> DataFrame:
    return rd.fresh_count(i.readings, AT)


@query("longrun_node_closure", with_ctes(
    f"""SELECT n.node_id, n.node_type, {half_up('tin', 1)} AS mass_in, {half_up('tout', 1)} AS mass_out,
      {half_up('tin - tout', 1)} AS imbalance_tph, {half_up('1e2 * (tin - tout) / nullif(tin, 0)', 2)} AS imbalance_pct
    FROM nodes n JOIN (SELECT to_node_id AS k, sum(tph) AS tin FROM af GROUP BY 1) i ON i.k = n.node_id
    JOIN (SELECT from_node_id AS k, sum(tph) AS tout FROM af GROUP BY 1) o ON o.k = n.node_id WHERE n.balance_role = 'unit'""",
    "r", "arcs", "nodes", extra={
        "avgf": "SELECT tag_id, avg(value) AS tph FROM r GROUP BY 1",
        "af": "SELECT a.from_node_id, a.to_node_id, f.tph FROM arcs a JOIN avgf f ON f.tag_id = a.measure_tag_id WHERE a.stream_type = 'dry_solids'",
    }))
def _(i: Inputs) -> DataFrame:
    return balance.longrun_node_closure(i.readings, i.arcs, i.nodes)


@query("longrun_desands", with_ctes(
    f"SELECT {half_up(_solids_sql('uq', 'ur'), 1)} AS underflow_solids_tph, {half_up(_solids_sql('oq', 'orho'), 1)} AS overflow_solids_tph FROM q",
    "r", extra={"q": """SELECT avg(value) FILTER (tag_id = 'WSH-HYC05-FI03') AS uq, avg(value) FILTER (tag_id = 'WSH-HYC05-DI03') AS ur,
      avg(value) FILTER (tag_id = 'WSH-HYC05-FI02') AS oq, avg(value) FILTER (tag_id = 'WSH-HYC05-DI02') AS orho FROM r"""}))
def _(i: Inputs) -> DataFrame:
    return balance.longrun_desands(i.readings, WASH_TAGS)


@query("design_closure", with_ctes(
    """SELECT n.node_id, n.balance_role, coalesce(i.t, 0e0) AS design_in_tph, coalesce(o.t, 0e0) AS design_out_tph,
      n.balance_role <> 'unit' OR abs(coalesce(i.t, 0) - coalesce(o.t, 0)) < 0.01 AS closes, x.windows
    FROM nodes n
    LEFT JOIN (SELECT to_node_id AS k, sum(design_tph) AS t FROM arcs WHERE stream_type <> 'water' AND from_node_id <> to_node_id GROUP BY 1) i ON i.k = n.node_id
    LEFT JOIN (SELECT from_node_id AS k, sum(design_tph) AS t FROM arcs WHERE stream_type <> 'water' AND from_node_id <> to_node_id GROUP BY 1) o ON o.k = n.node_id
    JOIN (SELECT node_id, count(*) AS windows FROM mb GROUP BY 1) x ON x.node_id = n.node_id""", "nodes", "arcs", "mb"))
def _(i: Inputs) -> DataFrame:
    seen = balance.mass_balance_node_1m(i.incidence).groupBy("node_id").agg(F.count(F.lit(1)).alias("windows"))
    return balance.design_closure(i.arcs, i.nodes).join(seen, "node_id")


SCORE_SQL = "rms_mm_s * rms_mm_s / (rms_mm_s * rms_mm_s + 40e0)"
SCORED_CTES = {
    "sc": f"SELECT *, {SCORE_SQL} AS failure_prob_30d FROM lab",
    "fl": "SELECT *, failure_prob_30d >= 0.5 AS model_flag, rms_mm_s >= 7.1 AS rms_flag, label_failure_30d AS label FROM sc",
}


def scored(i: Inputs) -> DataFrame:
    """Labelled features with a fixed formula as the probability, so the evaluation has SQL."""
    rms2 = F.col("rms_mm_s") * F.col("rms_mm_s")
    return i.labelled.withColumn("failure_prob_30d", rms2 / (rms2 + F.lit(40.0)))


def flagged(i: Inputs) -> DataFrame:
    return scored(i).select(
        "asset_id", "tag_id", "window_start", "days_to_fail", F.col("label_failure_30d").alias("label"),
        "failure_prob_30d", (F.col("failure_prob_30d") >= 0.5).alias("model_flag"),
        (F.col("rms_mm_s") >= 7.1).alias("rms_flag"), F.lit(7.1).alias("rms_threshold_mm_s"),
    )


PREDICTION_SQL = f"""SELECT asset_id, tag_id, window_end AS feature_window_end, failure_prob_30d,
  {half_up('1e2 * (1 - failure_prob_30d)', 1)} AS health_index, iso_10816_zone,
  {ACTION_SQL.replace('p >=', 'failure_prob_30d >=')} AS recommended_action FROM sc"""


def predicted(i: Inputs) -> DataFrame:
    rows = scored(i)
    return pdm.predictions(rows, pdm.rul_calibration(rows), "vibration", "1", HORIZON)


@query("peak_risk", with_ctes(
    f"SELECT tag_id, {sel('health_index iso_10816_zone recommended_action', 'failure_prob_30d')} FROM pr "
    "QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY failure_prob_30d DESC, feature_window_end DESC) = 1",
    "lab", extra={**SCORED_CTES, "pr": PREDICTION_SQL}))
def _(i: Inputs) -> DataFrame:
    return pdm.peak_risk(predicted(i))


@query("flagged_sensors", with_ctes(
    "SELECT count(*) FILTER (p >= 0.7) AS flagged, count(*) AS sensors FROM (SELECT tag_id, max(failure_prob_30d) AS p FROM sc GROUP BY 1)",
    "lab", extra=SCORED_CTES))
def _(i: Inputs) -> DataFrame:
    return pdm.flagged_sensors(pdm.peak_risk(predicted(i)))


@query("orders_with_notes", with_ctes(
    "SELECT w.work_order_id, w.asset_id, w.status, count(*) AS notes FROM wo w JOIN notes n ON n.work_order_id = w.work_order_id GROUP BY ALL", "wo", "notes"))
def _(i: Inputs) -> DataFrame:
    return wo.orders_with_notes(i.orders, i.notes)


@query("counts_by", with_ctes("SELECT severity, count(*) AS n FROM al GROUP BY 1", "al"))
def _(i: Inputs) -> DataFrame:
    return wo.counts_by(i.alert_rows, "severity")


@query("text_profile", "SELECT count(*) AS total, count(DISTINCT text) AS distinct_texts, round(avg(length(text)), 0) AS avg_length FROM documents")
def _(i: Inputs) -> DataFrame:
    return wo.text_profile(i.table("documents"), "text")


# ---- windows -------------------------------------------------------------------------------

@query("node_accumulation", with_ctes(f"SELECT {sel('node_id window_start window_end', 'accumulation_tph')} FROM acc", "acc"))
def _(i: Inputs) -> DataFrame:
    return balance.node_accumulation(i.tag_1m, i.nodes)


@query("state_transitions", with_ctes(
    "SELECT asset_id, tag_id, source_ts, state, prev_state, coalesce(state = 'RUNNING' AND prev_state <> 'RUNNING', false) AS is_start FROM z", "z"))
def _(i: Inputs) -> DataFrame:
    samples = equipment.run_state_samples(i.readings, i.tags)
    return equipment.state_transitions(samples, SLICE_SECONDS).select(
        "asset_id", "tag_id", "source_ts", "state", "prev_state", "is_start"
    )


@query("rms_deltas", with_ctes(f"SELECT {sel('tag_id window_start', 'rms_delta_1h rms_delta_24h')} FROM feat", "feat"))
def _(i: Inputs) -> DataFrame:
    return i.features.select("tag_id", "window_start", "rms_delta_1h", "rms_delta_24h")


@query("rms_slope_24h", with_ctes(f"SELECT {sel('tag_id window_start', 'rms_slope_24h')} FROM feat", "feat"))
def _(i: Inputs) -> DataFrame:
    return i.features.select("tag_id", "window_start", "rms_slope_24h")


@query("pick_candidate", with_ctes("SELECT arc_id, inferred_from_node_id, candidate_count, count(*) AS windows FROM infer GROUP BY ALL", "infer"))
def _(i: Inputs) -> DataFrame:
    return balance.arc_infer(i.incidence).groupBy("arc_id", "inferred_from_node_id", "candidate_count").agg(
        F.count(F.lit(1)).alias("windows")
    )


@query("cdc_latest", with_ctes(LATEST_SQL, "feed"))
def _(i: Inputs) -> DataFrame:
    return history.latest_images(i.feed, "alert_id")


@query("next_sample", stock_sql("SELECT source_ts, stockpile_id, end_ts FROM runs"))
def _(i: Inputs) -> DataFrame:
    return runs(i).select("source_ts", "stockpile_id", "end_ts")


@query("state_runs", stock_sql("SELECT source_ts, stockpile_id, CAST(run_id AS BIGINT) AS run_id FROM runs"))
def _(i: Inputs) -> DataFrame:
    return runs(i).select("source_ts", "stockpile_id", "run_id")


@query("breach_sessions", alert_sql("SELECT tag_id, rule_type, count(*) AS episodes, CAST(sum(samples) AS BIGINT) AS samples FROM ep GROUP BY 1, 2"))
def _(i: Inputs) -> DataFrame:
    return episodes(i).groupBy("tag_id", "rule_type").agg(
        F.count(F.lit(1)).alias("episodes"), F.sum("samples").alias("samples")
    )


@query("rule_specificity", alert_sql(f"SELECT {sel('tag_id rule_type episode_no rule_id severity', 'trigger_value')} FROM best"))
def _(i: Inputs) -> DataFrame:
    return alerts.matched_episodes(episodes(i), i.tags, i.rules).select(
        "tag_id", "rule_type", "episode_no", "rule_id", "severity", "trigger_value"
    )


@query("snapshot_as_of", with_ctes(
    f"""SELECT {sel('tag_id event_id source_ts quality', 'value')} FROM r
    WHERE source_ts > TIMESTAMP '{AT}' - INTERVAL 43200 SECONDS AND source_ts <= TIMESTAMP '{AT}'
    QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY source_ts DESC, seq DESC) = 1""", "r"))
def _(i: Inputs) -> DataFrame:
    return rd.snapshot_as_of(i.readings, AT, 43200).select("tag_id", "event_id", "source_ts", "quality", "value")


@query("trend_history", with_ctes(
    f"""SELECT {sel('tag_id window_start', 'rms_mm_s rms_delta_1h rms_delta_24h rms_slope_24h rms_pct_of_baseline')} FROM (SELECT tag_id, window_start, rms_mm_s,
      rms_mm_s - first_value(rms_mm_s) OVER (o ROWS BETWEEN {SHORT_LAG} PRECEDING AND CURRENT ROW) AS rms_delta_1h,
      rms_mm_s - first_value(rms_mm_s) OVER (o ROWS BETWEEN {LONG_LAG} PRECEDING AND CURRENT ROW) AS rms_delta_24h,
      (rms_mm_s - first_value(rms_mm_s) OVER (o ROWS BETWEEN {LONG_LAG} PRECEDING AND CURRENT ROW)) / 24e0 AS rms_slope_24h,
      1e2 * rms_mm_s / avg(rms_mm_s) OVER (o ROWS BETWEEN {BASE_ROWS} PRECEDING AND CURRENT ROW) AS rms_pct_of_baseline
      FROM feat WINDOW o AS (PARTITION BY tag_id ORDER BY window_start))""", "feat"))
def _(i: Inputs) -> DataFrame:
    return vibration.trend_history(i.features, SHORT_LAG, LONG_LAG, BASE_ROWS)


@query("hours_since_reset", with_ctes(
    f"""SELECT {sel('tag_id window_start', 'hours_since_maintenance')} FROM (SELECT tag_id, window_start,
      (epoch(window_start) - epoch(min(window_start) OVER (PARTITION BY tag_id, lf))) / 3600e0 AS hours_since_maintenance
      FROM (SELECT f.*, (SELECT max(failed_at) FROM fail x WHERE x.tag_id = f.tag_id AND x.failed_at <= f.window_start) AS lf FROM feat f))""", "feat", "fail"))
def _(i: Inputs) -> DataFrame:
    return vibration.hours_since_reset(i.features, i.failures).select(
        "tag_id", "window_start", "hours_since_maintenance"
    )


@query("top1_qualify", stock_sql("SELECT stockpile_id AS active_id FROM active"))
def _(i: Inputs) -> DataFrame:
    return stockpile.active_pile(i.readings, STACKER)


# ---- search and top-k ----------------------------------------------------------------------

TERMS = ["find", "mentan", "thtion", "erble", "queaux", "from", "thor"]
_TERM_LIST = "[" + ", ".join(f"'{t}'" for t in TERMS) + "]"
SEARCH_CTES = {
    "tok": "SELECT note_id, regexp_extract_all(lower(note_text), '[a-z]{3,}') AS w FROM sn",
    "asked": f"SELECT unnest({_TERM_LIST}) AS term",
    "said": f"""SELECT note_id, len(w) AS dl, unnest(w) AS word FROM tok""",
    "every": "SELECT term AS word FROM asked UNION SELECT word FROM said",
    **stem_ctes("every", "word"),
    "st": "SELECT count(*) AS n, avg(len(w)) AS al FROM tok",
    "tf": f"""SELECT d.note_id, q.stem AS term, count(*) AS tf, any_value(d.dl) AS dl
      FROM said d JOIN stems x ON x.word = d.word JOIN (SELECT DISTINCT stem FROM asked JOIN stems ON term = word) q ON q.stem = x.stem
      WHERE NOT list_contains([{', '.join(f"'{w}'" for w in ex.STOP_WORDS)}], d.word) GROUP BY ALL""",
    "df": "SELECT term, count(*) AS df FROM tf GROUP BY 1",
    "bs": """SELECT tf.note_id, round(sum(ln(1 + (st.n - df.df + 0.5e0) / (df.df + 0.5e0)) * tf.tf * 2.2e0
        / (tf.tf + 1.2e0 * (0.25e0 + 0.75e0 * tf.dl / st.al))), 9) AS bm25
      FROM tf JOIN df ON df.term = tf.term, st WHERE tf.tf > 0 GROUP BY 1""",
    "bm": "SELECT note_id, bm25, row_number() OVER (ORDER BY bm25 DESC, note_id) AS bm25_rank FROM bs QUALIFY bm25_rank <= 20",
    "vs": """SELECT note_id, round(list_cosine_similarity(CAST(note_embedding AS DOUBLE[]),
        (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 9) AS cosine_sim FROM sn WHERE note_embedding IS NOT NULL""",
    "vt": "SELECT note_id, cosine_sim, row_number() OVER (ORDER BY cosine_sim DESC, note_id) AS vector_rank FROM vs QUALIFY vector_rank <= 20",
    "votes": """SELECT note_id, 'words' AS list, bm25 AS score, bm25_rank AS place FROM bm
      UNION ALL SELECT note_id, 'vector', cosine_sim, vector_rank FROM vt""",
    "fu": """SELECT note_id, max(score) FILTER (list = 'words') AS bm25, max(place) FILTER (list = 'words') AS bm25_rank,
      max(score) FILTER (list = 'vector') AS cosine_sim, max(place) FILTER (list = 'vector') AS vector_rank,
      sum(1e0 / (60 + place)) AS rrf FROM votes GROUP BY note_id""",
    "bo": """SELECT DISTINCT ON (work_order_id) note_id, bm25, bm25_rank, cosine_sim, vector_rank, rrf, work_order_id, note_kind, note_text,
      asset_id, failure_mode, title, status FROM fu JOIN sn USING (note_id) JOIN wo USING (work_order_id)
      ORDER BY work_order_id, rrf DESC, note_id""",
}


def search_sql(body: str) -> str:
    return with_ctes(body, "sn", "wo", extra=SEARCH_CTES)


_INDEXED: dict[tuple[str, str], str] = {}


def indexed(i: Inputs) -> search.NoteIndex:
    """The index of the notes, built once for a session and a set of tables."""
    key = (i.spark.sparkContext.applicationId, i.sf)
    if key not in _INDEXED:
        _INDEXED[key] = search.build_index(i.search_notes, scratch(i.spark, "index")).path
    return search.NoteIndex(i.spark, _INDEXED[key])


def fused(i: Inputs) -> DataFrame:
    terms = search.query_terms(i.spark, QUESTION)
    return search.rrf_fuse(indexed(i).top(terms), search.vector_top(i.search_vectors, i.query_vector))


@query("content_terms", f"""SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(list_filter(
  regexp_extract_all(lower(text), '[a-z]{{3,}}'), lambda x: NOT list_contains([{', '.join(f"'{w}'" for w in ex.STOP_WORDS)}], x))),
  lambda x: x)), lambda x: x), ' ') AS terms FROM documents""")
def _(i: Inputs) -> DataFrame:
    return i.table("documents").select(
        "doc_id", F.array_join(F.sort_array(ex.content_terms("text")), " ").alias("terms")
    )


@query("word_stems", with_ctes("SELECT word, stem FROM stems", extra={
    "heard": "SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents", **stem_ctes("heard", "word")}))
def _(i: Inputs) -> DataFrame:
    heard = i.table("documents").select(F.explode(ex.words("text")).alias("word")).distinct()
    return with_stems(heard, "word", "stem")


@query("note_index", search_sql(f"""SELECT stem, count(DISTINCT note_id) AS notes, count(*) AS hits FROM said JOIN stems ON stems.word = said.word
  WHERE NOT list_contains([{', '.join(f"'{w}'" for w in ex.STOP_WORDS)}], said.word) GROUP BY 1"""))
def _(i: Inputs) -> DataFrame:
    return i.spark.read.parquet(f"{indexed(i).path}/postings").groupBy("stem").agg(
        F.count(F.lit(1)).alias("notes"), F.sum("tf").alias("hits"))


@query("bm25_top20", search_sql(f"SELECT {sel('note_id bm25_rank', 'bm25')} FROM bm"))
def _(i: Inputs) -> DataFrame:
    return indexed(i).top(search.query_terms(i.spark, QUESTION))


@query("vector_top20", search_sql(f"SELECT {sel('note_id vector_rank', 'cosine_sim')} FROM vt"))
def _(i: Inputs) -> DataFrame:
    return search.vector_top(i.search_vectors, i.query_vector)


@query("rrf_fuse", search_sql(f"SELECT {sel('note_id bm25_rank vector_rank', 'bm25 cosine_sim rrf')} FROM fu"))
def _(i: Inputs) -> DataFrame:
    return fused(i)


@query("best_note_per_order", search_sql(f"SELECT {sel('note_id work_order_id asset_id status note_kind', 'rrf')} FROM bo"))
def _(i: Inputs) -> DataFrame:
    return search.best_note_per_order(fused(i), i.search_notes, i.orders).select(
        "note_id", "work_order_id", "asset_id", "status", "note_kind", "rrf"
    )


@query("hybrid_search", search_sql(
    f"""SELECT note_id, round(rrf, 5) AS rrf_score, bm25_rank, vector_rank, {half_up('bm25', 3)} AS bm25_score,
      {half_up('cosine_sim', 4)} AS cosine_sim, work_order_id, asset_id, failure_mode, title, status, note_kind, note_text
    FROM bo ORDER BY rrf DESC, note_id LIMIT 5"""))
def _(i: Inputs) -> DataFrame:
    return search.hybrid_search(indexed(i), i.search_notes, i.orders, QUESTION, i.query_vector, vectors=i.search_vectors)


@query("matching_notes", search_sql("SELECT DISTINCT note_id FROM tf WHERE tf > 0"))
def _(i: Inputs) -> DataFrame:
    return indexed(i).matching(search.query_terms(i.spark, QUESTION))


@query("topk_global", search_sql(f"SELECT {sel('note_id', 'rrf')} FROM fu ORDER BY rrf DESC, note_id LIMIT 5"))
def _(i: Inputs) -> DataFrame:
    return fused(i).select("note_id", "rrf").orderBy(F.desc("rrf"), "note_id").limit(5)


_MEDIAN_LIST = ", ".join(f"median({c}) AS m_{c}" for c in pdm.FEATURES)
_DEVIATIONS = " UNION ALL ".join(
    f"SELECT tag_id, window_start, {n} AS i, '{c}' AS f, ({c} - m_{c}) / (abs(m_{c}) + 1e-9) AS d FROM lab, med WHERE {c} IS NOT NULL"
    for n, c in enumerate(pdm.FEATURES)
)


@query("topk_features_per_row", with_ctes(
    """SELECT tag_id, window_start, string_agg(f, ',' ORDER BY rn) AS top_features FROM (SELECT *, row_number() OVER
      (PARTITION BY tag_id, window_start ORDER BY abs(d) DESC, i) AS rn FROM dev) WHERE rn <= 3 GROUP BY 1, 2""",
    "lab", extra={"med": f"SELECT {_MEDIAN_LIST} FROM lab", "dev": _DEVIATIONS}))
def _(i: Inputs) -> DataFrame:
    parsed = F.from_json("top_features", "array<struct<feature: string, deviation_from_fleet_median: double>>")
    return pdm.top_features(i.labelled).select(
        "tag_id", "window_start", F.array_join(parsed["feature"], ",").alias("top_features")
    )


@query("ordered_report", with_ctes(
    f"SELECT *, row_number() OVER (ORDER BY downtime_minutes DESC, asset_id) AS place FROM ({DOWNTIME_SQL})", "wo", "tags", "notes"))
def _(i: Inputs) -> DataFrame:
    """The report in its order, and each row's place in it: one row per asset of the plant."""
    order = (F.desc("downtime_minutes"), "asset_id")
    report = wo.asset_downtime(i.orders, i.tags, i.notes)
    return report.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long")).orderBy("place")


@query("union_all", with_ctes(
    "SELECT 'BAD' AS kind, event_id, tag_id FROM r WHERE quality = 'BAD' UNION ALL SELECT 'ANY', event_id, tag_id FROM r", "r"))
def _(i: Inputs) -> DataFrame:
    rows = i.readings.select("event_id", "tag_id", "quality")
    bad = rows.where(F.col("quality") == "BAD").select(F.lit("BAD").alias("kind"), "event_id", "tag_id")
    return bad.unionByName(rows.select(F.lit("ANY").alias("kind"), "event_id", "tag_id"))


@query("distinct_rows", with_ctes("SELECT DISTINCT window_start, window_end FROM t1", "t1"))
def _(i: Inputs) -> DataFrame:
    return i.tag_1m.select("window_start", "window_end").distinct()


# ---- maintenance model ---------------------------------------------------------------------

@query("vibration_features_10m", with_ctes(f"SELECT {sel(FEATURE_PLAIN, FEATURE_DOUBLES)} FROM feat", "feat"))
def _(i: Inputs) -> DataFrame:
    return i.features


@query("failure_labels", with_ctes(f"SELECT {sel('tag_id window_start label_failure_30d', 'days_to_fail')} FROM lab", "lab"))
def _(i: Inputs) -> DataFrame:
    return i.labelled.select("tag_id", "window_start", "label_failure_30d", "days_to_fail")


@query("days_to_fail", with_ctes(
    f"""SELECT l.tag_id, l.window_start, {half_up('(epoch(f.t) - epoch(l.window_start)) / 86400e0', 6)} AS days_to_fail FROM lab l
    LEFT JOIN (SELECT tag_id, max(window_start) AS t FROM lab WHERE label_failure_30d GROUP BY 1) f ON f.tag_id = l.tag_id""", "lab"))
def _(i: Inputs) -> DataFrame:
    return vibration.days_to_fail(i.labelled).select("tag_id", "window_start", "days_to_fail")


_FITTED: dict[tuple[str, str], str] = {}


def fitted(i: Inputs) -> pdm.PdmModel:
    """The model at its full size, fitted and stored once for a session and a set of tables, and loaded from there."""
    key = (i.spark.sparkContext.applicationId, i.sf)
    if key not in _FITTED:
        path = scratch(i.spark, "model")
        pdm.train(i.labelled).save(path)
        _FITTED[key] = path
    return pdm.PdmModel.load(i.spark, _FITTED[key])


@query("pdm_train")
def _(i: Inputs) -> DataFrame:
    return fitted(i).probabilities(i.labelled).select("tag_id", "window_start", "failure_prob_30d")


@query("pdm_loao_eval")
def _(i: Inputs) -> DataFrame:
    return pdm.evaluation(pdm.cross_fit(i.labelled, scratch(i.spark, "folds")))


SCORED_DAYS = 10
NO_CORE = " AND ".join(f"{c} IS NOT NULL" for c in pdm.CORE_FEATURES)


# What a fitted model leaves to chance is left out: which rows are scored, under which ids, in what zone, and that the
# columns derived from the probability agree with it.
@query("pdm_fleet_run", with_ctes(
    f"""SELECT sha256('vibration|2|' || tag_id || '|' || strftime(window_end, '%Y-%m-%d %H:%M:%S')) AS prediction_id, asset_id, tag_id,
      window_end AS feature_window_end, iso_10816_zone, TRUE AS agrees
    FROM lab WHERE window_start >= (SELECT max(window_start) FROM lab) - INTERVAL {SCORED_DAYS} DAY AND {NO_CORE}""", "lab"))
def _(i: Inputs) -> DataFrame:
    path = scratch(i.spark, "fleet")
    for _ in range(2):  # the second run appends nothing
        score_fleet(i.spark, i.labelled, fitted(i), path, "vibration", "2", HORIZON, SCORED_DAYS)
    p = F.col("failure_prob_30d")
    agrees = p.between(0, 1) & (F.abs(F.col("health_index") - 100 * (1 - p)) <= 0.051) & F.col("predicted_rul_hours").isNotNull() & (
        F.col("recommended_action") == ex.recommended_action(p))
    return i.spark.read.parquet(path).select(
        "prediction_id", "asset_id", "tag_id", "feature_window_end", "iso_10816_zone", agrees.alias("agrees"))


@query("pdm_evaluation", with_ctes(
    f"""SELECT m.*, {half_up('a.ap', 3)} AS model_pr_auc FROM (SELECT asset_id AS held_out_asset, count(*) AS test_rows,
      {half_up("coalesce(count(*) FILTER (model_flag AND label) * 1e0 / nullif(count(*) FILTER (model_flag), 0), 0)", 3)} AS model_precision,
      {half_up("coalesce(count(*) FILTER (model_flag AND label) * 1e0 / nullif(count(*) FILTER (label), 0), 0)", 3)} AS model_recall,
      {half_up("coalesce(2e0 * count(*) FILTER (model_flag AND label) / nullif(count(*) FILTER (label) + count(*) FILTER (model_flag), 0), 0)", 3)} AS model_f1,
      7.1e0 AS rms_threshold_mm_s,
      {half_up("coalesce(2e0 * count(*) FILTER (rms_flag AND label) / nullif(count(*) FILTER (label) + count(*) FILTER (rms_flag), 0), 0)", 3)} AS rms_f1
      FROM fl GROUP BY 1) m
    JOIN (SELECT asset_id, sum(hits * ch / cr) / nullif(sum(hits), 0) AS ap FROM (SELECT asset_id, hits, sum(hits) OVER w AS ch, sum(n) OVER w AS cr
      FROM (SELECT asset_id, failure_prob_30d AS p, count(*) AS n, count(*) FILTER (label) AS hits FROM fl GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY asset_id ORDER BY p DESC)) GROUP BY 1) a ON a.asset_id = m.held_out_asset""",
    "lab", extra=SCORED_CTES))
def _(i: Inputs) -> DataFrame:
    return pdm.evaluation(flagged(i))


_QUANTILES = "[" + ", ".join(repr(0.5 + 0.495 * k / 59) for k in range(60)) + "]"


@query("rms_threshold_baseline", with_ctes(
    f"""SELECT {half_up('t', 6)} AS rms_threshold_mm_s, {half_up('f1', 6)} AS best_f1 FROM (
      SELECT th.k, th.t, coalesce(2e0 * count(*) FILTER (l.label_failure_30d AND l.rms_mm_s >= th.t)
        / nullif(count(*) FILTER (l.rms_mm_s >= th.t) + count(*) FILTER (l.label_failure_30d), 0), 0) AS f1
      FROM th, lab l GROUP BY 1, 2) ORDER BY f1 DESC, k LIMIT 1""",
    "lab", extra={"th": f"SELECT unnest(range(60)) AS k, unnest(quantile_cont(rms_mm_s, {_QUANTILES})) AS t FROM lab"}))
def _(i: Inputs) -> DataFrame:
    return pdm.rms_threshold_baseline(i.labelled)


@query("phase1_recall", with_ctes(
    f"""SELECT asset_id AS held_out_asset, count(*) AS phase1_rows,
      {half_up("coalesce(count(*) FILTER (model_flag AND label) * 1e0 / nullif(count(*) FILTER (label), 0), 0)", 3)} AS model_recall_phase1,
      {half_up("coalesce(count(*) FILTER (rms_flag AND label) * 1e0 / nullif(count(*) FILTER (label), 0), 0)", 3)} AS rms_recall_phase1
    FROM fl WHERE days_to_fail BETWEEN 2 AND 5 GROUP BY 1""", "lab", extra=SCORED_CTES))
def _(i: Inputs) -> DataFrame:
    return pdm.phase1_recall(flagged(i), 2.0, 5.0)


RUL_CTES = {
    **SCORED_CTES,
    "kb": "SELECT least(CAST(floor(failure_prob_30d * 10) AS INTEGER), 9) AS bin, median(days_to_fail) AS m FROM sc WHERE days_to_fail IS NOT NULL GROUP BY 1",
    "bb": """SELECT b.bin, k.m, (SELECT max(bin) FROM kb WHERE bin <= b.bin) AS lo, (SELECT min(bin) FROM kb WHERE bin >= b.bin) AS hi
      FROM (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin) b LEFT JOIN kb k ON k.bin = b.bin""",
    "rul": """SELECT b.bin, coalesce(b.m, l.m + (h.m - l.m) * (b.bin - l.bin) / nullif(h.bin - l.bin, 0), l.m, h.m) AS rul_days
      FROM bb b LEFT JOIN kb l ON l.bin = b.lo LEFT JOIN kb h ON h.bin = b.hi""",
}


@query("rul_calibration", with_ctes(f"SELECT {sel('bin', 'rul_days')} FROM rul", "lab", extra=RUL_CTES))
def _(i: Inputs) -> DataFrame:
    return pdm.rul_calibration(scored(i))


@query("pdm_score", with_ctes(
    f"""SELECT {sel('p.asset_id p.tag_id p.feature_window_end p.health_index p.iso_10816_zone p.recommended_action')},
      {half_up('p.failure_prob_30d', 6)} AS failure_prob_30d, {half_up('u.rul_days * 24', 6)} AS predicted_rul_hours
    FROM pr p JOIN rul u ON u.bin = least(CAST(floor(p.failure_prob_30d * 10) AS INTEGER), 9)""",
    "lab", extra={**RUL_CTES, "pr": PREDICTION_SQL}))
def _(i: Inputs) -> DataFrame:
    return predicted(i).select(
        "asset_id", "tag_id", "feature_window_end", "health_index", "iso_10816_zone",
        "recommended_action", "failure_prob_30d", "predicted_rul_hours",
    )


@query("fill_context", with_ctes(
    f"SELECT tag_id, window_start, " + ", ".join(f"{half_up(f'coalesce({c}, m_{c})', 6)} AS {c}" for c in pdm.FEATURES) + " FROM lab, med",
    "lab", extra={"med": f"SELECT {_MEDIAN_LIST} FROM lab"}))
def _(i: Inputs) -> DataFrame:
    return pdm.fill_context(i.labelled).select("tag_id", "window_start", *pdm.FEATURES)


# ---- work orders, history, checks ----------------------------------------------------------

TEMPLATES = [
    ("vibration", "Vibration on {asset}", "{tag} at {val} against {lim}", "Bearing replaced on {asset}"),
    ("*", "Excursion on {asset}", "{tag} breached {lim} at {val}", "No fault found"),
]


def _share_sql(modulus: int, salt: str) -> str:
    return f"CAST('0x' || substr(sha256(alert_id || '|{salt}'), 1, 8) AS BIGINT) % {modulus}"


def _pick_sql(salt: str, values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{_share_sql(len(values), salt)} + 1]"


_WORD_SQL = """replace(replace(replace(replace(CASE WHEN measure = 'vibration' THEN '{0}' ELSE '{1}' END,
  '{{asset}}', asset_id), '{{tag}}', tag_id), '{{val}}', printf('%.2f', coalesce(trigger_value, 0))), '{{lim}}', printf('%.2f', lim))"""


def _worded(column: int) -> str:
    return _WORD_SQL.format(TEMPLATES[0][column], TEMPLATES[1][column])


@query("alerts_to_work_orders", alert_sql(
    f"""SELECT 'WO-' || substr(sha256(alert_id), 1, 16) AS work_order_id, alert_id, asset_id, tag_id, area_code,
      CASE WHEN closed THEN 'CLOSED' ELSE {_pick_sql('status', ['OPEN', 'IN_PROGRESS', 'ON_HOLD'])} END AS status,
      CASE severity WHEN 'CRITICAL' THEN 'CRITICAL' WHEN 'HIGH' THEN 'HIGH' WHEN 'WARNING' THEN 'MEDIUM' ELSE 'LOW' END AS priority,
      measure AS failure_mode, {_worded(1)} AS title, {_worded(2)} AS description,
      CASE WHEN closed THEN {_worded(3)} END AS resolution_notes, {_pick_sql('raised', CREW)} AS raised_by,
      {_pick_sql('assigned', CREW)} AS assigned_to, raised_at AS created_at, raised_at AS updated_at,
      CASE WHEN closed THEN raised_at END AS closed_at,
      CASE WHEN closed THEN CAST({_share_sql(461, 'downtime')} + 20 AS INTEGER) END AS downtime_minutes
    FROM (SELECT *, {_share_sql(100, 'close')} < 60 AS closed,
      CASE WHEN trigger_value >= high THEN high ELSE coalesce(low, high, 0) END AS lim
      FROM (SELECT *, sha256(tag_id || '|' || rule_type || '|' || epoch_us(raised_at)) AS alert_id,
        CASE WHEN rule_type = 'limit_trip' THEN lo_lo ELSE lo END AS low,
        CASE WHEN rule_type = 'limit_trip' THEN hi_hi ELSE hi END AS high FROM best)
      WHERE severity <> 'WARNING' OR {_share_sql(100, 'raise')} < 55)"""))
def _(i: Inputs) -> DataFrame:
    found = alerts.derive_alerts(i.readings, i.tags, i.rules, EPISODE_GAP, LONG_SLICE_SECONDS)
    templates = i.spark.createDataFrame(TEMPLATES, "measure STRING, title STRING, description STRING, resolution STRING")
    return wo.alerts_to_orders(found, i.tags, templates, CREW)


@query("history_to_work_orders", with_ctes(
    f"""SELECT 'WO-' || substr(sha256(tag_id || '|' || epoch_us(ended)), 1, 16) AS work_order_id, CAST(NULL AS VARCHAR) AS alert_id, asset_id, tag_id,
      split_part(asset_id, '-', 1) AS area_code, 'CLOSED' AS status, 'HIGH' AS priority, 'vibration' AS failure_mode, 'Bearing failure on ' || asset_id AS title,
      printf('%s, vibration peaked in mm/s at %.2f, crest factor reached %.2f, kurtosis reached %.2f', tag_id, peak_rms, peak_crest, peak_kurt) AS description,
      'Bearing replaced.' AS resolution_notes, '{CREW[0]}' AS raised_by, '{CREW[0]}' AS assigned_to, ended AS created_at, ended AS updated_at, ended AS closed_at,
      CAST(240 + CAST('0x' || substr(sha256(tag_id || '|' || epoch_us(ended)), 1, 8) AS BIGINT) % 721 AS INTEGER) AS downtime_minutes
    FROM (SELECT l.asset_id, l.tag_id, f.ended, {PEAKS_SQL} FROM lab l
      JOIN (SELECT tag_id, max(window_start) AS ended FROM lab WHERE label_failure_30d GROUP BY 1) f ON f.tag_id = l.tag_id AND l.window_start <= f.ended GROUP BY ALL)""",
    "lab"))
def _(i: Inputs) -> DataFrame:
    return wo.failures_to_orders(vibration.failure_peaks(i.labelled), CREW[0])


DEFER_SQL = f"""SELECT w.* REPLACE (
  CASE WHEN status <> 'CLOSED' THEN created_at + INTERVAL 30 DAYS ELSE created_at END AS created_at,
  CASE WHEN status <> 'CLOSED' THEN TIMESTAMP '{AT}' ELSE updated_at END AS updated_at,
  CASE WHEN status <> 'CLOSED' THEN 'OPEN' ELSE status END AS status,
  CASE WHEN status <> 'CLOSED' THEN NULL ELSE assigned_to END AS assigned_to,
  CASE WHEN status <> 'CLOSED' AND priority = 'MEDIUM' THEN 'HIGH' WHEN status <> 'CLOSED' AND priority = 'HIGH' THEN 'CRITICAL' ELSE priority END AS priority,
  CAST(CASE WHEN status <> 'CLOSED' THEN ceil(coalesce(downtime_minutes, e.mean_exact) * e.escalation) ELSE downtime_minutes END AS BIGINT) AS downtime_minutes)
  FROM wo w, e"""
DEFER_CTES = {"e": ESCALATION_SQL, "d": DEFER_SQL}


@query("deferral_forecast", with_ctes(
    "SELECT work_order_id, asset_id, status, priority, assigned_to, created_at, updated_at, downtime_minutes FROM d", "wo", extra=DEFER_CTES))
def _(i: Inputs) -> DataFrame:
    return wo.defer_open_orders(i.orders, AT).select(
        "work_order_id", "asset_id", "status", "priority", "assigned_to", "created_at", "updated_at", "downtime_minutes"
    )


@query("deferral_by_asset", with_ctes(
    f"""SELECT work_order_id, asset_id, failure_mode, priority, downtime_minutes AS projected_downtime_minutes,
      {half_up('downtime_minutes / 60e0', 1)} AS projected_downtime_hours FROM d WHERE status = 'OPEN'""", "wo", extra=DEFER_CTES))
def _(i: Inputs) -> DataFrame:
    return wo.deferral_by_asset(wo.defer_open_orders(i.orders, AT))


@query("deferral_conclusion", with_ctes(
    f"""SELECT b AS baseline_minutes, f AS forecast_minutes, (SELECT count(*) FROM wo WHERE status <> 'CLOSED') AS open_jobs_deferred,
      f - b AS delta_minutes, {half_up('(f - b) / 60e0', 1)} AS delta_hours
    FROM (SELECT (SELECT CAST(sum(downtime_minutes) AS BIGINT) FROM wo) AS b, (SELECT CAST(sum(downtime_minutes) AS BIGINT) FROM d) AS f)""", "wo", extra=DEFER_CTES))
def _(i: Inputs) -> DataFrame:
    return wo.deferral_conclusion(i.orders, wo.defer_open_orders(i.orders, AT))


@query("scd2_history", with_ctes(
    f"""SELECT alert_id, delivery_status, {half_up('trigger_value', 6)} AS trigger_value, _pg_lsn AS valid_from, valid_to, valid_to IS NULL AS is_current
    FROM (SELECT *, lead(_pg_lsn) OVER (PARTITION BY alert_id ORDER BY _pg_lsn, _sort_by) AS valid_to FROM feed WHERE _pg_change_type <> 'update_preimage')
    WHERE _pg_change_type <> 'delete'""", "feed"))
def _(i: Inputs) -> DataFrame:
    return history.scd2_history(i.feed, "alert_id", FEED_SLICE)


@query("constraint_check", with_ctes(
    """SELECT 'order_key_unique' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM wo GROUP BY work_order_id HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'order_status', count(*) FROM wo WHERE status NOT IN ('OPEN', 'IN_PROGRESS', 'ON_HOLD', 'CLOSED', 'CANCELLED')
    UNION ALL SELECT 'order_priority', count(*) FROM wo WHERE priority NOT IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')
    UNION ALL SELECT 'closed_has_timestamp', count(*) FROM wo WHERE (status = 'CLOSED') <> (closed_at IS NOT NULL)
    UNION ALL SELECT 'note_order_exists', count(*) FROM notes WHERE work_order_id NOT IN (SELECT work_order_id FROM wo)
    UNION ALL SELECT 'note_kind', count(*) FROM notes WHERE note_kind NOT IN ('DIAGNOSIS', 'ACTION', 'PARTS', 'HANDOVER', 'SAFETY')
    UNION ALL SELECT 'order_alert_exists', count(*) FROM wo WHERE alert_id NOT IN (SELECT alert_id FROM al)""", "wo", "notes", "al"))
def _(i: Inputs) -> DataFrame:
    return checks.constraint_check(i.orders, i.notes, i.alert_rows)


@query("slurry_partner_check", with_ctes(
    """SELECT tag_id, count(*) AS readings FROM r WHERE tag_id IN (SELECT tag_id FROM tags WHERE instrument_type = 'FI')
    AND tag_id NOT IN (SELECT flow_tag_id FROM pairs) GROUP BY 1""", "r", "tags", "pairs"))
def _(i: Inputs) -> DataFrame:
    flows = i.readings.join(i.tags.where(F.col("instrument_type") == "FI").select("tag_id"), "tag_id", "left_semi")
    as_arcs = flows.groupBy("tag_id").agg(F.count(F.lit(1)).alias("readings")).select(
        F.col("tag_id").alias("arc_id"), F.col("tag_id").alias("measure_tag_id"),
        F.lit("slurry_flow_density").alias("measure_method"), "readings",
    )
    lone = checks.slurry_partner_check(as_arcs, i.tags)
    return as_arcs.join(lone.select("arc_id"), "arc_id").select(F.col("arc_id").alias("tag_id"), "readings")


@query("arc_vs_design", with_ctes(
    f"""SELECT arc_id, measure_method, design_tph, {half_up('m', 6)} AS measured_tph, {half_up('m - design_tph', 6)} AS deviation_tph,
      abs(m - design_tph) <= 60 AS within_tolerance
    FROM (SELECT arc_id, measure_method, design_tph, avg(measured_tph) AS m FROM mff GROUP BY ALL)""", "mff"))
def _(i: Inputs) -> DataFrame:
    return balance.arc_vs_design(balance.mass_flow_final(i.incidence), 60.0)


# ---- rules over time -----------------------------------------------------------------------

def roc_ctes() -> dict[str, str]:
    good = """SELECT r.* , t.asset_id, t.asset_name FROM r JOIN tags t ON t.tag_id = r.tag_id
      WHERE t.measure = 'temperature' AND r.quality = 'GOOD'"""
    return {
        "g": good,
        "sl": f"""SELECT g.*, time_bucket(INTERVAL '1 hour', g.source_ts) - to_hours(CAST(k AS INTEGER)) AS window_start
          FROM g, range(10) x(k)""",
        "ch": """SELECT tag_id, asset_id, asset_name, window_start, window_start + INTERVAL '10 hours' AS window_end,
          arg_min(value, source_ts) AS first_value, arg_max(value, source_ts) AS last_value,
          arg_max(value, source_ts) - arg_min(value, source_ts) AS rise FROM sl GROUP BY ALL""",
    }


ROC_PLAIN, ROC_DOUBLES = "tag_id asset_id window_start window_end", "first_value last_value rise"


@query("rate_of_change", with_ctes(
    f"SELECT {sel(ROC_PLAIN + ' asset_name', ROC_DOUBLES)} FROM ch WHERE rise > 5", "r", "tags", extra=roc_ctes()))
def _(i: Inputs) -> DataFrame:
    return alerts.rate_of_change(i.readings, i.tags, 5.0, window="10 hours", step="1 hour")


STALE_SECONDS = 3 * 3600


WATCHED_SINCE = "2024-01-01 00:00:00"
# Readings and the start of the watch of each registered tag, in order; a silence is the time to the next of these.
SILENCE_CTES = {
    "said": f"""SELECT t.tag_id, t.asset_id, t.asset_name, r.source_ts, r.seq FROM r JOIN tags t ON t.tag_id = r.tag_id WHERE t.measure = 'mass_flow'
      UNION ALL SELECT tag_id, asset_id, asset_name, NULL, NULL FROM tags WHERE measure = 'mass_flow'""",
    "still": f"""SELECT tag_id, asset_id, asset_name, source_ts AS last_seen, coalesce(source_ts, TIMESTAMP '{WATCHED_SINCE}') AS since,
      lead(source_ts) OVER (PARTITION BY tag_id ORDER BY source_ts NULLS FIRST, seq) AS next_ts FROM said""",
}


@query("stale_tags", with_ctes(
    f"""SELECT * EXCLUDE (since), date_sub('second', since, coalesce(next_ts, TIMESTAMP '{HORIZON}')) AS silent_seconds FROM still
    WHERE coalesce(next_ts, TIMESTAMP '{HORIZON}') >= since + to_seconds({STALE_SECONDS})""", "r", "tags", extra=SILENCE_CTES))
def _(i: Inputs) -> DataFrame:
    return alerts.stale_tags(i.readings, i.tags, HORIZON, STALE_SECONDS, slice_seconds=LONG_SLICE_SECONDS, since=WATCHED_SINCE)


@query("running_empty", with_ctes(
    f"""SELECT {sel('asset_id asset_name window_start window_end', 'throughput_tph lo')} FROM (SELECT e.*, b.asset_name, b.lo,
      e.state = 'RUNNING' AND e.throughput_tph < b.lo AS empty FROM eq e
      JOIN (SELECT asset_id, max(asset_name) AS asset_name, min(lo) AS lo FROM tags WHERE instrument_type = 'WI' AND asset_type = 'conveyor' GROUP BY 1) b
      ON b.asset_id = e.asset_id) WHERE empty""", "eq", "tags"))
def _(i: Inputs) -> DataFrame:
    return alerts.running_empty(i.equipment, i.tags, seconds=GRAIN_SECONDS, grain_seconds=GRAIN_SECONDS)


@query("imbalance_sustained", with_ctes(
    f"""SELECT {sel('node_id window_start window_end windows_counted', 'mean_imbalance_pct')} FROM (SELECT node_id, window_start, window_end,
      avg(imbalance_pct) OVER w AS mean_imbalance_pct, count(imbalance_pct) OVER w AS windows_counted FROM mb WHERE balance_role = 'unit'
      WINDOW w AS (PARTITION BY node_id ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    WHERE windows_counted = 5 AND abs(mean_imbalance_pct) > 5""", "mb"))
def _(i: Inputs) -> DataFrame:
    return alerts.imbalance_sustained(balance.mass_balance_node_1m(i.incidence))


TIMED_CTES = {
    **roc_ctes(),
    "applies": """SELECT t.tag_id, t.asset_id, u.rule_id, u.rule_type FROM tags t JOIN (FROM rules WHERE enabled) u
      ON concat_ws('=', u.scope_type, nullif(u.scope_value, '')) IN ('all', 'asset_type=' || t.asset_type, 'measure=' || t.measure, 'tag=' || t.tag_id)""",
    "mute": f"""SELECT * FROM (SELECT tag_id, source_ts, date_sub('second', source_ts,
        coalesce(lead(source_ts) OVER (PARTITION BY tag_id ORDER BY source_ts, seq), TIMESTAMP '{HORIZON}')) AS silent
      FROM r) WHERE silent >= {STALE_SECONDS}""",
    "bare": """SELECT e.asset_id, e.window_start, e.throughput_tph FROM eq e
      JOIN (SELECT asset_id, min(lo) AS lo FROM tags WHERE instrument_type = 'WI' GROUP BY 1) b ON b.asset_id = e.asset_id
      WHERE e.state = 'RUNNING' AND e.throughput_tph < b.lo""",
    "sus": """SELECT * FROM (SELECT node_id, window_end, avg(imbalance_pct) OVER w AS v, count(imbalance_pct) OVER w AS c FROM mb
      WHERE balance_role = 'unit' WINDOW w AS (PARTITION BY node_id ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
      WHERE c = 5 AND abs(v) > 5""",
    "tr": f"""SELECT a.rule_id, c.tag_id AS place, c.window_end AS raised_at, c.rise AS trigger_value
        FROM ch c JOIN applies a ON a.tag_id = c.tag_id AND a.rule_type = 'rate_of_change' WHERE c.rise > 5
      UNION ALL SELECT a.rule_id, m.tag_id, m.source_ts + to_seconds({STALE_SECONDS}), m.silent
        FROM mute m JOIN applies a ON a.tag_id = m.tag_id AND a.rule_type = 'stale'
      UNION ALL SELECT a.rule_id, b.asset_id, b.window_start, b.throughput_tph
        FROM bare b JOIN (SELECT DISTINCT asset_id, rule_id FROM applies WHERE rule_type = 'deviation') a ON a.asset_id = b.asset_id
      UNION ALL SELECT rule_id, node_id, window_end, v FROM sus, (SELECT rule_id FROM rules WHERE enabled AND rule_type = 'imbalance')""",
}


@query("timed_rule_alerts", with_ctes(
    f"""SELECT sha256(rule_id || '|' || place || '|' || epoch_us(raised_at)) AS alert_id, rule_id, raised_at,
      {half_up('trigger_value', 6)} AS trigger_value FROM tr""", "r", "tags", "rules", "eq", "mb", extra=TIMED_CTES))
def _(i: Inputs) -> DataFrame:
    return alerts.timed_rule_alerts(
        i.readings, i.tags, i.rules, i.equipment, balance.mass_balance_node_1m(i.incidence), HORIZON,
        5.0, grain_seconds=GRAIN_SECONDS, slice_seconds=LONG_SLICE_SECONDS,
    ).select("alert_id", "rule_id", "raised_at", "trigger_value")


@query("quality_breaches", with_ctes("SELECT event_id, tag_id, quality, 'quality' AS rule_type FROM r WHERE quality <> 'GOOD'", "r"))
def _(i: Inputs) -> DataFrame:
    return alerts.quality_breaches(i.readings, i.tags).select("event_id", "tag_id", "quality", "rule_type")


# ---- streaming -----------------------------------------------------------------------------

def streamed_readings(i: Inputs, delay: str = "1 day") -> DataFrame:
    """The readings as a stream over the events file, with a watermark."""
    schema = i.table("events").schema
    events = seam.read_stream(i.spark, i.sf, schema, schema.names, glob="events.parquet")
    return jobs.event_time(readings_from_events(events, i.tags), delay)


def drained(i: Inputs, df: DataFrame, name: str, mode: str) -> DataFrame:
    """Run a stream over all available input, write each result whole, and read the last one back."""
    path, checkpoint = scratch(i.spark, name), scratch(i.spark, name + "-cp")
    if mode == "append":
        writer = df.writeStream.format("parquet").option("path", path)
    else:
        writer = df.writeStream.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(path))
    started = writer.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return i.spark.read.schema(df.schema).parquet(path)


# Events land in three parts. Of the last hours of a part some come with the next one, within the
# watermark's delay; some of the first part come with the last one and are too late.
PARTS, DELAY = 3, "1 day"
TOO_LATE_SQL = "day(ts) <= 10 AND event_id % 97 = 0"
WATERMARK_SQL = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)"


def landing_part() -> Column:
    day = F.dayofmonth("ts") - 1
    part = F.least(F.floor(day / 10), F.lit(PARTS - 1))
    is_late = (day % 10 == 9) & (F.hour("ts") >= 12) & (F.col("event_id") % 5 == 0)
    too_late = (part == 0) & (F.col("event_id") % 97 == 0)
    return F.when(too_late, PARTS - 1).when(is_late, F.least(part + 1, F.lit(PARTS - 1))).otherwise(part)


def fed(i: Inputs, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What a stream in append mode has closed after all parts have landed; it is started anew for each part."""
    landed, path, checkpoint = (scratch(i.spark, f"{name}{end}") for end in ("-in", "", "-cp"))
    events = i.table("events")
    for part in range(PARTS):
        events.where(landing_part() == part).write.mode("append").parquet(landed)
        stream = readings_from_events(seam.read_stream(i.spark, landed, events.schema, events.columns), i.tags)
        closed = build(jobs.event_time(stream, DELAY))
        writer = closed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return i.spark.read.schema(closed.schema).parquet(path)


def on_time(sql: str) -> str:
    """The same SQL over the events that were not too late."""
    return sql.replace("FROM events e ", f"FROM (SELECT * FROM events WHERE NOT ({TOO_LATE_SQL})) e ")


def naive(df: DataFrame, *columns: str) -> DataFrame:
    """Streams carry TIMESTAMP; the tables' type is TIMESTAMP_NTZ."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("read_stream_view", "SELECT event_id, ts, value FROM events WHERE value > 50")
def _(i: Inputs) -> DataFrame:
    schema = i.table("events").schema
    view = seam.read_stream(
        i.spark, i.sf, schema, ["event_id", "ts", "value"], F.col("value") > 50, glob="events.parquet"
    )
    return drained(i, view, "view", "append")


@query("stream_tag_1m", on_time(with_ctes(f"SELECT {sel(T1_PLAIN, T1_DOUBLES)} FROM t1 WHERE window_end <= {WATERMARK_SQL}", "t1")))
def _(i: Inputs) -> DataFrame:
    return naive(fed(i, lambda r: jobs.stream_tag_1m(r, GRAIN), "tag1m"), "window_start", "window_end")


@query("stream_dedup", with_ctes(f"SELECT {sel('event_id tag_id source_ts', 'value')} FROM r", "r"))
def _(i: Inputs) -> DataFrame:
    rows = streamed_readings(i).select("event_id", "tag_id", "source_ts", "value")
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return naive(drained(i, jobs.deduplicated(twice), "dedup", "append"), "source_ts")


@query("stream_current", CURRENT_SQL)
def _(i: Inputs) -> DataFrame:
    path, checkpoint = scratch(i.spark, "current"), scratch(i.spark, "current-cp")
    rows = streamed_readings(i).select("tag_id", "event_id", "source_ts", "value", "value_text", "quality", "seq")
    jobs.stream_current(rows, path, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return naive(up.read_current(i.spark, path), "source_ts")


STREAM_ALERT_SQL = with_ctes(
    f"""SELECT b.tag_id, u.rule_id, b.rule_type, b.source_ts AS raised_at, u.severity,
      CASE WHEN b.rule_type = 'quality' THEN b.quality END AS trigger_text,
      {half_up('''CASE WHEN b.rule_type <> 'quality' THEN b.value END''', 6)} AS trigger_value, 'PENDING' AS delivery_status
    FROM (SELECT r.*, t.asset_type, t.measure, CASE WHEN r.quality <> 'GOOD' THEN 'quality' WHEN t.value_class <> 'analog' THEN NULL
        WHEN r.value > t.hi_hi OR r.value < t.lo_lo THEN 'limit_trip' WHEN r.value > t.hi OR r.value < t.lo THEN 'limit_warn' END AS rule_type
      FROM r JOIN tags t ON t.tag_id = r.tag_id) b
    JOIN rules u ON u.enabled AND u.rule_type = b.rule_type
     AND (u.scope_type = 'all' OR (u.scope_type = 'asset_type' AND u.scope_value = b.asset_type)
       OR (u.scope_type = 'measure' AND u.scope_value = b.measure) OR (u.scope_type = 'tag' AND u.scope_value = b.tag_id))
    QUALIFY row_number() OVER (PARTITION BY b.event_id ORDER BY CASE u.scope_type WHEN 'tag' THEN 0 WHEN 'all' THEN 2 ELSE 1 END, u.rule_id) = 1""",
    "r", "tags", "rules")
STREAM_ALERT_COLUMNS = ["tag_id", "rule_id", "rule_type", "raised_at", "severity", "trigger_text", "trigger_value", "delivery_status"]


@query("stream_limit_alerts", STREAM_ALERT_SQL)
def _(i: Inputs) -> DataFrame:
    found = jobs.stream_limit_alerts(streamed_readings(i), i.tags, i.rules)
    return naive(drained(i, found, "limits", "append").select(*STREAM_ALERT_COLUMNS), "raised_at")


# What the stream takes from the register and the rules: names, place, limits and words.
TOLD_COLUMNS = ["tag_id", "raised_at", "asset_id", "area_code", "rule_name", "limit_low", "limit_high", "message"]


@query("stream_static_rules", with_ctes(
    f"""SELECT c.tag_id, c.source_ts AS raised_at, c.asset_id, c.area_code, c.rule_name,
      {half_up("CASE c.rule_type WHEN 'limit_trip' THEN c.lo_lo WHEN 'limit_warn' THEN c.lo END", 6)} AS limit_low,
      {half_up("CASE c.rule_type WHEN 'limit_trip' THEN c.hi_hi WHEN 'limit_warn' THEN c.hi END", 6)} AS limit_high,
      replace(replace(replace(replace(replace(c.message_template, '{{tag_id}}', c.tag_id), '{{asset_name}}', c.asset_name), '{{value}}', shown),
        '{{unit}}', CASE c.rule_type WHEN 'quality' THEN '' ELSE unit END), '{{node_id}}', '') AS message
    FROM (SELECT s.*, u.rule_name, u.message_template, CASE s.rule_type WHEN 'quality' THEN s.quality ELSE coalesce(printf('%.2f', s.value), '?') END AS shown,
        row_number() OVER (PARTITION BY s.event_id ORDER BY list_position(['tag', 'asset_type', 'measure', 'all'], u.scope_type) // 2, u.rule_id) AS place
      FROM (SELECT r.event_id, r.source_ts, r.value, r.quality, t.*, CASE WHEN r.quality <> 'GOOD' THEN 'quality' WHEN t.value_class = 'analog' THEN
          ['limit_warn', 'limit_trip'][(r.value NOT BETWEEN t.lo AND t.hi)::INT + (r.value NOT BETWEEN t.lo_lo AND t.hi_hi)::INT] END AS rule_type
        FROM r JOIN tags t ON t.tag_id = r.tag_id) s
      JOIN (FROM rules WHERE enabled) u ON u.rule_type = s.rule_type
        AND (u.scope_type = 'all' OR u.scope_value = MAP {{'asset_type': s.asset_type, 'measure': s.measure, 'tag': s.tag_id}}[u.scope_type])) c
    WHERE place = 1""", "r", "tags", "rules"))
def _(i: Inputs) -> DataFrame:
    found = jobs.stream_limit_alerts(streamed_readings(i), i.tags, i.rules).select(*TOLD_COLUMNS)
    return naive(drained(i, found, "static", "append"), "raised_at")


@query("stream_alert_sink", STREAM_ALERT_SQL)
def _(i: Inputs) -> DataFrame:
    path, checkpoint = scratch(i.spark, "outbox"), scratch(i.spark, "outbox-cp")
    found = jobs.stream_limit_alerts(streamed_readings(i), i.tags, i.rules)
    jobs.stream_alert_sink(found, path, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return naive(i.spark.read.parquet(path).select(*STREAM_ALERT_COLUMNS), "raised_at")


@query("stream_rate_of_change", on_time(with_ctes(
    f"SELECT {sel(ROC_PLAIN, ROC_DOUBLES)} FROM ch WHERE window_end <= {WATERMARK_SQL}", "r", "tags", extra=roc_ctes())))
def _(i: Inputs) -> DataFrame:
    return naive(fed(i, lambda r: jobs.stream_rate_of_change(r, i.tags, window="10 hours", step="1 hour"), "roc"), "window_start", "window_end")


@query("stream_stale_tags", on_time(with_ctes(
    f"""SELECT tag_id, asset_id, last_seen, since + to_seconds({STALE_SECONDS}) AS stale_from FROM still
    WHERE (next_ts IS NULL OR next_ts >= since + to_seconds({STALE_SECONDS})) AND since + to_seconds({STALE_SECONDS}) <= {WATERMARK_SQL}""",
    "r", "tags", extra=SILENCE_CTES)))
def _(i: Inputs) -> DataFrame:
    return naive(fed(i, lambda r: stream_stale_tags(r, i.tags, WATCHED_SINCE, STALE_SECONDS), "stale"), "last_seen", "stale_from")


@query("stream_episodes", on_time(alert_sql(
    f"""SELECT {sel('tag_id rule_type raised_at ended_at samples', 'peak_high peak_low')} FROM ep
    WHERE ended_at + INTERVAL {(EPISODE_GAP + 1) * 1_000_000 - 1} MICROSECONDS <= {WATERMARK_SQL}""")))
def _(i: Inputs) -> DataFrame:
    return naive(fed(i, lambda r: jobs.stream_episodes(r, i.tags, EPISODE_GAP), "episodes"), "raised_at", "ended_at")
