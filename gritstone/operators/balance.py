"""Mass balance over the flow graph, per window, with one-pass reconciliation.

Shape of the job: the minute aggregates, the full list of arcs per window and
the level changes of bins are unioned and hash-partitioned by window once.
Everything after that (arc rows, choosing the inferred tonnage, node rows) is
keyed by the window plus something, so it runs inside that partitioning with
no further shuffle. A window holds at most a few rows per arc.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.functions.expressions import (
    arc_tonnage, balance_status, is_solids_arc, percent, slurry_solids, whole_seconds,
)
from gritstone.functions.slices import DAY, previous_row, sliced
from gritstone.session import materialize

# Windows and arcs meet by a salt, so neither side is a single task or one array.
SPINE_ROWS = 1_000_000

ARC_COLUMNS = [
    "arc_id", "from_node_id", "to_node_id", "stream_type", "measure_method", "design_tph",
    "measure_tag_id",
]


def slurry_pairs(tags: DataFrame) -> DataFrame:
    """Flow tag and density tag of the same asset that end in the same number."""
    def numbered(code: str, name: str) -> DataFrame:
        return tags.where(F.col("instrument_type") == code).select(
            "asset_id", F.regexp_extract("tag_id", code + "([0-9]+)$", 1).alias("_number"),
            F.col("tag_id").alias(name),
        )

    pairs = numbered("FI", "flow_tag_id").join(
        numbered("DI", "density_tag_id"), ["asset_id", "_number"]
    )
    return pairs.select("flow_tag_id", "density_tag_id")


def arc_window_spine(tag_1m: DataFrame, arcs: DataFrame, rows_a_part: int = SPINE_ROWS) -> DataFrame:
    """Every arc in every window that has any reading, instrumented or not.

    The windows are dealt into as many parts as windows x arcs need, at ``rows_a_part`` rows each, and each part meets its own
    copy of the arcs by an equal key. Only the two counts are taken beforehand.
    """
    windows = tag_1m.select("window_start", "window_end").distinct()
    graph = materialize(arcs.select(*ARC_COLUMNS))
    parts = max(1, -(-windows.count() * graph.count() // rows_a_part))
    dealt = windows.withColumn("_part", F.pmod(F.xxhash64("window_start"), F.lit(parts)))
    copies = graph.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return dealt.join(copies, "_part").select("window_start", "window_end", *ARC_COLUMNS)


def node_accumulation(tag_1m: DataFrame, nodes: DataFrame, slice_seconds: int = DAY) -> DataFrame:
    """Stored tonnes per hour of bins, from the level change since the previous window.

    Divided by the elapsed time, so a gap in the readings does not inflate it.
    The window before is looked up per (bin, slice) and across slice edges.
    """
    bins = nodes.where(F.col("accumulation_tag_id").isNotNull() & (F.col("capacity_t") > 0)).select(
        "node_id", F.col("accumulation_tag_id").alias("tag_id"), "capacity_t"
    )
    levels = tag_1m.select("tag_id", "window_start", "window_end", "avg_value").join(bins, "tag_id")
    followed = previous_row(
        sliced(levels, "window_start", slice_seconds), ["node_id"], ["window_start"],
        {"avg_value": "_level_before", "window_start": "_start_before"},
    )
    step = F.col("avg_value") - F.col("_level_before")
    hours = whole_seconds(F.col("_start_before"), F.col("window_start")) / F.lit(3600.0)
    return followed.select(
        "node_id", "window_start", "window_end",
        F.try_divide(step / F.lit(100.0) * F.col("capacity_t"), hours).alias("accumulation_tph"),
    )


def _arc_measurements(tag_1m: DataFrame, arcs: DataFrame, tags: DataFrame) -> DataFrame:
    """Minute rows of the tags that measure an arc, marked as flow or density."""
    flow = arcs.where(F.col("measure_tag_id").isNotNull()).select(
        *ARC_COLUMNS, F.col("measure_tag_id").alias("tag_id"), F.lit("flow").alias("_role")
    )
    density = (
        arcs.where(F.col("measure_method") == "slurry_flow_density")
        .join(slurry_pairs(tags), F.col("measure_tag_id") == F.col("flow_tag_id"))
        .select(*ARC_COLUMNS, F.col("density_tag_id").alias("tag_id"), F.lit("density").alias("_role"))
    )
    measuring = materialize(flow.unionByName(density))
    return tag_1m.select("tag_id", "window_start", "window_end", "avg_value", "good_pct").join(
        measuring, "tag_id"
    ).drop("tag_id")


def window_contributions(
    tag_1m: DataFrame, arcs: DataFrame, tags: DataFrame, nodes: DataFrame | None = None,
) -> DataFrame:
    """Arc rows (and bin rows, when nodes are given), hash-partitioned by window."""
    rows = arc_window_spine(tag_1m, arcs).unionByName(
        _arc_measurements(tag_1m, arcs, tags), allowMissingColumns=True
    ).withColumn("node_id", F.lit(None).cast("string"))
    if nodes is not None:
        rows = rows.unionByName(node_accumulation(tag_1m, nodes), allowMissingColumns=True)
    else:
        rows = rows.withColumn("accumulation_tph", F.lit(None).cast("double"))

    def of(role: str, column: str) -> Column:
        return F.max(F.when(F.col("_role") == role, F.col(column)))

    grouped = (
        rows.repartition("window_start")
        .groupBy("window_start", "window_end", "node_id", *ARC_COLUMNS)
        .agg(
            of("flow", "avg_value").alias("_flow"), of("density", "avg_value").alias("_density"),
            F.least(
                F.coalesce(of("flow", "good_pct"), F.lit(100.0)),
                F.coalesce(of("density", "good_pct"), F.lit(100.0)),
            ).alias("good_sample_pct"),
            F.max("accumulation_tph").alias("accumulation_tph"),
        )
    )
    measured = arc_tonnage(F.col("measure_method"), F.col("_flow"), F.col("_density"))
    return grouped.withColumn("measured_tph", measured).withColumn(
        "is_estimated", F.col("measure_tag_id").isNull() | (F.col("measure_method") == "inferred")
    )


def _arc_view(rows: DataFrame, extra: list[str]) -> DataFrame:
    deviation = percent(F.col("measured_tph") - F.col("design_tph"), F.nullif(F.col("design_tph"), F.lit(0.0)))
    return rows.select(
        "arc_id", "window_start", "window_end", "from_node_id", "to_node_id", "stream_type",
        "measure_method", "measured_tph", "design_tph", deviation.alias("deviation_pct"),
        "good_sample_pct", "is_estimated", *extra,
    )


def mass_flow_1m(tag_1m: DataFrame, arcs: DataFrame, tags: DataFrame) -> DataFrame:
    """Dry solids per arc and window. No rows means quality 100, all-bad rows mean 0."""
    return _arc_view(window_contributions(tag_1m, arcs, tags), [])


def reconciled_incidence(
    tag_1m: DataFrame, arcs: DataFrame, nodes: DataFrame, tags: DataFrame,
) -> DataFrame:
    """One row per (window, node, arc end), with the inferred tonnage of unmeasured arcs.

    Where a unit node has exactly one unmeasured arc, closing its balance gives
    that arc's tonnage. Both ends may offer a candidate; the upstream node wins,
    then the lower node id. A single pass: two unknowns at a node stay unknown.
    """
    rows = window_contributions(tag_1m, arcs, tags, nodes)

    def end(node: Column, side: str) -> Column:
        return F.struct(node.alias("node"), F.lit(side).alias("side"))

    ends = (
        F.when(F.col("arc_id").isNull(), F.array(end(F.col("node_id"), "store")))
        .when(
            is_solids_arc(),
            F.array(end(F.col("to_node_id"), "in"), end(F.col("from_node_id"), "out")),
        )
        .otherwise(F.array(end(F.lit(None).cast("string"), "aside")))
    )
    incidence = rows.withColumn("_end", F.explode(ends)).select(
        *[c for c in rows.columns if c != "node_id"],
        F.col("_end.node").alias("node_id"), F.col("_end.side").alias("side"),
    ).join(nodes.select("node_id", "balance_role"), "node_id", "left")

    at_node = Window.partitionBy("window_start", "node_id")
    on_arc = Window.partitionBy("window_start", "arc_id")
    is_flow = F.col("side").isin("in", "out")
    is_unknown = is_flow & F.col("measured_tph").isNull()

    def total(side: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("side") == side, F.col("measured_tph"))).over(at_node), F.lit(0.0)
        )

    known = incidence.select(
        "*", total("in").alias("known_in"), total("out").alias("known_out"),
        F.count_if(is_unknown).over(at_node).alias("unknown_arcs"),
        F.coalesce(
            F.max(F.when(F.col("side") == "store", F.col("accumulation_tph"))).over(at_node),
            F.lit(0.0),
        ).alias("node_accumulation_tph"),
    )
    surplus = F.col("known_in") - F.col("known_out") - F.col("node_accumulation_tph")
    offers = is_unknown & (F.col("balance_role") == "unit") & (F.col("unknown_arcs") == 1)
    candidate = known.withColumn(
        "candidate_tph",
        F.when(offers, F.when(F.col("side") == "out", surplus).otherwise(-surplus)),
    )
    preference = F.struct(F.when(F.col("side") == "out", 0).otherwise(1), F.col("node_id"))
    offered = F.when(
        F.col("candidate_tph").isNotNull(),
        F.struct(F.col("node_id").alias("node"), F.col("candidate_tph").alias("tph")),
    )
    return candidate.select(
        "*",
        F.min_by(offered, F.when(F.col("candidate_tph").isNotNull(), preference)).over(on_arc).alias("_chosen"),
        F.count("candidate_tph").over(on_arc).alias("candidate_count"),
        (F.max("candidate_tph").over(on_arc) - F.min("candidate_tph").over(on_arc)).alias(
            "inference_spread_tph"
        ),
    ).select(
        "*", F.col("_chosen.node").alias("inferred_from_node_id"),
        F.col("_chosen.tph").alias("inferred_tph"),
        F.coalesce("measured_tph", "_chosen.tph").alias("final_tph"),
    ).drop("_chosen")


def node_balance_inputs(incidence: DataFrame) -> DataFrame:
    """Known inflow and outflow of each unit node and which arc it lacks."""
    unknown = F.col("measured_tph").isNull()
    return (
        incidence.where(F.col("side").isin("in", "out") & (F.col("balance_role") == "unit"))
        .groupBy("node_id", "window_start")
        .agg(
            F.sum(F.when(F.col("side") == "in", F.col("measured_tph"))).alias("known_in"),
            F.sum(F.when(F.col("side") == "out", F.col("measured_tph"))).alias("known_out"),
            F.count_if(unknown).alias("unknown_arcs"),
            F.max(F.when(unknown, F.col("arc_id"))).alias("unknown_arc_id"),
            F.max(F.when(unknown, F.col("side"))).alias("unknown_side"),
        )
    )


def arc_infer(incidence: DataFrame) -> DataFrame:
    """The chosen candidate per inferred arc, how many there were and how far apart."""
    return incidence.where(
        (F.col("side") == "out") & F.col("measured_tph").isNull() & F.col("inferred_tph").isNotNull()
    ).select(
        "arc_id", "window_start", "inferred_from_node_id", "inferred_tph", "candidate_count",
        "inference_spread_tph",
    )


def mass_flow_final(incidence: DataFrame) -> DataFrame:
    """Measured or inferred tonnage per arc. Each arc has one 'out' end or stands aside."""
    arcs = incidence.where(F.col("side").isin("out", "aside"))
    inferred = F.col("inferred_tph").isNotNull()
    return arcs.select(
        "arc_id", "window_start", "window_end", "from_node_id", "to_node_id", "stream_type",
        "measure_method", "design_tph", F.col("final_tph").alias("measured_tph"),
        (F.col("measured_tph").isNull() & inferred).alias("is_reconciled"),
        (F.col("is_estimated") | inferred).alias("is_estimated"), "good_sample_pct",
    )


def node_flow(incidence: DataFrame) -> DataFrame:
    """Inflow, outflow, arc counts and quality per node: one grouping, no outer join."""
    def when_side(side: str, value: Column) -> Column:
        return F.when(F.col("side") == side, value)

    tph = F.col("final_tph")
    measured = tph.isNotNull()
    return (
        incidence.where(F.col("side").isin("in", "out", "store") & F.col("balance_role").isNotNull())
        .groupBy("node_id", "window_start", "window_end", "balance_role")
        .agg(
            F.sum(when_side("in", tph)).alias("mass_in_tph"),
            F.count_if((F.col("side") == "in") & measured).alias("arcs_in_measured"),
            F.count_if(F.col("side") == "in").alias("arcs_in_total"),
            F.sum(when_side("out", tph)).alias("mass_out_tph"),
            F.count_if((F.col("side") == "out") & measured).alias("arcs_out_measured"),
            F.count_if(F.col("side") == "out").alias("arcs_out_total"),
            F.least(
                F.coalesce(F.min(when_side("in", F.col("good_sample_pct"))), F.lit(100.0)),
                F.coalesce(F.min(when_side("out", F.col("good_sample_pct"))), F.lit(100.0)),
            ).alias("data_quality_pct"),
            F.max("node_accumulation_tph").alias("accumulation_tph"),
            F.coalesce(
                F.max(F.col("inferred_from_node_id") == F.col("node_id")), F.lit(False)
            ).alias("used_for_inference"),
        )
        .where(F.col("arcs_in_total") + F.col("arcs_out_total") > 0)
    )


def mass_balance_node_1m(incidence: DataFrame) -> DataFrame:
    """Balance and status per node and window; imbalance only where closing is expected."""
    raw = F.col("mass_in_tph") - F.col("mass_out_tph") - F.col("accumulation_tph")
    is_unit = F.col("balance_role") == "unit"
    fed = is_unit & (F.col("mass_in_tph") > 0)
    unmeasured = (
        F.col("arcs_in_total") + F.col("arcs_out_total")
        - F.col("arcs_in_measured") - F.col("arcs_out_measured")
    )
    return node_flow(incidence).withColumn("_raw", raw).select(
        "node_id", "window_start", "window_end", "balance_role", "mass_in_tph", "mass_out_tph",
        "accumulation_tph", F.when(is_unit, F.col("_raw")).alias("imbalance_tph"),
        F.when(fed, percent(F.col("_raw"), F.col("mass_in_tph"))).alias("imbalance_pct"),
        F.when(fed, percent(F.col("mass_out_tph"), F.col("mass_in_tph"))).alias("closure_pct"),
        "arcs_in_measured", "arcs_in_total", "arcs_out_measured", "arcs_out_total",
        "data_quality_pct",
        balance_status(
            F.col("balance_role"), F.col("mass_in_tph"), F.col("mass_out_tph"), F.col("_raw"),
            unmeasured, F.col("data_quality_pct"), F.col("used_for_inference"),
        ).alias("status"),
    )


# The desands cyclone's instruments.
DESANDS_TAGS = {
    "feed_q": "DSD-CYC01-FI01", "feed_rho": "DSD-CYC01-DI01",
    "overflow_q": "DSD-CYC01-FI02", "overflow_rho": "DSD-CYC01-DI02",
    "underflow_q": "DSD-CYC01-FI03", "underflow_rho": "DSD-CYC01-DI03",
    "water_q": "UTL-WTR01-FI01",
}


def desands_balance_1m(tag_1m: DataFrame, tag_ids: dict[str, str] = DESANDS_TAGS) -> DataFrame:
    """Water and solids balance of the desands cyclone, one row per window."""
    wide = (
        tag_1m.where(F.col("tag_id").isin(list(tag_ids.values())))
        .groupBy("window_start", "window_end")
        .agg(*[
            F.max(F.when(F.col("tag_id") == tag, F.col("avg_value"))).alias(name)
            for name, tag in tag_ids.items()
        ])
    )
    for stream in ("feed", "overflow", "underflow"):
        wide = wide.withColumn(
            f"{stream}_solids_tph", slurry_solids(F.col(f"{stream}_q"), F.col(f"{stream}_rho"))
        )
    feed, over, under = (F.col(f"{s}_solids_tph") for s in ("feed", "overflow", "underflow"))
    return wide.select(
        "window_start", "window_end",
        F.col("feed_q").alias("feed_slurry_m3h"), F.col("feed_rho").alias("feed_density_tm3"),
        "feed_solids_tph",
        F.col("overflow_q").alias("overflow_slurry_m3h"),
        F.col("overflow_rho").alias("overflow_density_tm3"), "overflow_solids_tph",
        F.col("underflow_q").alias("underflow_slurry_m3h"),
        F.col("underflow_rho").alias("underflow_density_tm3"), "underflow_solids_tph",
        F.col("water_q").alias("water_added_m3h"),
        percent(under, feed).alias("solids_recovery_pct"),
        percent(over, feed).alias("fines_reject_pct"),
        (feed - over - under).alias("solids_imbalance_tph"),
    )


def longrun_node_closure(readings: DataFrame, arcs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole-period mean per weightometer, summed into and out of each unit node."""
    mean = readings.groupBy("tag_id").agg(F.avg("value").alias("tph"))
    dry = arcs.where(F.col("stream_type") == "dry_solids").join(
        mean, F.col("measure_tag_id") == F.col("tag_id")
    )
    ends = F.array(
        F.struct(F.col("to_node_id").alias("node"), F.lit("in").alias("side")),
        F.struct(F.col("from_node_id").alias("node"), F.lit("out").alias("side")),
    )
    sums = (
        dry.select("tph", F.explode(ends).alias("_end"))
        .groupBy(F.col("_end.node").alias("node_id"))
        .agg(
            F.sum(F.when(F.col("_end.side") == "in", F.col("tph"))).alias("tin"),
            F.sum(F.when(F.col("_end.side") == "out", F.col("tph"))).alias("tout"),
        )
        .where(F.col("tin").isNotNull() & F.col("tout").isNotNull())
    )
    gap = F.col("tin") - F.col("tout")
    return nodes.where(F.col("balance_role") == "unit").join(sums, "node_id").select(
        "node_id", "node_type", F.round("tin", 1).alias("mass_in"),
        F.round("tout", 1).alias("mass_out"), F.round(gap, 1).alias("imbalance_tph"),
        F.round(percent(gap, F.col("tin")), 2).alias("imbalance_pct"),
    )


def longrun_desands(readings: DataFrame, tag_ids: dict[str, str] = DESANDS_TAGS) -> DataFrame:
    """Underflow and overflow solids reconstructed from whole-period means."""
    names = ("overflow_q", "overflow_rho", "underflow_q", "underflow_rho")
    means = readings.where(F.col("tag_id").isin([tag_ids[n] for n in names])).agg(*[
        F.avg(F.when(F.col("tag_id") == tag_ids[n], F.col("value"))).alias(n) for n in names
    ])
    return means.select(
        F.round(slurry_solids(F.col("underflow_q"), F.col("underflow_rho")), 1).alias("underflow_solids_tph"),
        F.round(slurry_solids(F.col("overflow_q"), F.col("overflow_rho")), 1).alias("overflow_solids_tph"),
    )


def arc_vs_design(flows: DataFrame, tolerance_tph: float = 5.0) -> DataFrame:
    """Mean measured against design tonnage per arc."""
    deviation = F.col("measured_tph") - F.col("design_tph")
    return (
        flows.groupBy("arc_id", "design_tph", "measure_method")
        .agg(F.avg("measured_tph").alias("measured_tph"))
        .select(
            "arc_id", "design_tph", "measure_method", "measured_tph",
            deviation.alias("deviation_tph"),
            (F.abs(deviation) <= tolerance_tph).alias("within_tolerance"),
        )
    )


def design_closure(arcs: DataFrame, nodes: DataFrame, tolerance_tph: float = 0.01) -> DataFrame:
    """Design inflow and outflow per node, from the arcs alone."""
    ends = F.array(
        F.struct(F.col("to_node_id").alias("node"), F.lit("in").alias("side")),
        F.struct(F.col("from_node_id").alias("node"), F.lit("out").alias("side")),
    )
    sums = (
        arcs.where(is_solids_arc())
        .select("design_tph", F.explode(ends).alias("_end"))
        .groupBy(F.col("_end.node").alias("node_id"))
        .agg(
            F.sum(F.when(F.col("_end.side") == "in", F.col("design_tph"))).alias("_in"),
            F.sum(F.when(F.col("_end.side") == "out", F.col("design_tph"))).alias("_out"),
        )
    )
    design_in, design_out = (F.coalesce(c, F.lit(0.0)) for c in ("_in", "_out"))
    return nodes.join(sums, "node_id", "left").select(
        "node_id", "balance_role", design_in.alias("design_in_tph"),
        design_out.alias("design_out_tph"),
        ((F.col("balance_role") != "unit") | (F.abs(design_in - design_out) < tolerance_tph)).alias("closes"),
    )


def wet_dry_check(
    tags: DataFrame, dry_feed_tph: float, tag_ids: dict[str, str] = DESANDS_TAGS,
    tolerance_tph: float = 5.0,
) -> DataFrame:
    """Do the nominal slurry figures of the cyclone reconcile with the dry side?"""
    names = [n for n in tag_ids if n != "water_q"]
    nominal = tags.where(F.col("tag_id").isin([tag_ids[n] for n in names])).agg(*[
        F.max(F.when(F.col("tag_id") == tag_ids[n], F.col("nominal"))).alias(n) for n in names
    ])
    solids = nominal.select(*[
        slurry_solids(F.col(f"{s}_q"), F.col(f"{s}_rho")).alias(f"{s}_solids_tph")
        for s in ("feed", "overflow", "underflow")
    ])
    split = F.col("feed_solids_tph") - F.col("overflow_solids_tph") - F.col("underflow_solids_tph")
    return solids.select(
        "*", split.alias("split_closure_tph"),
        (
            (F.abs(split) <= tolerance_tph)
            & (F.abs(F.col("feed_solids_tph") - dry_feed_tph) <= tolerance_tph)
        ).alias("reconciles"),
    )
