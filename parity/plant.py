"""A small invented plant for the parity queries, as Spark rows and as SQL values.

Source bin, feeder, crusher, surge bin, screen with a recirculating crusher,
cyclone with a water self-loop, thickener and product pile.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

from gritstone.schemas import DIM_ARC, DIM_NODE, DIM_RULE, DIM_TAG, schema_of

TAG_SCHEMA = StructType([*DIM_TAG.fields, *schema_of("tag_no INT, scan_group INT").fields])

RUN_STATES = "RUNNING|STOPPED|FAULT"
PILE_STATES = "IDLE|SP01|SP02|SP03"


def _tag(no, group, tag_id, asset_name, asset_type, area_name, measure, unit, nominal, enum=None):
    asset_id, code = tag_id.rsplit("-", 1)
    analog = enum is None
    limits = [round(nominal * f, 4) for f in (0.90, 0.94, 1.06, 1.12)] if analog else [None] * 4
    return (
        tag_id, asset_id, asset_name, asset_type, asset_id.split("-")[0], area_name, measure,
        code[:2], unit, "analog" if analog else "discrete", 1.0, nominal if analog else None,
        *limits, code[:2] in ("WI", "FI", "DI"), code[:2] in ("VI", "VP", "VK", "TI", "II"), enum,
        f"{asset_name} {measure}", no, group,
    )


_TAG_ROWS = [
    # group 0: dry side, surge bin level, conveyors
    (0, "TIP-FDR02-WI01", "Apron feeder", "feeder", "Feed", "mass_flow", "t/h", 1000.0, None),
    (0, "GYR-BLT02-WI01", "Crusher belt", "conveyor", "Crushing", "mass_flow", "t/h", 1000.0, None),
    (0, "GYR-BLT05-WI01", "Reclaim belt", "conveyor", "Crushing", "mass_flow", "t/h", 1000.0, None),
    (0, "GYR-BIN03-LI01", "Surge bin", "bin", "Crushing", "level", "pct", 55.0, None),
    (0, "GYR-BLT02-ZI01", "Crusher belt", "conveyor", "Crushing", "state", "enum", 1.0, RUN_STATES),
    (0, "GYR-BLT05-ZI01", "Reclaim belt", "conveyor", "Crushing", "state", "enum", 1.0, RUN_STATES),
    (0, "GYR-BLT02-II01", "Crusher belt", "conveyor", "Crushing", "motor_current", "A", 60.0, None),
    (0, "QCL-SMP03-QI01", "Product sampler", "sampler", "Laboratory", "assay", "pct", 62.0, None),
    (0, "QCL-SMP03-QI02", "Product sampler", "sampler", "Laboratory", "assay", "pct", 3.0, None),
    # group 1: recirculating loop and wet side
    (1, "SEP-BLT06-WI01", "Oversize belt", "conveyor", "Screening", "mass_flow", "t/h", 200.0, None),
    (1, "SEP-BLT07-WI01", "Return belt", "conveyor", "Screening", "mass_flow", "t/h", 200.0, None),
    (1, "SEP-BLT08-WI01", "Undersize belt", "conveyor", "Screening", "mass_flow", "t/h", 1000.0, None),
    (1, "WSH-HYC05-FI01", "Cyclone", "cyclone", "Desands", "volume_flow", "m3/h", 1500.0, None),
    (1, "WSH-HYC05-DI01", "Cyclone", "cyclone", "Desands", "density", "t/m3", 1.5, None),
    (1, "WSH-HYC05-FI02", "Cyclone", "cyclone", "Desands", "volume_flow", "m3/h", 700.0, None),
    (1, "WSH-HYC05-DI02", "Cyclone", "cyclone", "Desands", "density", "t/m3", 1.2, None),
    (1, "WSH-HYC05-FI03", "Cyclone", "cyclone", "Desands", "volume_flow", "m3/h", 800.0, None),
    (1, "WSH-HYC05-DI03", "Cyclone", "cyclone", "Desands", "density", "t/m3", 1.9, None),
    (1, "SVC-PMP09-FI01", "Process water", "utility", "Utilities", "volume_flow", "m3/h", 1200.0, None),
    # group 2: vibration sensors with context
    (2, "GYR-JAW04-VI01", "Primary crusher", "crusher", "Crushing", "vibration", "mm/s", 2.7, None),
    (2, "GYR-JAW04-VP01", "Primary crusher", "crusher", "Crushing", "vibration_peak", "mm/s", 9.5, None),
    (2, "GYR-JAW04-VK01", "Primary crusher", "crusher", "Crushing", "vibration_kurtosis", "dimensionless", 3.0, None),
    (2, "GYR-JAW04-TI01", "Primary crusher", "crusher", "Crushing", "temperature", "degC", 62.0, None),
    (2, "GYR-JAW04-II01", "Primary crusher", "crusher", "Crushing", "motor_current", "A", 1310.0, None),
    (2, "GYR-JAW04-ZI01", "Primary crusher", "crusher", "Crushing", "state", "enum", 1.0, RUN_STATES),
    (2, "SEP-DCK07-VI01", "Sizing screen", "screen", "Screening", "vibration", "mm/s", 6.9, None),
    (2, "SEP-DCK07-VP01", "Sizing screen", "screen", "Screening", "vibration_peak", "mm/s", 24.0, None),
    (2, "SEP-DCK07-VK01", "Sizing screen", "screen", "Screening", "vibration_kurtosis", "dimensionless", 3.2, None),
    (2, "SEP-DCK07-II01", "Sizing screen", "screen", "Screening", "motor_current", "A", 90.0, None),
    (2, "SEP-CON06-VI01", "Tertiary crusher", "crusher", "Screening", "vibration", "mm/s", 10.8, None),
    (2, "SEP-CON06-VP01", "Tertiary crusher", "crusher", "Screening", "vibration_peak", "mm/s", 37.0, None),
    (2, "SEP-CON06-VK01", "Tertiary crusher", "crusher", "Screening", "vibration_kurtosis", "dimensionless", 3.4, None),
    (2, "SEP-CON06-TI01", "Tertiary crusher", "crusher", "Screening", "temperature", "degC", 58.0, None),
    (2, "SEP-CON06-VI02", "Tertiary crusher", "crusher", "Screening", "vibration", "mm/s", 5.0, None),
    # group 3: stacker
    (3, "YRD-BLD02-ZI01", "Stacker", "stacker", "Stockpiles", "state", "enum", 1.0, RUN_STATES),
    (3, "YRD-BLD02-ZI02", "Stacker", "stacker", "Stockpiles", "state", "enum", 1.0, PILE_STATES),
    (3, "YRD-BLD02-WI01", "Stacker", "stacker", "Stockpiles", "mass_flow", "t/h", 900.0, None),
    (3, "GYR-JAW04-PI01", "Primary crusher", "crusher", "Crushing", "pressure", "kPa", 8700.0, None),
    # registered, but never scanned
    (4, "YRD-BLD09-WI01", "Standby stacker", "stacker", "Stockpiles", "mass_flow", "t/h", 900.0, None),
]
TAGS = [_tag(no, *row) for no, row in enumerate(_TAG_ROWS)]
SCAN_GROUPS = 4

NODES = [
    ("N1", "Source bin", "bin", "TIP", "source", None, 0.0, 0, 0),
    ("N2", "Apron feeder", "feeder", "TIP", "unit", None, 0.0, 1, 0),
    ("N3", "Primary crusher", "crusher", "GYR", "unit", None, 0.0, 2, 0),
    ("N4", "Surge bin", "bin", "GYR", "unit", "GYR-BIN03-LI01", 850.0, 3, 0),
    ("N5", "Sizing screen", "screen", "SEP", "unit", None, 0.0, 4, 0),
    ("N6", "Tertiary crusher", "crusher", "SEP", "unit", None, 0.0, 4, 1),
    ("N7", "Cyclone", "cyclone", "WSH", "unit", None, 0.0, 5, 0),
    ("N8", "Thickener", "thickener", "WSH", "sink", None, 0.0, 6, 1),
    ("N9", "Product pile", "stockpile", "YRD", "sink", None, 0.0, 6, 0),
]

ARCS = [
    ("A01", "N1", "N2", "Drawdown", 1000.0, "TIP-FDR02-WI01", "weightometer", "dry_solids"),
    ("A02", "N2", "N3", "Crusher feed", 1000.0, None, "inferred", "dry_solids"),
    ("A03", "N3", "N4", "Crusher discharge", 1000.0, "GYR-BLT02-WI01", "weightometer", "dry_solids"),
    ("A04", "N4", "N5", "Reclaim", 1000.0, "GYR-BLT05-WI01", "weightometer", "dry_solids"),
    ("A05", "N5", "N6", "Oversize", 200.0, "SEP-BLT06-WI01", "weightometer", "dry_solids"),
    ("A06", "N6", "N5", "Return", 200.0, "SEP-BLT07-WI01", "weightometer", "dry_solids"),
    ("A07", "N5", "N7", "Undersize", 1000.0, "SEP-BLT08-WI01", "weightometer", "dry_solids"),
    ("A08", "N7", "N8", "Overflow", 160.0, "WSH-HYC05-FI02", "slurry_flow_density", "slurry"),
    ("A09", "N7", "N9", "Underflow", 850.0, "WSH-HYC05-FI03", "slurry_flow_density", "slurry"),
    ("A10", "N7", "N7", "Process water", 0.0, "SVC-PMP09-FI01", "volume_flow", "water"),
]

RULES = [
    ("stop-dry", "Dry line past its stop", "measure", "mass_flow", "limit_trip", "HIGH", 0, "{tag_id} carries {value} {unit}, stop the line", True),
    ("stop-deck", "Deck past its stop", "asset_type", "screen", "limit_trip", "CRITICAL", 0, "{asset_name} must stop: {tag_id} reads {value} {unit}", True),
    ("stop-peak", "Jaw peaks", "tag", "GYR-JAW04-VP01", "limit_trip", "CRITICAL", 0, "Peaks of {value} {unit} at {asset_name}", True),
    ("stop-rest", "Past a stop limit", "all", None, "limit_trip", "WARNING", 0, "{asset_name}: {tag_id} reads {value} {unit}, past its stop limit", True),
    ("look-wash", "Wash plant out of band", "asset_type", "cyclone", "limit_warn", "INFO", 0, "{asset_name} washes at {value} {unit}", True),
    ("look-amps", "Motor draws oddly", "measure", "motor_current", "limit_warn", "WARNING", 0, "{asset_name} draws {value} {unit}", True),
    ("own-deck", "Deck under watch", "tag", "SEP-DCK07-VI01", "limit_warn", "INFO", 0, "Watch {tag_id}: {value}{node_id}", True),
    ("look-rest", "Out of band", "all", None, "limit_warn", "INFO", 0, "{asset_name}: {tag_id} reads {value} {unit}, out of band", True),
    ("doubt-assay", "Assay not to be trusted", "measure", "assay", "quality", "HIGH", 0, "{tag_id} sends {value}", True),
    ("doubt-wash", "Wash signal in doubt", "asset_type", "cyclone", "quality", "INFO", 0, "{tag_id} of {asset_name} sends {value}", True),
    ("warm-jaw", "Jaw warms fast", "tag", "GYR-JAW04-TI01", "rate_of_change", "WARNING", 36000, "{asset_name} warmed by {value}", True),
    ("warm-cone", "Cone warms fast", "tag", "SEP-CON06-TI01", "rate_of_change", "CRITICAL", 36000, "{asset_name} warmed by {value}", True),
    ("mute-wet", "Flow meter mute", "measure", "volume_flow", "stale", "HIGH", 10800, "Nothing from {tag_id} for {value} s", True),
    ("mute-one", "Feeder meter mute", "tag", "TIP-FDR02-WI01", "stale", "INFO", 10800, "Nothing from the feeder for {value} s", True),
    ("mute-lab", "Sampler mute", "asset_type", "sampler", "stale", "CRITICAL", 10800, "Nothing from {asset_name} for {value} s", True),
    ("bare-stack", "Stacker runs bare", "asset_type", "stacker", "deviation", "HIGH", 3600, "{asset_name} runs bare at {value}", True),
    ("open-node", "Node does not close", "node", None, "imbalance", "CRITICAL", 18000, "{node_id} is off by {value}", True),
    ("old-rule", "No longer used", "all", None, "limit_warn", "INFO", 0, "never sent", False),
]

# The plant's own instruments, under the names the operators ask for.
PILE_TAG, BELT_TAG, FE_TAG, SIO2_TAG = "YRD-BLD02-ZI02", "YRD-BLD02-WI01", "QCL-SMP03-QI01", "QCL-SMP03-QI02"
WASH_TAGS = {
    "feed_q": "WSH-HYC05-FI01", "feed_rho": "WSH-HYC05-DI01", "overflow_q": "WSH-HYC05-FI02", "overflow_rho": "WSH-HYC05-DI02",
    "underflow_q": "WSH-HYC05-FI03", "underflow_rho": "WSH-HYC05-DI03", "water_q": "SVC-PMP09-FI01",
}
CREW = ["ada", "ben", "chidi", "dana", "eli"]

_TABLES = {
    "tags": (TAG_SCHEMA, TAGS), "nodes": (DIM_NODE, NODES), "arcs": (DIM_ARC, ARCS),
    "rules": (DIM_RULE, RULES),
}


def dim(spark: SparkSession, name: str) -> DataFrame:
    """A dimension with an exact size estimate, so the planner may broadcast it by itself."""
    schema, rows = _TABLES[name]
    columns = dict(zip(schema.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema=schema)


def dim_sql(name: str) -> str:
    """The same rows as a SELECT over typed SQL values."""
    schema, rows = _TABLES[name]
    sql_type = {DoubleType(): "DOUBLE", IntegerType(): "INTEGER", BooleanType(): "BOOLEAN"}

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    columns = ", ".join(
        f"CAST({f.name} AS {sql_type.get(f.dataType, 'VARCHAR')}) AS {f.name}" for f in schema.fields
    )
    return f"SELECT {columns} FROM (VALUES {values}) v({', '.join(schema.names)})"
