"""Column expressions shared by the operators. All are built-in, codegen-friendly SQL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Solids specific gravity, status bands, ISO 10816 zone edges, action bands.
SOLIDS_SG = 4.9
MIN_QUALITY_PCT = 80.0
BALANCED_PCT = 2.0
DRIFT_PCT = 5.0
ISO_ZONE_EDGES = (2.8, 7.1, 11.0)
ACT_NOW_PROBABILITY = 0.7
WATCH_PROBABILITY = 0.3
ACT_NOW_TEXT = "Schedule bearing replacement within 2 weeks. Order parts now."
WATCH_TEXT = "Add to the watch list and take spectral readings at the next shutdown."
NO_ACTION_TEXT = "No action. Continue trending."

# Words that carry no meaning in a maintenance question.
STOP_WORDS = [
    "what", "did", "we", "and", "on", "a", "the", "to", "is", "are", "of", "in", "for",
    "with", "how", "why", "it", "that", "this", "was", "were", "has", "have", "been",
]


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of either timestamp type."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_seconds(ts: str | Column) -> Column:
    return micros(ts) / F.lit(1e6)


def whole_seconds(start: str | Column, end: str | Column) -> Column:
    """Elapsed whole seconds, fractions dropped."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL for a zero whole (division by zero raises under ANSI)."""
    return F.try_divide(F.lit(100.0) * part, whole)


def good_only(value: str | Column = "value", quality: str | Column = "quality") -> Column:
    """The value where its quality is GOOD, else NULL, so the row still counts."""
    return F.when(_col(quality) == "GOOD", _col(value))


def slurry_solids(flow_m3h: Column, density_tm3: Column) -> Column:
    """Dry solids t/h of a slurry stream.

    flow * density * mass fraction of solids; density cancels, which leaves a
    form that cannot divide by zero.
    """
    return flow_m3h * F.lit(SOLIDS_SG) * (density_tm3 - 1.0) / F.lit(SOLIDS_SG - 1.0)


def arc_tonnage(method: Column, flow: Column, density: Column) -> Column:
    return (
        F.when(method == "weightometer", flow)
        .when(method == "slurry_flow_density", slurry_solids(flow, density))
    )


def is_solids_arc() -> Column:
    """Water streams and self-loops never enter the balance."""
    return (F.col("stream_type") != "water") & (F.col("from_node_id") != F.col("to_node_id"))


def balance_status(
    role: Column, mass_in: Column, mass_out: Column, imbalance: Column, unmeasured_arcs: Column,
    quality_pct: Column, used_for_inference: Column,
) -> Column:
    """A node closes only if it is a unit, fully measured and not closed by construction.

    Zero inflow leaves the ratio NULL and therefore falls through to ALARM.
    """
    ratio = F.abs(percent(imbalance, mass_in))
    return (
        F.when(role != "unit", "NOT_APPLICABLE")
        .when(
            mass_in.isNull() | mass_out.isNull() | (unmeasured_arcs > 0)
            | (quality_pct < MIN_QUALITY_PCT),
            "INSUFFICIENT_DATA",
        )
        .when(used_for_inference, "ESTIMATED")
        .when(ratio <= BALANCED_PCT, "BALANCED")
        .when(ratio <= DRIFT_PCT, "DRIFT")
        .otherwise("ALARM")
    )


def iso_zone(rms: str | Column) -> Column:
    rms = _col(rms)
    a, b, c = ISO_ZONE_EDGES
    return F.when(rms < a, "A").when(rms < b, "B").when(rms < c, "C").otherwise("D")


def limit_class(value: str | Column = "value") -> Column:
    """limit_trip beyond the trip limits, limit_warn beyond the warning limits, else NULL."""
    v = _col(value)
    return (
        F.when((v > F.col("hi_hi")) | (v < F.col("lo_lo")), "limit_trip")
        .when((v > F.col("hi")) | (v < F.col("lo")), "limit_warn")
    )


def recommended_action(probability: str | Column) -> Column:
    p = _col(probability)
    return (
        F.when(p >= ACT_NOW_PROBABILITY, ACT_NOW_TEXT)
        .when(p >= WATCH_PROBABILITY, WATCH_TEXT)
        .otherwise(NO_ACTION_TEXT)
    )


def alert_message(
    template: Column, tag_id: Column, asset_name: Column, value_text: Column, unit: Column,
    node_id: Column,
) -> Column:
    """Fill the placeholders of a message template that is itself data."""
    message = template
    for name, part in (
        ("tag_id", tag_id), ("asset_name", asset_name), ("value", value_text), ("unit", unit),
        ("node_id", node_id),
    ):
        message = F.replace(message, F.lit("{" + name + "}"), F.coalesce(part, F.lit("")))
    return message


def two_decimals(value: Column) -> Column:
    """The value with two decimals, rounded from its exact binary value; ``?`` for NULL."""
    shown = F.call_function("format_number", value, F.lit("0.00"))
    return F.when(value.isNull(), "?").otherwise(shown)


def words(text: str | Column) -> Column:
    """Lower-case words of three or more letters, repeats kept."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit("([a-z]{3,})"), F.lit(1))


def content_terms(text: str | Column) -> Column:
    """Distinct words in order of appearance without stop words."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.array_distinct(F.array_except(words(text), stop))


def stable_id(*parts: str | Column) -> Column:
    """Repeatable id, so a retried task or a replayed batch produces the same key."""
    return F.sha2(F.concat_ws("|", *[_col(p).cast("string") for p in parts]), 256)


def stable_share(modulus: int, *parts: str | Column) -> Column:
    """A repeatable number in ``[0, modulus)`` from the digest of the parts."""
    return F.conv(F.substring(stable_id(*parts), 1, 8), 16, 10).cast("bigint") % F.lit(modulus)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
