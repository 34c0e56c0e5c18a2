"""Small builders shared by the tests."""

from __future__ import annotations

import datetime as dt

from gritstone.schemas import TAG_READING

START = dt.datetime(2026, 8, 27)


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def reading(tag_id, seconds, value=None, text=None, quality="GOOD", seq=None):
    ts = at(seconds)
    seq = int(seconds * 1000) if seq is None else seq
    return (f"{tag_id}/{seconds}/{seq}", tag_id, ts, value, text, quality, "u", seq, "test", ts)


def readings(spark, rows):
    return spark.createDataFrame(rows, TAG_READING)


def tag(tag_id, asset_type="conveyor", measure="mass_flow", nominal=None, limits=(None,) * 4, enum=None):
    asset_id, code = tag_id.rsplit("-", 1)
    lo_lo, lo, hi, hi_hi = limits
    return (
        tag_id, asset_id, f"name {asset_id}", asset_type, asset_id.split("-")[0], "area", measure,
        code[:2], "u", "discrete" if enum else "analog", 1.0, nominal, lo_lo, lo, hi, hi_hi, True,
        True, enum, "text",
    )


def rows_by(df, *keys):
    """Rows as a dict keyed by the given columns."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
