"""Scalar column helpers (all built-in Spark expressions, no UDFs)."""

from clearbid.functions.core import (
    Interval,
    day_floor,
    decode_cells,
    geo_region,
    hour_floor,
    in_range,
    last_full_hour,
    parse_rfc3339,
    split_keywords,
    ts_lit,
)

__all__ = [
    "Interval",
    "day_floor",
    "decode_cells",
    "geo_region",
    "hour_floor",
    "in_range",
    "last_full_hour",
    "parse_rfc3339",
    "split_keywords",
    "ts_lit",
]
