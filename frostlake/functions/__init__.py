"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from frostlake.functions.columns import (
    epoch_ms_to_seconds,
    nan_to_null,
    round2,
    round_native,
    rounder,
    seconds_to_timestamp,
    seconds_to_utc_wall_clock,
    to_double,
)

__all__ = [
    "epoch_ms_to_seconds",
    "nan_to_null",
    "round2",
    "round_native",
    "rounder",
    "seconds_to_timestamp",
    "seconds_to_utc_wall_clock",
    "to_double",
]
