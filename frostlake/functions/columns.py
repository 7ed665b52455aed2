"""Column expressions shared by the layers.

Everything here builds Catalyst expressions, so it stays inside whole-stage
codegen. The ANSI mode of Spark 4 is on by default; every conversion of raw
text therefore goes through ``try_cast`` (null on failure, never an error that
kills a job over one malformed reading).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z: the span a
# formatted timestamp can hold. Outside it the reading has no time (null).
MIN_EPOCH_SECONDS = -62135596800
MAX_EPOCH_SECONDS = 253402300799


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: ColumnOrName) -> Column:
    """Text to double; malformed text becomes null instead of failing."""
    return _col(c).try_cast("double")


def round2(c: ColumnOrName, scale: int = 2) -> Column:
    """Half-up rounding that does not depend on binary noise.

    The value is first fixed to six decimals, then rounded half-up. Native
    ``round`` on a double rounds the binary value, so a reading such as
    ``1.005`` (stored as 1.00499999...) lands on different sides in different
    engines and summation orders. Values that do not fit DECIMAL(18,6)
    (|x| >= 1e12), NaN and infinities fall back to native rounding.
    """
    x = _col(c)
    return F.coalesce(F.round(x.try_cast("decimal(18,6)"), scale).cast("double"), F.round(x, scale))


def round_native(c: ColumnOrName, scale: int = 2) -> Column:
    """Spark's own HALF_UP ``round`` on the double, as literally written."""
    return F.round(_col(c), scale)


def rounder(mode: str) -> Callable[[Column], Column]:
    if mode == "round2":
        return round2
    if mode == "native":
        return round_native
    raise ValueError(f"unknown rounding mode {mode!r}; use 'round2' or 'native'")


def epoch_ms_to_seconds(c: ColumnOrName) -> Column:
    """Epoch-milliseconds text to whole epoch seconds (truncated toward zero).

    Null when the text is not a number or the instant falls outside years
    1..9999.
    """
    secs = (to_double(c) / F.lit(1000.0)).try_cast("bigint")
    return F.when(secs.between(MIN_EPOCH_SECONDS, MAX_EPOCH_SECONDS), secs)


def seconds_to_timestamp(secs: ColumnOrName) -> Column:
    """Epoch seconds to a TIMESTAMP (an instant, independent of time zone)."""
    return F.timestamp_seconds(_col(secs))


def seconds_to_utc_wall_clock(secs: ColumnOrName, time_zone: str = "UTC") -> Column:
    """Epoch seconds to the wall clock (TIMESTAMP_NTZ) of ``time_zone``.

    Built without the session time zone, so date and hour derived from it do
    not change with ``spark.sql.session.timeZone``.
    """
    utc = F.timestamp_add("SECOND", _col(secs), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if time_zone.upper() in ("UTC", "Z", "+00:00", "ETC/UTC", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN to null (what a JSON consumer needs); other values unchanged."""
    x = _col(c)
    return F.when(~F.isnan(x), x)
