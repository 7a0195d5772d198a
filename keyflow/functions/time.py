"""Event-time columns.

Records carry time twice: ``ms`` (BIGINT epoch milliseconds, the unit every
window bound is reported in) and ``ts`` (TIMESTAMP built from ``ms``, the
column ``window``/``session_window``/``withWatermark`` need). Both are derived
without the session time zone, so results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ms(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Epoch milliseconds (floored) of a TIMESTAMP or TIMESTAMP_NTZ column.

    NTZ goes through an interval difference, which is plain arithmetic on
    the wall-clock value (no zone, no DST), then floors to the millisecond.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    interval = (c - F.expr(_NTZ_EPOCH)).cast("interval second").cast("decimal(18,6)")
    return F.floor(interval * F.lit(1000)).cast("bigint")


def event_time(ms: Column | str) -> Column:
    """TIMESTAMP instant for epoch milliseconds (zone-independent)."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(c)


def floor_div(col: Column | str, n: int) -> Column:
    """Exact integer floor division of a BIGINT by a positive constant."""
    c = F.col(col) if isinstance(col, str) else col
    d = F.lit(int(n)).cast("bigint")
    c = c.cast("bigint")
    # integral division (a double would round above 2^53) truncates towards zero
    return F.call_function("div", c, d) - F.when(c % d < 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def ms_literal(duration_ms: int) -> Column:
    return F.lit(int(duration_ms)).cast("bigint")


def iso_instant(ms: Column | str) -> Column:
    """``Instant.toString`` text of epoch ms: ``2024-01-01T00:00:07.179Z``.

    The fraction is printed only when non-zero (three digits, as the
    milliseconds are all there is).
    """
    c = F.col(ms) if isinstance(ms, str) else ms
    wall = F.expr(_NTZ_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.floor(c / 1000)).cast("decimal(20,6)"))
    frac = F.pmod(c, F.lit(1000))
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(frac.cast("string"), 3, "0"))),
        F.lit("Z"),
    )
