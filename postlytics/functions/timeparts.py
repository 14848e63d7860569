"""Time column functions.

Wall-clock values stay in TIMESTAMP_NTZ so that nothing depends on the
session time zone; the local time is obtained with `convert_timezone`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlytics import config as C

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros_of_ntz(ts: Column | str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ read as UTC, from zone-free fields only.

    (`timestampdiff` would cast NTZ to a zoned TIMESTAMP first, which moves wall
    clocks that fall into a daylight-saving gap of the session zone.)
    """
    t = _col(ts)
    day = F.unix_date(F.to_date(t)).cast("bigint")
    second = F.date_part(F.lit("SECOND"), t)          # decimal(8,6): seconds with micros
    return (day * F.lit(86_400_000_000) + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(t).cast("bigint") * F.lit(60_000_000)
            + (second * F.lit(1_000_000)).cast("bigint"))


def epoch_ms_of_ntz(ts: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC (floor; no session zone involved)."""
    return F.floor(epoch_micros_of_ntz(ts) / F.lit(1000)).cast("bigint")


def epoch_ms_to_seconds(ms_text: Column | str) -> Column:
    """Text of epoch milliseconds -> whole seconds, cut toward zero; bad text -> null."""
    return (_col(ms_text).try_cast("bigint") / F.lit(1000)).cast("bigint")


def ntz_from_epoch_seconds(seconds: Column | str) -> Column:
    """Seconds since the epoch -> TIMESTAMP_NTZ wall clock in UTC."""
    return F.timestamp_add("SECOND", _col(seconds), F.expr(_EPOCH_NTZ))


def to_local_time(seconds: Column | str, zone: str = C.LOCAL_TIME_ZONE) -> Column:
    """Seconds since the epoch -> local wall clock of `zone` (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz_from_epoch_seconds(seconds))


def date_part_columns(created_at: Column | str, zone: str = C.LOCAL_TIME_ZONE) -> dict[str, Column]:
    local = to_local_time(epoch_ms_to_seconds(created_at), zone)
    return {
        "created_at_date": local,
        "year": F.year(local),
        "month": F.month(local),
        "dayofmonth": F.dayofmonth(local),
    }


def parse_timestamp_text(text: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> TIMESTAMP_NTZ (null when it does not parse)."""
    return F.try_to_timestamp(_col(text), F.lit(C.TIMESTAMP_TEXT_FORMAT)).cast("timestamp_ntz")


def epoch_seconds_of_ntz(ts: Column | str) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ read as UTC (floor)."""
    return F.floor(epoch_micros_of_ntz(ts) / F.lit(1_000_000)).cast("bigint")
