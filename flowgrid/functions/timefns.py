"""Wall-clock helpers on TIMESTAMP_NTZ.

Series are positioned by integers - hours or days since 1970-01-01 - so that RANGE frames, lags and chunk
arithmetic are plain integer work, and no value ever passes through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_date() -> Column:
    return F.lit("1970-01-01").cast("date")


def day_pos(ts: Column | str) -> Column:
    """Days since 1970-01-01 of a date or timestamp."""
    return F.datediff(F.col(ts) if isinstance(ts, str) else ts, _epoch_date())


def hour_pos(ts: Column | str) -> Column:
    """Hours since 1970-01-01, floored to the hour."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return day_pos(ts) * 24 + F.hour(ts)


def hour_ts(pos: Column | str) -> Column:
    """Inverse of :func:`hour_pos`: the start of the hour as TIMESTAMP_NTZ."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), pos)


def day_date(pos: Column | str) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.date_add(_epoch_date(), pos.cast("int"))


def day_of_hour(pos: Column | str) -> Column:
    """Day position of an hour position (floor division, also before 1970)."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(pos / 24).cast("int")


def hour_of_day(pos: Column | str) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.pmod(pos, F.lit(24)).cast("int")


def weekday_of(pos: Column | str) -> Column:
    """Monday = 0 weekday of a day position (1970-01-01 was a Thursday)."""
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.pmod(pos + 3, F.lit(7)).cast("int")


def to_local(ts_utc: Column | str, zone: str) -> Column:
    """UTC wall clock -> local naive wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts_utc) if isinstance(ts_utc, str) else ts_utc)


def fractional_days(ts: Column | str, origin: str) -> Column:
    """Days between ``origin`` (a date literal) and ``ts`` as a fraction."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.datediff(ts, F.lit(origin).cast("date"))
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return whole + seconds / F.lit(86400.0)


def utc_instant(ts: str) -> Column:
    """A naive timestamp read as UTC, whatever the session zone is: streaming event time must be an instant."""
    c = F.col(ts)
    whole = (day_pos(c).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60) * 1000000
    return F.timestamp_micros(whole + (F.extract(F.lit("SECOND"), c) * 1000000).cast("bigint"))
