"""Time normalisation.

All instants are carried as TIMESTAMP_NTZ in UTC.  Arithmetic goes through
``timestampdiff``/``timestampadd`` on NTZ values so no session time zone is
involved (``date_trunc`` would return a session-zone TIMESTAMP).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



# An offset follows a time part; the last field of a plain date is none.
_OFFSET_RE = r"[0-9]{1,2}:[0-9]{2}.*([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)$|T[0-9]{2}([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)$"


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime / ISO string, without any time zone.

    ``F.lit(datetime)`` builds a session-zone TIMESTAMP, whose cast to NTZ shifts the value
    when the session zone is not UTC; going through the text form avoids that."""
    if value is None:
        return F.lit(None).cast(T.TimestampNTZType())
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if hasattr(value, "strftime") else str(value)
    return F.lit(text).cast(T.TimestampNTZType())


def epoch_ntz() -> Column:
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ (built lazily: columns need an active session)."""
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of an NTZ value, from its date and time fields.

    Built from fields so no session time zone is involved (``timestamp_diff`` casts NTZ to a
    session-zone TIMESTAMP, which shifts wall-clock times that fall in a DST gap)."""
    c = _c(ts)
    return (F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000 + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))


def micros_between(start, end) -> Column:
    """Microseconds from ``start`` to ``end`` (both NTZ)."""
    return epoch_micros(end) - epoch_micros(start)


def plus_micros(ts, micros) -> Column:
    return F.timestamp_add("MICROSECOND", _c(micros) if not isinstance(micros, int) else F.lit(micros), _c(ts))


def floor_time(ts, seconds: int) -> Column:
    """Floor an NTZ instant to a multiple of ``seconds`` since the epoch (30 min -> half hour)."""
    step = int(seconds) * 1_000_000
    us = epoch_micros(ts)
    return F.timestamp_add("MICROSECOND", us - F.pmod(us, F.lit(step)), epoch_ntz())


def to_utc(c, dtype: T.DataType | None = None) -> Column:
    """ISO string (``Z``, ``+hh:mm`` or naive) or timestamp -> UTC TIMESTAMP_NTZ.

    Naive values are UTC.  Unparsable strings give NULL (``try_`` functions), never an error.
    """
    col = _c(c)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch_ntz())
    s = F.trim(col.cast("string"))
    # Naive strings get a 'Z' (naive = UTC), so every string carries its zone; Spark's cast
    # parser (try_cast) then reads Z or +hh:mm without raising and without the session zone.
    # The regex guard keeps parses from failing, which is the slow path.
    zone = F.when(F.length(s) <= 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z"))     # a plain date is its midnight
    with_zone = F.when(s.rlike(_OFFSET_RE), s).otherwise(F.concat(F.nullif(s, F.lit("")), zone))
    instant = with_zone.try_cast("timestamp")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch_ntz())


def to_utc_col(df, name: str) -> Column:
    """:func:`to_utc` using the column's declared type in ``df``."""
    return to_utc(name, df.schema[name].dataType)


def utc_date(ts) -> Column:
    """UTC calendar date of an NTZ instant (00:00 belongs to the new day)."""
    return F.to_date(_c(ts))


def format_zulu(ts) -> Column:
    """Second-precision ``yyyy-MM-ddTHH:mm:ssZ`` (from the NTZ text form: no session zone)."""
    return F.concat(F.regexp_replace(F.substring(_c(ts).cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def interval_minutes(from_s, to_s) -> Column:
    """Whole minutes between two ISO strings, truncated toward zero.

    NULL when either end is missing or empty.  Malformed values also yield NULL;
    callers that must drop such events test :func:`to_utc` themselves.
    """
    f, t = _c(from_s), _c(to_s)
    present = f.isNotNull() & (f != "") & t.isNotNull() & (t != "")
    us = micros_between(to_utc(f), to_utc(t))
    mins = F.when(us >= 0, F.floor(us / F.lit(60_000_000))).otherwise(F.ceil(us / F.lit(60_000_000)))
    return F.when(present, mins.cast("int"))


def safe_horizon(now, lag_minutes: int = 60, step_seconds: int = 1800) -> Column:
    """Last complete interval boundary at least ``lag_minutes`` before ``now``."""
    return floor_time(plus_micros(_c(now), -int(lag_minutes) * 60_000_000), step_seconds)
