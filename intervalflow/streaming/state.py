"""High-water state as a table ``(source_key, last_interval)`` (E13) and the rules around it:
high-water marks (A2, A3), newer-than-state filter (F8, J4), resume windows (ST2-ST4, A8),
monotone state advance (ST6), JSON-map import (P14)."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import floor_time, plus_micros, to_utc, ntz_lit

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
DAY_US = 86_400 * SECOND_US
# Resume overlap (30 min + 1 s), earliest allowed start, first-run window, heating look-back.
RESUME_OVERLAP_US = 30 * MINUTE_US + SECOND_US
EARLIEST_ALLOWED = dt.datetime(2015, 1, 1)
BOOTSTRAP_DAYS = 7
HEATING_LOOKBACK_US = 60 * MINUTE_US


def _ts(v) -> Column:
    return ntz_lit(v)


def high_water(df: DataFrame, keys: Sequence[str], ts_col: str = "interval_start",
               out_col: str = "last_interval") -> DataFrame:
    """A2/A3: max of the parsed instants per key (X4: never a string max).  Unparsable values
    are skipped; keys without any parsable value produce no row (state unchanged)."""
    t = to_utc(ts_col, df.schema[ts_col].dataType)
    return df.select(*keys, t.alias("_t")).filter(F.col("_t").isNotNull()) \
             .groupBy(*keys).agg(F.max("_t").alias(out_col))


def newer_than_state(df: DataFrame, state: DataFrame, keys: Sequence[str], ts_col: str = "timestamp",
                     state_col: str = "last_interval", keep: str = "newer") -> DataFrame:
    """F8 + J4: rows strictly newer than the key's state; no state keeps everything.

    ``keep='late'`` returns the complement (ST7: rows at or before the state, discarded).
    The state is one row per key: the join is a plain equi left join, broadcast by Spark
    only when its measured size allows.
    """
    s = state.select(*keys, F.col(state_col).alias("_last"))
    j = df.join(s, list(keys), "left")
    newer = F.col("_last").isNull() | (F.col(ts_col) > F.col("_last"))
    return j.filter(newer if keep == "newer" else ~newer).drop("_last")


def advance_state(state: DataFrame, batch_marks: DataFrame, keys: Sequence[str],
                  col: str = "last_interval") -> DataFrame:
    """ST6: new state = greatest(old, batch high-water) per key, so replays never move it back."""
    b = batch_marks.select(*keys, F.col(col).alias("_new"))
    j = state.select(*keys, F.col(col).alias("_old")).join(b, list(keys), "full_outer")
    return j.select(*keys, F.greatest("_old", "_new").alias(col))


def resume_start(state_col: str, now: dt.datetime, bootstrap_days: int = BOOTSTRAP_DAYS) -> Column:
    """ST2/ST3: ``greatest(last - 30m1s, 2015-01-01)``; no state -> ``now - bootstrap_days``."""
    overlap = F.greatest(plus_micros(state_col, -RESUME_OVERLAP_US), _ts(EARLIEST_ALLOWED))
    return F.when(F.col(state_col).isNotNull(), overlap).otherwise(
        _ts(now - dt.timedelta(days=bootstrap_days)))


def heating_resume_start(state_col: str, now: dt.datetime, lookback_hours: int = 1) -> Column:
    """ST4: midnight (UTC) of the last processed day; no state -> ``now - 1 h``."""
    return F.when(F.col(state_col).isNotNull(), floor_time(state_col, 86_400)).otherwise(
        _ts(now - dt.timedelta(hours=lookback_hours)))


def earliest_resume(starts: DataFrame, col: str = "resume_start") -> DataFrame:
    """The earliest resume point over devices (one global min, partial per task)."""
    return starts.agg(F.min(col).alias("earliest_resume"))


def import_state_json(df: DataFrame, text_col: str = "value") -> DataFrame:
    """An existing ``{source_key: iso-string}`` JSON map -> state rows.

    Aware strings are normalised to UTC, naive ones are taken as UTC, unreadable ones NULL.
    """
    m = F.from_json(F.col(text_col), "MAP<STRING,STRING>")
    e = df.select(F.explode(m).alias("source_key", "_raw"))
    return e.select("source_key", to_utc("_raw").alias("last_interval"))


def export_state_value(ts_col: str) -> Column:
    """P14 (write side): UTC instant as ``yyyy-MM-ddTHH:mm:ssZ``-style ISO string."""
    from ..functions.timefns import format_zulu
    return format_zulu(ts_col)
