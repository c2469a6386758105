"""Range and extreme-value scans over a reading table.

When the input carries the lake's ``date`` partition column (UTC date of
``interval_end``), a matching ``date`` bound is added so Spark prunes partitions (R1):
an interval starting at ``t`` ends at ``t + 30 min``, so its ``date`` lies in
``[to_date(start + 30m), to_date(end + 30m)]``.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import ntz_lit

HALF_HOUR = dt.timedelta(minutes=30)
BASELINE = dt.datetime(2015, 1, 1)
METER = ("kind", "mpan_mprn", "serial")


def _ts(v) -> F.Column:
    return ntz_lit(v)


def consumption_range(df: DataFrame, start: dt.datetime, end: dt.datetime,
                      ts_col: str = "interval_start", date_col: str = "date",
                      step: dt.timedelta = HALF_HOUR, ordered: bool = True,
                      meter: tuple[str, str, str] | None = None, buckets: int | None = None) -> DataFrame:
    """Rows with ``start <= ts < end`` (half-open), ascending by time, then meter.

    ``meter`` is (kind, id, serial).  On a lake with ``meter_bucket`` and ``buckets`` the meter's bucket is a constant, so
    only its partitions are read."""
    cond = (F.col(ts_col) >= _ts(start)) & (F.col(ts_col) < _ts(end))
    if date_col in df.columns:
        cond = cond & F.col(date_col).between(F.lit((start + step).date()), F.lit((end + step).date()))
    keys = [c for c in METER if c in df.columns]
    if meter:
        for c, v in zip(METER, meter):
            cond = cond & (F.col(c) == v)
        if buckets and "meter_bucket" in df.columns:
            cond = cond & (F.col("meter_bucket") == F.pmod(F.xxhash64(*map(F.lit, meter)), F.lit(buckets)).cast("int"))
    out = df.filter(cond)
    return out.orderBy(ts_col, *keys) if ordered else out


def extremes(df: DataFrame, by: Sequence[str], ts_col: str = "interval_start",
             value_cols: Sequence[str] = ("consumption",), baseline: dt.datetime | None = None) -> DataFrame:
    """Earliest and latest record per group (``min_by``/``max_by``), and the
    earliest at or after ``baseline``.  Replaces limit-1 lookups with one aggregation."""
    aggs = [F.min(ts_col).alias("earliest_start"), F.max(ts_col).alias("latest_start")]
    for v in value_cols:
        aggs += [F.min_by(v, ts_col).alias(f"earliest_{v}"), F.max_by(v, ts_col).alias(f"latest_{v}")]
    base = baseline or BASELINE
    aggs.append(F.min(F.when(F.col(ts_col) >= _ts(base), F.col(ts_col))).alias("earliest_since_baseline"))
    return df.groupBy(*by).agg(*aggs)


def head(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """O3: first ``n`` rows (a top-k: Spark keeps a bounded heap per task)."""
    return (df.orderBy(*order) if order else df).limit(n)
