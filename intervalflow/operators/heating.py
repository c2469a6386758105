"""Heating day reports: one parse, three flattenings (P16, F2-F4, J3, P9, U1/U2), period
filter (F7), device x day grid (J6, F9).

A day report is parsed once with ``from_json`` and each array is exploded from the same
parsed column (R5: no second scan).  The humidity lookup (J3) stays inside the row: the
humidity points of the same report are filtered by time stamp and the last one wins, so
no join or shuffle is needed and duplicate stamps resolve like a dict update.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timefns import interval_minutes, to_utc, ntz_lit


CORRUPT = "_corrupt_record"


def parse_day_reports(reports: DataFrame, text_col: str = "value") -> DataFrame:
    """Parse landed day-report JSON into column ``rep``.

    Malformed text keeps its raw value in ``rep._corrupt_record`` (Spark's permissive mode),
    so it can be quarantined; its arrays are NULL and yield no rows."""
    keep = [c for c in reports.columns if c != text_col]
    schema = T.StructType(schemas.DAY_REPORT.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    rep = F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return reports.select(*keep, rep.alias("rep"))


def unparsable_reports(parsed: DataFrame) -> DataFrame:
    """S9 quarantine: reports whose JSON did not parse at all ("warn and continue").

    Spark also flags a report with one ill-typed point as corrupt while parsing the rest; such
    a report is kept (the bad point is dropped by the flatteners), as in the reference."""
    nothing = F.col("rep.callForHeat").isNull() & F.col("rep.measuredData").isNull() & F.col("rep.settings").isNull()
    bad = parsed.filter(F.col("rep").isNull() | (F.col(f"rep.{CORRUPT}").isNotNull() & nothing))
    return bad.withColumn("value", F.col(f"rep.{CORRUPT}")).drop("rep")


def trv_devices(devices: DataFrame, type_col: str = "device_type") -> DataFrame:
    """only TRV devices take part in heating loads."""
    return devices.filter(F.col(type_col) == "trv")


def _record(kind, sensor, ts, to, demand, temp, hum):
    """Uniform record struct so the three arrays of a report can be concatenated."""
    ts, to, demand, temp, hum = [F.lit(None) if v is None else v for v in (ts, to, demand, temp, hum)]
    return F.struct(F.lit(kind).alias("record_kind"), F.lit(sensor).cast("string").alias("sensor_type"),
                    ts.cast("string").alias("ts_raw"), to.cast("string").alias("to_raw"),
                    demand.cast("string").alias("heat_demand"), temp.cast("double").alias("temperature"),
                    hum.cast("double").alias("humidity"))


_NULL = None


def _demand_array():
    """NULL elements and ``NONE`` skipped; a missing value is kept (NULL demand)."""
    arr = F.coalesce(F.col("rep.callForHeat.dataIntervals"), F.array())
    kept = F.filter(arr, lambda i: i.isNotNull() & ~i["value"].eqNullSafe("NONE"))
    return F.transform(kept, lambda i: _record("demand", None, i["from"], i["to"], i["value"], _NULL, _NULL))


def _inside_array():
    """F4 + J3: inside points with a time stamp and numeric celsius; humidity of the same
    report and stamp, last one wins."""
    hum = F.filter(F.coalesce(F.col("rep.measuredData.humidity.dataPoints"), F.array()),
                   lambda h: h.isNotNull() & h["value"].isNotNull() & h["timestamp"].isNotNull() & (h["timestamp"] != ""))
    pts = F.filter(F.coalesce(F.col("rep.measuredData.insideTemperature.dataPoints"), F.array()),
                   lambda p: p.isNotNull() & p["timestamp"].isNotNull() & (p["timestamp"] != "")
                   & p["value"]["celsius"].isNotNull())

    def rec(p):
        match = F.try_element_at(F.filter(hum, lambda h: h["timestamp"] == p["timestamp"]), F.lit(-1))
        return _record("temperature", "inside", p["timestamp"], _NULL, _NULL, p["value"]["celsius"], match["value"])
    return F.transform(pts, rec)


def _target_array():
    """target settings kept iff power ON, ``from`` non-empty, celsius numeric."""
    arr = F.filter(F.coalesce(F.col("rep.settings.dataIntervals"), F.array()),
                   lambda s: s.isNotNull() & (s["value"]["power"] == "ON") & s["from"].isNotNull() & (s["from"] != "")
                   & s["value"]["temperature"]["celsius"].isNotNull())
    return F.transform(arr, lambda s: _record("temperature", "target", s["from"], _NULL, _NULL,
                                              s["value"]["temperature"]["celsius"], _NULL))


def _explode_records(parsed: DataFrame, arrays, device_col: str, zone_col: str) -> DataFrame:
    rec = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    return parsed.select(F.col(device_col).alias("_device"), F.col(zone_col).alias("_zone"),
                         F.explode(rec).alias("r")).select("_device", "_zone", "r.*")


def _demand_cols(r: DataFrame, keep_invalid: bool) -> DataFrame:
    f, t = F.col("ts_raw"), F.col("to_raw")
    both = f.isNotNull() & (f != "") & t.isNotNull() & (t != "")
    bad_end = both & (to_utc(f).isNull() | to_utc(t).isNull())
    out = r.filter(~bad_end).select(
        F.col("_device").alias("trv_id"), F.col("_zone").alias("zone_id"), F.lit(True).alias("requested"),
        "heat_demand", to_utc(f).alias("timestamp"), interval_minutes(f, t).alias("duration_minutes"))
    out = out.withColumn("valid", F.col("timestamp").isNotNull())
    return out if keep_invalid else out.filter("valid").drop("valid")


def _temperature_cols(r: DataFrame) -> DataFrame:
    return r.select(F.col("_device").alias("device_id"), F.col("_zone").alias("zone_id"), "temperature",
                    to_utc("ts_raw").alias("timestamp"), "sensor_type", "humidity") \
            .filter(F.col("timestamp").isNotNull())


def demand_events(parsed: DataFrame, device_col: str = "device_id", zone_col: str = "zone_id",
                  keep_invalid: bool = False) -> DataFrame:
    """E8 rows from ``callForHeat.dataIntervals``.

    P9: duration in whole minutes when both ends are present; an end that is present but
    does not parse drops the event.  Rows without a usable start time (X14) are flagged
    ``valid = false`` and removed unless ``keep_invalid`` (quarantine).
    """
    return _demand_cols(_explode_records(parsed, [_demand_array()], device_col, zone_col), keep_invalid)


def temperature_records(parsed: DataFrame, device_col: str = "device_id", zone_col: str = "zone_id") -> DataFrame:
    """E9 rows: inside points (F4) with humidity (J3), then target settings (F3); one explode."""
    return _temperature_cols(_explode_records(parsed, [_inside_array(), _target_array()], device_col, zone_col))


def heating_records(parsed: DataFrame, device_col: str = "device_id", zone_col: str = "zone_id", keep_invalid: bool = False) -> DataFrame:
    """U1 in one pass (R5): demand and temperature rows of every report from a single
    explode, tagged ``record_kind``, with ``date`` from the UTC time stamp.  Records whose time does not parse (X14) go unless ``keep_invalid``."""
    r = _explode_records(parsed, [_demand_array(), _inside_array(), _target_array()], device_col, zone_col)
    f, t = F.col("ts_raw"), F.col("to_raw")
    is_d = F.col("record_kind") == "demand"
    bad_end = is_d & f.isNotNull() & (f != "") & t.isNotNull() & (t != "") & (to_utc(f).isNull() | to_utc(t).isNull())
    ts = to_utc(f)
    out = r.filter(~bad_end & (ts.isNotNull() | F.lit(keep_invalid))).select(
        "record_kind",
        F.when(is_d, F.col("_device")).alias("trv_id"), F.col("_zone").alias("zone_id"),
        F.when(is_d, F.lit(True)).alias("requested"), "heat_demand", ts.alias("timestamp"),
        F.when(is_d, interval_minutes(f, t)).alias("duration_minutes"),
        F.when(~is_d, F.col("_device")).alias("device_id"), "temperature", "sensor_type", "humidity")
    return out.withColumn("date", F.to_date("timestamp"))


def in_period(df: DataFrame, start: dt.datetime, end: dt.datetime, ts_col: str = "timestamp") -> DataFrame:
    """``start <= ts <= end`` (both inclusive)."""
    lo, hi = ntz_lit(start), ntz_lit(end)
    return df.filter(F.col(ts_col).between(lo, hi))


def device_day_grid(devices: DataFrame, start: dt.date, end: dt.date, device_cols: Sequence[str] = ("device_id",),
                    device_start_col: str | None = None) -> DataFrame:
    """J6 + F9: every (device, day) in ``[start, end]`` inclusive, skipping days before the
    device's own start day.  Generated per device row with ``sequence`` (no cross join)."""
    lo = F.lit(start)
    if device_start_col:
        lo = F.greatest(lo, F.coalesce(F.to_date(device_start_col), lo))
    hi = F.lit(end)
    # sequence() counts down when lo > hi; an empty range must give no rows
    days = F.filter(F.sequence(lo, F.greatest(lo, hi)), lambda d: d <= hi)
    return devices.select(*device_cols, F.explode(days).alias("date"))


def days_to_fetch(grid: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid cells whose report has not landed yet (``left_anti``)."""
    return grid.join(landed.select(*keys).distinct(), list(keys), "left_anti")
