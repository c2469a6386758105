"""Explicit schemas of the landed documents (E5-E7, E11, E12); the tables' schemas are with their sinks.

Timestamps are TIMESTAMP_NTZ holding UTC wall-clock time, so results never depend
on the session time zone.  Landed JSON keeps time stamps as STRING until they are
normalised by :func:`intervalflow.functions.timefns.to_utc`.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# E5 account document
_AGREEMENT = _st(("tariff_code", S), ("tariff", S), ("valid_from", S), ("valid_to", S))
_METER_REF = _st(("serial_number", S), ("serial", S))
_E_POINT = _st(("mpan", S), ("mpan_number", S), ("mpan_mprn", S),
               ("meters", T.ArrayType(_METER_REF)), ("agreements", T.ArrayType(_AGREEMENT)))
_G_POINT = _st(("mprn", S), ("mpan_mprn", S), ("mprn_number", S),
               ("meters", T.ArrayType(_METER_REF)), ("agreements", T.ArrayType(_AGREEMENT)))
ACCOUNT = _st(("number", S), ("electricity_meter_points", T.ArrayType(_E_POINT)),
              ("gas_meter_points", T.ArrayType(_G_POINT)))


def page_envelope(result_type: T.DataType) -> T.StructType:
    """``{results: [...], next: ...}``."""
    return _st(("results", T.ArrayType(result_type)), ("next", S))


# E7 heating day report (timestamps stay strings, as landed)
_CELSIUS = _st(("celsius", D))
_CALL_INTERVAL = _st(("from", S), ("to", S), ("value", S))
_INSIDE_POINT = _st(("timestamp", S), ("value", _CELSIUS))
_HUMIDITY_POINT = _st(("timestamp", S), ("value", D))
_SETTING = _st(("from", S), ("to", S), ("value", _st(("power", S), ("temperature", _CELSIUS))))
DAY_REPORT = _st(
    ("callForHeat", _st(("dataIntervals", T.ArrayType(_CALL_INTERVAL)))),
    ("measuredData", _st(("insideTemperature", _st(("dataPoints", T.ArrayType(_INSIDE_POINT)))),
                         ("humidity", _st(("dataPoints", T.ArrayType(_HUMIDITY_POINT)))))),
    ("settings", _st(("dataIntervals", T.ArrayType(_SETTING)))),
)

# E11 zones -> devices, E12 homes
ZONE = _st(("id", L), ("name", S), ("type", S))
ZONES = T.ArrayType(ZONE)
HOME = _st(("id", L), ("name", S), ("dateTimeZone", S), ("temperatureUnit", S))
ME = _st(("homes", T.ArrayType(HOME)))

# Meter configuration entry
METER_CONFIG = T.ArrayType(_st(("kind", S), ("mpan_or_mprn", S), ("serial", S), ("tariff_code", S)))
