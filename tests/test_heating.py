"""Day-report flattening: every edge row of FIXTURES.md part 1."""

import json

from conftest import ts
from pyspark.sql import functions as F
from intervalflow.operators import heating as H

REPORT = {
    "callForHeat": {"dataIntervals": [
        None,
        {"from": "2024-01-01T06:00:00Z", "to": "2024-01-01T06:30:00Z", "value": "LOW"},
        {"from": "2024-01-01T07:00:00Z", "to": "2024-01-01T07:15:00Z", "value": "NONE"},
        {"from": "2024-01-01T08:00:00Z", "to": "2024-01-01T08:45:30Z"},
        {"from": "2024-01-01T09:00:00Z", "value": "HIGH"},
        {"from": "2024-01-01T10:00:00Z", "to": "not-a-time", "value": "MEDIUM"},
    ]},
    "measuredData": {
        "insideTemperature": {"dataPoints": [
            {"timestamp": "2024-01-01T06:00:00Z", "value": {"celsius": 19.2}},
            {"timestamp": "2024-01-01T06:05:00Z", "value": {"celsius": "bad"}},
            {"timestamp": "", "value": {"celsius": 20.0}},
            {"timestamp": "2024-01-01T06:10:00Z", "value": {"celsius": 19.5}},
        ]},
        "humidity": {"dataPoints": [
            {"timestamp": "2024-01-01T06:00:00Z", "value": 40.0},
            {"timestamp": "2024-01-01T06:00:00Z", "value": 41.0},
        ]},
    },
    "settings": {"dataIntervals": [
        {"from": "2024-01-01T06:00:00Z", "value": {"power": "ON", "temperature": {"celsius": 21.0}}},
        {"from": "2024-01-01T07:00:00Z", "value": {"power": "OFF", "temperature": {"celsius": 18.0}}},
        {"from": "", "value": {"power": "ON", "temperature": {"celsius": 18.0}}},
    ]},
}


def parsed(spark):
    df = spark.createDataFrame([("d1", "z1", json.dumps(REPORT)), ("d2", "z2", "{not json")],
                               "device_id string, zone_id string, value string")
    return H.parse_day_reports(df)


def test_demand_rules(spark):
    rows = H.demand_events(parsed(spark)).orderBy("timestamp").collect()
    got = [(r.heat_demand, r.timestamp, r.duration_minutes, r.requested) for r in rows]
    assert got == [("LOW", ts("2024-01-01 06:00:00"), 30, True),
                   (None, ts("2024-01-01 08:00:00"), 45, True),   # missing value kept
                   ("HIGH", ts("2024-01-01 09:00:00"), None, True)]  # missing `to` -> NULL duration


def test_temperature_rules(spark):
    rows = H.temperature_records(parsed(spark)).orderBy("sensor_type", "timestamp").collect()
    got = [(r.sensor_type, r.timestamp, r.temperature, r.humidity) for r in rows]
    assert got == [("inside", ts("2024-01-01 06:00:00"), 19.2, 41.0),   # duplicate stamp: last wins
                   ("inside", ts("2024-01-01 06:10:00"), 19.5, None),
                   ("target", ts("2024-01-01 06:00:00"), 21.0, None)]


def test_unified_single_pass_matches_parts(spark):
    p = parsed(spark)
    u = H.heating_records(p)
    assert u.filter("record_kind = 'demand'").count() == H.demand_events(p).count()
    assert u.filter("record_kind = 'temperature'").count() == H.temperature_records(p).count()
    assert set(u.columns) >= {"trv_id", "device_id", "zone_id", "timestamp", "date", "record_kind"}


def test_period_is_inclusive(spark):
    t = H.temperature_records(parsed(spark))
    assert H.in_period(t, ts("2024-01-01 06:00:00"), ts("2024-01-01 06:10:00")).count() == 3


def test_device_day_grid_skips_days_before_start(spark):
    import datetime as dt
    devices = spark.createDataFrame([("a", None), ("b", dt.datetime(2024, 1, 3, 12))], "device_id string, start timestamp_ntz")
    g = H.device_day_grid(devices, dt.date(2024, 1, 1), dt.date(2024, 1, 3), device_start_col="start")
    got = sorted((r.device_id, r.date.day) for r in g.collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("b", 3)]
    late = spark.createDataFrame([("c", dt.datetime(2024, 2, 1))], "device_id string, start timestamp_ntz")
    assert H.device_day_grid(late, dt.date(2024, 1, 1), dt.date(2024, 1, 3), device_start_col="start").count() == 0


def test_landed_report_files_and_quarantine(spark, tmp_path):
    from intervalflow.sources.documents import read_text_documents
    (tmp_path / "zone1-2024-01-01.json").write_text(json.dumps(REPORT, indent=2))
    (tmp_path / "zone2-2024-01-01.json").write_text("{broken")
    docs = read_text_documents(spark, str(tmp_path))
    docs = docs.withColumn("device_id", F.regexp_extract("source_file", r"(zone[0-9]+)", 1)) \
               .withColumn("zone_id", F.col("device_id"))
    parsed = H.parse_day_reports(docs)
    assert H.demand_events(parsed).count() == 3
    assert [r.device_id for r in H.unparsable_reports(parsed).collect()] == ["zone2"]
