"""High-water state: the reference's boundary tests plus monotone advance and codec."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import ts
from intervalflow.streaming import state as st


def _resume(spark, last):
    df = spark.createDataFrame([(last,)], "last_interval timestamp_ntz")
    return df.select(st.resume_start("last_interval", dt.datetime(2025, 10, 18)).alias("r")).first().r


def test_overlap_resume(spark):
    assert _resume(spark, ts("2025-10-16 23:30:00")) == ts("2025-10-16 22:59:59")


def test_clock_change_resume(spark):
    assert _resume(spark, ts("2025-03-30 01:30:00")) == ts("2025-03-30 00:59:59")


def test_floor_and_first_run(spark):
    assert _resume(spark, ts("2015-01-01 00:10:00")) == ts("2015-01-01 00:00:00")
    assert _resume(spark, None) == ts("2025-10-11 00:00:00")


def test_heating_resume(spark):
    df = spark.createDataFrame([(ts("2024-01-05 17:42:00"),), (None,)], "l timestamp_ntz")
    got = [r[0] for r in df.select(st.heating_resume_start("l", dt.datetime(2024, 1, 6, 12))).collect()]
    assert got == [ts("2024-01-05 00:00:00"), ts("2024-01-06 11:00:00")]


def test_state_advance_is_monotone(spark):
    empty = spark.createDataFrame([], "source_key string, last_interval timestamp_ntz")
    b1 = spark.createDataFrame([("123:ABC", ts("2025-10-17 23:30:00"))], "source_key string, last_interval timestamp_ntz")
    s1 = st.advance_state(empty, b1, ["source_key"])
    assert s1.first().last_interval == ts("2025-10-17 23:30:00")
    older = spark.createDataFrame([("123:ABC", ts("2025-10-01 00:00:00"))], "source_key string, last_interval timestamp_ntz")
    assert st.advance_state(s1, older, ["source_key"]).first().last_interval == ts("2025-10-17 23:30:00")


def test_half_hour_sequence_exact(spark):
    # ST12: a sequence of half-hour updates keeps the exact last value
    state = spark.createDataFrame([], "source_key string, last_interval timestamp_ntz")
    t = ts("2024-01-01 00:00:00")
    for i in range(4):
        b = spark.createDataFrame([("k", t + dt.timedelta(minutes=30 * i))], "source_key string, last_interval timestamp_ntz")
        state = st.advance_state(state, b, ["source_key"])
    assert state.first().last_interval == ts("2024-01-01 01:30:00")


def test_high_water_skips_unparsable(spark):
    df = spark.createDataFrame([("k", "2024-01-01T00:30:00Z"), ("k", "junk"), ("j", "junk")], "k string, t string")
    rows = {r.k: r.last_interval for r in st.high_water(df, ["k"], "t").collect()}
    assert rows == {"k": ts("2024-01-01 00:30:00")}


def test_newer_than_state_and_late(spark):
    rows = spark.createDataFrame([("a", ts("2024-01-01 00:00:00")), ("a", ts("2024-01-02 00:00:00")),
                                  ("b", ts("2024-01-01 00:00:00"))], "k string, timestamp timestamp_ntz")
    state = spark.createDataFrame([("a", ts("2024-01-01 00:00:00"))], "k string, last_interval timestamp_ntz")
    assert st.newer_than_state(rows, state, ["k"]).count() == 2
    assert st.newer_than_state(rows, state, ["k"], keep="late").count() == 1


def test_import_state_json(spark):
    doc = '{"123:ABC": "2024-01-01T01:00:00", "g:1": "2024-01-01T01:00:00+01:00", "z:1": "2024-01-01T01:00:00Z", "x:1": "bad"}'
    rows = {r.source_key: r.last_interval for r in st.import_state_json(spark.createDataFrame([(doc,)], "value string")).collect()}
    assert rows == {"123:ABC": ts("2024-01-01 01:00:00"), "g:1": ts("2024-01-01 00:00:00"),
                    "z:1": ts("2024-01-01 01:00:00"), "x:1": None}
    out = spark.createDataFrame([(ts("2024-01-01 01:00:00"),)], "t timestamp_ntz").select(st.export_state_value("t")).first()[0]
    assert out == "2024-01-01T01:00:00Z"
