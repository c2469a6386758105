import datetime as dt

from pyspark.sql import functions as F

from intervalflow.functions import codes, timefns


def _one(spark, col, data="x string", rows=(("a",),)):
    return [r[0] for r in spark.createDataFrame(list(rows), data).select(col).collect()]


def test_to_utc_accepts_zulu_offset_and_naive(spark):
    rows = [("2024-01-01T00:30:00Z",), ("2024-01-01T00:30:00+01:00",), ("2024-01-01T00:30:00",),
            ("2024-01-01T00:30:00.250-02:00",), ("garbage",), ("",), (None,)]
    got = _one(spark, timefns.to_utc("x"), rows=rows)
    assert got == [dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2023, 12, 31, 23, 30), dt.datetime(2024, 1, 1, 0, 30),
                   dt.datetime(2024, 1, 1, 2, 30, 0, 250000), None, None, None]


def test_floor_and_format(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 10, 59, 59, 999999),)], "t timestamp_ntz")
    r = df.select(timefns.floor_time("t", 1800).alias("f"), timefns.format_zulu("t").alias("z"),
                  timefns.safe_horizon("t", 60).alias("h")).first()
    assert r.f == dt.datetime(2024, 3, 5, 10, 30)
    assert r.z == "2024-03-05T10:59:59Z"
    assert r.h == dt.datetime(2024, 3, 5, 9, 30)


def test_interval_minutes_truncates_and_nulls(spark):
    rows = [("2024-01-01T00:00:00Z", "2024-01-01T00:30:59Z"), ("2024-01-01T00:00:00Z", None),
            ("", "2024-01-01T00:30:00Z"), ("2024-01-01T00:00:00.5Z", "2024-01-01T00:01:00Z")]
    got = _one(spark, timefns.interval_minutes("a", "b"), "a string, b string", rows)
    assert got == [30, None, None, 0]


def test_parse_tariff_code_examples(spark):
    rows = [("E-1R-AGILE-24-09-01-A",), ("E-1R-A",), ("E-1R-VAR-BB",), ("E-1R",), ("G-1R-GAS-24-09-01-A",), ("",)]
    p = codes.parse_tariff_code("x")
    got = [tuple(r) for r in spark.createDataFrame(rows, "x string").select(
        p["kind"], p["register"], p["product_code"], p["region"]).collect()]
    assert got == [("E", "1R", "AGILE-24-09-01", "A"), ("E", "1R", None, "A"), ("E", "1R", "VAR-BB", None),
                   ("E", None, None, None), ("G", "1R", "GAS-24-09-01", "A"), ("", None, None, None)]


def test_energy_from_code(spark):
    got = _one(spark, codes.energy_from_code("x"), rows=[("E-1R-X-A",), ("X-E-Y",), ("G-1R-GAS-A",)])
    assert got == ["electricity", "electricity", "gas"]


def test_first_present_skips_empty(spark):
    got = _one(spark, codes.first_present("a", "b", "c"), "a string, b string, c string",
               [("", None, "z"), (None, "y", "z"), ("", "", "")])
    assert got == ["z", "y", None]


def test_unquoted_keys_parse(spark):
    from intervalflow.sources.documents import bad_meter_configs, parse_meter_config
    rows = [(1, '[{kind:"electricity",mpan_or_mprn:"001",serial:"S1"}]'),
            (2, '[{"kind":"gas","mpan_or_mprn":"G2","serial":"S2","tariff_code":"G-1R-X-A"}]'),
            (3, 'not json at all'), (4, '[{kind:"gas",mpan_or_mprn:"a, x:1",serial:"S"}]')]
    out = parse_meter_config(spark.createDataFrame(rows, "id int, value string")).orderBy("id").collect()
    assert [(r.id, r.repaired, r.kind, r.mpan_or_mprn) for r in out] == [(1, True, "electricity", "001"),
                                                                         (2, False, "gas", "G2"), (4, True, "gas", "a, x:1")]
    assert [r.id for r in bad_meter_configs(spark.createDataFrame(rows, "id int, value string")).collect()] == [3]


def test_state_key(spark):
    assert _one(spark, codes.state_key("a", "b"), "a string, b string", [("123", "ABC")]) == ["123:ABC"]


def test_time_functions_ignore_session_zone(spark):
    # 02:45 on 2024-03-10 does not exist in New York; NTZ arithmetic must not shift it.
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 45), dt.datetime(2024, 3, 10, 3, 15))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(timefns.floor_time("a", 1800).alias("f"), timefns.micros_between("a", "b").alias("d"),
                      timefns.format_zulu("a").alias("z"), timefns.to_utc(F.lit("2024-03-10T02:45:00")).alias("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.f == dt.datetime(2024, 3, 10, 2, 30)
    assert r.d == 30 * 60 * 1_000_000
    assert r.z == "2024-03-10T02:45:00Z"
    assert r.u == dt.datetime(2024, 3, 10, 2, 45)


def test_normalise_units(spark):
    df = spark.createDataFrame([("gas", 2.0), ("electricity", 2.0)], "kind string, v double") \
              .withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = [float(r[0]) for r in df.select(codes.normalise_units("v", "kind", {"gas": "11.1"})).collect()]
    assert got == [22.2, 2.0]


def test_plain_dates_are_utc_midnights_in_any_zone(spark):
    from intervalflow.functions.timefns import to_utc
    df = spark.createDataFrame([("2024-01-15",), ("2024-01-15T10:00:00-05:00",), ("",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [str(r[0]) for r in df.select(to_utc("s")).collect()]
            assert got == ["2024-01-15 00:00:00", "2024-01-15 15:00:00", "None"], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_missing_intervals_without_an_end_column(spark):
    from intervalflow.operators.quality import missing_intervals
    r = missing_intervals(spark.createDataFrame([("m",), ("m",)], "meter string"), ["meter"]).first()
    assert (r.expected, r.actual, r.missing) == (2, 2, 0)
