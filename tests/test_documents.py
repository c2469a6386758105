"""Pages, accounts and tariff discovery on hand-written documents."""

import datetime as dt
import json

from pyspark.sql import types as T

from intervalflow.operators import tariffs as TF
from intervalflow.sources import documents as D


def test_pages_concatenate_in_order(spark):
    rows = [(0, json.dumps({"results": [{"v": 1}, {"v": 2}], "next": "p1"})), (1, json.dumps({"results": [{"v": 3}]})),
            (2, json.dumps({"next": None}))]
    df = spark.createDataFrame(rows, "page_no int, value string")
    out = D.read_pages(df, T.StructType([T.StructField("v", T.IntegerType())])).orderBy("page_no", "page_pos").collect()
    assert [r.v for r in out] == [1, 2, 3]
    assert [r.is_last_page for r in out] == [False, False, True]


def _account(points_e, points_g=()):
    return json.dumps({"number": "A-1", "electricity_meter_points": list(points_e), "gas_meter_points": list(points_g)})


def _ag(code, vf, vt=None):
    return {"tariff_code": code, "valid_from": vf, "valid_to": vt}


def test_active_tariff_rules(spark):
    p0 = {"mpan": "1", "meters": [{"serial_number": "S"}], "agreements": [
        _ag("E-1R", "2024-01-01T00:00:00Z"),                              # product does not parse -> skipped
        _ag("E-1R-OLD-A", "2023-01-01T00:00:00Z"),
        _ag("E-1R-NEW-A", "2024-02-01T00:00:00Z"),                        # latest valid_from wins
        _ag("E-1R-TIE-A", "2024-02-01T00:00:00Z"),                        # tie: first kept
        _ag("E-1R-EXPIRED-A", "2024-03-01T00:00:00Z", "2024-03-02T00:00:00Z"),
        _ag("E-1R-BAD-A", "not a date"),
    ]}
    p1 = {"mpan": "2", "meters": [], "agreements": [_ag("E-1R-LATER-A", "2024-05-01T00:00:00Z")]}
    g0 = {"mprn": "9", "meters": [{"serial": "G"}], "agreements": [_ag("G-1R-FUTURE-A", "2030-01-01T00:00:00Z")]}
    g1 = {"mprn": "8", "meters": [], "agreements": [_ag("G-1R-GAS-A", "2020-01-01T00:00:00+01:00")]}
    acc = D.read_accounts(spark.createDataFrame([(_account([p0, p1], [g0, g1]),)], "value string"))
    got = {r.kind: r.tariff_code for r in TF.active_tariffs(acc, dt.datetime(2024, 6, 1)).collect()}
    assert got == {"electricity": "E-1R-NEW-A", "gas": "G-1R-GAS-A"}  # first point that yields one decides


def test_list_meters_aliases_and_empty_ids(spark):
    pts = [{"mpan_number": "1", "meters": [{"serial": "S1"}, {"serial_number": ""}]}, {"mpan": "", "meters": [{"serial_number": "S2"}]}]
    acc = D.read_accounts(spark.createDataFrame([(_account(pts, [{"mprn": "G", "meters": [{"serial_number": "S3"}]}]),)], "value string"))
    got = sorted((r.kind, r.mpan_mprn, r.serial) for r in D.list_meters(acc).collect())
    assert got == [("electricity", "1", "S1"), ("gas", "G", "S3")]


def test_zone_devices_and_homes(spark):
    zones = spark.createDataFrame([(json.dumps([{"id": 1, "name": "Hall", "type": "HEATING"}, {"id": 2, "type": "HEATING"},
                                                {"id": 3, "name": "Tank", "type": "HOT_WATER"}]),)], "value string")
    got = sorted((r.device_id, r.name, r.device_type) for r in D.devices_from_zones(zones).collect())
    assert got == [("1", "Hall", "trv"), ("2", "TRV", "trv")]
    me = spark.createDataFrame([(json.dumps({"homes": [{"id": 5, "name": "H", "dateTimeZone": "Europe/London",
                                                       "temperatureUnit": "CELSIUS", "extra": 1}]}),), ("{}",)], "value string")
    assert [tuple(r) for r in D.homes(me).collect()] == [(5, "H", "Europe/London", "CELSIUS")]


def test_resolve_tariff_precedence(spark):
    meters = spark.createDataFrame([("A", "d1", "electricity", "m1", "OVR"), ("A", "d1", "gas", "m2", None),
                                    ("B", "d2", "electricity", "m3", None), ("C", "d2", "gas", "m4", "")],
                                   "account string, deployment string, kind string, mpan_mprn string, tariff_code string")
    globals_ = spark.createDataFrame([("d1", "gas", "GLOBAL-G")], "deployment string, kind string, tariff_code string")
    found = spark.createDataFrame([("B", "electricity", "FOUND-E")], "account string, kind string, tariff_code string")
    got = {r.mpan_mprn: (r.resolved_tariff, r.tariff_source) for r in TF.resolve_tariff(meters, globals_, found).collect()}
    assert got == {"m1": ("OVR", "override"), "m2": ("GLOBAL-G", "global"), "m3": ("FOUND-E", "discovered"),
                   "m4": (None, None)}


def test_landed_readers_take_values_from_the_path(spark, tmp_path):
    from intervalflow.sources import documents as docs
    for name, text in (("page-2.json", '{"results": [{"a": 3}], "next": null}'), ("page-10.json", '{"results": []}'), ("page-1.json", '{"results": [{"a": 1}, {"a": 2}], "next": "p2"}')):
        (tmp_path / name).write_text(text)
    rows = docs.read_landed_pages(spark, str(tmp_path), T.StructType([T.StructField("a", T.IntegerType())])).orderBy("page_no", "page_pos").collect()
    assert [(r.page_no, r.page_pos, r.is_last_page, r.a) for r in rows] == [(1, 0, False, 1), (1, 1, False, 2), (2, 0, True, 3)]
    root = str(tmp_path / "reports")
    spark.createDataFrame([("{}", "007", "2024-01-05"), ("[]", "a b/%+ü", "2024-01-06"), ("x", None, "no day")], "value string, zone_id string, date string") \
        .write.partitionBy("zone_id", "date").text(root)
    got = docs.read_day_reports(spark, root).collect()
    assert sorted((str(r.zone_id), str(r.date), r.value.strip()) for r in got) == [("007", "2024-01-05", "{}"), ("None", "None", "x"), ("a b/%+ü", "2024-01-06", "[]")]
    assert all(r.device_id == r.zone_id and r.landed_at is not None for r in got)


def test_packed_documents_read_like_files_of_their_own(spark, tmp_path):
    """Many documents to a file: as many files as tasks, and the same ids, dates, pages and values as from one file each."""
    from intervalflow.sources import documents as docs
    rows = [("{}", "007", "2024-01-05"), ("[]", "a b/%+ü", "2024-01-06"), ("x", None, "no day"), ("y", "", None)]
    df = spark.createDataFrame(rows + [(f'{{"n": {i}}}', f"z{i}", "2024-01-07") for i in range(200)], "value string, zone_id string, date string")
    df.write.partitionBy("zone_id", "date").text(str(tmp_path / "files"))
    docs.land_packed(df, str(tmp_path / "packed"), ["zone_id", "date"])
    assert len(list((tmp_path / "packed").glob("*.parquet"))) <= spark.sparkContext.defaultParallelism
    got = docs.read_day_reports(spark, str(tmp_path / "packed"), packed=True).collect()
    plain = docs.read_day_reports(spark, str(tmp_path / "files")).collect()
    key = lambda r: (str(r.device_id), str(r.zone_id), str(r.date), r.value.strip())
    assert len(got) == 204 and sorted(map(key, got)) == sorted(map(key, plain))
    assert len({r.source_file for r in got}) == 204 and all(r.landed_at is not None for r in got)
    pages = spark.createDataFrame([(2, '{"results": [{"a": 3}], "next": null}'), (10, '{"results": []}'), (1, '{"results": [{"a": 1}, {"a": 2}], "next": "p2"}')], "page long, value string")
    docs.land_packed(pages, str(tmp_path / "pages"), ["page"])
    back = docs.read_landed_pages(spark, str(tmp_path / "pages"), T.StructType([T.StructField("a", T.IntegerType())]), packed=True).collect()
    assert sorted((r.page_no, r.page_pos, r.is_last_page, r.a) for r in back) == [(1, 0, False, 1), (1, 1, False, 2), (2, 0, True, 3)]


def test_unknown_fields_of_nested_documents(spark):
    from intervalflow.sources import documents as docs
    declared = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.StructType([T.StructField("c", T.LongType())])))])
    rows = ['{"a": "x", "b": [{"c": 1, "d": 2}, {"c": 1, "d": "t"}], "e": {"f": 1}}', '{"a": {"no": 1}, "b": {"q": 1}, "e": {"f": 1}}', "broken", None, "[]", '{"b": []}']
    got = {(r.path, r.type): (r.n_values, r.n_documents) for r in docs.unknown_fields(spark.createDataFrame([(r,) for r in rows], "value string"), declared).collect()}
    assert got == {("e", "OBJECT<f: BIGINT>"): (2, 2), ("b[].d", "BIGINT"): (1, 1), ("b[].d", "STRING"): (1, 1), ("b.q", "BIGINT"): (1, 1)}


def test_profiles_merge_and_times_are_parsed(spark):
    from intervalflow.operators import quality
    rows = [("m1", "2024-01-01T00:30:00Z", 1.0, "a"), ("m2", "bad", 3.0, "a"), ("m2", "2024-01-01T02:00:00+01:00", 5.0, "b"), (None, None, None, "b")]
    df = spark.createDataFrame(rows, "meter_id string, interval_end string, consumption double, part string")
    p = quality.profile(df.drop("part"), exact=True).first()
    assert str(p.min_interval_end) == "2024-01-01 00:30:00" and str(p.max_interval_end) == "2024-01-01 01:00:00" and p.distinct_meter_id == 2
    m = quality.merge_profiles(quality.profile_sketches(df, ["part"])).first()
    assert (m.n_rows, m.unreadable_interval_end, m.distinct_meter_id, m.p50_consumption) == (4, 1, 2, 3.0)
    report = quality.dataset_report(fx_events(spark), 3).collect()
    assert sum(r.section == "row" for r in report) == 3 and {r.name for r in report if r.section == "size"} == {"files", "bytes"}
    assert any(r.section == "column" and r.name == "ts" and r.value == "timestamp_ntz" for r in report)


def fx_events(spark):
    from conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_union_with_a_tag(spark):
    from intervalflow.operators.dedup import union_tagged
    one, two = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2, 3.0)], "a int, c double")
    assert sorted(map(tuple, union_tagged([("demand", one), ("temperature", two)]).collect())) == [("demand", 1, "x", None), ("temperature", 2, None, 3.0)]
