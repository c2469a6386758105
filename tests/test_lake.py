"""Lake writers/readers: partition layout, idempotent merge, pruning, legacy layout, quarantine."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from intervalflow.plans import fixtures as fx
from intervalflow.sinks import folders, lake


def _readings(spark, rows):
    return spark.createDataFrame(rows, "event_id long, interval_end string, consumption double") \
                .withColumn("consumption", F.col("consumption").cast("decimal(18,6)")) \
                .select("event_id", F.lit("electricity").alias("kind"), F.lit("0000000007").alias("mpan_mprn"),
                        F.lit("S1").alias("serial"), F.lit("T").alias("tariff_code"),
                        "interval_end", "consumption")


def test_date_is_utc_day_of_interval_end(spark):
    # 23:30-00:00 lands on the next day; 3 rows on 2 days (the reference's path test, with asserts)
    df = spark.createDataFrame([("2024-01-01T01:00:00Z", 1.0), ("2024-01-01T02:00:00Z", 2.0), ("2024-01-02T00:00:00Z", 3.0)],
                               "interval_end string, consumption double")
    got = [r.date for r in lake.prepare_consumption(df).orderBy("interval_end").collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_merge_is_idempotent_and_keeps_other_intervals(spark):
    root = lake.new_lake_root(spark, "t-merge")
    raw = fx.consumption_raw(spark, SF_SMALL)
    lake.write_consumption(raw.filter("event_id % 2 = 0"), root)
    lake.write_consumption(raw.filter("event_id % 2 = 1"), root)
    first = lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).drop("meter_bucket").checkpoint()
    lake.write_consumption(raw.filter("event_id % 2 = 1"), root)  # replay
    second = lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).drop("meter_bucket")
    assert first.count() == fx.consumption(spark, SF_SMALL).count()  # X1 fixed: nothing lost
    assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0


def test_ids_keep_leading_zeros_and_partitions_prune(spark):
    root = lake.new_lake_root(spark, "t-prune")
    lake.write_consumption(fx.consumption_raw(spark, SF_SMALL), root)
    back = lake.read_lake(spark, root, lake.CONSUMPTION_LAKE)
    assert back.filter(F.col("mpan_mprn").startswith("00000000")).count() > 0
    from intervalflow.sources.scans import consumption_range
    q = consumption_range(back, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan or "19727" in plan


def test_legacy_and_new_layout_read_together(spark):
    new, old = lake.new_lake_root(spark, "t-new"), lake.new_lake_root(spark, "t-old")
    lake.write_consumption(_readings(spark, [(1, "2024-01-01T00:30:00Z", 1.5)]), new)
    legacy = _readings(spark, [(0, "2024-01-01T00:30:00Z", 9.9), (2, "2024-01-01T01:00:00Z", 2.5)])
    lake.write_consumption(legacy, old, partition_cols=lake.REFERENCE_CONSUMPTION_PARTS)
    keys = ["kind", "mpan_mprn", "serial", "interval_start", "interval_end"]
    both = lake.read_lake(spark, new, lake.CONSUMPTION_LAKE, legacy_root=old, keys=keys)
    got = sorted((r.event_id, float(r.consumption)) for r in both.collect())
    assert got == [(1, 1.5), (2, 2.5)]  # new layout wins for the shared interval


def test_quarantine_unparsable_end(spark):
    root, q = lake.new_lake_root(spark, "t-q"), lake.new_lake_root(spark, "t-qq") + "/q"
    lake.write_consumption(_readings(spark, [(1, "2024-01-01T00:30:00Z", 1.0), (2, "garbage", 2.0)]), root, quarantine_root=q)
    assert lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count() == 1
    assert spark.read.parquet(q).count() == 1


def test_heating_sink_keeps_kinds_apart(spark):
    root = lake.new_lake_root(spark, "t-heat")
    rows = [("demand", "7", ts("2024-01-01 06:00:00")), ("temperature", "7", ts("2024-01-01 06:00:00"))]
    df = spark.createDataFrame(rows, "record_kind string, trv_id string, timestamp timestamp_ntz")
    lake.write_heating(df, root)
    back = spark.read.option("basePath", root).parquet(root)
    assert sorted(r.record_kind for r in back.collect()) == ["demand", "temperature"]  # X2 fixed


def test_unit_rate_sink_layout(spark):
    root = lake.new_lake_root(spark, "t-rates")
    r = fx.rates(spark, SF_SMALL)
    from intervalflow.operators.rates import stamp_rates
    lake.write_unit_rates(stamp_rates(r), root)
    back = spark.read.option("basePath", root).parquet(root)
    assert back.count() == r.count()
    assert {"energy", "product", "tariff", "date"} <= set(back.columns)


def test_compaction_preserves_rows(spark):
    root = lake.new_lake_root(spark, "t-compact")
    c = lake.lake_rows(fx.consumption(spark, SF_SMALL))
    for i in range(3):
        lake.write_partitioned(c.filter(F.pmod("event_id", F.lit(3)) == i), root, lake.CONSUMPTION_PARTS, mode="append")
    before = lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count()
    lake.compact(spark, root, lake.CONSUMPTION_LAKE, lake.CONSUMPTION_PARTS)
    assert lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count() == before == c.count()


def test_merge_reads_only_touched_partitions(spark):
    root = lake.new_lake_root(spark, "t-dpp")
    raw = fx.consumption_raw(spark, SF_SMALL)
    lake.write_consumption(raw, root)
    batch = lake.lake_rows(raw.filter("event_id % 50 = 0"))
    old = lake.touched_partitions(spark, root, lake.CONSUMPTION_LAKE, batch, lake.CONSUMPTION_PARTS)
    plan = old._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "dynamicpruning" in filters                       # exact touched partitions (DPP)
    assert ">= 2024-01-01" in filters.split("]")[0]          # static date range of the batch


def test_profile_file_sizes_and_counts(spark):
    from intervalflow.operators import quality
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    sizes = quality.file_sizes(ev).collect()
    import os
    assert [r.file_size for r in sizes] == [os.path.getsize(f"{SF_SMALL}/events.parquet")]
    prof = quality.profile(fx.consumption(spark, SF_SMALL), exact=False).first()
    assert prof.n_rows == fx.consumption(spark, SF_SMALL).count() and prof.distinct_mpan_mprn > 0


def test_costed_sink_roundtrip(spark):
    from intervalflow.operators.rates import rate_join
    root = lake.new_lake_root(spark, "t-costed")
    costed = rate_join(fx.consumption(spark, SF_SMALL), fx.rates(spark, SF_SMALL))
    lake.write_costed(costed, root)
    back = spark.read.option("basePath", root).parquet(root)
    assert back.count() == costed.count()
    assert {"cost", "unit_rate", "rate_valid_from", "date", "meter_bucket"} <= set(back.columns)


def test_empty_input_leaves_an_unpartitioned_table(spark):
    root = lake.new_lake_root(spark, "t-empty")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    lake.write_partitioned(df, root)
    lake.write_partitioned(df.limit(0), root)
    assert spark.read.parquet(root).count() == 2


def test_loads_of_other_devices_and_times_only_add(spark):
    root = lake.new_lake_root(spark, "t-append")
    schema = "record_kind string, trv_id string, sensor_type string, temperature double, timestamp timestamp_ntz"
    one = [("temperature", "7", "inside", 1.0, ts("2024-01-01 06:00:00")), ("temperature", "7", "inside", 2.0, ts("2024-01-01 06:00:00"))]
    other = [("temperature", "8", "inside", 3.0, ts("2024-01-01 06:00:00")), ("temperature", "7", "inside", 4.0, ts("2024-01-01 18:00:00"))]
    for rows in (one, other, one, [("temperature", "8", "inside", 9.0, ts("2024-01-01 06:00:00"))]):
        lake.write_heating(spark.createDataFrame(rows, schema), root)
    back = spark.read.option("basePath", root).parquet(root)
    assert sorted(r.temperature for r in back.collect()) == [1.0, 2.0, 4.0, 9.0]


def test_keep_first_with_null_order(spark):
    from intervalflow.operators.dedup import keep_first
    df = spark.createDataFrame([(1, None, "x"), (2, 5, "late"), (2, None, "none"), (2, 3, "first")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in keep_first(df, ["k"], "o").collect()) == [(1, "x"), (2, "first")]


def test_lake_keeps_other_columns_of_either_load(spark):
    root = lake.new_lake_root(spark, "t-extra")
    base = _readings(spark, [(1, "2024-01-01T00:30:00Z", 1.125)])
    lake.write_consumption(base.withColumn("unit", F.lit("kWh")), root)
    lake.write_consumption(_readings(spark, [(2, "2024-01-01T01:00:00Z", 2.0)]).withColumn("note", F.lit("n")), root)
    rows = spark.read.option("mergeSchema", "true").parquet(root).orderBy("interval_end").collect()
    assert [(float(r.consumption), r.unit, r.note) for r in rows] == [(1.125, "kWh", None), (2.0, None, "n")]


def test_layouts_of_many_folders_leave_one_file_a_folder(spark, tmp_path):
    """No checksum file beside each small Parquet file (on a local disk each file that is made costs a process); partitions that were
    written with checksum files are replaced whole."""
    root = str(tmp_path / "lake")
    rows = spark.createDataFrame([(i, i % 7, f"d{i % 3}") for i in range(60)], "id int, m int, date string")
    rows.filter("id < 30").write.partitionBy("m", "date").parquet(root)
    assert list((tmp_path / "lake").rglob(".*.parquet.crc"))
    lake.write_partitioned(rows, root, ["m", "date"], rows=60)
    files = [f for f in (tmp_path / "lake").rglob("*") if f.is_file() and f.parent.name.startswith("date=")]
    assert len(files) == 21 and all(f.name.endswith(".parquet") for f in files)
    assert sorted(map(tuple, spark.read.parquet(root).select("id", "m", "date").collect())) == sorted(map(tuple, rows.collect()))


_ODD = [None, "0000000007", "a b", "x/y", "50%25", "\u00fc\u20ac", "k=v:+{}[]^", "it's", "."]
_PARTS = lake.REFERENCE_CONSUMPTION_PARTS


def _odd_readings(spark, n=3):
    rows = [(i, float(j) if j else None, ts(f"2024-01-0{1 + j % 2} 0{j}:30:00"), "gas", m, None if m is None else f"S{i % 2}", None if i == 3 else dt.date(2024, 1, 1 + j % 2))
            for i, m in enumerate(_ODD) for j in range(n)]
    df = spark.createDataFrame(rows, "event_id long, consumption double, interval_end timestamp_ntz, kind string, mpan_mprn string, serial string, date date")
    return df.withColumn("consumption", F.col("consumption").cast("decimal(18,6)"))


def _folders(root):
    return sorted({str(f.parent.relative_to(root)) for f in root.rglob("*.parquet")})


def test_small_folders_are_those_that_spark_writes(spark, tmp_path):
    df = _odd_readings(spark)
    lake.write_partitioned(df, str(tmp_path / "ours"), _PARTS, mode="append", rows=df.count(), deal_by=lake.METER_KEYS)
    df.write.partitionBy(*_PARTS).parquet(str(tmp_path / "sparks"))
    assert _folders(tmp_path / "ours") == _folders(tmp_path / "sparks")
    assert not [f.name for f in (tmp_path / "ours").iterdir() if f.name.startswith(".staging")]
    for root in ("ours", "sparks"):
        plain, by_tasks = spark.read.schema(df.schema).parquet(str(tmp_path / root)), folders.read(spark, str(tmp_path / root), df.schema)
        assert by_tasks.schema == plain.schema and sorted(by_tasks.collect(), key=str) == sorted(plain.collect(), key=str)
        assert sorted(by_tasks.select(*df.columns).collect(), key=str) == sorted(df.collect(), key=str)


def test_small_folders_are_replaced_whole_and_others_stay(spark, tmp_path):
    root, df = tmp_path / "lake", _odd_readings(spark)
    df.write.partitionBy(*_PARTS).parquet(str(root))
    batch = _odd_readings(spark, 1).filter("event_id in (0, 1, 3)").withColumn("consumption", F.lit(9).cast("decimal(18,6)"))
    for _ in range(2):
        lake.write_partitioned(batch, str(root), _PARTS, rows=3, deal_by=lake.METER_KEYS, max_records_per_file=1)
    touched = batch.select(*_PARTS).distinct().withColumnsRenamed({c: f"_{c}" for c in _PARTS})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _PARTS]
    want = df.join(touched, same, "left_anti").unionByName(batch)
    assert sorted(spark.read.schema(df.schema).parquet(str(root)).select(*df.columns).collect(), key=str) == sorted(want.collect(), key=str)
    assert len([f for f in root.rglob("*") if f.is_file() and "mpan_mprn=0000000007/serial=S1/date=2024-01-01" in str(f)]) == 1  # no checksum file of the old one


def test_small_folders_fill_files_up_to_the_limit(spark, tmp_path):
    df = spark.range(10).select("id", F.lit("m").alias("m"), F.lit("d").alias("d"))
    lake.write_partitioned(df, str(tmp_path / "lake"), ["m", "d"], mode="append", rows=10, deal_by=["m"], max_records_per_file=4)
    files = list((tmp_path / "lake").rglob("*.parquet"))
    assert sorted(spark.read.parquet(str(f)).count() for f in files) == [2, 4, 4]


def test_small_folders_of_a_large_batch_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """However few its bytes: a layout of many folders costs by its folders."""
    monkeypatch.setattr(lake, "SMALL_BATCH", 100)
    monkeypatch.setattr(lake, "FOLDER_ROWS", 50, raising=False)
    df = spark.range(400).select("id", F.lit("gas").alias("kind"), (F.col("id") % 80).cast("string").alias("mpan_mprn"), F.lit("S").alias("serial"),
                                 F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"))
    lake.write_partitioned(df, str(tmp_path / "lake"), _PARTS, mode="append", rows=400, deal_by=lake.METER_KEYS)
    parts = [f.name.split("-")[1] for f in (tmp_path / "lake").rglob("*.parquet")]
    assert len(parts) == 240 and len(set(parts)) == 8 and max(parts.count(p) for p in parts) < 80


def test_legacy_lake_is_listed_by_tasks_and_pruned_before_files_are_opened(spark, tmp_path):
    root, new = tmp_path / "old", str(tmp_path / "new")
    lake.write_consumption(_readings(spark, [(1, "2024-01-01T00:30:00Z", 1.5), (2, "2024-01-02T01:00:00Z", 2.5)]), str(root), partition_cols=_PARTS)
    lake.write_consumption(_readings(spark, [(3, "2024-01-01T00:30:00Z", 3.5)]), new)
    both = lake.read_lake(spark, new, lake.CONSUMPTION_LAKE, legacy_root=str(root), keys=lake.CONSUMPTION_KEYS)
    assert "MapInArrow" in both._jdf.queryExecution().toString()
    old = folders.read(spark, str(root), lake.CONSUMPTION_LAKE)
    day = next(root.rglob("date=2024-01-02"))
    (day / "other.parquet").write_bytes(b"no parquet")
    (day.parent / "date=2024-01-01" / "empty.parquet").write_bytes(b"")
    assert [r.event_id for r in old.filter("date = DATE'2024-01-01'").collect()] == [1]
    assert [r.event_id for r in old.filter("mpan_mprn = 'x'").collect()] == []
    with pytest.raises(Exception, match="(?i)parquet"):
        old.collect()
    (day / "other.parquet").unlink()
    (day.parent / "stray.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="not in the layout"):  # not left out
        folders.read(spark, str(root), lake.CONSUMPTION_LAKE).collect()


def test_legacy_files_of_other_types_are_read_as_declared(spark, tmp_path):
    root = str(tmp_path / "old")
    t = spark.sql("SELECT 7 AS EVENT_ID, timestamp'2024-01-01 00:30:00' AS interval_end, CAST(1.5 AS DECIMAL(9,2)) AS consumption, "
                  "'gas' AS kind, '007' AS mpan_mprn, 'S' AS serial, DATE'2024-01-01' AS date")
    t.write.partitionBy(*_PARTS).parquet(root)
    row = folders.read(spark, root, lake.CONSUMPTION_LAKE).first()
    assert (row.event_id, row.interval_end, str(row.consumption), row.mpan_mprn, row.tariff_code) == (7, ts("2024-01-01 00:30:00"), "1.500000", "007", None)
    assert folders.read(spark, str(tmp_path / "old" / "kind=gas" / "mpan_mprn=007" / "serial=S" / "date=2024-01-01"), lake.CONSUMPTION_LAKE) is None


def test_failed_load_of_small_folders_leaves_the_lake_as_it_was(spark, tmp_path):
    root, df = tmp_path / "lake", _odd_readings(spark)
    lake.write_partitioned(df, str(root), _PARTS, mode="append", rows=df.count(), deal_by=lake.METER_KEYS)
    before = sorted(str(f) for f in root.rglob("*") if f.is_file())
    bad = df.withColumn("consumption", F.when(F.col("event_id") == 5, F.raise_error(F.lit("no reading")).cast("decimal(18,6)")).otherwise(F.col("consumption")))
    with pytest.raises(Exception, match="no reading"):
        lake.write_partitioned(bad, str(root), _PARTS, rows=df.count(), deal_by=lake.METER_KEYS)
    assert sorted(str(f) for f in root.rglob("*") if f.is_file()) == before and not list(root.glob(".staging-*"))
