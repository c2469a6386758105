"""Changes after the fact: re-costing, stored totals, late rows, resumable backfills, lakes of several loads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from intervalflow.operators import quality, recost, rollups
from intervalflow.operators.rates import normalise_rates, rate_join, rate_segments
from intervalflow.plans import fixtures as fx
from intervalflow.sinks import lake, totals
from intervalflow.streaming import ingest

METER = ["kind", "mpan_mprn", "serial"]
RATES = "tariff_code string, valid_from string, valid_to string, value_inc_vat double"


def files_of(root):
    """Data files by partition folder."""
    out = {}
    for folder, _, names in os.walk(root.removeprefix("file://")):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.relpath(folder, root), set()).add(n)
    return out


def readings(spark, rows):
    return spark.createDataFrame(rows, "mpan_mprn string, interval_end string, consumption double").select(
        F.lit("electricity").alias("kind"), "mpan_mprn", F.lit("S").alias("serial"), F.lit("T").alias("tariff_code"), "interval_end", "consumption")


def test_rate_changes_are_the_instants_at_which_prices_differ(spark):
    old = spark.createDataFrame([("T", "2024-01-01", "2024-01-05", 1.0), ("T", "2024-01-10", None, 2.0), ("U", "2024-01-01", None, 1.0), ("V", "2024-01-01", None, 1.0)], RATES)
    new = spark.createDataFrame([("T", "2024-01-01", "2024-01-04", 1.0), ("T", "2024-01-10", "2024-01-20", 2.0), ("T", "2024-01-20", None, 2.0),
                                 ("U", "2024-01-01", None, 1.0), ("W", "2024-01-03", None, 1.0)], RATES)
    got = {(r.tariff_code, str(r.valid_from)[:10], r.valid_to and str(r.valid_to)[:10]) for r in recost.rate_changes(old, new).collect()}
    # A rate's end is one of its columns, so its whole validity counts as changed.
    assert got == {("T", "2024-01-01", "2024-01-04"), ("T", "2024-01-04", "2024-01-05"), ("T", "2024-01-10", "2024-01-20"), ("T", "2024-01-20", None),
                   ("V", "2024-01-01", None), ("W", "2024-01-03", None)}
    assert recost.rate_changes(new, new).count() == 0 and recost.rate_changes(new.limit(0), new.limit(0)).count() == 0


def test_rate_changes_match_a_plain_lookup(spark):
    """At every instant of the fixture's rates: the rate found in old and in new differs iff a change covers the instant."""
    new = fx.rates(spark, SF_SMALL).checkpoint()
    pick = F.pmod(F.xxhash64("valid_from"), F.lit(7))
    old = new.filter(pick != 0).withColumn("valid_to", F.when(pick == 1, None).otherwise(F.col("valid_to")))
    points = new.select("tariff_code", "valid_from").unionByName(new.select("tariff_code", F.col("valid_to").alias("valid_from")).dropna()).distinct()

    def segments(rates):
        return [(r.tariff_code, r.valid_from, r._seg_end, (r.valid_from, r.valid_to, r.value_inc_vat))
                for r in rate_segments(normalise_rates(rates), ["tariff_code"]).collect()]

    def at(segs, key, t):
        return next((s[3] for s in segs if s[0] == key and s[1] <= t and (s[2] is None or t < s[2])), None)
    so, sn, changes = segments(old), segments(new), recost.rate_changes(old, new).collect()
    for key, t in points.collect():
        covered = any(c.tariff_code == key and c.valid_from <= t and (c.valid_to is None or t < c.valid_to) for c in changes)
        assert covered == (at(so, key, t) != at(sn, key, t))


def test_recosting_touches_only_the_changed_days(spark):
    roots = [lake.new_lake_root(spark, t) for t in ("t-rl", "t-rc")]
    raw, old = fx.consumption_raw(spark, SF_SMALL), fx.rates(spark, SF_SMALL).checkpoint()
    lake.write_consumption(raw, roots[0])
    recost.cost_touched(spark, *roots, raw, old)
    before = files_of(roots[1])
    noon = F.col("valid_from").between(F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-10 12:00:00").cast("timestamp_ntz"))
    new = old.withColumn("value_inc_vat", F.when(noon, F.col("value_inc_vat") * 3).otherwise(F.col("value_inc_vat")).cast("decimal(18,4)"))
    changed = recost.changed_days(recost.rate_changes(old, new), dt.date(2024, 1, 1), dt.date(2024, 1, 31)).select("date").distinct().collect()
    days = {r.date for r in changed}
    plan = recost.affected_readings(spark, roots[0], old, new)._jdf.queryExecution().executedPlan().toString()
    recost.recost(spark, *roots, old, new)
    after = files_of(roots[1])
    moved = {k.split("/")[0].removeprefix("date=") for k in before if before[k] != after[k]}
    assert 0 < len(days) < 10 and moved <= {str(d) for d in days} and "PartitionFilters" in plan and "date#" in plan
    want = rate_join(fx.consumption(spark, SF_SMALL), new, how="left").select("event_id", "unit_rate", "rate_valid_from")
    got = spark.read.option("basePath", roots[1]).parquet(roots[1]).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert recost.recost(spark, *roots, new, new) is None and files_of(roots[1]) == after


def test_totals_of_a_second_load_keep_the_first(spark):
    roots = [lake.new_lake_root(spark, t) for t in ("t-tl", "t-tc", "t-tt")]
    rates = spark.createDataFrame([("T", "2024-01-01", None, 2.0)], RATES)

    def load(rows):
        r = readings(spark, rows)
        lake.write_consumption(r, roots[0])
        recost.cost_touched(spark, roots[0], roots[1], r, rates)
        totals.update_daily_totals(spark, roots[1], roots[2], recost.meter_days(lake.prepare_consumption(r)))

    load([("a", "2024-01-01T00:30:00Z", 1.0), ("a", "2024-01-02T00:00:00Z", 1.0)])          # both belong to the first
    load([("b", "2024-01-01T10:00:00Z", 5.0)])
    load([("a", "2024-01-01T12:00:00Z", 10.0), ("a", "2024-02-01T12:00:00Z", 3.0)])           # late, and another month
    daily = totals.read_daily_totals(spark, roots[2])
    assert sorted((r.mpan_mprn, str(r.usage_date), float(r.kwh), float(r.cost), r.n_intervals) for r in daily.collect()) == [
        ("a", "2024-01-01", 12.0, 24.0, 3), ("a", "2024-02-01", 3.0, 6.0, 1), ("b", "2024-01-01", 5.0, 10.0, 1)]
    months = {(r.mpan_mprn, str(r.usage_month)): float(r.kwh) for r in totals.totals_rollup(daily).collect() if r.grain == "month"}
    assert months == {("a", "2024-01-01"): 12.0, ("a", "2024-02-01"): 3.0, ("b", "2024-01-01"): 5.0}


def test_null_partitions_survive_the_next_load(spark):
    root = lake.new_lake_root(spark, "t-null")
    rows = [("E-1R-A", None, ts("2024-01-01 00:00:00"), 1.0), ("E-1R-A", "", ts("2024-01-01 00:30:00"), 2.0), ("E-1R-A", None, None, 3.0)]
    schema = "tariff_code string, product_code string, valid_from timestamp_ntz, value_inc_vat double"
    for row in [*rows, rows[0]]:
        lake.write_unit_rates(spark.createDataFrame([row], schema).withColumn("energy", F.lit("electricity")), root)
    back = spark.read.option("basePath", root).parquet(root).collect()
    assert sorted((r.value_inc_vat, r.product) for r in back) == [(1.0, None), (2.0, None)]
    assert spark.read.parquet(root + "-quarantine").count() == 1
    costed = lake.new_lake_root(spark, "t-null-c")
    c = spark.createDataFrame([("m1", None), ("m2", None), ("m1", ts("2024-01-01 01:00:00")), ("m2", ts("2024-01-01 01:00:00"))], "mpan_mprn string, interval_end timestamp_ntz")
    c = c.select(F.lit("gas").alias("kind"), "mpan_mprn", F.lit("S").alias("serial"), F.col("interval_end").alias("interval_start"), "interval_end")
    for m in ("m1", "m2"):
        lake.write_costed(c.filter(F.col("mpan_mprn") == m), costed)
    assert spark.read.parquet(costed).count() == 2 and spark.read.parquet(costed + "-quarantine").count() == 2


def test_curated_homes_come_one_by_one(spark):
    root = lake.new_lake_root(spark, "t-cur")
    for home, kwh in (("A", 1.0), ("B", 2.0), ("A", 3.0)):
        lake.write_curated(spark.createDataFrame([(home, dt.date(2024, 1, 1), kwh)], "home_id string, date date, kwh double"), root, "x")
    assert sorted((r.home_id, r.kwh) for r in spark.read.parquet(root).collect()) == [("A", 3.0), ("B", 2.0)]


def test_a_load_opens_no_file_of_other_partitions(spark):
    root = lake.new_lake_root(spark, "t-foot")
    lake.write_consumption(readings(spark, [("a", "2024-01-01T10:00:00Z", 1.0), ("a", "2024-01-02T10:00:00Z", 1.0)]).withColumn("unit", F.lit("kWh")), root)
    local = root.removeprefix("file://")
    for folder, names in files_of(local).items():
        if folder.startswith("date=2024-01-01"):
            for n in names:
                with open(f"{local}/{folder}/{n}", "wb") as f:
                    f.write(b"not parquet")
                if os.path.exists(f"{local}/{folder}/.{n}.crc"):
                    os.remove(f"{local}/{folder}/.{n}.crc")
    lake.write_consumption(readings(spark, [("b", "2024-01-02T11:00:00Z", 2.0)]).withColumn("note", F.lit("n")), root)
    schema = lake.saved_schema(spark, root)
    day = lake.read_lake(spark, root, schema).filter("date = DATE '2024-01-02'").orderBy("mpan_mprn").collect()
    assert [(r.mpan_mprn, r.unit, r.note) for r in day] == [("a", "kWh", None), ("b", None, "n")]


def test_compaction_leaves_good_partitions_alone(spark):
    root = lake.new_lake_root(spark, "t-size")
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("p/+ "), (F.col("id") % 4).cast("string"))).alias("p"))
    df.filter("p IS NULL OR p <> 'p/+ 2'").repartition(6).write.partitionBy("p").parquet(root)
    df.filter("p = 'p/+ 2'").coalesce(1).write.mode("append").partitionBy("p").parquet(root)
    before = files_of(root)
    schema = lake.T.StructType([lake.T.StructField("id", lake.T.LongType()), lake.T.StructField("p", lake.T.StringType())])
    lake.compact(spark, root, schema, ["p"])
    after = files_of(root)
    assert sorted(len(v) for v in before.values()) == [1, 6, 6, 6] and all(len(v) == 1 for v in after.values())
    assert sum(before[k] == after[k] for k in before) == 1
    back = lake.read_lake(spark, root, schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 4000
    lake.compact(spark, root, schema, ["p"])
    assert files_of(root) == after
    size = max(r.bytes for r in lake.partition_files(spark, root, schema, ["p"]).collect())
    df.filter("p = 'p/+ 1'").repartition(9).write.mode("append").partitionBy("p").parquet(root)
    lake.compact(spark, root, schema, ["p"], target_bytes=size)
    assert max(len(v) for v in files_of(root).values()) <= 4 and lake.read_lake(spark, root, schema).count() == 5000


def test_scheduled_load_takes_late_readings(spark):
    roots = [lake.new_lake_root(spark, t) for t in ("t-late", "t-late-c", "t-late-s")]
    rates = spark.createDataFrame([("T", "2024-01-01", None, 2.0)], RATES)
    run = lambda rows: ingest.scheduled_load(spark, readings(spark, rows), rates, roots[0], roots[1], roots[2] + "/s", dt.datetime(2024, 1, 6, 9)).collect()
    run([("a", "2024-01-05T10:00:00Z", 1.0)])
    late = [("a", "2024-01-02T10:00:00Z", 7.0), ("a", "2024-01-05T10:00:00Z", 1.0), ("a", "bad", 1.0)]
    assert [r.actual for r in run(late)] == [1]
    run(late)
    costed = spark.read.parquet(roots[1])
    assert sorted(float(r.cost) for r in costed.collect()) == [2.0, 14.0]
    assert spark.read.parquet(roots[0] + "-late").count() == 1 and spark.read.parquet(roots[0] + "-quarantine").count() == 2


def test_backfill_goes_on_where_it_stopped(spark, monkeypatch):
    root = lake.new_lake_root(spark, "t-bf")
    raw = fx.consumption_raw(spark, SF_SMALL)
    write, done = lake.write_consumption, []

    def failing(df, *args, **kwargs):
        if len(done) == 2:
            raise RuntimeError("lost")
        write(df, *args, **kwargs)
        done.append(1)
    monkeypatch.setattr(lake, "write_consumption", failing)
    span = (dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    with pytest.raises(RuntimeError):
        ingest.backfill(raw, root, *span, 10, ledger_root=root + "-ledger")
    assert [w[0].day for w in ingest.open_windows(spark, *span, 10, root + "-ledger")] == [21]
    monkeypatch.setattr(lake, "write_consumption", write)
    assert ingest.backfill(raw, root, *span, 10, ledger_root=root + "-ledger") == 0
    assert lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count() == fx.consumption(spark, SF_SMALL).count()


def test_gap_runs_of_odd_series(spark):
    day = "2024-01-0"
    times = [("a", f"{day}1 23:00:00"), ("a", f"{day}1 23:00:00"), ("a", f"{day}2 00:30:00"), ("a", f"{day}2 00:40:00"), ("a", f"{day}2 01:50:00"), ("b", f"{day}1 00:00:00"), ("c", None)]
    df = spark.createDataFrame(times, "m string, s string").select("m", F.to_timestamp_ntz("s").alias("interval_start"))
    runs = quality.gap_runs(df, ["m"])
    got = sorted((str(r.run_start)[5:16], str(r.run_end)[5:16], r.n_slots) for r in runs.collect())
    assert got == [("01-01 23:30", "01-02 00:30", 2), ("01-02 01:00", "01-02 02:00", 2)]
    slots = sorted(str(r.slot_start)[8:16] for r in quality.gap_slots(df, ["m"]).collect())
    assert slots == ["01 23:30", "02 00:00", "02 01:00", "02 01:30"]
    assert sorted((str(r.date), r.n_missing, r.n_runs) for r in quality.gap_trend(runs).collect()) == [("2024-01-01", 1, 1), ("2024-01-02", 3, 2)]


def test_bills_of_all_kinds(spark):
    d = dt.date
    daily = spark.createDataFrame([("m", d(2024, 1, k), 1.0, 10.0, 48, 48) for k in range(1, 11)] + [("m", d(2024, 1, 20), 1.0, 10.0, 48, 40), ("m", d(2024, 2, 3), 1.0, 7.0, 48, 48)],
                                  "meter string, usage_date date, kwh double, cost double, n_intervals long, n_priced long")
    bills = spark.createDataFrame([("m", "1", d(2023, 12, 28), d(2024, 1, 4), 30.2), ("m", "2", d(2024, 1, 4), d(2024, 1, 8), 50.0), ("m", "3", d(2024, 1, 8), d(2024, 1, 10), 1.0),
                                   ("m", "4", d(2024, 1, 19), d(2024, 1, 21), 10.0), ("n", "5", d(2024, 1, 1), d(2024, 1, 9), 4.0), ("m", "6", d(2024, 1, 5), d(2024, 1, 5), 9.0)],
                                  "meter string, bill_id string, period_start date, period_end date, billed_amount double")
    got = sorted((r.bill_id or "", r.status, r.days_used, r.expected) for r in rollups.reconcile_bills(daily, bills, ["meter"]).collect())
    assert got == [("", "unbilled", 1, 7.0), ("", "unbilled", 1, 10.0), ("1", "within", 3, 30.0), ("2", "over", 4, 40.0), ("3", "under", 2, 20.0),
                   ("4", "unpriced", 1, 10.0), ("5", "no_usage", 0, 0.0)]


def test_backfill_stages_raw_columns_of_rejected_rows_only(spark, monkeypatch):
    """What is staged by window has a usable reading once; a reading without a time keeps its raw columns for the quarantine."""
    root, held = lake.new_lake_root(spark, "t-raw"), lake.new_lake_root(spark, "t-raw-staged")
    monkeypatch.setattr(ingest, "scratch_path", lambda spark, tag: held)
    rows = [(1, "2024-01-01T00:00:00Z", 1.0), (2, "?", 2.0), (3, "2024-01-02T00:00:00Z", 3.0)]
    raw = spark.createDataFrame(rows, "event_id long, interval_start string, consumption double").select(
        "event_id", F.lit("gas").alias("kind"), F.lit("7").alias("mpan_mprn"), F.lit("S").alias("serial"), F.lit("T").alias("tariff_code"), "interval_start",
        F.lit("2024-01-03T00:00:00Z").alias("interval_end"), "consumption")
    assert ingest.backfill(raw, root, dt.date(2024, 1, 1), dt.date(2024, 1, 2), 1) == 0
    assert {r.event_id: r._raw is not None for r in spark.read.parquet(held).collect()} == {1: False, 2: True, 3: False}
    assert [r.reason for r in spark.read.parquet(root + "-quarantine").collect()] == ["no interval_start"]
    assert lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count() == 2
