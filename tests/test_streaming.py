"""Stream result = batch result over the same landed files, replays included."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from intervalflow.plans import fixtures as fx
from intervalflow.plans.queries import _events_to_readings
from intervalflow.sinks import lake
from intervalflow.streaming import ingest


def test_stream_equals_batch(spark):
    landing = lake.new_lake_root(spark, "t-landing")
    fx.land_event_splits(spark, SF_SMALL, landing, splits=4, repeat=1)
    root, state_root = lake.new_lake_root(spark, "t-stream"), lake.new_lake_root(spark, "t-state") + "/s"
    schema = fx.table(spark, SF_SMALL, "events").schema
    ingest.stream_consumption(spark, landing, schema, _events_to_readings, root, state_root,
                              max_files_per_trigger=1)
    streamed = lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).drop("meter_bucket", "date")
    batch = lake.lake_rows(fx.consumption(spark, SF_SMALL)).select(*streamed.columns)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
    state = ingest.read_state(spark, state_root)
    hw = batch.groupBy(F.concat_ws(":", "mpan_mprn", "serial").alias("source_key")).agg(F.max("interval_start").alias("last_interval"))
    assert state.exceptAll(hw).count() == 0 and hw.exceptAll(state).count() == 0


def test_scheduled_load_is_idempotent(spark):
    import datetime as dt
    roots = [lake.new_lake_root(spark, t) for t in ("t-sl", "t-slc", "t-sls")]
    run = lambda: ingest.scheduled_load(spark, fx.consumption_raw(spark, SF_SMALL), fx.rates(spark, SF_SMALL),
                                        roots[0], roots[1], roots[2] + "/s", dt.datetime(2024, 1, 20, 12, 10))
    q1 = run().collect()
    first = spark.read.option("basePath", roots[1]).parquet(roots[1]).checkpoint()
    q2 = run().collect()
    second = spark.read.option("basePath", roots[1]).parquet(roots[1])
    # The second run resumes from state: its window is the overlap, and the tables stay as they are.
    assert 0 < sum(r.actual for r in q2) < sum(r.actual for r in q1)
    assert first.count() > 0 and first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0
    assert first.filter(F.col("interval_end") > F.lit("2024-01-20 11:00:00").cast("timestamp_ntz")).count() == 0


def test_stream_keeps_readings_of_any_age(spark):
    """Files at 12:00, 13:00, 09:00 and the day before, newest first: all four readings are stored, two of them are late."""
    import datetime as dt
    ev = fx.table(spark, SF_SMALL, "events").limit(1)
    times = [dt.datetime(2024, 1, 5, 12, 3), dt.datetime(2024, 1, 5, 13, 3), dt.datetime(2024, 1, 5, 9, 3), dt.datetime(2024, 1, 4, 12, 3)]
    landing, root = lake.new_lake_root(spark, "t-age"), lake.new_lake_root(spark, "t-age-lake")
    state_root, ckpt = lake.new_lake_root(spark, "t-age-state"), lake.new_lake_root(spark, "t-age-ckpt")
    for i, at in enumerate(times):
        one = ev.withColumn("event_id", F.lit(i).cast("long")).withColumn("ts", F.lit(str(at)).cast(ev.schema["ts"].dataType))
        one.write.mode("append").parquet(landing)
        ingest.stream_consumption(spark, landing, ev.schema, _events_to_readings, root, state_root, checkpoint=ckpt)
    assert lake.read_lake(spark, root, lake.CONSUMPTION_LAKE).count() == 4
    late = spark.read.parquet(*[f"{root}-late/epoch={i}" for i in range(4)])
    assert sorted(r.event_id for r in late.collect()) == [2, 3]


def test_state_survives_an_unfinished_write(spark):
    import datetime as dt
    import os
    root = lake.new_lake_root(spark, "t-crash")
    one = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], ingest.STATE_SCHEMA)
    for _ in range(3):
        ingest.save_state(spark, one, root)
    local = root.removeprefix("file://")
    newest = sorted(os.listdir(local))[-1]
    os.makedirs(f"{local}/version=999999999999")           # a version without its success mark
    assert newest == "version=000000000003" and len(os.listdir(local)) == 3
    assert ingest.read_state(spark, root).collect()[0].source_key == "a"


def test_marks_are_a_log_that_is_folded_now_and_then(spark, monkeypatch):
    """The state of N batches is the source's high-water mark; a batch writes its own keys only."""
    import datetime as dt
    import os
    from intervalflow.streaming import state as st
    monkeypatch.setattr(ingest, "FOLD_AFTER", 3)
    root = lake.new_lake_root(spark, "t-marks")
    local = root.removeprefix("file://")
    rows = [(f"k{i % 4}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=(7 * i) % 12)) for i in range(12)]
    schema = "source_key string, interval_start timestamp_ntz"
    for i in range(0, 12, 2):
        ingest.update_state(spark, spark.createDataFrame(rows[i:i + 2], schema), root, F.col("source_key"))
        newest = max((n for n in os.listdir(local) if n.startswith("marks-")), key=lambda n: n[-12:])
        assert spark.read.parquet(f"{root}/{newest}").count() <= 2
        want = st.high_water(spark.createDataFrame(rows[:i + 2], schema), ["source_key"])
        got = ingest.read_state(spark, root)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert any(n.startswith("version=") for n in os.listdir(local)) and len(ingest._since_version(spark, root)) <= 4


def test_report_stream_counts_what_it_keeps_aside(spark):
    """Files in any order; one is no JSON, one has a record without a time, one comes after its device's state."""
    landing, root = lake.new_lake_root(spark, "t-land"), lake.new_lake_root(spark, "t-hs")
    state_root, ckpt = lake.new_lake_root(spark, "t-hss"), lake.new_lake_root(spark, "t-hsc")
    call = '{"callForHeat": {"dataIntervals": [{"from": "%s", "to": null, "value": "LOW"}]}}'
    waves = [[(call % "2024-01-02T10:00:00Z", "007", "2024-01-02"), ("{oops", "8", "2024-01-02")],
             [(call % "2024-01-01T10:00:00Z", "007", "2024-01-01"), (call % "", "9", "2024-01-01")]]
    for wave in waves:
        spark.createDataFrame(wave, "value string, zone_id string, date string").write.mode("append").partitionBy("zone_id", "date").text(landing)
        ingest.stream_reports(spark, landing, root, state_root, checkpoint=ckpt)
    got = lake.read_lake(spark, root, lake.HEATING_LAKE).collect()
    assert sorted((r.trv_id, r.timestamp.day) for r in got) == [("007", 1), ("007", 2)]
    aside = spark.read.parquet(root + "-quarantine").collect()
    assert sorted((r.reason, r.epoch) for r in aside) == [("no timestamp", 1), ("unreadable report", 0)] and any("{oops" in r.row for r in aside)
    assert [(r.trv_id, r.epoch) for r in spark.read.parquet(root + "-late").collect()] == [("007", 1)]
    assert {r.source_key: r.last_interval.day for r in ingest.read_state(spark, state_root).collect()} == {"007:007": 2}


def test_stream_costs_what_it_touches(spark):
    landing = lake.new_lake_root(spark, "t-cl")
    roots = [lake.new_lake_root(spark, t) for t in ("t-cr", "t-cc", "t-ct", "t-cs")]
    fx.land_event_splits(spark, SF_SMALL, landing, splits=2, repeat=0)
    rates = fx.rates(spark, SF_SMALL).checkpoint()

    def readings(batch):
        return _events_to_readings(batch).withColumn("tariff_code", F.when(F.col("kind") == "gas", F.lit(fx.TARIFF_GAS)).otherwise(F.lit(fx.TARIFF_ELECTRICITY)))
    ingest.stream_consumption(spark, landing, fx.table(spark, SF_SMALL, "events").schema, readings, roots[0], roots[3] + "/s", max_files_per_trigger=50,
                              rates=rates, costed_root=roots[1], totals_root=roots[2])
    from intervalflow.operators.rates import rate_join
    from intervalflow.sinks import totals
    want = rate_join(fx.consumption(spark, SF_SMALL), rates, how="left")
    got = spark.read.option("basePath", roots[1]).parquet(roots[1])
    cols = ["event_id", "rate_valid_from", "unit_rate"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0 and got.count() == want.count()
    daily = totals.read_daily_totals(spark, roots[2])
    assert daily.agg(F.sum("n_intervals")).first()[0] == want.count()
    assert float(daily.agg(F.sum("kwh")).first()[0]) == float(want.agg(F.sum("consumption")).first()[0])


def test_packed_reports_stream_like_files_of_their_own(spark):
    """Two waves, the later day first, each landed in a few files: a late record and an unreadable report are kept aside."""
    from intervalflow.sources import documents
    landing, root = lake.new_lake_root(spark, "t-pland"), lake.new_lake_root(spark, "t-phs")
    state_root, ckpt = lake.new_lake_root(spark, "t-phss"), lake.new_lake_root(spark, "t-phsc")
    call = '{"callForHeat": {"dataIntervals": [{"from": "%s", "to": null, "value": "LOW"}]}}'
    waves = [[(call % "2024-01-02T10:00:00Z", "007", "2024-01-02"), ("{oops", "8", "2024-01-02")], [(call % "2024-01-01T10:00:00Z", "007", "2024-01-01")]]
    for wave in waves:
        documents.land_packed(spark.createDataFrame(wave, "value string, zone_id string, date string"), landing, ["zone_id", "date"])
        ingest.stream_reports(spark, landing, root, state_root, checkpoint=ckpt, packed=True)
    got = lake.read_lake(spark, root, lake.HEATING_LAKE).collect()
    assert sorted((r.trv_id, r.zone_id, r.timestamp.day) for r in got) == [("007", "007", 1), ("007", "007", 2)]
    assert [(r.reason, r.epoch) for r in spark.read.parquet(root + "-quarantine").collect()] == [("unreadable report", 0)]
    assert [(r.trv_id, r.epoch) for r in spark.read.parquet(root + "-late").collect()] == [("007", 1)]
