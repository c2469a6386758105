"""Rate joins: the reference's enrichment tests (tightened) plus plan and subset properties."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from intervalflow.operators import rates as R
from intervalflow.plans import fixtures as fx

CONS = [("2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z", 0.5), ("2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z", 0.7)]


def cons_df(spark, rows=CONS):
    return spark.createDataFrame(rows, "interval_start string, interval_end string, consumption double") \
                .withColumn("tariff_code", F.lit("T"))


def rates_df(spark, rows):
    return spark.createDataFrame(rows, "valid_from string, valid_to string, value_inc_vat double") \
                .withColumn("tariff_code", F.lit("T"))


@pytest.mark.parametrize("strategy", ["key", "bucket"])
def test_asof_basic_cost(spark, strategy):
    r = rates_df(spark, [("2023-12-31T23:30:00Z", "2024-01-01T00:30:00Z", 0.30), ("2024-01-01T00:30:00Z", None, 0.28)])
    out = R.rate_join(cons_df(spark), r, strategy=strategy)
    rows = out.orderBy("interval_start").collect()
    assert len(rows) == 2
    assert round(sum(x.cost for x in rows), 6) == round(0.5 * 0.30 + 0.7 * 0.28, 6)
    assert [x.unit_rate for x in rows] == [0.30, 0.28]
    assert "rate_valid_from" in out.columns and "rate_tariff_code" in out.columns


@pytest.mark.parametrize("strategy", ["key", "bucket"])
def test_asof_gap_matches_exactly_one(spark, strategy):
    r = rates_df(spark, [("2023-12-31T23:30:00Z", "2024-01-01T00:15:00Z", 0.30)])
    rows = R.rate_join(cons_df(spark), r, strategy=strategy).collect()
    assert len(rows) == 1 and rows[0].interval_start == ts("2024-01-01 00:00:00")


def test_asof_expired_newest_rate_is_unmatched(spark):
    # An older, longer rate is NOT used when the newest one has expired
    r = rates_df(spark, [("2024-01-01T00:00:00Z", None, 0.9), ("2024-01-01T00:10:00Z", "2024-01-01T00:20:00Z", 0.1)])
    rows = R.rate_join(cons_df(spark), r).orderBy("interval_start").collect()
    assert [x.unit_rate for x in rows] == [0.9]


def test_asof_left_keeps_unmatched(spark):
    r = rates_df(spark, [("2023-12-31T23:30:00Z", "2024-01-01T00:15:00Z", 0.30)])
    rows = R.rate_join(cons_df(spark), r, how="left").orderBy("interval_start").collect()
    assert [x.cost is None for x in rows] == [False, True]


def test_asof_edges_empty_and_missing_valid_from(spark):
    c = cons_df(spark)
    empty = rates_df(spark, []).limit(0)
    assert R.rate_join(c, empty).count() == 2 and "cost" not in R.rate_join(c, empty).columns
    no_vf = spark.createDataFrame([(0.3,)], "value_inc_vat double").withColumn("tariff_code", F.lit("T"))
    assert "cost" not in R.rate_join(c, no_vf).columns


def test_asof_derives_start_from_end_and_ex_vat(spark):
    c = spark.createDataFrame([("2024-01-01T01:00:00Z", 2.0)], "interval_end string, consumption double") \
             .withColumn("tariff_code", F.lit("T"))
    r = spark.createDataFrame([("2024-01-01T00:00:00Z", None, 0.25)], "valid_from string, valid_to string, value_ex_vat double") \
             .withColumn("tariff_code", F.lit("T"))
    row = R.rate_join(c, r).first()
    assert row.interval_start == ts("2024-01-01 00:30:00") and row.cost == 0.5


def test_tie_on_valid_from_prefers_open_ended(spark):
    r = rates_df(spark, [("2024-01-01T00:00:00Z", "2024-01-01T00:20:00Z", 0.1), ("2024-01-01T00:00:00Z", None, 0.2)])
    rows = R.rate_join(cons_df(spark), r).collect()
    assert sorted(x.unit_rate for x in rows) == [0.2, 0.2]


def test_interval_join_nested_loop_recomputation(spark):
    r = rates_df(spark, [("2023-12-31T23:30:00Z", "2024-01-01T00:30:00Z", 0.30), ("2024-01-01T00:30:00Z", None, 0.28)])
    out = R.rate_join_interval(cons_df(spark), r).collect()
    cons, rates = CONS, [(ts("2023-12-31 23:30:00"), ts("2024-01-01 00:30:00"), 0.30), (ts("2024-01-01 00:30:00"), None, 0.28)]
    expect = []
    for s, _, c in cons:
        t = ts(s.replace("Z", "").replace("T", " "))
        for vf, vt, v in rates:
            if t >= vf and (vt is None or t < vt):
                expect.append(c * v)
    assert round(sum(x.cost for x in out), 4) == round(sum(expect), 4)


def _plan_a(cons, rates, by):
    """Cross-check plan: tag-union both sides, last rate (ignore nulls) up to each reading."""
    n = R.normalise_rates(rates)
    seg = R.rate_segments(n, by)
    r = seg.select(*by, F.col("valid_from").alias("t"), F.lit(0).alias("side"),
                   F.struct("valid_from", "_seg_end", "value_inc_vat").alias("rate"))
    c = cons.select(*by, F.col("interval_start").alias("t"), F.lit(1).alias("side"),
                    F.lit(None).cast(r.schema["rate"].dataType).alias("rate"), "interval_start", "mpan_mprn", "serial")
    u = r.withColumn("interval_start", F.lit(None).cast("timestamp_ntz")).withColumn("mpan_mprn", F.lit(None).cast("string")) \
         .withColumn("serial", F.lit(None).cast("string")).unionByName(c)
    w = Window.partitionBy(*by).orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("hit", F.last("rate", ignorenulls=True).over(w)).filter("side = 1")
    ok = F.col("hit").isNotNull() & (F.col("hit._seg_end").isNull() | (F.col("interval_start") < F.col("hit._seg_end")))
    return u.filter(ok).select("mpan_mprn", "serial", "interval_start", F.col("hit.valid_from").alias("rate_valid_from"))


def test_plans_agree_on_fixture(spark):
    cons, rates = fx.consumption(spark, SF_SMALL), fx.rates(spark, SF_SMALL)
    cols = ["mpan_mprn", "serial", "interval_start", "rate_valid_from"]
    key = R.rate_join(cons, rates, strategy="key").select(*cols)
    bucket = R.rate_join(cons, rates, strategy="bucket", broadcast_max_rows=0).select(*cols)
    a = _plan_a(cons, rates, ["tariff_code"]).select(*cols)
    assert key.count() > 0
    assert key.exceptAll(bucket).count() == 0 and bucket.exceptAll(key).count() == 0
    assert key.exceptAll(a).count() == 0 and a.exceptAll(key).count() == 0


def test_asof_subset_of_interval_join(spark):
    cons, rates = fx.consumption(spark, SF_SMALL), fx.rates(spark, SF_SMALL)
    cols = ["mpan_mprn", "serial", "interval_start", "rate_valid_from"]
    asof = R.rate_join(cons, rates).select(*cols)
    inter = R.rate_join_interval(cons, rates).select(*cols)
    assert asof.exceptAll(inter).count() == 0


def test_prorated_weights_sum_to_coverage(spark):
    r = rates_df(spark, [("2024-01-01T00:00:00Z", "2024-01-01T00:15:00Z", 0.30), ("2024-01-01T00:20:00Z", None, 0.10)])
    out = R.rate_join_prorated(cons_df(spark), r).orderBy("interval_start", "rate_valid_from").collect()
    assert [(x.weight, round(x.cost, 6)) for x in out] == [(0.5, 0.075), (1 / 3, round(0.5 * 0.1 / 3, 6)), (1.0, 0.07)]


def test_missing_intervals_reference_cases(spark):
    from intervalflow.operators.quality import missing_intervals

    def run(ends):
        df = spark.createDataFrame([("m", e) for e in ends], "m string, e string") \
                  .withColumn("interval_end", F.to_timestamp_ntz(F.regexp_replace("e", "Z$", "")))
        r = missing_intervals(df, ["m"]).first()
        return r.expected, r.actual, r.missing

    assert run(["2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z"]) == (2, 2, 0)   # contiguous
    assert run(["2024-01-01T00:30:00Z", "2024-01-01T01:30:00Z"]) == (3, 2, 1)   # one slot missing
    assert run(["2024-01-01T00:30:00Z"]) == (1, 1, 0)                            # fewer than two rows
    # duplicates count as actual rows (reference rule) but not in the distinct variant
    df = spark.createDataFrame([("m", "2024-01-01 00:30:00"), ("m", "2024-01-01 00:30:00"), ("m", "2024-01-01 01:30:00")],
                               "m string, e string").withColumn("interval_end", F.to_timestamp_ntz("e"))
    r = missing_intervals(df, ["m"]).first()
    assert (r.expected, r.actual, r.missing, r.missing_distinct) == (3, 3, 0, 1)


def _plan(df):
    df.collect()  # AQE: read the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_asof_plan_broadcasts_checked_side_and_skips_reading_shuffle(spark):
    cons = fx.consumption(spark, SF_SMALL).checkpoint()
    rates = fx.rates(spark, SF_SMALL)
    plan = _plan(R.rate_join(cons, rates, strategy="bucket"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the rate segments are staged and the readings are not shuffled
    assert "Exchange hashpartitioning" not in plan


def test_asof_plan_over_bound_shuffles_on_tariff_and_day(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = R.rate_join(fx.consumption(spark, SF_SMALL), fx.rates(spark, SF_SMALL), strategy="bucket",
                        broadcast_max_rows=0)
        plan = _plan(j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "_lb" in plan and "_rb" in plan


def test_strategy_choice_follows_rate_shape(spark):
    two = R.staged_rates(R.normalise_rates(fx.rates(spark, SF_SMALL)), ["tariff_code"])[1]
    many = R.staged_rates(R.normalise_rates(fx.rates(spark, SF_SMALL, "many")), ["tariff_code"])[1]
    assert two.strategy() == "bucket" and two.max_per_key > R.KEY_JOIN_MAX_CANDIDATES
    assert many.strategy() == "key" and many.max_per_key <= R.KEY_JOIN_MAX_CANDIDATES
    assert two.clip is not None and two.row_bytes > 0
    assert two.strategy(0) == many.strategy(0) == "merge"           # nothing may be broadcast


@pytest.mark.parametrize("shape", ["two", "many"])
def test_merge_join_equals_the_others(spark, shape):
    """One hot tariff and many, left join, groups far smaller than a tariff's readings, rows that cannot be hashed."""
    cons = fx.consumption(spark, SF_SMALL) if shape == "two" else fx.consumption_many_keys(spark, SF_SMALL)
    cons = cons.withColumn("extra", F.create_map(F.lit("k"), F.col("event_id")))
    rates = fx.rates(spark, SF_SMALL, shape)
    cols = ["event_id", "interval_start", "tariff_code", "rate_tariff_code", "rate_valid_from", "rate_valid_to", "rate_value_inc_vat"]
    cand, _ = R.staged_rates(R.normalise_rates(rates), ["tariff_code"])
    want = R.rate_join(cons, rates, how="left", strategy="bucket").select(*cols)
    for rows in (40, 10**6):
        got = R._merge_join(cons, cand, ["tariff_code"], "interval_start", "rate_valid_from", "_seg_end", "left", rows).select(*cols)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    inner = R.rate_join(cons, rates, broadcast_max_rows=0)
    assert "unit_rate" in inner.columns and inner.count() == want.filter("rate_valid_from IS NOT NULL").count()


def test_merge_join_shuffles_once_without_day_rows(spark):
    cons = fx.consumption(spark, SF_SMALL).checkpoint()
    cand, _ = R.staged_rates(R.normalise_rates(fx.rates(spark, SF_SMALL)), ["tariff_code"])
    plan = _plan(R._merge_join(cons, cand, ["tariff_code"], "interval_start", "rate_valid_from", "_seg_end", "left", 200))
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning(_g") == 1 and "Join" not in plan


def test_merge_join_of_null_keys_and_times(spark):
    t = "2024-01-01 00:00:00"
    cons = spark.createDataFrame([(1, None, t), (2, "T", None), (3, "T", t), (4, "T", "2023-12-31 23:59:59"), (5, "U", t)], "id int, tariff_code string, s string") \
                .select("id", "tariff_code", F.to_timestamp_ntz("s").alias("interval_start"))
    rates = spark.createDataFrame([("T", t, 1.0), (None, t, 2.0)], "tariff_code string, valid_from string, value_inc_vat double")
    got = {r.id: r.unit_rate for r in R.rate_join(cons, rates, how="left", strategy="merge").collect()}
    assert got == {1: None, 2: None, 3: 1.0, 4: None, 5: None}


def test_prorated_remainder_adds_up(spark):
    rows = [("T", "2024-01-01 00:00:00", "2024-01-01 00:15:00", 0.3), ("T", "2024-01-01 00:20:00", "2024-01-02 00:10:00", 0.1), ("T", "2024-03-01 00:00:00", None, 0.5)]
    rates = spark.createDataFrame(rows, "tariff_code string, valid_from string, valid_to string, value_inc_vat double")
    times = ["2023-12-31 23:45:00", "2024-01-01 00:00:00", "2024-01-01 23:45:00", "2024-02-10 10:00:00", "2030-01-01 00:00:00", "1969-05-05 00:00:00"]
    cons = spark.createDataFrame([(i, k, t, 1.0) for i, t in enumerate(times) for k in ("T", "U")], "id int, tariff_code string, s string, consumption double") \
                .select("id", "tariff_code", F.to_timestamp_ntz("s").alias("interval_start"), (F.to_timestamp_ntz("s") + F.expr("INTERVAL 30 MINUTES")).alias("interval_end"), "consumption")
    for empty in (False, True):
        used = rates.limit(0) if empty else rates
        out = R.rate_join_prorated(cons, used, remainder=True)
        sums = out.groupBy("id", "tariff_code").agg(F.sum("weight").alias("w"), F.count("cost").alias("priced")).collect()
        assert len(sums) == 12 and all(abs(r.w - 1) < 1e-12 for r in sums)
        assert {"rate_valid_from", "unit_rate", "cost", "rate_segment_end"} <= set(out.columns)
        got = sorted((r.id, str(r.unpriced_from)[11:16], str(r.unpriced_to)[11:16]) for r in out.filter("cost IS NULL AND tariff_code = 'T'").collect())
        part = [(0, "23:45", "00:00"), (1, "00:15", "00:20"), (2, "00:10", "00:15"), (3, "10:00", "10:30"), (5, "00:00", "00:30")]
        assert empty or got == part
    assert R.rate_join_prorated(cons, rates.limit(0)).count() == 0
