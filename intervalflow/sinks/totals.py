"""Stored daily totals that are kept up to date load by load.

One row for each meter and UTC day of usage, replaced only where a load changed that meter's day; months and whole periods are sums of the
stored days, so no reading is read again for them.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rollups import usage_daily
from . import lake

METER = ["kind", "mpan_mprn", "serial"]


def update_daily_totals(spark: SparkSession, costed_root: str, totals_root: str, touched: DataFrame) -> None:
    """Sum the days ``touched(kind, mpan_mprn, serial, usage_date)`` anew from the costed lake and put them in place of their stored totals.

    Only the touched days' partitions are read: a day's readings end on it or at the midnight after, so they are in two ``date``
    partitions.  All other meters and days stay as they are."""
    touched = touched.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most one row for each calendar day that has readings.
        days = sorted(r["usage_date"] for r in touched.select("usage_date").distinct().collect() if r["usage_date"] is not None)
        if not days:
            return
        dates = sorted({*days, *(d + dt.timedelta(days=1) for d in days)})
        costed = lake.read_lake(spark, costed_root, lake.saved_schema(spark, costed_root)).filter(F.col("date").isin(dates)).drop("date")
        mine = costed.withColumn("usage_date", F.to_date("interval_start")).join(touched, [*METER, "usage_date"], "left_semi").drop("usage_date")
        daily = usage_daily(mine, METER).withColumnRenamed("usage_date", "date")
        lake.replace_keys(daily, totals_root, ["date"], [*METER, "date"], sort_cols=METER)
    finally:
        touched.unpersist()


def read_daily_totals(spark: SparkSession, totals_root: str) -> DataFrame:
    """``(kind, mpan_mprn, serial, usage_date, kwh, cost, n_intervals, n_priced)``."""
    return lake.read_lake(spark, totals_root, lake.saved_schema(spark, totals_root)).withColumnRenamed("date", "usage_date")


def totals_rollup(daily: DataFrame) -> DataFrame:
    """Days, months and whole periods of each meter from stored daily totals, as ``usage_rollup`` gives them from readings."""
    base = daily.withColumn("usage_month", F.trunc("usage_date", "month"))
    g = base.groupingSets([[*METER, "usage_month", "usage_date"], [*METER, "usage_month"], METER], *METER, "usage_month", "usage_date")
    level = (F.when(F.grouping("usage_date") == 0, F.lit("day")).when(F.grouping("usage_month") == 0, F.lit("month")).otherwise(F.lit("total")))
    return g.agg(F.sum("kwh").alias("kwh"), F.sum("cost").alias("cost"), F.sum("n_intervals").alias("n_intervals"), level.alias("grain"))
