"""Re-costing after changed rates (ST8, K4): only what a change touches is costed again.

Old and new rates are compared as disjoint segments, which gives the time intervals of each key in which the rate in force differs.  Those
become days, the days' readings of those keys are read back from the lake (its ``date`` partitions prune), costed and put in place of the old
costed rows.  Everything else stays as it is.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefns import plus_micros, utc_date
from ..session import staged
from ..sinks import files, lake
from .rates import HALF_HOUR_US, normalise_rates, rate_join, rate_segments


def rate_changes(old: DataFrame, new: DataFrame, by: Sequence[str] = ("tariff_code",)) -> DataFrame:
    """``(*by, valid_from, valid_to)``: when the rate in force (any of its columns) is not the same in ``old`` and ``new``; NULL end = open.

    An interval difference by a sweep: both sides' segment starts and ends, in order of time within a key; after each, the state of either
    side is its last start or end.  Neighbouring intervals may touch."""
    by = list(by)
    o, n = normalise_rates(old), normalise_rates(new)
    cols = [c for c in [*n.columns, *[c for c in o.columns if c not in n.columns]] if c not in by]

    def turns(rates: DataFrame, side: str, other: str) -> DataFrame:
        """Instants at which a side's rate begins or ends; where one ends and another begins, the beginning counts."""
        seg = rate_segments(rates, by).filter(F.col("_seg_end").isNull() | (F.col("_seg_end") > F.col("valid_from")))
        have = {f.name: f.dataType for f in [*o.schema, *n.schema]}
        value = F.struct(*[(F.col(c) if c in rates.columns else F.lit(None)).cast(have[c]).alias(c) for c in cols])
        both = seg.select(*by, F.explode(F.array(
            F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("begins"), value.alias("rate")),
            F.struct(F.col("_seg_end").alias("at"), F.lit(0).alias("begins"), F.lit(None).cast(_struct_of(cols, have)).alias("rate")))).alias("t"))
        return both.filter("t.at IS NOT NULL").select(*by, "t.at", F.col("t.begins").alias(f"{side}_begins"), F.struct("t.rate").alias(side),
                                                      F.lit(None).cast("int").alias(f"{other}_begins"))

    both = turns(o, "o", "n").unionByName(turns(n, "n", "o"), allowMissingColumns=True)
    at = both.groupBy(*by, "at").agg(F.max_by("o", "o_begins").alias("o"), F.max_by("n", "n_begins").alias("n"))
    w = Window.partitionBy(*by).orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = at.select(*by, F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_to"),
                      F.last("o", ignorenulls=True).over(upto)["rate"].alias("o"), F.last("n", ignorenulls=True).over(upto)["rate"].alias("n"))
    return swept.filter(~F.col("o").eqNullSafe(F.col("n"))).drop("o", "n")


def _struct_of(cols: Sequence[str], types: dict) -> str:
    return "struct<" + ",".join(f"`{c}`:{types[c].simpleString()}" for c in cols) + ">"


def changed_days(changes: DataFrame, first: dt.date, last: dt.date, by: Sequence[str] = ("tariff_code",), length_us: int = HALF_HOUR_US) -> DataFrame:
    """``(*by, date)``: the ``date`` partitions (UTC day of the interval's end) between ``first`` and ``last`` that readings in changed intervals
    have; readings last ``length_us``."""
    lo = F.greatest(utc_date(plus_micros("valid_from", length_us)), F.lit(first))
    hi = F.least(F.coalesce(utc_date(plus_micros("valid_to", length_us - 1)), F.lit(last)), F.lit(last))
    return changes.filter(lo <= hi).select(*by, F.explode(F.sequence(lo, hi)).alias("date")).distinct()


def lake_days(spark: SparkSession, root: str) -> list[dt.date]:
    """The ``date`` partitions of a lake that is partitioned by date first, from the names of its folders."""
    named = [n.removeprefix("date=") for n in files.names(spark, root) if n.startswith("date=")]
    return sorted(dt.date.fromisoformat(n) for n in named if n != "__HIVE_DEFAULT_PARTITION__")


def affected_readings(spark: SparkSession, lake_root: str, old: DataFrame, new: DataFrame, by: Sequence[str] = ("tariff_code",)) -> DataFrame | None:
    """Stored readings whose rate differs between ``old`` and ``new`` or may (those of the same key and day); None if there are none.

    The days are a list of at most as many as the lake has, so the scan prunes by a constant filter."""
    days = lake_days(spark, lake_root)
    if not days:
        return None
    todo = staged(changed_days(rate_changes(old, new, by), days[0], days[-1], by), "changed")
    dates = sorted({r["date"] for r in todo.select("date").distinct().collect()} & set(days))
    if not dates:
        return None
    schema = lake.saved_schema(spark, lake_root) or lake.CONSUMPTION_LAKE
    within = F.col("date").isin(dates) if len(dates) < len(days) else F.lit(True)
    return lake.read_lake(spark, lake_root, schema).filter(within).join(todo, [*by, "date"], "left_semi")


def recost(spark: SparkSession, lake_root: str, costed_root: str, old: DataFrame, new: DataFrame, by: Sequence[str] = ("tariff_code",)) -> DataFrame | None:
    """Cost again what the change from ``old`` to ``new`` rates touches, in place; every other costed row stays.  Returns the keys and days of the
    readings that were costed (``kind, mpan_mprn, serial, usage_date``), or None.  A run that is repeated, or resumed after a failure, gives the
    same table."""
    readings = affected_readings(spark, lake_root, old, new, by)
    if readings is None:
        return None
    lake.write_costed(rate_join(readings.drop("date", "meter_bucket"), new, by=list(by), how="left"), costed_root)
    return meter_days(readings)


def cost_touched(spark: SparkSession, lake_root: str, costed_root: str, batch: DataFrame, rates: DataFrame, by: Sequence[str] = ("tariff_code",)) -> None:
    """Cost the lake partitions that a batch of readings touches, from the lake as it is now."""
    prepared = lake.prepare_consumption(batch)
    schema = lake.saved_schema(spark, lake_root) or lake.lake_schema(spark, lake_root, lake.CONSUMPTION_LAKE, prepared)
    parts = prepared.select(*lake.CONSUMPTION_PARTS).filter(F.col("date").isNotNull()).distinct()
    touched = lake.touched_partitions(spark, lake_root, schema, parts, lake.CONSUMPTION_PARTS)
    if touched is not None:
        lake.write_costed(rate_join(touched.drop("date", "meter_bucket"), rates, by=list(by), how="left"), costed_root)


def meter_days(readings: DataFrame, start: str | Column = "interval_start") -> DataFrame:
    """The meters and UTC days of usage of some readings."""
    return readings.select("kind", "mpan_mprn", "serial", F.to_date(start).alias("usage_date")).distinct()
