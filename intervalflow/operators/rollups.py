"""Roll-ups: daily / monthly totals (A9), bills and their reconciliation (A12), cross-domain daily table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sums(cols: dict[str, str]) -> list:
    return [F.sum(src).alias(name) for name, src in cols.items()]


def usage_daily(df: DataFrame, by: Sequence[str], ts_col: str = "interval_start",
                measures: dict[str, str] | None = None) -> DataFrame:
    """A9 daily: totals per group and UTC day of ``ts_col``; partial aggregation map-side."""
    measures = measures or {"kwh": "consumption", "cost": "cost"}
    aggs = _sums(measures) + [F.count(F.lit(1)).alias("n_intervals")]
    if "cost" in df.columns:
        aggs.append(F.count("cost").alias("n_priced"))
    return df.withColumn("usage_date", F.to_date(ts_col)).groupBy(*by, "usage_date").agg(*aggs)


def usage_rollup(df: DataFrame, by: Sequence[str], ts_col: str = "interval_start",
                 measures: dict[str, str] | None = None) -> DataFrame:
    """Day, month and whole-period totals per group in one pass (grouping sets)."""
    measures = measures or {"kwh": "consumption", "cost": "cost"}
    base = df.withColumn("usage_month", F.trunc(F.to_date(ts_col), "month")) \
             .withColumn("usage_date", F.to_date(ts_col))
    by = list(by)
    sets = [by + ["usage_month", "usage_date"], by + ["usage_month"], by]
    g = base.groupingSets(sets, *by, "usage_month", "usage_date")
    level = (F.when(F.grouping("usage_date") == 0, F.lit("day"))
              .when(F.grouping("usage_month") == 0, F.lit("month"))
              .otherwise(F.lit("total")))
    return g.agg(*_sums(measures), F.count(F.lit(1)).alias("n_intervals"), level.alias("grain"))


def bill(daily: DataFrame, charges: DataFrame, by: Sequence[str], charge_keys: Sequence[str],
         month_col: str = "usage_month") -> DataFrame:
    """Energy cost plus standing charge per group and month.

    ``daily`` is :func:`usage_daily` output; ``charges`` holds ``standing_charge`` per day
    keyed by ``charge_keys`` (a configuration table).  Standing cost = charge x days with data.
    """
    d = daily.withColumn(month_col, F.trunc("usage_date", "month"))
    m = d.groupBy(*by, month_col).agg(F.sum("kwh").alias("kwh"), F.sum("cost").alias("energy_cost"),
                                      F.count(F.lit(1)).alias("days"))
    j = m.join(charges, list(charge_keys), "left")
    std = F.col("standing_charge") * F.col("days")
    return j.withColumn("standing_cost", std) \
            .withColumn("total_cost", F.col("energy_cost") + F.coalesce(std, F.lit(0)))


def reconcile_bills(daily: DataFrame, bills: DataFrame, by: Sequence[str], tolerance: float = 0.01, charges: DataFrame | None = None,
                    charge_keys: Sequence[str] = ()) -> DataFrame:
    """Billed amounts against the costs of the same days.

    ``daily`` is :func:`usage_daily` output; ``bills(*by, bill_id, period_start, period_end, billed_amount)`` has one row a bill, whose period
    of days (the end excluded) need not be a month.  Every day belongs to the bills whose period contains it, so a day that two bills
    claim counts in both.  One row a bill, and one for each group and month of days that no bill claims:

    ``expected`` = cost of the days, plus ``standing_charge`` (by ``charge_keys``) for each day of the period; ``variance`` = billed less expected;
    ``status``: ``unbilled`` (days without a bill), ``no_usage`` (a bill without days), ``unpriced`` (readings without a rate, so there
    is no expectation), else ``within`` when the variance is at most ``tolerance`` of the expected amount, ``over`` or ``under``."""
    by = list(by)
    period = ["bill_id", "period_start", "period_end", "billed_amount"]
    claimed = bills.filter(F.col("period_start") < F.col("period_end")).select(
        *by, *period, F.explode(F.sequence("period_start", F.date_sub("period_end", 1))).alias("usage_date"))
    month = F.when(F.col("bill_id").isNull(), F.trunc("usage_date", "month"))
    days = claimed.join(daily.select(*by, "usage_date", "kwh", "cost", "n_intervals", "n_priced"), [*by, "usage_date"], "full_outer")
    one = days.withColumn("_month", month).groupBy(*by, *period, "_month").agg(
        F.sum("kwh").alias("kwh"), F.sum("cost").alias("energy_cost"), F.count("n_intervals").alias("days_used"),
        F.coalesce(F.sum(F.col("n_intervals") - F.col("n_priced")), F.lit(0).cast("long")).alias("n_unpriced"), F.min("usage_date").alias("_first"), F.max("usage_date").alias("_last"))
    if charges is not None:
        one = one.join(charges.select(*charge_keys, "standing_charge"), list(charge_keys), "left")
    standing = F.coalesce(F.col("standing_charge") * (F.datediff("period_end", "period_start")), F.lit(0)) if charges is not None else F.lit(0)
    expected = F.when(F.col("bill_id").isNotNull(), F.coalesce("energy_cost", F.lit(0)) + standing).otherwise(F.col("energy_cost"))
    out = one.withColumn("expected", expected).withColumn("variance", F.col("billed_amount") - F.col("expected"))
    status = (F.when(F.col("bill_id").isNull(), F.lit("unbilled")).when(F.col("days_used") == 0, F.lit("no_usage"))
              .when(F.col("n_unpriced") > 0, F.lit("unpriced"))
              .when(F.abs("variance") <= F.lit(tolerance) * F.abs("expected"), F.lit("within"))
              .when(F.col("variance") > 0, F.lit("over")).otherwise(F.lit("under")))
    return out.select(*by, "bill_id", F.coalesce("period_start", "_first").alias("period_start"),
                      F.coalesce("period_end", F.date_add("_last", 1)).alias("period_end"), "days_used", "kwh", "energy_cost", "n_unpriced",
                      "expected", "billed_amount", "variance", status.alias("status"))


def daily_cross_domain(energy_daily: DataFrame, heating_daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two daily aggregates on (home, date)."""
    return energy_daily.join(heating_daily, list(keys), "full_outer")
