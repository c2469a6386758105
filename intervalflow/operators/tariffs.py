"""Tariff discovery and resolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import first_present, parse_tariff_code
from ..functions.timefns import epoch_ntz, micros_between, to_utc, ntz_lit
from ..sources.documents import meter_points


def agreements(accounts: DataFrame, account_col: str = "account") -> DataFrame:
    """All agreements with point and agreement positions, parsed times and product code."""
    pts = meter_points(accounts, account_col)
    a = pts.select("account", "kind", "point_pos", F.posexplode("agreements").alias("ag_pos", "a"))
    vf_s, vt_s = F.col("a.valid_from"), F.col("a.valid_to")
    return a.select(
        "account", "kind", "point_pos", "ag_pos",
        first_present("a.tariff_code", "a.tariff").alias("tariff_code"),
        vf_s.alias("valid_from_raw"), vt_s.alias("valid_to_raw"),
        to_utc(F.nullif(vf_s, F.lit(""))).alias("valid_from"),
        to_utc(F.nullif(vt_s, F.lit(""))).alias("valid_to"),
    ).withColumn("product_code", parse_tariff_code("tariff_code")["product_code"])


def active_filter(ag: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``valid_from <= as_of < valid_to`` (open end allowed); unparsable dates are out."""
    t = ntz_lit(as_of)
    vt_bad = F.coalesce(F.col("valid_to_raw"), F.lit("")).__ne__("") & F.col("valid_to").isNull()
    return ag.filter(F.col("tariff_code").isNotNull() & F.col("valid_from").isNotNull() & ~vt_bad
                     & (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))


def active_tariffs(accounts: DataFrame, as_of: dt.datetime, account_col: str = "account") -> DataFrame:
    """A4: per account and kind, the active agreement with the latest ``valid_from`` whose
    product code parses; ties keep the first agreement; the first point that yields one wins.

    Computed as a grouped ``min_by`` over (point position, -valid_from, agreement position),
    which Spark pre-aggregates per task, instead of a window over each account.
    """
    ok = active_filter(agreements(accounts, account_col), as_of)
    ok = ok.filter(F.col("product_code").isNotNull() & (F.col("product_code") != ""))
    rank = F.struct(F.col("point_pos"), -micros_between(epoch_ntz(), "valid_from"), F.col("ag_pos"))
    best = F.min_by(F.struct("tariff_code", "product_code", "valid_from", "valid_to"), rank).alias("_b")
    return ok.groupBy("account", "kind").agg(best).select("account", "kind", "_b.*")


def resolve_tariff(meters: DataFrame, globals_: DataFrame, discovered: DataFrame,
                   meter_override_col: str = "tariff_code", scope_cols=("deployment",)) -> DataFrame:
    """Per-meter override, else global per (scope, kind), else discovered active tariff.

    ``globals_`` is a configuration table (scope, kind, tariff_code); ``discovered`` is the
    output of :func:`active_tariffs`.  Plain left joins: Spark broadcasts the small sides by
    their measured size and shuffles otherwise.
    """
    g = globals_.select(*scope_cols, "kind", F.col("tariff_code").alias("_global"))
    d = discovered.select("account", "kind", F.col("tariff_code").alias("_discovered"))
    j = meters.join(g, [*scope_cols, "kind"], "left").join(d, ["account", "kind"], "left")
    over = F.nullif(F.col(meter_override_col), F.lit("")) if meter_override_col in meters.columns else F.lit(None)
    src = (F.when(over.isNotNull(), F.lit("override")).when(F.col("_global").isNotNull(), F.lit("global"))
            .when(F.col("_discovered").isNotNull(), F.lit("discovered")))
    out = j.withColumn("resolved_tariff", F.coalesce(over, F.col("_global"), F.col("_discovered"))) \
           .withColumn("tariff_source", src)
    return out.drop("_global", "_discovered")
