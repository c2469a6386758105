"""De-duplication and unions.

"Keep first" needs an explicit arrival order in a distributed job (event id, or
file name + position for landed files).  It is computed as a grouped ``min_by``
so Spark combines duplicates map-side before the shuffle; groups are the
duplicate sets themselves, so a hot meter does not make a hot group.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str | None = None) -> DataFrame:
    """One row per ``keys``; the row with the smallest ``order`` wins, nulls last.

    Ties, and inputs without an order, resolve by a hash of the other columns, so the result does not
    depend on the data's layout.  Null keys form their own group (as
    ``drop_duplicates`` does).
    """
    order = [order] if isinstance(order, str) else list(order or [])
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    # A struct is never null itself, so a row whose order is null still counts.
    tie = [c for c in rest if c not in order]
    rank = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], *([F.xxhash64(*tie)] if tie else [F.lit(0)]))
    picked = F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_kf")
    return df.groupBy(*keys).agg(picked).select(*keys, "_kf.*").select(*df.columns)


def dedup_consumption(df: DataFrame, meter_cols: Sequence[str] = ("kind", "mpan_mprn", "serial"),
                      order: str | None = None) -> DataFrame:
    """Per meter on (interval_start, interval_end) when both exist, else on the whole row."""
    meter = [c for c in meter_cols if c in df.columns]
    if {"interval_start", "interval_end"}.issubset(df.columns):
        keys = meter + ["interval_start", "interval_end"]
        return keep_first(df, keys, order)
    return df.distinct()


def dedup_rates(df: DataFrame, order: str | None = None) -> DataFrame:
    """D3: on the present subset of (valid_from, valid_to, tariff_code); NULL equals NULL."""
    keys = [c for c in ("valid_from", "valid_to", "tariff_code") if c in df.columns]
    if not keys:
        return df
    return keep_first(df, keys, order)


def union_tagged(frames: Iterable[tuple[str, DataFrame]], tag_col: str = "record_kind") -> DataFrame:
    """Union by name with a tag column, missing columns NULL."""
    tagged = [df.select(F.lit(tag).alias(tag_col), *df.columns) for tag, df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
