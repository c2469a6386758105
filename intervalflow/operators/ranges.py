"""Rows in order over many tasks: groups of consecutive rows of nearly equal size.

``repartitionByRange`` balances partitions by sampled keys but leaves no column that says where a row went.  Here its partitions' least keys
become bounds, and any row, of the same table or another, finds its group by a binary search over them inside an expression.  Rows of a
group can then meet in one exchange, and rows of another table can be copied to just the groups that their range covers.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds are one literal in the plan, 8 bytes a column each.
MAX_GROUPS = 1 << 16


def group_bounds(df: DataFrame, cols: Sequence[str], rows_a_group: int, most: int = MAX_GROUPS) -> list[tuple[int, ...]]:
    """Least key of each group of ``df`` in the order of the BIGINT columns ``cols``, which hold no null.  Two jobs that read these columns
    alone; at most ``most`` rows come to the driver."""
    groups = max(1, min(most, df.count() // rows_a_group))
    if groups == 1:
        return [(-(1 << 63),) * len(cols)]
    parts = df.select(*cols).repartitionByRange(groups, *cols).groupBy(F.spark_partition_id().alias("part"))
    return sorted(tuple(r["first"]) for r in parts.agg(F.min(F.struct(*cols)).alias("first")).collect())


def group_of(bounds: list[tuple[int, ...]], key: Sequence[Column]) -> Column:
    """Number of the last group whose least key is at or before ``key``; 0 for a key before all."""
    if len(bounds) == 1:
        return F.lit(0)
    columns = [F.from_json(F.lit(json.dumps(list(c))), "array<bigint>") for c in zip(*bounds)]

    def reached(at: Column) -> Column:
        out = F.lit(True)
        for fixed, k in reversed(list(zip(columns, key))):
            first = F.get(fixed, at)
            out = (first < k) | ((first == k) & out)
        return out

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"] + 1) / 2).cast("int")
        return F.when(reached(mid), F.struct(mid.alias("lo"), s["hi"].alias("hi"))).otherwise(
            F.struct(s["lo"].alias("lo"), F.greatest(mid - 1, s["lo"]).alias("hi")))

    steps = F.sequence(F.lit(1), F.lit((len(bounds) - 1).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds) - 1).alias("hi"))
    return F.aggregate(steps, start, halve, lambda s: s["lo"])
