"""Bounded training samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_of(id_col: str) -> Column:
    """crc32(id as text) mod 4; 2 marks the held-out rows."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def bounded_sample(rows: DataFrame, hashed: Sequence[str], label_col: str, per_label: int, seed: int) -> DataFrame:
    """About ``per_label`` distinct rows of every label (all rows of rarer ones), chosen by a hash of the columns ``hashed``: the same on every run.

    Those columns must tell different rows apart: of rows that are equal in them all or none are chosen, and copies of a whole row count
    and come once, so the result is bounded whatever repeats.  The number of labels must be small; one count of each comes to the driver."""
    h = F.xxhash64(*hashed, F.lit(seed))
    counts = rows.groupBy(label_col).agg(F.approx_count_distinct(h, 0.02)).collect()
    u = F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.lit(0.0)
    for r in counts:
        rate = F.when(F.col(label_col) == r[0], F.lit(min(1.0, per_label / max(r[1], 1)))).otherwise(rate)
    return rows.where(u < rate).dropDuplicates()
