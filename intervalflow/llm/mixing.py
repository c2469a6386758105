"""Mixing sources to target weights by repeating documents.

Token counts are summed by source; from them come the sources' targets and repetition rates; every document is then taken
floor(rate) times, plus once more with the probability of the rate's fraction, by a hash of its id and text: the same on
every run and on every layout of the data.

Everything is SQL.  The only rows that come together are one for each source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stage

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
SEED = 9


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_rates(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target, rate)`` of ``sizes(source, size)``.

    Sources by code point, null last, weigh ``weights``, repeating.  They share the total size by weight; a target stops at
    ``cap`` times its source's size and the excess is shared among the others by weight, until none is above.  So every target is
    the smaller of its cap and ``level * weight``; the level rises with each round that caps more sources, and is final when a
    round caps no more.  A source without words has target and rate 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source, so that a window without partitions is small.
    rank = F.expr("row_number() OVER (ORDER BY source IS NULL, encode(source, 'UTF-8')) - 1")
    per = stage(per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))), "sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= cap * F.col("source_size")
        fixed, n, free = per.agg(F.sum(F.when(over, cap * F.col("source_size")).otherwise(0.0)), F.sum(over.cast("int")),
                                 F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if not n and n != 0 or n == capped or not free:
            break
        level, capped = max(level, (total - fixed) / free), n
    target = F.least(F.col("weight") * F.lit(level), cap * F.col("source_size"))
    return stage(per.select("source", "source_size", target.alias("target"),
                            F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate")), "rates")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        count: Callable[[Column], Column] = word_count, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP,
        seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (size times copies).

    Null sources are one source.  Rows that repeat id and text get the same number of copies.  The rates are a staged table of
    one row for each source, so the join's plan follows its measured size: it is broadcast below Spark's threshold, else both
    sides shuffle and adaptive execution splits a hot source.
    """
    named = docs.select("*", F.col(source_col).cast("string").alias("__source"), count(F.col(text_col).cast("string")).alias("__size"))
    rates = source_rates(named.select(F.col("__source").alias("source"), F.col("__size").alias("size")), weights, cap)
    u = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    r = rates.select(F.col("source").alias("__s"), "source_size", "target", "rate")
    joined = named.drop("source_size", "target", "rate").join(r, F.col("__source").eqNullSafe(F.col("__s")))
    whole = F.floor("rate")
    out = joined.withColumn("copies", (whole + (u < F.col("rate") - whole).cast("int")).cast("int"))
    return (out.drop("size", "taken").withColumnRenamed("__size", "size").withColumn("taken", F.col("size") * F.col("copies"))
            .drop("__source", "__s", "rate"))


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Every row ``copies`` times."""
    return mixed.where("copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).drop("__copy")
