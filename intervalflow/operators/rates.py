"""Rate joins: as-of (J1), interval (J2), prorated (J8), unmatched report (J7), S3, P10-P12.

Spark has no user-facing as-of join, so it is composed from built-ins:

1. Rates are turned into *disjoint segments* ``[valid_from, least(next valid_from, valid_to))``
   with ``lead`` over each key (rates are a small, time-driven dimension).  A reading at
   instant ``t`` then matches at most one segment, exactly the one an as-of lookup picks
   (greatest ``valid_from <= t``, then the ``valid_to`` check).
2. The segments are staged (they are read for statistics and for the join) and joined to readings in one
   of three physical shapes, chosen from one aggregate over the staged table:

   * ``key``    - equi-join on ``by`` only; used when every key has few rates, so the
                  residual scans a short list per reading.
   * ``bucket`` - segments are exploded into the UTC days they cover and the join is on
                  ``(by, day)``; keeps the residual short when a few tariffs carry many
                  rates (the natural shape: few tariffs x many meters).  Open-ended
                  segments are clipped at the last rate instant, and readings after that
                  day look up the clip day, so nothing is unbounded.
   * ``merge``  - readings and segments meet in order of (key, time): readings are dealt into groups
                  of consecutive (key, time), each segment goes to the groups it covers, and inside a
                  group the last segment before a reading is its rate.  No day rows, no clip day, no
                  salts; one hot tariff is spread over as many tasks as its readings need.

   ``key`` and ``bucket`` are taken where the same aggregate proves that the candidate side may be
   broadcast; otherwise both sides are shuffled by ``merge``.  Readings are never collected or grouped.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import energy_from_code, parse_tariff_code
from ..functions.timefns import epoch_micros, micros_between, ntz_lit, plus_micros, to_utc_col, utc_date
from ..session import staged
from .ranges import group_bounds, group_of

HALF_HOUR_US = 1_800_000_000
KEY_JOIN_MAX_CANDIDATES = 64
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20
CLIP_SALTS = 16
#: Readings in a group of the merge join.
MERGE_GROUP_ROWS = 50_000
_LEAST, _LAST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class CandidateStats:
    rows: int
    max_per_key: int
    keys: int
    floor: object         # first and last start, python datetimes (NTZ) or None
    clip: object
    day_rows: int         # (candidate, day) rows of the bucket join
    row_bytes: float      # mean size of a row

    def strategy(self, max_rows: int = BROADCAST_MAX_ROWS) -> str:
        shape, rows = ("key", self.rows) if self.max_per_key <= KEY_JOIN_MAX_CANDIDATES else ("bucket", self.day_rows)
        return shape if self.may_broadcast(rows, max_rows) else "merge"

    def may_broadcast(self, rows: int, max_rows: int) -> bool:
        """A hint overrides Spark's own byte limit, so it needs a row bound and a byte bound."""
        return rows <= max_rows and rows * max(self.row_bytes, 1) <= BROADCAST_MAX_BYTES


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: text by its bytes, other columns 16 each."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    return sum(text, F.lit(16 * len(df.columns))).cast("long")


def _candidate_stats(cand: DataFrame, by: Sequence[str], lo: str, hi: str) -> CandidateStats:
    """One job over the staged rate side: row count, largest key, size, the clip instant and how many day rows there would be.

    The clip is the last ``lo``: no later day tells two candidates apart, so an end that is open or far in the
    future needs no day rows beyond it.
    """
    clipped = cand.crossJoin(F.broadcast(cand.agg(F.max(lo).alias("_clip"))))          # one row
    days = F.size(_day_range(lo, hi, utc_date(lo), utc_date("_clip")))
    per_key = clipped.groupBy(*by).agg(F.count(F.lit(1)).alias("k"), F.min(lo).alias("floor"), F.max("_clip").alias("clip"),
                                       F.sum(days).alias("days"), F.sum(_row_bytes(cand)).alias("bytes"))
    row = per_key.agg(F.sum("k").alias("rows"), F.max("k").alias("max_per_key"), F.count(F.lit(1)).alias("keys"), F.min("floor").alias("floor"),
                      F.max("clip").alias("clip"), F.sum("days").alias("days"), F.sum("bytes").alias("bytes")).first()
    rows = int(row["rows"] or 0)
    return CandidateStats(rows, int(row["max_per_key"] or 0), row["keys"], row["floor"], row["clip"], int(row["days"] or 0),
                          (row["bytes"] or 0) / max(rows, 1))


def _day_range(lo: str, hi: str, floor_day: Column, clip_day: Column) -> Column:
    """The UTC days of ``[lo, hi)`` from the floor day up to the clip day."""
    first = F.greatest(utc_date(lo), floor_day)
    return F.sequence(first, F.greatest(first, F.least(F.coalesce(utc_date(plus_micros(hi, -1)), clip_day), clip_day)))


def _ts_lit(value) -> Column:
    return ntz_lit(value)


def normalise_readings(cons: DataFrame) -> DataFrame:
    """P1/P2 on a reading table: UTC NTZ times, ``interval_start`` derived when absent."""
    out = cons
    if "interval_end" in out.columns:
        out = out.withColumn("interval_end", to_utc_col(out, "interval_end"))
    if "interval_start" not in out.columns:
        out = out.withColumn("interval_start", plus_micros("interval_end", -HALF_HOUR_US))
    else:
        out = out.withColumn("interval_start", to_utc_col(out, "interval_start"))
    return out


def normalise_rates(rates: DataFrame) -> DataFrame:
    out = rates.withColumn("valid_from", to_utc_col(rates, "valid_from"))
    if "valid_to" in out.columns:
        out = out.withColumn("valid_to", to_utc_col(out, "valid_to"))
    else:
        out = out.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    return out.filter(F.col("valid_from").isNotNull())


def rate_segments(rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Disjoint as-of segments, end in ``_seg_end`` (NULL = open).

    Ties on ``valid_from`` (X11): open-ended first, then later ``valid_to``, then the higher
    value wins; losers get an empty segment and never match.
    """
    value_cols = [c for c in ("value_inc_vat", "value_ex_vat") if c in rates.columns]
    order = [F.col("valid_from").asc(), F.col("valid_to").isNull().asc(),
             F.col("valid_to").asc_nulls_last()] + [F.col(c).asc_nulls_first() for c in value_cols]
    w = Window.partitionBy(*by).orderBy(*order)
    return rates.withColumn("_seg_end", F.least(F.lead("valid_from").over(w), F.col("valid_to")))


def _prefixed(rates: DataFrame, by: Sequence[str], prefix: str = "rate_") -> DataFrame:
    keep = [c for c in rates.columns if not c.startswith("_")]
    extra = [c for c in rates.columns if c.startswith("_")]
    return rates.select(*[F.col(c).alias(prefix + c) for c in keep], *extra)


def _salt(df: DataFrame) -> Column:
    """A hash that tells rows of one key and time apart; columns that cannot be compared take no part."""
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def _meet_days(left: DataFrame, cand: DataFrame, lo: str, hi: str, days: Column, floor_day: Column, clip_day: Column) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Both sides with a row for each day they share: ``days`` of ``left``, and the days of ``[lo, hi)``.  All readings from the
    last rate change on meet on the clip day: there they are salted, and the candidates repeat."""
    salts = F.sequence(F.lit(0), F.lit(CLIP_SALTS - 1))
    cand = cand.withColumn("_rb", F.explode(_day_range(lo, hi, floor_day, clip_day)))
    cand = cand.withColumn("_rs", F.explode(F.when(F.col("_rb") == clip_day, salts).otherwise(F.array(F.lit(0)))))
    salt = F.pmod(_salt(left), F.lit(CLIP_SALTS)).cast("int")
    left = left.withColumn("_lb", F.explode(days))
    left = left.withColumn("_ls", F.when(F.col("_lb") == clip_day, salt).otherwise(0))
    return left, cand, [F.col("_lb") == F.col("_rb"), F.col("_ls") == F.col("_rs")]


def _point_join(left: DataFrame, cand: DataFrame, by: Sequence[str], t: str, lo: str, hi: str,
                how: str, strategy: str, stats: CandidateStats, broadcast_max_rows: int) -> DataFrame:
    """Readings whose instant ``t`` lies in a candidate's ``[lo, hi)`` (``hi`` NULL = open)."""
    cand = cand.filter(F.col(hi).isNull() | (F.col(hi) > F.col(lo)))
    cond = (F.col(t) >= F.col(lo)) & (F.col(hi).isNull() | (F.col(t) < F.col(hi)))
    for b in by:
        cond = (F.col(b) == F.col("rate_" + b)) & cond
    rows = stats.rows
    if strategy == "bucket":
        clip_day = F.to_date(_ts_lit(stats.clip))
        left, cand, same_day = _meet_days(left, cand, lo, hi, F.array(F.least(utc_date(t), clip_day)), utc_date(lo), clip_day)
        cond = same_day[0] & same_day[1] & cond
        rows = stats.day_rows
    if stats.may_broadcast(rows, broadcast_max_rows):
        cand = F.broadcast(cand)
    return left.join(cand, cond, how).drop("_lb", "_rb", "_ls", "_rs", "_seg_end")


def _merge_join(left: DataFrame, cand: DataFrame, by: Sequence[str], t: str, lo: str, hi: str, how: str,
                group_rows: int = MERGE_GROUP_ROWS) -> DataFrame:
    """Readings with the candidate whose disjoint ``[lo, hi)`` holds their instant ``t``, by a merge in order of (key, time).

    Readings are dealt into groups of consecutive (hash of the key, time, hash of the row), so even the readings of one key and instant
    fill several groups.  A candidate is copied to the groups from its start to its end, all but the first of which it enters with a start
    before theirs: that is the rate carried over.  In a group the last candidate before a reading decides."""
    cand = cand.filter(F.col(hi).isNull() | (F.col(hi) > F.col(lo)))
    for b in by:
        cand = cand.filter(F.col("rate_" + b).isNotNull())
    key = F.xxhash64(*[F.col(b).cast("string") for b in by])
    at = F.coalesce(epoch_micros(t), F.lit(_LEAST))
    keyed = left.select(key.alias("_k"), at.alias("_t"), _salt(left).alias("_s"), F.struct(*left.columns).alias("_row"))
    bounds = group_bounds(keyed, ["_k", "_t", "_s"], group_rows)
    rates = cand.select(F.xxhash64(*[F.col("rate_" + b).cast("string") for b in by]).alias("_k"), epoch_micros(lo).alias("_t"),
                        F.coalesce(epoch_micros(hi) - 1, F.lit(_LAST)).alias("_to"), F.struct(*cand.columns).alias("_rate"))
    k, least, last = F.col("_k"), F.lit(_LEAST), F.lit(_LAST)
    rates = rates.withColumn("_g", F.explode(F.sequence(group_of(bounds, [k, F.col("_t"), least]), group_of(bounds, [k, F.col("_to"), last]))))
    rows = keyed.withColumn("_g", group_of(bounds, [k, F.col("_t"), F.col("_s")]))
    none = F.lit(None)
    both = (rates.select("_g", *[F.col(f"_rate.rate_{b}").cast("string").alias(f"_by_{b}") for b in by], "_t", F.lit(0).alias("_side"),
                         none.cast(rows.schema["_row"].dataType).alias("_row"), "_rate")
            .unionByName(rows.select("_g", *[F.col(f"_row.{b}").cast("string").alias(f"_by_{b}") for b in by], "_t", F.lit(1).alias("_side"),
                                     "_row", none.cast(rates.schema["_rate"].dataType).alias("_rate"))))
    before = Window.partitionBy("_g", *[f"_by_{b}" for b in by]).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = (both.repartition(len(bounds), "_g").withColumn("_found", F.last("_rate", ignorenulls=True).over(before))
             .filter("_side = 1").select("_row.*", "_found"))
    end = F.col(f"_found.{hi}")
    hit = F.col("_found").isNotNull() & (end.isNull() | (F.col(t) < end)) & F.col(t).isNotNull()
    if how == "inner":
        found = found.filter(hit)
    names = [c for c in cand.columns if c != "_seg_end"]
    return found.select(*left.columns, *[F.when(hit, F.col(f"_found.{c}")).alias(c) for c in names])


def _with_cost(df: DataFrame, rate_cols: Sequence[str], per_row: bool = False) -> DataFrame:
    """Unit rate from inc-VAT column if present (per table), else ex-VAT; cost."""
    inc, ex = "rate_value_inc_vat", "rate_value_ex_vat"
    if per_row and inc in rate_cols and ex in rate_cols:
        unit = F.coalesce(F.col(inc), F.col(ex))
    elif inc in rate_cols:
        unit = F.col(inc)
    elif ex in rate_cols:
        unit = F.col(ex)
    else:
        return df
    out = df.withColumn("unit_rate", unit)
    if "consumption" in df.columns:
        out = out.withColumn("cost", F.col("consumption") * F.col("unit_rate"))
    return out


def _no_rates(cons: DataFrame, rates: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Readings when there is no rate: NULL rate columns of the right types for a left join."""
    if how != "left":
        return cons
    cand = _prefixed(normalise_rates(rates), by)
    out = cons.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in cand.schema if f.name.startswith("rate_")])
    return _with_cost(out, cand.columns)


def rate_join(cons: DataFrame, rates: DataFrame, by: Sequence[str] = ("tariff_code",), how: str = "inner",
              strategy: str = "auto", per_row_rate: bool = False,
              broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """As-of (backward) rate join with cost.

    For each reading, the rate with the greatest ``valid_from <= interval_start`` is taken,
    then kept only if ``valid_to`` is NULL or later (F1).  ``how='inner'`` drops unmatched
    readings (reference behaviour); ``how='left'`` keeps them with NULL rate columns.
    Rate columns are prefixed ``rate_`` (P12); ``unit_rate`` and ``cost`` follow P10/P11.
    Empty rates, or rates without ``valid_from``, return the readings unchanged, with ``how='left'`` with
    the rate columns that there are, all NULL, so later steps find them.
    """
    by = list(by)
    cons = normalise_readings(cons)
    if "valid_from" not in rates.columns:
        return cons
    cand, stats = staged_rates(normalise_rates(rates), by)
    if stats.rows == 0:
        return _no_rates(cons, rates, by, how)
    strategy = stats.strategy(broadcast_max_rows) if strategy == "auto" else strategy
    if strategy == "merge":
        out = _merge_join(cons, cand, by, "interval_start", "rate_valid_from", "_seg_end", how)
    else:
        out = _point_join(cons, cand, by, "interval_start", "rate_valid_from", "_seg_end", how,
                          strategy, stats, broadcast_max_rows)
    rate_cols = [c for c in cand.columns if c.startswith("rate_")]
    return _with_cost(out, rate_cols, per_row_rate)


def staged_rates(rates: DataFrame, by: Sequence[str], disjoint: bool = True) -> tuple[DataFrame, CandidateStats]:
    """Rates, as as-of segments if ``disjoint``, with the prefix of rate columns, written once to the shared folder, and their statistics:
    however costly the rates are to make, it happens once."""
    cand = staged(_prefixed(rate_segments(rates, by) if disjoint else rates, by), "rates")
    return cand, _candidate_stats(cand, ["rate_" + b for b in by], "rate_valid_from", "_seg_end" if disjoint else "rate_valid_to")


def rate_join_interval(cons: DataFrame, rates: DataFrame, by: Sequence[str] = ("tariff_code",),
                       how: str = "inner", strategy: str = "auto",
                       broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Every rate whose ``[valid_from, valid_to)`` covers ``interval_start``."""
    by = list(by)
    cons = normalise_readings(cons)
    cand, stats = staged_rates(normalise_rates(rates), by, disjoint=False)
    if stats.rows == 0:
        return _no_rates(cons, rates, by, how)
    # Overlapping rates: several may hold at once, so there is no merge; without a broadcast both sides meet by key and day.
    if strategy == "auto":
        strategy = "key" if stats.max_per_key <= KEY_JOIN_MAX_CANDIDATES else "bucket"
    out = _point_join(cons, cand, by, "interval_start", "rate_valid_from", "rate_valid_to", how,
                      strategy, stats, broadcast_max_rows)
    return _with_cost(out, [c for c in cand.columns if c.startswith("rate_")])


def rate_join_prorated(cons: DataFrame, rates: DataFrame, by: Sequence[str] = ("tariff_code",),
                       broadcast_max_rows: int = BROADCAST_MAX_ROWS, remainder: bool = False) -> DataFrame:
    """Split each reading over the as-of segments it overlaps.

    ``weight`` = overlap / reading length; ``cost`` = consumption x weight x unit rate.
    Overlap join on day buckets: a reading and a segment meet only in the first day both
    cover (clipped like :func:`rate_join`), so each pair is emitted once.

    With ``remainder`` the parts of a reading that no segment covers come out too, with NULL rate columns and cost and, in
    ``unpriced_from`` and ``unpriced_to``, what they cover; the weights of a reading then add up to 1.  The parts are the key's gaps:
    before its first segment, between segments and after the last.  Without any rate the rate columns are there, all NULL.
    """
    by = list(by)
    cons = normalise_readings(cons)
    if "valid_from" not in rates.columns:
        return cons
    cand, stats = staged_rates(normalise_rates(rates), by)
    rate_cols = [c for c in cand.columns if c.startswith("rate_")]
    cand = cand.filter(F.col("_seg_end").isNull() | (F.col("_seg_end") > F.col("rate_valid_from")))
    cand = cand.withColumns({"_lo": F.col("rate_valid_from"), "_hi": F.col("_seg_end"), **{f"_by_{b}": F.col(f"rate_{b}") for b in by}})
    if remainder:
        cand = cand.unionByName(_gaps(cand, by), allowMissingColumns=True)
    none = F.lit(None).cast("date")
    floor_day, clip_day = (F.to_date(_ts_lit(x)) if stats.rows else none for x in (stats.floor, stats.clip))
    s, e, a, b = F.col("interval_start"), F.col("interval_end"), F.col("_lo"), F.col("_hi")
    first = F.greatest(F.least(utc_date(s), clip_day), floor_day)
    days = F.sequence(first, F.greatest(first, F.least(utc_date(plus_micros(e, -1)), clip_day)))
    left, cand, same_day = _meet_days(cons, cand, "_lo", "_hi", F.coalesce(days, F.array(none)), floor_day, clip_day)
    # A key's gaps have no more day rows than its segments, and those of all days from the floor to the clip.
    span = (stats.clip.date() - stats.floor.date()).days + 2 if stats.rows else 0
    if stats.may_broadcast(stats.day_rows + (stats.day_rows + stats.keys * span if remainder else 0), broadcast_max_rows):
        cand = F.broadcast(cand)
    cond = same_day[0] & same_day[1] & (a < e) & (b.isNull() | (s < b)) & \
        (F.col("_lb") == F.least(F.greatest(utc_date(s), utc_date(a), floor_day), clip_day))
    for k in by:
        cond = (F.col(k) == F.col(f"_by_{k}")) & cond
    j = left.join(cand, cond, "left" if remainder else "inner")
    if remainder:
        # A reading of a key without rates, or of unknown extent, is one unpriced part; on its other days nothing was found.
        alone = a.isNull() & (F.col("_lb").isNull() | (F.col("_lb") == first))
        j = j.filter(a.isNotNull() | alone)
    start, end = F.greatest(s, a), F.least(e, F.coalesce(b, e))
    j = j.withColumn("overlap_us", micros_between(start, end)).withColumn(
        "weight", F.col("overlap_us") / F.nullif(micros_between(s, e), F.lit(0)))
    if remainder:
        bare = F.col("rate_valid_from").isNull()
        j = j.withColumns({"weight": F.coalesce("weight", F.lit(1.0)), "unpriced_from": F.when(bare, start), "unpriced_to": F.when(bare, end)})
    out = _with_cost(j, rate_cols)
    if "cost" in out.columns:
        out = out.withColumn("cost", F.col("cost").cast("double") * F.col("weight"))
    return out.drop("_lb", "_rb", "_ls", "_rs", "_lo", "_hi", *[f"_by_{k}" for k in by]).withColumnRenamed("_seg_end", "rate_segment_end")


#: Where the gap before a key's first rate begins.
_EARLIEST = "0001-01-01 00:00:00"


def _gaps(cand: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(_by_*, _lo, _hi)``: the key's times that none of its disjoint segments covers."""
    w = Window.partitionBy(*[f"_by_{b}" for b in by]).orderBy("_lo")
    nxt, prev = F.lead("_lo").over(w), F.lag("_lo").over(w)
    spans = cand.select(*[F.col(f"_by_{b}") for b in by], F.array(
        F.when(prev.isNull(), F.struct(ntz_lit(_EARLIEST).alias("lo"), F.col("_lo").alias("hi"))),
        F.when(F.col("_hi").isNotNull() & (nxt.isNull() | (F.col("_hi") < nxt)), F.struct(F.col("_hi").alias("lo"), nxt.alias("hi")))).alias("_gaps"))
    gaps = spans.select(*[f"_by_{b}" for b in by], F.explode(F.filter("_gaps", lambda g: g.isNotNull())).alias("_g"))
    return gaps.select(*[f"_by_{b}" for b in by], F.col("_g.lo").alias("_lo"), F.col("_g.hi").alias("_hi"))


def unmatched_intervals(costed_left: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count readings that found no rate, per ``by`` (input from ``rate_join(how='left')``)."""
    un = costed_left.filter(F.col("rate_valid_from").isNull())
    return un.groupBy(*by).agg(F.count(F.lit(1)).alias("n_unmatched"),
                               F.sum("consumption").alias("kwh_unmatched"))


def rates_overlapping(rates: DataFrame, start, end, tariff_code: str | None = None) -> DataFrame:
    """S3: rates of a tariff overlapping ``[start, end)``, ordered by ``valid_from``; P8 energy."""
    r = normalise_rates(rates)
    cond = (F.col("valid_from") < _ts_lit(end)) & (F.col("valid_to").isNull() | (F.col("valid_to") > _ts_lit(start)))
    if tariff_code is not None:
        cond = cond & (F.col("tariff_code") == F.lit(tariff_code))
    return r.filter(cond).orderBy("valid_from")


def stamp_rates(rates: DataFrame, product_code=None, tariff_code=None) -> DataFrame:
    """Stamp product, tariff and energy (P8 from the tariff code, P7 for the product)."""
    out = rates
    if tariff_code is not None:
        out = out.withColumn("tariff_code", F.lit(tariff_code))
    parsed = parse_tariff_code("tariff_code")
    out = out.withColumn("product_code", F.lit(product_code) if product_code is not None else parsed["product_code"])
    return out.withColumn("energy", energy_from_code("tariff_code"))
