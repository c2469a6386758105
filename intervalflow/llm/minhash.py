"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set is its distinct k-word shingles (64-bit hashes of lower-cased words).  Its sketch has
``bins`` coordinates, filled by rounds of hashed bin placement: in each of the first ``bins`` rounds every
shingle goes to one hashed bin with a value that sorts by round, then by hash; a bin keeps its smallest.
If bins are still empty, later rounds place every shingle in one fixed bin each, so every coordinate
fills.  Each coordinate agrees for two sets with probability equal to their Jaccard similarity, and the
number that agree is concentrated; large sets need one round or two, not one pass per coordinate.

``bands`` of ``rows`` coordinates give the candidates: a pair at similarity s shares a band with
probability ``1 - (1 - s**rows)**bands`` (0.99993 at 0.8 with the defaults).  Links are confirmed on the full sets.

Equal sets collapse to a class before banding, and a bucket never emits all its pairs: see ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .graph import components
from .groups import whole_groups
from .storage import drop, stage

BANDS, ROWS = 24, 5
#: Bands whose buckets are compared first; members of a bucket that is compared pair by pair; rows of a tile of a larger one.
FIRST_BANDS, FEW, TILE = 2, 8, 256
_MASK = tx.U((1 << 56) - 1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int, hasher: tx.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows in one array, and the bounds of the rows."""
    low = tx.lower_ascii(data)
    starts, ends, first = tx.word_bounds(low, bounds)
    row, h, _ = tx.shingles(hasher.segments(low, starts, ends), first, k)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(bounds)))


def sketches(sets: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates for every row; rows with an empty set stay at the largest value."""
    n = len(first) - 1
    out = np.full(n * bins, ~tx.U(0), tx.U)
    row = tx.rows_of(first)
    open_rows = np.diff(first) > 0
    for i in range(2 * bins):
        if not open_rows.any():
            break
        live = open_rows[row]
        r, h = row[live], tx.mix(sets[live] ^ tx.mix(np.uint64([i + 1])))
        value = (tx.U(i) << tx.U(56)) | (h & _MASK)
        bin_ = (h >> tx.U(56)).astype(np.int64) * bins >> 8 if i < bins else np.full(len(r), i - bins)
        np.minimum.at(out, r * bins + bin_, value)
        open_rows &= (out.reshape(n, bins) == ~tx.U(0)).any(axis=1)
    return out.reshape(n, bins)


def band_hashes(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sketch), bands), tx.U)
    for j in range(rows):
        out = tx.mix(out ^ sketch[:, j::rows][:, :bands])
    return tx.mix(out + np.arange(bands, dtype=tx.U))


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, n_shingles, digest, bands)`` of every row; ``digest`` (128 bits of the set) is null for an empty set."""
    bins = bands * rows
    assert bins <= 256, "the bin is taken from 8 bits of the hash"

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for batch in batches:
            for part in tx.slices(batch, "text"):
                sets, first = shingle_sets(*tx.raw(part.column(1)), k, hasher)
                size = np.diff(first)
                keys = band_hashes(sketches(sets, first, bins), bands, rows).view(np.int64)
                digest = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None
                          for a, b in zip(first, first[1:])]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(size) + 1) * bands, bands), pa.int32()),
                                                 pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()),
                                                  pa.array(digest, pa.binary()), lists],
                                                 ["id", "n_shingles", "digest", "bands"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>")


def _sets_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, k: int) -> DataFrame:
    """``(id, set)`` of the wanted ids: all shingle hashes as little-endian bytes, sorted."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for batch in batches:
            for part in tx.slices(batch, "text"):
                sets, first = shingle_sets(*tx.raw(part.column(1)), k, hasher)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([sets[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())],
                    ["id", "set"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    once = src.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return once.mapInArrow(run, "id long, set binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets overlap by ``percent`` of their union or more."""
    def linked(one: pd.Series, two: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(one, two):
            a, b = np.frombuffer(x, tx.U), np.frombuffer(y, tx.U)
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                out.append(False)
                continue
            both = np.concatenate([a, b])
            both.sort(kind="stable")
            inter = int((both[1:] == both[:-1]).sum())
            out.append(100 * inter >= percent * (len(a) + len(b) - inter))
        return pd.Series(out, dtype=bool)

    check = F.pandas_udf(linked, "boolean")
    with_b = pairs.distinct().join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
    with_ab = with_b.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    return with_ab.where(check("set_a", "set_b")).select("a", "b")


def _with_component(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    return (buckets.join(comp.select(F.col("node").alias("id"), F.col("component").alias("c")), "id", "left")
            .withColumn("c", F.coalesce("c", "id")))


def _apart(rows: DataFrame) -> DataFrame:
    """Members of other components than their bucket's hub ``a``."""
    hubs = rows.groupBy("band").agg(F.min("id").alias("a"), F.min_by("c", "id").alias("ca"), F.min("c").alias("lo"),
                                    F.max("c").alias("hi")).where("lo < hi").select("band", "a", "ca")
    return rows.join(stage(hubs, "hubs"), "band").where("c <> ca")


def _edges(comp: DataFrame) -> DataFrame:
    return comp.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))


def _tiles(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between members of different components in the buckets of ``rows(band, id, c, n)``.

    A bucket is cut into tiles; a member goes to every pair of tiles that holds its own.  A task counts the shared shingles of all
    pairs of a tile pair by matrix products and emits the pairs that are linked."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["band", "ti", "tj"]):
            ids = np.stack([t.column(c).to_numpy() for c in ("band", "ti", "tj")])
            cuts = np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1, [t.num_rows]])
            key, comp, tile = (t.column(c).to_numpy() for c in ("id", "c", "tile"))
            raw = t.column("set").to_pylist()
            out = [np.zeros((0, 2), np.int64)]
            for lo, hi in zip(cuts, cuts[1:]):
                own = [np.frombuffer(x, tx.U) for x in raw[lo:hi]]
                size = np.array([len(x) for x in own])
                shared = _overlaps(own)
                k, c, part = key[lo:hi], comp[lo:hi], tile[lo:hi]
                hit = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
                hit &= (c[:, None] != c[None, :]) & (k[:, None] < k[None, :])
                if ids[1, lo] != ids[2, lo]:
                    hit &= part[:, None] != part[None, :]
                x, y = np.nonzero(hit)
                out.append(np.stack([k[x], k[y]], axis=1))
            links = np.unique(np.concatenate(out), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    tiled = (rows.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
             .withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
             .withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other"))
             .join(sets, "id").select("band", "ti", "tj", "tile", "id", "c", "set"))
    return (tiled.repartition("band", "ti", "tj").sortWithinPartitions("band", "ti", "tj").mapInArrow(run, "a long, b long")
            .distinct())


def _overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many shingles each pair of sets shares.  Shingles of one set alone count only on the diagonal, which nobody reads."""
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    distinct, col, n = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1
    use = n[col] > 1
    row, col = row[use], place[col[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(col[-1]) + 1 if len(col) else 0, columns):
        a, b = np.searchsorted(col, [at, at + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[row[a:b], col[a:b] - at] = 1
        total += m @ m.T
    return total.astype(np.int64)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Rows are linked when ``100 * |A & B| >= percent * |A | B|``; a component's id is its smallest row id, which is
    the row that is kept.  Rows without words (or null) have an empty set, link with nothing and are kept; so are
    rows with a null id, which have a null component.  Rows that repeat an id share its component; where their texts
    differ, the smallest text is the one that is compared.  Other columns of ``docs`` are ignored.

    A bucket never emits all its pairs.  Its hub is its smallest document.  First the hubs of a few bands meet their members; then
    the hub of every bucket meets one member of every other component in it.  By then a large group of copies is one component.
    Every bucket that still holds several components is then compared in full: up to ``FEW`` members pair by pair, more of them in tiles
    inside tasks, which emit links only.  So no candidate is dropped, and the links found are those of all pairs that share a bucket.
    """
    spark = docs.sparkSession
    sig = stage(signatures(docs, id_col, text_col, k, bands, rows), "signatures")
    classes = stage(sig.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "bands")).alias("m"), F.count(F.lit(1)).alias("n")).select("digest", "m.id", "m.bands", "n"), "classes")
    copies = stage(classes.where("n > 1").select("digest", F.col("id").alias("a")), "copies")
    links = sig.where("digest IS NOT NULL").join(copies, "digest").where("id <> a").select("a", F.col("id").alias("b"))
    members = classes.select("id", F.posexplode("bands").alias("i", "band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    shared = stage(shared, "shared")
    buckets = stage(members.join(shared, "band"), "buckets")
    sets = stage(_sets_of(docs, id_col, text_col, buckets.select("id").distinct(), k), "sets")

    first = buckets.where(F.col("i") < FIRST_BANDS).withColumn("c", F.col("id"))
    comp = components(stage(_confirm(_apart(first).select("a", F.col("id").alias("b")), sets, percent), "links"))
    least = _apart(_with_component(buckets, comp)).groupBy("band", "c", "a").agg(F.min("id").alias("b"))
    comp = components(_edges(comp).unionByName(stage(_confirm(least.select("a", "b"), sets, percent), "links")))

    mixed = _with_component(buckets, comp)
    several = mixed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    mixed = stage(mixed.join(stage(several.select("band", "n"), "several"), "band"), "mixed")
    few = mixed.where(F.col("n") <= FEW)
    pairs = (few.select("band", F.col("id").alias("a"), F.col("c").alias("c1")).join(
        few.select("band", F.col("id").alias("b"), F.col("c").alias("c2")), "band").where("a < b AND c1 <> c2").select("a", "b"))
    rest = stage(_confirm(pairs, sets, percent), "links").unionByName(stage(_tiles(mixed.where(F.col("n") > FEW), sets, percent), "links"))
    comp = components(_edges(comp).unionByName(rest).unionByName(links))
    drop(spark, buckets, sets)
    return (sig.select("id", "n_shingles").join(comp.withColumnRenamed("node", "id"), "id", "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
