"""Near-duplicate embeddings by spherical-cap filters with structured random product codes.

Unit vectors are cut into ``blocks`` equal pieces.  Each piece has its own codebook of ``codes`` random unit directions; a filter is one
code from each codebook, so ``codes ** blocks`` directions need only ``blocks * codes`` inner products.  There are ``structures``
such products, each after a random rotation of its own.  A vector passes every
filter whose direction it exceeds: the sum of its inner products with the filter's codes is at least ``height``
standard deviations of a random vector's sum.  The passing filters are list-decoded: each block's codes are walked in
descending order and a branch ends where even the best codes of the blocks to come cannot reach the height.  Vectors meet in the
filters they share, and every meeting is verified in double precision.  Close vectors share many filters,
unrelated ones next to none.

Links are counted, not emitted: a filter's members are compared in blocks of ``TILE`` rows by matrix products; a pair that shares
several filters counts in the smallest of them.  Out of a task come link counts and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .groups import whole_groups
from .storage import stage

#: Several independent structures even out the luck of one random code.
STRUCTURES, BLOCKS, SEED = 8, 2, 17
#: Vectors that a filter should hold by chance, filters that a pair at the threshold should share on average, and the dimension below which
#: all pairs of a label are compared: there the sums of two pieces are far from normal and a filter may have no members at all.
OCCUPANCY, SHARED, EXACT_BELOW = 40.0, 20.0, 24
#: Rows of a tile; filters of up to FEW rows are compared many at a time.
TILE, FEW = 2048, 64


def _coordinate(dim: int, points: int = 20_001) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(t, density, probability to exceed t) of a coordinate of a random unit vector.  A filter's direction has equal parts in all pieces and the
    rotation is random, so an inner product with it is ``sqrt(blocks)`` times such a coordinate."""
    t = np.linspace(-1, 1, points)
    density = np.maximum(1 - t ** 2, 0) ** ((dim - 3) / 2)
    tail = np.cumsum(density[::-1])[::-1]
    return t, density / density.sum(), tail / tail[0]


def settings(dim: int, rows: int, threshold: float, structures: int = STRUCTURES, blocks: int = BLOCKS) -> tuple[float, int]:
    """``(height, codes)`` for a label of ``rows`` vectors.  The height lets about ``OCCUPANCY`` unrelated vectors into a filter however
    many there are, and there are as many codes as it takes for a pair at the threshold to share ``SHARED`` filters: filters, not
    their members, grow with the table, and a row goes to a few dozen of them at every size."""
    t, density, tail = _coordinate(dim)
    wanted = min(max(OCCUPANCY / max(rows, 1), 1e-9), 0.02)
    least = float(t[np.argmax(tail <= wanted)])
    # A vector at this cosine has the coordinate cosine * t + sin * sqrt(1 - t^2) * t', with t' of a random vector at right angles.
    over = t >= least
    cosine = min(threshold, 0.999)
    need = (least - cosine * t[over]) / (math.sqrt(1 - cosine ** 2) * np.sqrt(np.maximum(1 - t[over] ** 2, 1e-12)))
    t2, _, tail2 = _coordinate(dim - 1)
    both = float((density[over] * np.interp(need, t2, tail2, left=1.0, right=0.0)).sum())
    # In the units of ``list_decode``: deviations of the sum over all pieces.
    return least * math.sqrt(dim), max(2, math.ceil((SHARED / (structures * both)) ** (1 / blocks)))


def codebooks(dim: int, blocks: int, codes: int, seed: int = SEED) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation (so that no coordinate is special) and one (codes, piece) codebook of unit rows for each piece."""
    rng = np.random.default_rng([seed, dim])
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    books = []
    for piece in np.array_split(np.arange(dim), min(blocks, dim)):
        book = rng.normal(size=(codes, len(piece)))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True))
    return rotation, books


def list_decode(unit: np.ndarray, rotation: np.ndarray, books: list[np.ndarray], height: float) -> list[np.ndarray]:
    """For each row the sorted ids of all filters that it exceeds."""
    v = unit @ rotation
    cuts = np.cumsum([0] + [b.shape[1] for b in books])
    # A random vector's sum of inner products has about this deviation.
    least = height * np.sqrt(len(books) / v.shape[1])
    dots = [v[:, a:b] @ book.T for a, b, book in zip(cuts, cuts[1:], books)]
    best_left = np.concatenate([np.cumsum([d.max(axis=1) for d in dots[::-1]], axis=0)[::-1][1:], np.zeros((1, len(v)))])
    row, total, ident = np.arange(len(v)), np.zeros(len(v)), np.zeros(len(v), np.int64)
    for d, rest in zip(dots, best_left):
        order = np.argsort(-d, axis=1)
        ranked = np.take_along_axis(d, order, axis=1)
        # How many of the leading codes can still reach the height from each partial sum.
        reach = np.array([np.searchsorted(-ranked[r], t + rest[r] - least, side="right") for r, t in zip(row, total)], np.int64)
        at = np.repeat(np.arange(len(row)), reach)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(reach) - reach, reach)
        r = row[at]
        row, total, ident = r, total[at] + ranked[r, rank], ident[at] * d.shape[1] + order[r, rank]
    order = np.lexsort((ident, row))
    return np.split(ident[order], np.searchsorted(row[order], np.arange(1, len(v))))


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of unit length; scaling by the largest component first keeps squares finite."""
    m = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(float)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _filters(vectors: DataFrame, structures: int, blocks: int, plans: dict, seed: int) -> DataFrame:
    """``vectors(key, label, dim, v, weight)`` with the sorted array ``filters``; ``plans`` has height and codes by dimension.  Vectors of few dimensions share one filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in map(int, np.unique(dims)):
                part = batch.filter(pa.array(dims == dim))
                if dim < EXACT_BELOW:
                    one = pa.array([[0]] * part.num_rows, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*part.columns, one], [*batch.schema.names, "filters"])
                    continue
                height, codes = plans[dim] if dim in plans else plans[None]
                if dim not in known:
                    known[dim] = [codebooks(dim, blocks, codes, seed + k) for k in range(structures)]
                unit = _unit(part.column(3), dim)
                found = [[f + k * codes ** blocks for f in list_decode(unit, *x, height)] for k, x in enumerate(known[dim])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([np.concatenate(x) for x in zip(*found)], pa.list_(pa.int64()))],
                                                 [*batch.schema.names, "filters"])

    kinds = ", ".join(f"{c} {t}" for c, t in vectors.dtypes)
    return vectors.mapInArrow(run, f"{kinds}, filters array<long>")


def _shared_below(p: np.ndarray, q: np.ndarray, limit: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether the rows of each pair (p, q) share a filter below the pair's limit."""
    def below(rows: np.ndarray) -> np.ndarray:
        n = bounds[rows + 1] - bounds[rows]
        at = np.repeat(np.arange(len(rows)), n)
        f = flat[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[rows], n)]
        low = f < limit[at]
        return at[low] << 32 | f[low]
    both = np.sort(np.concatenate([below(p), below(q)]))
    out = np.zeros(len(p), bool)
    out[both[1:][both[1:] == both[:-1]] >> 32] = True
    return out


def _members(rows: np.ndarray, low: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which of the filters ``low`` each row has, as ones and zeros."""
    m = np.zeros((len(rows), len(low)), np.float32)
    for i, r in enumerate(rows):
        f = flat[bounds[r]:bounds[r + 1]]
        m[i, np.searchsorted(low, f[f <= low[-1]])] = 1
    return m


def _forest(hit: np.ndarray, ka: np.ndarray, kb: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``hit`` connects, fewer than there are rows: smallest labels spread until they stand."""
    la, lb, top = ka.copy(), kb.copy(), np.iinfo(np.int64).max
    while hit.any():
        na = np.minimum(la, np.where(hit, lb[None, :], top).min(axis=1))
        nb = np.minimum(lb, np.where(hit, na[:, None], top).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return [(x, k) for k, x in {**dict(zip(ka, la)), **dict(zip(kb, lb))}.items() if x != k]


def _compare(rows: pa.Table, threshold: float) -> pa.RecordBatch:
    """Link counts (a = b) and edges (a < b, n = 0) of whole groups of rows, sorted by group and tile."""
    rows = rows.combine_chunks()
    col = {c: rows.column(c).chunk(0) for c in rows.column_names}
    key, weight, tile, filt, dims = (col[c].to_numpy() for c in ("key", "weight", "tile", "filter", "dim"))
    flat, bounds = col["filters"].flatten().to_numpy(), np.concatenate([[0], np.cumsum(col["filters"].value_lengths().to_numpy())])
    label = col["label"].dictionary_encode().indices.to_numpy()
    ids = np.stack([label, dims, filt, col["ti"].to_numpy(), col["tj"].to_numpy()])
    starts = np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1, [len(key)]])
    group, size = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), np.diff(starts)
    counted, edges = [(key[:0], weight[:0])], [np.zeros((0, 2), np.int64)]
    for dim in map(int, np.unique(dims)):
        mine = np.flatnonzero(dims == dim)
        unit = np.zeros((len(key), dim))
        unit[mine] = _unit(col["v"].filter(pa.array(dims == dim)), dim)
        small = mine[size[group[mine]] <= FEW]
        for step in range(1, int(size[group[small]].max(initial=1))):
            p = small[:-step][group[small[:-step]] == group[small[step:]]]
            p = p[(ids[3, p] == ids[4, p]) | (tile[p] != tile[p + step])]       # between two tiles, only pairs across
            hit = np.einsum("ij,ij->i", unit[p], unit[p + step]) >= threshold
            p = p[hit]
            q = p + step
            new = ~_shared_below(p, q, filt[p], flat, bounds)
            p, q = p[new], q[new]
            counted += [(key[p], weight[q]), (key[q], weight[p])]
            edges.append(np.stack([key[p], key[q]], axis=1))
        for g in np.unique(group[mine[size[group[mine]] > FEW]]):
            at = np.arange(starts[g], starts[g + 1])
            same = ids[3, at[0]] == ids[4, at[0]]
            one, two = (at, at) if same else (at[tile[at] == ids[3, at[0]]], at[tile[at] == ids[4, at[0]]])
            if not len(one) or not len(two):
                continue
            hit = unit[one] @ unit[two].T >= threshold
            if same:
                np.fill_diagonal(hit, False)
            low = np.unique(np.concatenate([flat[bounds[r]:bounds[r + 1]] for r in at]))
            low = low[low < filt[at[0]]]
            if len(low):
                hit &= ~(_members(one, low, flat, bounds) @ _members(two, low, flat, bounds).T > 0)
            counted.append((key[one], hit @ weight[two]))
            if not same:
                counted.append((key[two], weight[one] @ hit))
            edges.append(np.array(_forest(hit, key[one], key[two]), np.int64).reshape(-1, 2))
    k, n = (np.concatenate(x) for x in zip(*counted))
    who, back = np.unique(k[n > 0], return_inverse=True)
    e = np.concatenate(edges)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([who, e[:, 0]])), pa.array(np.concatenate([who, e[:, 1]])),
                                       pa.array(np.concatenate([np.bincount(back, n[n > 0], len(who)).astype(np.int64), np.zeros(len(e), np.int64)]))],
                                      ["a", "b", "n"])


def _meet(met: DataFrame, threshold: float) -> DataFrame:
    """Compare the rows of every (label, dim, filter, tile pair); a task streams its sorted groups."""
    order = ["label", "dim", "filter", "ti", "tj", "tile", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, order[:5]):
            yield _compare(rows, threshold)

    return met.repartition(*order[:5]).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, n long")


def similar(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
            threshold: float = 0.93, structures: int = STRUCTURES, blocks: int = BLOCKS, codes: int | None = None, height: float | None = None,
            seed: int = SEED) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Rows are compared when their labels are equal and not null (all rows, with ``label_col=None``) and their dimensions are
    equal.  Vectors that are null, zero, empty or hold null or non-finite components, and rows with a null id, link with nothing and are kept.
    Equal vectors are one point with a weight, so copies cost nothing; ``n_links`` still counts every copy.
    Rows that repeat an id with one vector count as copies.  
    Below ``EXACT_BELOW`` dimensions all pairs of a label are compared, in tiles, and no link is lost; from there on the filters'
    recall is a matter of ``height`` and ``codes``, which follow the largest label's size unless given (``settings``; figures in the README).  A link that is
    found is exact.
    """
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    v = F.col(vector_col)
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0),
                        F.lit(False)) & label.isNotNull() & F.col(id_col).isNotNull()
    kind = dict(vectors.dtypes)[vector_col]
    plain = F.transform(v, lambda x: x + F.lit(0.0)).cast(kind)             # -0.0 and 0.0 are one value
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.when(usable, plain).alias("v"))
    rows = stage(rows.withColumn("point", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.col("label"), F.to_json("v")), 256))), "points")
    points = stage(rows.where("point IS NOT NULL").groupBy("point", "label").agg(
        F.min("id").alias("key"), F.first("v").alias("v"), F.count(F.lit(1)).alias("weight")), "points")

    plans = {}
    if height is not None and codes is not None:
        plans[None] = (height, codes)
    else:
        # A row for each dimension that occurs; vectors of a table usually have one.
        for r in points.groupBy("label", F.size("v").alias("dim")).count().groupBy("dim").agg(F.max("count").alias("n")).where(F.col("dim") >= EXACT_BELOW).collect():
            plans[r["dim"]] = settings(r["dim"], r["n"], threshold, structures, blocks)
    listed = stage(_filters(points.select("key", "label", F.size("v").alias("dim"), "v", "weight"), structures, blocks, plans, seed), "filters")
    spread = listed.select("key", "label", "dim", F.explode("filters").alias("filter"))
    sizes = spread.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stage(sizes.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "sizes")
    # A crowded filter is cut into tiles; a row goes to every pair of tiles that holds its own.  The join has no hint:
    # where it shuffles, adaptive execution splits crowded filters.
    met = (listed.withColumn("filter", F.explode("filters")).join(sizes, ["label", "dim", "filter"])
           .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
           .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
           .withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other"))
           .select("key", "label", "dim", "v", "weight", "filters", "filter", "tile", "ti", "tj"))
    found = stage(_meet(met, threshold), "links")
    counts = found.where("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
    comp = components(found.where("a <> b").select("a", "b"))
    per_point = stage(points.select("point", "key", "weight").join(counts, "key", "left").join(comp.withColumnRenamed("node", "key"), "key", "left")
                      .select("point", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                              F.coalesce("component", "key").alias("component_id")), "points")
    return (rows.join(per_point, "point", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
