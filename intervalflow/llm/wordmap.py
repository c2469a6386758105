"""Encoding texts by their distinct words.

The words (or other pieces) that a ``cut`` function finds in the texts are counted, each distinct one is encoded once by the caller, and the
codes go back to the texts in their order.  The way back is a dictionary of the words that are frequent for their size, at most ``limit`` of them
and at most ``DICTIONARY_BYTES``, sorted by leading bits of a 64-bit hash: (hash, 32 bits more of the digest, place, ids) and an index of leading bits in flat
arrays.  They are a file that Python workers map, so an executor has one copy of it however many workers it runs: on a shared folder that
is mounted everywhere the file itself, else a copy that Spark hands to every executor (``addFile``).  Words beyond it are resolved exactly by a join; only texts that hold such a word are shuffled for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intervalflow.session import scratch_path

from . import textops as tx
from .storage import collected, open_path, qualified, release, stage

#: The dictionary's bounds, whichever is met first.  A word counts with the bytes of its ids and, beside them, of its hash, its place and the index.
DICTIONARY_WORDS, DICTIONARY_BYTES, WORD_BYTES = 5_000_000, 128_000_000, 18
#: Text that a counting task holds, and words whose bytes are gathered at once.
COUNT_BYTES, GATHERED_WORDS = 12 << 20, 1 << 15
#: Rows of an Arrow batch, if the session does not say.  Texts are long, and Spark holds a batch three times: its vectors, its message, the worker's copy.
BATCH_ROWS, _BATCH_KEY = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Counts from here on are told apart no more when the dictionary's least counts are chosen, so a bounded table comes to the driver.
LEVELS = 100_000

#: A function of Arrow batches and the columns that it adds, as DDL.
Then = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str]
#: Bytes of all texts, starts and ends of their words, and the index of the first word of every text (one more for the end).
Cut = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def text_bytes(col: pa.Array) -> list[bytes]:
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of ``BATCH_ROWS``, unless it has a setting of its own.  Tasks are planned when the
    result is asked for, so the setting stays."""
    if spark.conf.get(_BATCH_KEY) == "10000":               # Spark's default
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))


def count(docs: DataFrame, text_col: str, cut: Callable[[list[bytes]], Cut]) -> DataFrame:
    """``(chunk, n)``: the distinct words of all texts.  Tasks count first, in blocks of ``COUNT_BYTES`` of text."""
    def distinct(held: list[tuple]) -> pa.RecordBatch:
        """Words are told apart by 96 bits of digest; each one's bytes are copied once."""
        sizes = np.cumsum([0] + [len(d) for d, *_ in held])
        data = np.concatenate([d for d, *_ in held])
        hashes, checks, counts, starts, ends = (np.concatenate(x) for x in zip(*(
            (h, c, n, s + at, e + at) for (_, h, c, n, s, e), at in zip(held, sizes))))
        first, n = _distinct(hashes, checks, counts)
        size = (ends - starts)[first]
        to = np.concatenate([[0], np.cumsum(size)])
        flat = np.empty(to[-1], np.uint8)
        for k in range(0, len(first), GATHERED_WORDS):
            a, b = to[k], to[min(k + GATHERED_WORDS, len(first))]
            part = slice(k, k + GATHERED_WORDS)
            flat[a:b] = data[np.arange(a, b) - np.repeat(to[:-1][part] - starts[first[part]], size[part])]
        words = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(flat)])
        return pa.RecordBatch.from_arrays([words, pa.array(n)], ["chunk", "n"])

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = tx.Hasher(), []
        for batch in batches:
            for part in tx.slices(batch, "text"):
                data, starts, ends, _ = cut(text_bytes(part.column(0)))
                hashes, checks = hasher.digests(data, starts, ends)
                at, n = _distinct(hashes, checks)
                held.append((data, hashes[at], checks[at], n, starts[at], ends[at]))
                if sum(len(d) for d, *_ in held) > COUNT_BYTES:
                    yield distinct(held)
                    held = []
        if held:
            yield distinct(held)

    small_batches(docs.sparkSession)
    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "chunk string, n long")
            .groupBy("chunk").agg(F.sum("n").alias("n")))


def _distinct(hashes: np.ndarray, checks: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of one entry of each (hash, check) and the sum of its counts (one each by default).

    Entries are sorted by their hash's leading bits with the index in the low ones, four times as fast as an argsort.  Where two hashes share
    the leading bits, one may come out in several parts whose counts add up."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = tx.U((1 << len(hashes).bit_length()) - 1)
    order = (np.sort((hashes & ~low) | np.arange(len(hashes), dtype=tx.U)) & low).astype(np.int64)
    h, c = hashes[order], checks[order]
    edges = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]))
    n = np.diff(edges, append=len(order)) if counts is None else np.add.reduceat(counts[order], edges)
    return order[edges], n.astype(np.int64)


def dictionary(words: DataFrame, limit: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(hashes, their checks, bounds, ids) of the most frequent of ``words(chunk, n, ids)`` for their size, ``limit`` words and ``DICTIONARY_BYTES``
    at most, and how many are not among them.  They are sorted by the hashes' leading bits, equal ones by falling count (its number of bits).

    Words fall into classes by the bits of their number of ids; each class has its own least count, so long words never keep short ones out."""
    level, kind_of = F.least("n", F.lit(LEVELS)), F.length(F.bin(F.size("ids")))
    per = (words.groupBy(level.alias("n"), kind_of.alias("bits"))
           .agg(F.count(F.lit(1)).alias("k"), F.sum(WORD_BYTES + kind.itemsize * F.size("ids").cast("long")).alias("bytes")).collect())
    least, full, held, used = [LEVELS + 1] * 33, set(), 0, 0
    for n, bits, k, size in sorted(per, key=lambda r: (-r.n / (1 << r.bits), r.bits)):
        if bits in full or held + k > limit or used + size > DICTIONARY_BYTES:
            full.add(bits)
        else:
            least[bits], held, used = n, held + k, used + size

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for batch in batches:
            for part in tx.slices(batch, "chunk"):
                data, bounds = tx.raw(part.column(0))
                to = part.column(1).offsets.to_numpy().astype(np.int64) * kind.itemsize
                flat = np.ascontiguousarray(part.column(1).values.to_numpy(), kind).tobytes()
                packed = [flat[a:b] for a, b in zip(to, to[1:])]
                hashes, checks = hasher.digests(data, bounds[:-1], bounds[1:])
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(checks.view(np.int32)), part.column(2),
                                                  pa.array(packed, pa.binary())], ["hash", "check", "often", "ids"])

    taken = level >= F.element_at(F.array(*map(F.lit, least)), kind_of + 1)
    often = F.length(F.bin("n")).cast("tinyint").alias("often")
    coded = words.where(taken).select("chunk", "ids", often).mapInArrow(run, "hash long, check int, often tinyint, ids binary")
    got = collected(coded, "dictionary")
    hashes, checks = got.column("hash").to_numpy().view(tx.U), got.column("check").to_numpy().view(np.uint32)
    low = tx.U((1 << 64 - _lead_bits(len(hashes))) - 1)
    order = np.argsort((hashes & ~low) + (tx.U(64) - got.column("often").to_numpy().astype(tx.U)))
    hashes, checks = hashes[order], checks[order]
    ids = pa.concat_arrays(got.column("ids").chunks) if got.num_rows else pa.array([], pa.binary())
    del got
    ids = ids.take(pa.array(order))
    data, bounds = tx.raw(ids)
    bounds, flat = (bounds // kind.itemsize).astype(np.int32), data.view(kind).copy()
    del ids, data
    release()
    return hashes, checks, bounds, flat, sum(r.k for r in per) - held


def _find(wanted: np.ndarray, check: np.ndarray, hashes: np.ndarray, checks: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Place of each wanted hash and check in ``hashes``, or -1.  These are sorted by their leading bits; ``index`` has where each value of them
    starts.  Most are found at the first place of their value, if the frequent ones stand there."""
    if not len(hashes):
        return np.full(len(wanted), -1, np.int64)
    shift = tx.U(64 - (len(index) - 1).bit_length() + 1)
    lead = (wanted >> shift).astype(np.int64)
    at = index.take(lead)
    # Where no hash has these leading bits, this is the place of others, or the last.
    out = np.minimum(at, len(hashes) - 1).astype(np.int64)
    todo = np.flatnonzero((hashes.take(out) != wanted) | (checks.take(out) != check))
    out[todo] = -1
    at, stop, wanted, check = at[todo] + 1, index.take(lead[todo] + 1), wanted[todo], check[todo]
    while len(todo):
        live = np.flatnonzero(at < stop)
        todo, at, stop, wanted, check = todo[live], at[live], stop[live], wanted[live], check[live]
        same = (hashes.take(at) == wanted) & (checks.take(at) == check)
        out[todo[same]] = at[same]
        more = np.flatnonzero(~same)
        todo, at, stop, wanted, check = todo[more], at[more] + 1, stop[more], wanted[more], check[more]
    return out


def _lead_bits(n: int) -> int:
    """Leading bits by which ``n`` hashes are told apart; two to four hashes have one value."""
    return max(1, n.bit_length() - 2)


def _index(hashes: np.ndarray) -> np.ndarray:
    """Where each value of the leading bits starts in hashes that are sorted by them."""
    bits = _lead_bits(len(hashes))
    edges = np.arange(1, 1 << bits, dtype=tx.U) << tx.U(64 - bits)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int32)


#: Path of a shared file (a bare name if Spark copies it to the executors), and of each array in it type, place and length.
Shared = tuple[str, list[tuple[str, int, int]]]


def share(spark: SparkSession, arrays: list[np.ndarray]) -> Shared:
    """Write arrays to one file in the shared folder.  Tasks map it there if the folder is mounted; else Spark copies it to every executor."""
    path, layout, at = qualified(spark, scratch_path(spark, "dictionary")), [], 0
    files, name = open_path(path)
    files.create_dir(name.rsplit("/", 1)[0])
    with files.open_output_stream(name) as out:
        for a in arrays:
            layout.append((a.dtype.str, at, len(a)))
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
            out.write(b"\0" * (-a.nbytes % 64))
            at += a.nbytes + -a.nbytes % 64
        out.write(b"\0" * 64)
    if path.startswith("file:"):
        return name, layout
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1], layout


def mapped(shared: Shared) -> list[np.ndarray]:
    """The arrays of a shared file, in a task."""
    name = shared[0]
    raw = np.memmap(name if name.startswith("/") else SparkFiles.get(name), np.uint8, "r")
    return [raw[at:at + n * np.dtype(kind).itemsize].view(kind) for kind, at, n in shared[1]]


def encode(docs: DataFrame, text_col: str, out_col: str, words: DataFrame, cut: Callable[[list[bytes]], Cut], wide: bool,
           limit: int = DICTIONARY_WORDS, packed: bool = False, then: Then | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of all words of the text in ``out_col``: array of int, or with ``packed`` binary, little-endian, of
    four bytes each if ``wide``, else two.  ``words(chunk, n, ids)`` is a staged table.  ``then`` works on the result's batches in
    the same tasks: a function of them, and the columns that it adds (as DDL).  Without ``keep_text`` the text goes to the tasks but does not
    come back from them."""
    small_batches(docs.sparkSession)
    kind = np.dtype("<u4" if wide else "<u2")
    hashes, checks, to, flat, missing = dictionary(words, limit, kind)
    shared = share(docs.sparkSession, [hashes, checks, _index(hashes), to, flat])
    del hashes, checks, to, flat
    src = docs.drop(out_col).withColumn(text_col, F.col(text_col).cast("string"))
    at = src.columns.index(text_col)
    cols = [c for c in src.columns if keep_text or c != text_col]
    extra = ["__row", out_col, "__gaps"] if missing else [out_col]
    kinds = {"__row": "long", out_col: "binary", "__gaps": "array<struct<at: int, chunk: string>>"}
    gap_type = pa.list_(pa.struct([("at", pa.int32()), ("chunk", pa.string())]))
    listed = not packed and not missing

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, checks, index, to, flat = mapped(shared)
        hasher, row = tx.Hasher(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in tx.slices(batch, text_col):
                data, starts, ends, first = cut(text_bytes(part.column(at)))
                place = _find(*hasher.digests(data, starts, ends), hashes, checks, index)
                known = place >= 0
                begin = np.where(known, to[place], 0)
                n = np.where(known, to[np.minimum(place + 1, len(to) - 1)] - begin, 0)
                stop = np.concatenate([[0], np.cumsum(n)])
                ids = flat.take(np.arange(stop[-1]) - np.repeat(stop[:-1] - begin, n))
                bounds = stop[first]
                own = part.columns if keep_text else part.columns[:at] + part.columns[at + 1:]
                arrays = [*own, _lists(ids, bounds) if listed else _binary(ids, bounds)]
                if missing:
                    lost = np.flatnonzero(~known)
                    mine = np.searchsorted(lost, first)
                    rel = stop[lost] - bounds[np.searchsorted(first, lost, side="right") - 1]
                    raw = data.tobytes()
                    gaps = [{"at": int(i), "chunk": raw[a:b].decode()} for i, a, b in zip(rel, starts[lost], ends[lost])]
                    arrays = [*own, pa.array(np.arange(row, row + part.num_rows)), arrays[-1],
                              pa.array([gaps[a:b] for a, b in zip(mine, mine[1:])], gap_type)]
                    row += part.num_rows
                yield pa.RecordBatch.from_arrays(arrays, [*cols, *extra])

    plain = ", ".join(f"`{c}` {t}" for c, t in src.dtypes if c in cols)
    after, added = then or ((lambda batches: batches), "")
    added = added and f", {added}"
    if not missing:
        return src.mapInArrow(lambda batches: after(run(batches)), f"{plain}, `{out_col}` {'binary' if packed else 'array<int>'}{added}")
    coded = src.mapInArrow(run, ", ".join([plain, *(f"`{c}` {kinds[c]}" for c in extra)]))
    coded = stage(coded, "coded")
    holes = coded.where("size(__gaps) > 0")
    parts = holes.select("__row", F.posexplode("__gaps").alias("k", "gap")).select("__row", "k", "gap.at", "gap.chunk")
    filled = parts.join(words.select("chunk", F.col("ids").alias("part")), "chunk").groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("k", "at", "part"))).alias("__parts"))
    empty = F.array().cast("array<struct<k: int, at: int, part: array<int>>>")
    both = (coded.where("size(__gaps) = 0").select(*cols, out_col, empty.alias("__parts"))
            .unionByName(holes.join(filled, "__row").select(*cols, out_col, "__parts")))

    @tx.tidy
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, text_col if keep_text else out_col):
                out = []
                for ids, parts in zip(part.column(len(cols)).to_pylist(), part.column(len(cols) + 1).to_pylist()):
                    done, last = [], 0
                    for p in parts:
                        done += [ids[last:p["at"] * kind.itemsize], np.array(p["part"], kind).tobytes()]
                        last = p["at"] * kind.itemsize
                    out.append(b"".join([*done, ids[last:]]))
                bounds = np.concatenate([[0], np.cumsum([len(x) // kind.itemsize for x in out])])
                flat = np.frombuffer(b"".join(out), kind)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(cols)], _binary(flat, bounds) if packed else _lists(flat, bounds)], [*cols, out_col])

    return both.mapInArrow(lambda batches: after(fill(batches)), f"{plain}, `{out_col}` {'binary' if packed else 'array<int>'}{added}")


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _binary(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * ids.itemsize).astype(np.int32).tobytes()),
                                                                pa.py_buffer(ids.tobytes())])
