"""Vectorised text kernels used inside Arrow tasks: word and line hashes, shingles, n-grams.

Words are ``[^\\x20\\x09-\\x0D]+`` everywhere.  Hashes are 64 bit.  Up to eight bytes of UTF-8 hash one to one.  Up to 64 bytes run through two
chains of 64 bits, each mixed after every eight bytes; longer ranges are digests (BLAKE2b).  ``Hasher.digests`` has 32 bits more, of which the same
holds, for those who must tell any two words of a corpus apart.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
#: Odd constants without structure, and the longest range that is chained.
_ONE, _TWO, _CHAINED = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = np.asarray(x, dtype=U)
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Hasher:
    """Hashes of byte ranges."""

    def segments(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every byte range ``data[start:end]``; a whole range counts, however long."""
        return self.digests(data, starts, ends)[0]

    def digests(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every byte range and 32 more bits of its digest (zero for up to eight bytes, which need none)."""
        if not len(starts):
            return np.zeros(0, U), np.zeros(0, np.uint32)
        words = np.zeros(len(data) // 8 + 3, U)
        words.view(np.uint8)[:len(data)] = data

        def block(at: np.ndarray, n: np.ndarray) -> np.ndarray:
            """Eight bytes from ``at`` on; of fewer the last one says how many there are, with a value that UTF-8 never has."""
            i, shift = at >> 3, ((at & 7) << 3).astype(U)
            v = (words[i] >> shift) | (words[i + 1] << U(1) << (U(63) - shift))
            part = np.flatnonzero(n < 8)
            bits = (n[part] << 3).astype(U)
            v[part] = (v[part] & ((U(1) << bits) - U(1))) | (U(0xF8) + n[part].astype(U)) << U(56)
            return v

        starts, n = np.asarray(starts, np.int64), np.asarray(ends, np.int64) - starts
        out = mix(block(starts, n))
        extra = np.zeros(len(out), np.uint32)
        some = np.flatnonzero((n > 8) & (n <= _CHAINED))
        if len(some):
            size = n[some]
            a, b = mix(size.astype(U) * _ONE), mix(size.astype(U) * _TWO)
            for k in range(0, _CHAINED, 8):
                live = np.flatnonzero(size > k)
                if not len(live):
                    break
                v = block(starts[some[live]] + k, np.minimum(size[live] - k, 8))
                a[live], b[live] = mix(a[live] ^ v), mix((b[live] + v) * _TWO)
            out[some] = mix(a + (b << U(32) | b >> U(32)))
            extra[some] = mix(b ^ mix(a ^ _ONE)).astype(np.uint32) | np.uint32(1)
        long_ = np.flatnonzero(n > _CHAINED)
        if len(long_):
            view = memoryview(np.ascontiguousarray(data))
            made = b"".join(hashlib.blake2b(view[s:e], digest_size=16).digest() for s, e in zip(starts[long_].tolist(), (starts + n)[long_].tolist()))
            both = np.frombuffer(made, U).reshape(-1, 2)
            out[long_], extra[long_] = both[:, 0], both[:, 1].astype(np.uint32) | np.uint32(1)
        return out, extra


def chain(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in their order; each is mixed in before the next."""
    h = mix(columns[0] ^ _ONE)
    for c in columns[1:]:
        h = mix(h * _TWO + c)
    return h


def release() -> None:
    """Give memory that a task has freed back to the system.  Python workers live on between stages, and what their allocators keep counts
    against the executor while the next stage runs elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):      # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of Arrow batches that releases memory when its last batch is out."""
    def whole(batches):
        yield from run(batches)
        release()
    return whole


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Parts of a batch whose texts add up to about ``limit`` bytes (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if pa.types.is_large_string(col.type) else np.int32,
                            count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the bounds of its rows; null is empty."""
    col = col.fill_null("" if pa.types.is_string(col.type) else b"") if col.null_count else col
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    bounds = np.frombuffer(col.buffers()[1], dtype=kind, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[bounds[0]:bounds[-1]] if buf is not None and len(buf) else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def word_edges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte, whether it is in a word, is a word's first, is a word's last."""
    ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    first[cut] = ink[cut]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    last[cut - 1] = ink[cut - 1]
    return ink, first, last


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of every row (one more for the end)."""
    _, first, last = word_edges(data, bounds)
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row index of every item, from the index of the first item of every row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, position of its first word) of every run of k words within a row.  With ``short``,
    a row of 1 to k-1 words has one shingle: its whole sequence."""
    n = np.diff(first)
    row = rows_of(first)
    if len(words) >= k:
        at = np.flatnonzero(row[:len(words) - k + 1] == row[k - 1:])
        out_row, out_hash = row[at], chain([words[at + j] for j in range(k)])
    else:
        at = out_row = np.zeros(0, np.int64)
        out_hash = np.zeros(0, U)
    for m in range(1, k) if short else ():
        few = np.flatnonzero(n == m)
        whole = chain([words[first[few] + j] for j in range(m)])
        out_row = np.concatenate([out_row, few])
        out_hash = np.concatenate([out_hash, mix(whole + U(m))])
        at = np.concatenate([at, first[few]])
    return out_row, out_hash, at


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows in one array, and the bounds of the rows."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def ngram_buckets(points: np.ndarray, bounds: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram that lies within one row.  32-bit hashing; ``buckets`` is a power of two."""
    if len(points) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = len(points) - n + 1
    h = np.full(m, 0x811C9DC5 + n, np.uint32)
    for j in range(n):
        h ^= points[j:m + j]
        h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(14)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    same = row[:m] == row[n - 1:] if n > 1 else np.ones(m, bool)
    return row[:m][same], (h[same] & np.uint32(buckets - 1)).astype(np.int64)
