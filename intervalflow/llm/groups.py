"""Streaming the sorted groups of a partition through Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows are gathered up to this many bytes before whole groups are handed on.
GATHER_BYTES = 16 << 20


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], gather: int = GATHER_BYTES) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that are sorted by ``keys``, many small groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.get_total_buffer_size() if b.num_rows else 0 for b in held) < gather:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        ids = [t.column(c) for c in keys]
        last, cut = [c[t.num_rows - 1].as_py() for c in ids], t.num_rows
        while cut and all(c[cut - 1].as_py() == x for c, x in zip(ids, last)):
            cut -= 1
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)
