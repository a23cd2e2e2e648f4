"""Arrow batches joined to larger ones, for work whose cost is mostly per call."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

ROWS = 60_000
BYTES = 64 << 20


def larger(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of about so many rows, or fewer when their texts are long."""
    held: list[pa.RecordBatch] = []
    n = b = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        b += batch.nbytes
        if n >= rows or b >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, b = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
