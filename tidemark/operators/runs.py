"""Groups out of sorted Arrow batches, without a call from the JVM for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of equal ``by``, over batches that are sorted by it."""
    key: tuple | None = None
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c) for c in by]
        differs = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            differs |= codes[1:] != codes[:-1]
        edges = [0, *(np.flatnonzero(differs) + 1).tolist(), batch.num_rows]
        for at, end in zip(edges, edges[1:], strict=False):
            own = tuple(c[at].as_py() for c in columns)
            if key is not None and own != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(at, end - at))
    if key is not None:
        yield key, pa.Table.from_batches(held)
