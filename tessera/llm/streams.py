"""Arrow helpers for operators that work group by group on sorted partitions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by keys, one table each; only one group and one
    batch are held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for col in cols:
            new[1:] |= col[1:] != col[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi == lo:
                continue
            key = tuple(col[lo] for col in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of a sorted partition, many at a time: a batch and what the one before
    it left of its last group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            col = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= col[1:] != col[:-1]
        end = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        cuts = np.flatnonzero(new)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            at = int(cuts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
            batch = batch.slice(at)
        held.append(batch)
        last = end
    if held:
        yield pa.Table.from_batches(held)


def emit(rows: Iterable[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most `size`."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) >= size:
            yield _batch(block, schema)
            block = []
    if block:
        yield _batch(block, schema)


def _batch(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=field.type) for col, field in zip(zip(*block), schema)], schema=schema
    )


def text_slices(column: pa.Array, most_bytes: int = 4 << 20, most_rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about most_bytes each (one row at least) and no
    more than most_rows."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False))
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(column):
        floor = ends[lo - 1] if lo else 0
        hi = min(lo + most_rows, max(lo + 1, int(np.searchsorted(ends, floor + most_bytes, side="right"))))
        yield lo, hi
        lo = hi
