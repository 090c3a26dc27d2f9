"""Whole groups from sorted Arrow batches, for work inside a task on several rows at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def _changes(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where a row's key differs from the row's before; the first row counts as different."""
    out = np.zeros(table.num_rows, dtype=bool)
    out[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        out[1:] |= values[1:] != values[:-1]
    return out


def group_bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Starts of the groups of a table sorted by number columns `keys`, and its length."""
    return np.append(np.flatnonzero(_changes(table, keys)), table.num_rows)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from the sorted batches of a task; what is held is one batch and the group under way."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        begins = np.flatnonzero(_changes(pa.Table.from_batches([batch]), keys))
        if held and all(held[-1].column(k)[held[-1].num_rows - 1] == batch.column(k)[0] for k in keys):
            begins = begins[1:]
        if not len(begins):
            held.append(batch)
            continue
        # the last group may go on in the next batch
        whole = [b for b in (*held, batch.slice(0, int(begins[-1]))) if b.num_rows]
        if whole:
            yield pa.Table.from_batches(whole)
        held = [batch.slice(int(begins[-1]))]
    if held:
        yield pa.Table.from_batches(held)
