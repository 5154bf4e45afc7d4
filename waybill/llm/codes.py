"""Counts of numbers below 2**24, added up over all tasks in ranges.

A row holds the counts of one group (some key columns) in one range of numbers.
A range is summed in an array of fixed size, so neither a common group nor a
common number makes a large task, and the result has a bound of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RANGE_BITS = 20

Keys = tuple[tuple[str, pa.DataType], ...]


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ascending keys: the distinct ones, the sums of their values, their numbers."""
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[firsts], np.add.reduceat(values, firsts), np.diff(np.append(firsts, len(keys)))


def merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of several pieces in one, ascending."""
    keys, values = (np.concatenate(column) for column in zip(*pieces))
    order = np.argsort(keys, kind="stable")
    return grouped(keys[order], values[order])[:2]


def _batch(rows: list[tuple], keys: Keys) -> pa.RecordBatch:
    kinds = [*(kind for _, kind in keys), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(columns, kinds)],
                                      [*(name for name, _ in keys), "part", "codes", "counts"])


def packed(held: dict[tuple, list[tuple[np.ndarray, np.ndarray]]], keys: Keys) -> pa.RecordBatch:
    """One row per group and range from pieces of numbers and counts per group."""
    rows = []
    for group, pieces in held.items():
        codes, sums = merged(pieces)
        parts = codes >> np.uint32(RANGE_BITS)
        cuts = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [len(codes)]])
        rows += [(*group, int(parts[low]), codes[low:high].tobytes(), sums[low:high].astype("<i8").tobytes())
                 for low, high in zip(cuts[:-1], cuts[1:])]
    return _batch(rows, keys)


def add_up(keys: Keys):
    """A function over batches sorted by the keys and `part`: one row per group and range."""
    names = [*(name for name, _ in keys), "part"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, totals = None, np.zeros(1 << RANGE_BITS, np.int64)

        def flush() -> pa.RecordBatch:
            places = np.flatnonzero(totals)
            codes = (places + (current[-1] << RANGE_BITS)).astype(np.uint32)
            row = (*current, codes.tobytes(), totals[places].astype("<i8").tobytes())
            totals[places] = 0
            return _batch([row], keys)

        for batch in batches:
            for row in batch.to_pylist():
                group = tuple(row[name] for name in names)
                if current is not None and group != current:
                    yield flush()
                current = group
                codes = np.frombuffer(row["codes"], np.uint32) - np.uint32(group[-1] << RANGE_BITS)
                totals[codes] += np.frombuffer(row["counts"], "<i8")
        if current is not None:
            yield flush()
    return add
