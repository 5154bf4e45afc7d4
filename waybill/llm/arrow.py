"""Small helpers around Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text is worked on in slices of about this many bytes, whatever the batch holds.
SLICE_BYTES = 1 << 20


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the borders of its values. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, borders, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(borders, width, len(column) + 1, column.offset * width().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes of text; a longer text is a range of its own."""
    _, offsets = utf8(column)
    low, rows = 0, len(column)
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into smaller ones by the bytes of one text column."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        for low, high in slices(batch.column(place), limit):
            yield batch.slice(low, high - low)


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                 rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and the groups' borders, from sorted batches. Keys are integers."""
    held: list[pa.RecordBatch] = []
    count = 0

    def cut(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[:1] = True
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(change), table.num_rows)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        borders = cut(table)
        if len(borders) > 2:
            yield table.slice(0, borders[-2]), borders[:-1]
        held = table.slice(borders[-2]).combine_chunks().to_batches()
        count = table.num_rows - borders[-2]
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)
