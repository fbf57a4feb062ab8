"""Groups of sorted plain columns, streamed: Spark sorts each partition, a task holds a batch and one group's rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def order_key(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Numbers that order as the ids do within this array, nulls first."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return np.asarray(ids).astype(np.int64)
    return np.asarray(pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense")).astype(np.int64)


def starts(b: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    """Whether each row of a sorted batch begins a group of equal keys; the first row does."""
    new = np.zeros(b.num_rows, bool)
    new[:1] = True
    for c in keys:
        x = b.column(c)
        k = np.asarray(x) if pa.types.is_integer(x.type) and not x.null_count else order_key(x)
        new[1:] |= k[1:] != k[:-1]
    return new


def same_group(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: tuple[str, ...]) -> bool:
    """Whether row i of a and row j of b have equal keys."""
    return all(a.column(c)[i].as_py() == b.column(c)[j].as_py() for c in keys)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted partition again, in batches that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = int(np.flatnonzero(starts(b, keys))[-1])
        if last or (held and not same_group(held[-1], 0, b, 0, keys)):
            if last and held and not same_group(held[-1], 0, b, 0, keys):
                yield from _joined(held)
                held = []
            held.append(b.slice(0, last))
            yield from _joined(held)
            held = []
        held.append(b.slice(last))
    yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in held if b.num_rows]
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def lists_by_document(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(id, v, columns as int lists) with one row for each (id, v), lists in place order of the first column.

    A document's own list is held whole; its text is as well where the list is used.
    """
    kind = rows.schema["id"].dataType.simpleString()
    keys = ("id", "v")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in whole_groups(batches, keys):
            begin = np.flatnonzero(starts(b, keys))
            offsets = pa.array(np.append(begin, b.num_rows).astype(np.int32))
            head = pa.array(begin)
            lists = [pa.ListArray.from_arrays(offsets, b.column(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([b.column("id").take(head), b.column("v").take(head), *lists], ["id", "v", *columns])

    dealt = rows.select("id", "v", *(rows[c].cast("int") for c in columns)).repartition("id", "v").sortWithinPartitions("id", "v", columns[0])
    return dealt.mapInArrow(scan, f"id {kind}, v long, " + ", ".join(f"{c} array<int>" for c in columns))
