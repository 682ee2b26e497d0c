"""Groups of sorted rows inside a task, taken from a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def _changes(batch: pa.RecordBatch, keys: tuple[str, ...]) -> np.ndarray:
    """Positions at which a row's key differs from the row before it."""
    differs = np.zeros(max(0, batch.num_rows - 1), bool)
    for name in keys:
        column = batch.column(name)
        if pa.types.is_integer(column.type):
            values = column.to_numpy(zero_copy_only=False)
        else:
            values = np.array(column.to_pylist(), object)
        differs |= values[1:] != values[:-1]
    return np.flatnonzero(differs) + 1


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys; a group may span batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = [0, *_changes(batch, keys).tolist(), batch.num_rows]
        if waiting and any(waiting[-1].column(k)[waiting[-1].num_rows - 1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(waiting)
            waiting = []
        for begin, end in zip(edges[:-1], edges[1:]):
            waiting.append(batch.slice(begin, end - begin))
            if end < batch.num_rows:
                yield pa.Table.from_batches(waiting)
                waiting = []
    if waiting:
        yield pa.Table.from_batches(waiting)


def smallest_reachable(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each id, the smallest id reachable by the links between positions a and b."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    a, b = place[a], place[b]
    root = np.arange(len(ids))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return ids[order][root][place]
