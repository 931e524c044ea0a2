"""Many short series at once in numpy: rows sorted by series become a time-by-series matrix, longest series first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


class Packed:
    """``at[t, s]`` is the row of reading ``t`` of series ``s``; the first ``alive[t]`` series have such a reading."""

    def __init__(self, key: np.ndarray):
        n = len(key)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.zeros(0, int)
        length = np.diff(np.r_[first, n])
        order = np.argsort(-length, kind="stable")
        self.start, self.length = first[order], length[order]
        self.alive = np.searchsorted(-self.length, -np.arange(1, (self.length[0] if len(order) else 0) + 1), side="right")

    def rows(self, t: int) -> np.ndarray:
        return self.start[: self.alive[t]] + t


def series_median(key: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys, ascending in order of appearance of sorted input, and the median of ``x`` in each."""
    order = np.lexsort((x, key))
    k, v = key[order], x[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
    n = np.diff(np.r_[first, len(k)])
    return k[first], (v[first + (n - 1) // 2] + v[first + n // 2]) / 2


def whole_series(batches: Iterator[pa.RecordBatch], key: str, run: Callable[[pa.Table], pa.RecordBatch], least_rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Feed ``run`` with whole series of input that is sorted by ``key``, about ``least_rows`` at a time."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < least_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        k = t[key].to_numpy()
        cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        if cut:
            yield run(t.slice(0, cut))
            held = t.slice(cut).to_batches()
            n = t.num_rows - cut
    if held:
        yield run(pa.Table.from_batches(held).combine_chunks())
