"""Arrow tables of rows that Spark dealt and sorted by their keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs that kernels of arrays hold at once, but for a single row of more.
HELD = 1 << 18


def starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Whether each row has other keys than the row before it; nulls are alike, and the first row starts."""
    new = np.zeros(len(t), bool)
    new[:1] = True
    for k in keys:
        c = t.column(k)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        a, b = c.slice(1), c.slice(0, max(len(t) - 1, 0))
        other = pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= other.to_numpy(zero_copy_only=False).astype(bool)
    return new


def numbers(t: pa.Table, name: str) -> np.ndarray:
    """A column as doubles, nan for null."""
    return t.column(name).cast(pa.float64()).to_numpy()


def known(t: pa.Table, names: list[str]) -> np.ndarray:
    """Rows that have none of these null."""
    out = np.ones(len(t), bool)
    for n in names:
        out &= t.column(n).is_valid().to_numpy()
    return out


def whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The batches, sorted by the keys, as tables that are cut where the keys change."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not len(t):
            continue
        last = held[-1].slice(len(held[-1]) - 1) if held else t.slice(0, 0)
        new = np.flatnonzero(starts(pa.concat_tables([last, t]), keys)[len(last) :])
        if len(new):
            cut = int(new[-1])
            if held or cut:
                yield pa.concat_tables([*held, t.slice(0, cut)])
            held = []
            t = t.slice(cut)
        held.append(t)
    if held:
        yield pa.concat_tables(held)


def parts(sizes: np.ndarray, most: int = HELD) -> Iterator[slice]:
    """Stretches of neighbours whose sizes add up to no more than `most`, or of one."""
    ends, i = np.cumsum(sizes), 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + most, "right")))
        yield slice(i, j)
        i = j


def ranges(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): the n places from `first` on, of each row."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
