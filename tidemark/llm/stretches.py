"""Texts of any length in stretches of bounded size, a slice of stretches at a time.

A text above ``size`` bytes is cut where the caller allows it; what an operator needs of a
text must then add up over its stretches. Only a text without such a place stays whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .batches import SLICE, buffers

#: Where a stretch may begin: a mask over some bytes, the first and last of which are context.
Places = Callable[[np.ndarray], np.ndarray]


@dataclass
class Slice:
    """Consecutive stretches: their bytes, where each begins and ends, and its row."""

    raw: np.ndarray
    bounds: np.ndarray  # one more than stretches, from 0
    rows: np.ndarray
    last: np.ndarray  # whether a stretch is its text's last


def _cuts(raw: np.ndarray, start: int, end: int, size: int, places: Places) -> Iterator[int]:
    while end - start > size:
        at, found = start + size, None
        while at < end - 1 and found is None:
            upto = min(end, at + size + 2)
            inside = np.flatnonzero(places(raw[at - 1 : upto])[1:-1])
            found = at + int(inside[0]) if len(inside) else None
            at = upto - 2 if upto < end else end
        if found is None:
            return
        yield found
        start = found


def sliced(column: pa.Array, places: Places, size: int = SLICE) -> Iterator[Slice]:
    """The column's texts in slices of about ``size`` bytes; null is an empty text."""
    offsets, raw = buffers(column)
    starts, rows, last = offsets[:-1], np.arange(len(column)), np.ones(len(column), bool)
    for row in np.flatnonzero(np.diff(offsets) > size).tolist()[::-1]:
        cuts = list(_cuts(raw, int(offsets[row]), int(offsets[row + 1]), size, places))
        starts, rows = np.insert(starts, row + 1, cuts), np.insert(rows, row + 1, [row] * len(cuts))
        last = np.insert(last, row, [False] * len(cuts))
    edges = np.append(starts, offsets[-1])
    at = 0
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + size, "right")) - 1)
        yield Slice(raw[edges[at] : edges[upto]], edges[at : upto + 1] - edges[at], rows[at:upto], last[at:upto])
        at = upto
