"""Signatures for a set similarity join by partitions of the feature domain.

Sets fall into bands of similar size, so that similar sets lie in one band or in two
neighbouring ones. For such a pair of bands the similarity bounds how many features
two similar sets may differ in, ``k``. The domain of 64-bit features is cut into
``groups`` of ``parts`` ranges each; ``k`` differences leave ``spare + 1`` groups with
at most ``loss`` of their parts touched. A signature stands for the features in all but
``loss`` parts of one group, and all such subsets are enumerated: similar sets share one.

Signatures of hardly any feature say nothing and would meet everywhere. Those of less
than ``least`` features are not used; a set for which more than ``spare`` groups hold
such ones adds signatures of another cut of the domain, until a cut suits it. Two
similar sets meet in the first cut that suits either, as both use it.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb, exp, factorial, sqrt
from typing import NamedTuple

import numpy as np

from .batches import mix

#: Groups lose a part up to this many differences; beyond, a signature is a whole part.
SUBSETS_UP_TO = 32
#: Cuts tried before the last one, which uses all signatures.
CUTS = 16


class Layout(NamedTuple):
    """How the domain is cut for one pair of bands."""

    groups: int
    parts: int
    loss: int
    spare: int
    least: int
    edges: np.ndarray
    subsets: np.ndarray


@lru_cache(maxsize=None)
def band(number: int, percent: int) -> tuple[int, int]:
    """Smallest and largest set size of a band."""
    low = 1 if number == 0 else band(number - 1, percent)[1] + 1
    return low, low * 100 // percent


def band_of(size: int, percent: int) -> int:
    number = 0
    while band(number, percent)[1] < size:
        number += 1
    return number


@lru_cache(maxsize=None)
def layout(pair: int, percent: int) -> Layout | None:
    """The cut for bands ``pair - 1`` and ``pair``; none if only equal sets are similar."""
    if pair == 0:
        return None
    smallest = band(pair - 1, percent)[0]
    k = (band(pair - 1, percent)[1] + band(pair, percent)[1]) * (100 - percent) // (100 + percent)
    if k == 0:
        return None
    loss, parts = (1, 3) if k < SUBSETS_UP_TO else (0, 1)
    need = k // (loss + 1) + 1
    for least in (2, 1):
        spare = 0
        while True:
            mean = smallest / ((need + spare) * parts) * (parts - loss)
            thin = min(1.0, comb(parts, loss) * sum(exp(-mean) * mean**i / factorial(i) for i in range(least)))
            expected = (need + spare) * thin
            if int(expected + 2 * sqrt(expected)) <= spare or spare > need // 2 + 1:
                break
            spare += 1
        if spare <= need // 2 + 1:
            break
    groups = need + spare
    cells = groups * parts
    edges = np.array([(j << 64) // cells for j in range(1, cells)], np.uint64)
    kept = list(combinations(range(parts), parts - loss))
    subsets = np.zeros((parts, len(kept)), np.uint64)
    for i, members in enumerate(kept):
        subsets[list(members), i] = 1
    return Layout(groups, parts, loss, spare, least, edges, subsets)


@lru_cache(maxsize=None)
def salts(pair: int, cut: int, count: int) -> np.ndarray:
    return mix(np.arange(count, dtype=np.uint64) + np.uint64(pair << 40) + np.uint64(cut << 32), 31)


def signatures(features: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set, given as sorted distinct 64-bit features."""
    size = len(features)
    if size == 0:
        return np.zeros(0, np.uint64)
    own = band_of(size, percent)
    out = []
    for pair in (own, own + 1):
        plan = layout(pair, percent)
        if plan is None:
            continue
        for cut in range(CUTS + 1):
            placed = features if cut == 0 else np.sort(mix(features, cut))
            bounds = np.concatenate([[0], np.searchsorted(placed, plan.edges), [size]])
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(mix(placed, 77), out=sums[1:])
            counts = np.diff(bounds).astype(np.uint64).reshape(plan.groups, plan.parts) @ plan.subsets
            of = (sums[bounds[1:]] - sums[bounds[:-1]]).reshape(plan.groups, plan.parts) @ plan.subsets
            made = mix(of.reshape(-1) + salts(pair, cut, of.size))
            if cut == CUTS:
                out.append(made)
                break
            thin = counts < plan.least
            out.append(made[~thin.reshape(-1)])
            if int(thin.any(axis=1).sum()) <= plan.spare:
                break
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)
