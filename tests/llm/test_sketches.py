"""Sketches of sets: they may let a pair through, but never rule out a similar one."""

import numpy as np
import pytest

from tidemark.llm.similar import Sketches, cells_apart, sketch


@pytest.mark.parametrize("size", [1, 3, 32, 33, 64, 500, 900, 5000])
def test_sketches_rule_out_no_similar_set(size):
    rng = np.random.default_rng(size)
    for _ in range(40):
        left = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        cut, more = rng.integers(0, size // 3 + 1, 2)
        right = np.unique(np.concatenate([left[cut:], rng.integers(0, 2**64, more, dtype=np.uint64)]))
        shared = len(np.intersect1d(left, right))
        assert cells_apart(sketch(left), sketch(right)) <= len(left) + len(right) - 2 * shared
        found = Sketches([(1, 1, len(left), sketch(left))]).close_to(2, 2, len(right), sketch(right), 80)
        assert found == [1] or 100 * shared < 80 * (len(left) + len(right) - shared)
    other = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    assert Sketches([(1, 1, len(left), sketch(left))]).close_to(2, 2, len(other), sketch(other), 80) == []
