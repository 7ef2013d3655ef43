from __future__ import annotations

import numpy as np

from headway.llm import suffix_tree_lm


def test_ranked_is_exact_where_leading_bits_are_shared():
    draw = np.random.default_rng(5)
    spread = draw.integers(0, 2**64, 5000, dtype=np.uint64)
    close = np.uint64(1 << 63) + draw.integers(0, 300, 5000, dtype=np.uint64)
    # With one value far off, the others differ only in bits that make room for places.
    far = np.concatenate([close, [np.uint64(0), np.uint64(2**64 - 1)]])
    for values in (spread, np.repeat(spread, 3), close, far, far[::-1].copy(), spread[:1], spread[:0]):
        distinct, which = suffix_tree_lm._ranked(values)
        expected, place = np.unique(values, return_inverse=True)
        assert distinct.dtype == np.uint64 and distinct.tolist() == expected.tolist()
        assert which.dtype == np.int32 and which.tolist() == place.tolist()
