"""Longest-previous-factor arrays against their definition."""

import numpy as np
import pytest

from estatelens.llm import suffix_dedup


def shared(text, i, j, most):
    n = 0
    while n < most and i + n < len(text) and j + n < len(text) and text[i + n] == text[j + n]:
        n += 1
    return n


@pytest.mark.parametrize("letters, most", [(1, 9), (2, 5), (2, 20), (4, 100)])
def test_lengths(letters, most):
    r = np.random.default_rng(letters)
    text = np.concatenate([r.integers(97, 97 + letters, 150), np.tile(r.integers(97, 97 + letters, 12), 12)]).astype(np.uint8)
    at = np.arange(len(text) - most)
    doc, start = r.integers(0, 3, len(at)), r.integers(0, 60, len(at))  # positions that repeat, in any order
    order, length = suffix_dedup.previous_factor(text, at, suffix_dedup.suffix_ranks(text, at, most), most, doc, start)
    want = [max([shared(text, at[i], at[j], most) for j in range(len(at)) if (doc[j], start[j]) < (doc[i], start[i])], default=0)
            for i in range(len(at))]
    assert sorted(order.tolist()) == list(range(len(at)))
    assert length.tolist() == [want[i] for i in order]
    assert len(suffix_dedup.previous_factor(text, at[:0], at[:0], most, at[:0])[1]) == 0


def test_windows_of_a_chunk_are_compared():
    data = np.frombuffer(b"abcdefabcdeg", np.uint8)
    at, other = np.array([6, 7]), np.array([0, 1])
    assert suffix_dedup._same_bytes(data, at, other, 4) and not suffix_dedup._same_bytes(data, np.array([6, 7, 8]), np.array([0, 1, 2]), 4)
    assert suffix_dedup._same_bytes(data, at[:0], other[:0], 4)
