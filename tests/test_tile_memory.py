"""What a tile of the vector search holds in Python."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tidefunnel.operators import vectors


def test_many_ties_are_measured_in_blocks():
    # every row is as near as the last: 400 questions with 1,000 hits each
    rows = np.ones((1000, 32))
    questions = np.zeros((400, 32), np.float32)
    questions[:, 0] = 2
    i, row, _ = vectors.closest(questions, rows, 3)
    assert len(i) == 400_000
    tracemalloc.start()
    found = vectors._cosines(questions, rows, i, row)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(found, 1 / np.sqrt(32)) and peak < 40 << 20  # over 200 MB before


def test_questions_are_kept_as_stored():
    lists = pa.array([[1.5, 2.0], [0.1, 3.0]], pa.list_(pa.float32()))
    kept = vectors.matrix(lists, None)
    assert kept.dtype == np.float32 and vectors.matrix(lists).dtype == np.float64
    rows = np.random.default_rng(3).random((50, 2))
    for a, b in zip(vectors.closest(kept, rows, 4), vectors.closest(vectors.matrix(lists), rows, 4), strict=True):
        assert np.array_equal(a, b)
