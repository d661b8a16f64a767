"""Fast similarity sketching of sets of 64-bit numbers, many sets at a time.

t rounds throw every element into a random bin with a value that grows with the
round; t more rounds send every element to one given bin each, so each of the t
coordinates fills.  A set stops as soon as it has no empty bin.  The coordinates
of two sets agree with a chance equal to their Jaccard similarity, and the share
of equal ones is concentrated as for independent coordinates.
"""

from __future__ import annotations

import numpy as np

from tidefunnel.llm.words import K, mix

SIZE = 320  # coordinates
ROWS = 5  # coordinates of a band: a pair at 0.75 shares none of 64 bands with chance 3e-8
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(values: np.ndarray, begins: np.ndarray, size: int = SIZE) -> np.ndarray:
    """One row of coordinates for each set; an empty set keeps EMPTY everywhere."""
    n = len(begins) - 1
    out = np.full(n * size, EMPTY)
    owner = np.repeat(np.arange(n), np.diff(begins))
    base = owner * size
    fixed = np.uint64(size)
    for turn in range(2 * size):
        if not len(values):
            break
        seed = mix(np.array([turn + 1], np.uint64) * K)[0]
        value = mix(values ^ seed)
        if turn < size:
            place = base + ((value >> np.uint64(32)) * fixed >> np.uint64(32)).astype(np.int64)
        else:
            place = base + (turn - size)
        # the high bits hold the round, so earlier rounds win; the rest orders within it
        coded = (np.uint64(turn) << np.uint64(53)) | (mix(value) >> np.uint64(11))
        # a bin that an earlier round filled stays; duplicates of an element change nothing
        open_ = out[place] >> np.uint64(53) >= np.uint64(turn)
        np.minimum.at(out, place[open_], coded[open_])
        if turn % 2 or turn < 4:
            left = (out.reshape(n, size) == EMPTY).any(axis=1)
            if not left.all():
                keep = left[owner]
                values, owner, base = values[keep], owner[keep], base[keep]
    return out.reshape(n, size)


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number for each band of ``rows`` coordinates, different from band to band."""
    n, size = sketch.shape
    many = size // rows
    value = np.broadcast_to(mix(np.arange(1, many + 1, dtype=np.uint64)), (n, many)).copy()
    with np.errstate(over="ignore"):
        for j in range(rows):
            value = mix(value * K + sketch[:, j : many * rows : rows])
    return value


def short_form(sketch: np.ndarray) -> np.ndarray:
    """The low byte of each coordinate, mixed: enough to estimate similarity."""
    return (mix(sketch) & np.uint64(255)).astype(np.uint8)
