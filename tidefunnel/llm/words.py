"""Words and word shingles of whole Arrow batches as 64-bit numbers, in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z in
lower case.  A word's number is a polynomial over random 64-bit values of its
bytes, mixed afterwards; a shingle's number is a mix of those of its words.  Two
different words or shingles get the same number with a chance of about 2**-56.

The work goes in blocks of about BLOCK bytes, cut behind a separator or a
document, so memory follows the block and not the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
K = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * K)
    values[65:91] = values[97:123]
    return values


def _separators() -> np.ndarray:
    found = np.zeros(256, bool)
    found[[9, 10, 11, 12, 13, 32]] = True
    return found


BYTE, SEPARATOR = _byte_values(), _separators()


def text_bytes(column: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of bytes, and where each begins (one entry more than texts)."""
    if not isinstance(column, pa.Array):
        column = pa.array(column, pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(K), -1, 1 << 64))
    out = []
    for base in (K, inverse):
        steps = np.full(n, base)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, where each text's words begin among them)."""
    parts, starts_of = [], []
    up = down = np.zeros(0, np.uint64)
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:  # cut where a word cannot go on
            cut = np.flatnonzero(SEPARATOR[data[at:end]])
            doc = offsets[np.searchsorted(offsets, end, side="right") - 1]
            best = max(at + cut[-1] + 1 if len(cut) else 0, doc)
            while best <= at and end < n:
                end = min(n, end + BLOCK)
                cut = np.flatnonzero(SEPARATOR[data[at:end]])
                doc = offsets[np.searchsorted(offsets, end, side="right") - 1]
                best = max(at + cut[-1] + 1 if len(cut) else 0, doc if doc < end else 0)
                best = n if end == n and best <= at else best
            end = best
        block = data[at:end]
        if len(block) > len(up):
            up, down = _powers(max(len(block), min(n, BLOCK)))
        gap = SEPARATOR[block]
        first = np.zeros(len(block), bool)
        begun = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        first[begun] = True
        first[0] = True
        starts = ~gap
        starts[1:] &= gap[:-1] | first[1:]
        last = ~gap
        last[:-1] &= gap[1:] | first[1:]
        s, e = np.flatnonzero(starts), np.flatnonzero(last)
        with np.errstate(over="ignore"):
            total = np.cumsum(BYTE[block] * up[: len(block)], dtype=np.uint64)
            value = total[e] - np.where(s > 0, total[np.maximum(s, 1) - 1], np.uint64(0))
            value = mix(value * down[s] ^ (e - s + 1).astype(np.uint64) * K)
        parts.append(value)
        starts_of.append(s + at)
        at = end
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    where = np.concatenate(starts_of) if parts else np.zeros(0, np.int64)
    return words, np.searchsorted(where, offsets)


def windows(words: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each run of k words inside a text, where each text's runs begin)."""
    counts = np.maximum(np.diff(begins) - k + 1, 0)
    if len(words) < k:
        return np.zeros(0, np.uint64), np.zeros(len(begins), np.int64)
    n = len(words) - k + 1
    value = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            value = mix(value * K + words[j : j + n])
    keep = np.zeros(n + 1, np.int64)
    np.add.at(keep, np.minimum(begins[:-1][counts > 0], n), 1)
    np.add.at(keep, np.minimum((begins[:-1] + counts)[counts > 0], n), -1)
    inside = np.cumsum(keep)[:n] > 0
    return value[inside], np.concatenate([[0], np.cumsum(counts)])


def shingles(words: np.ndarray, begins: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """As ``windows``; a text with words, but fewer than k, has its whole sequence as one."""
    value, at = windows(words, begins, k)
    sizes = np.diff(begins)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if not len(short):
        return value, at
    own = np.zeros(len(short), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k - 1):
            here = sizes[short] > j
            own[here] = mix(own[here] * K + words[begins[short[here]] + j])
        own = mix(own ^ sizes[short].astype(np.uint64) * BYTE[7])
    counts = np.diff(at)
    counts[short] = 1
    out = np.zeros(counts.sum(), np.uint64)
    to = np.concatenate([[0], np.cumsum(counts)])
    lone = np.zeros(len(out), bool)
    lone[to[short]] = True
    out[lone] = own
    out[~lone] = value
    return out, to


def slices(offsets: np.ndarray, most: int = BLOCK) -> list[tuple[int, int]]:
    """Runs of texts with about ``most`` bytes together (at least one text each)."""
    out, a = [], 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        out.append((a, b))
        a = b
    return out
