"""Quality by a generalised additive model with pairwise interactions.

The score is a sum of lookup tables: one for each feature, and one for each of a
few pairs of features.  Training goes round the features in turn; each turn fits a
shallow tree to the gradient, over the bins of that feature alone, and adds a small
share of it to the feature's table.  Afterwards the pairs that explain most of what
is left are boosted the same way on a coarse grid.  Scoring is one binary search a
feature and additions, for whole batches.

The model is fitted on at most ROWS labelled documents: those with the least hash of
their id, a documented bound that does not follow the table.  Every document is
scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm import rules
from tidefunnel.llm.common import documents

ROWS = 20_000
BINS, GRID = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 40, 6
RATE = 0.15
LEAVES = 3


# --- features ---------------------------------------------------------------

FEATURES = (
    "words", "word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "marks",
    "digits", "doubled_words", "distinct_words", "stops", "commas", "words_a_line", "short_words",
    "longest_word", "beyond_ascii",
)


def _doubled(text: bytes) -> tuple[int, int, int, int]:
    """Words equal to the one before, distinct words, words up to 3 bytes, longest word."""
    found = text.split()
    if not found:
        return 0, 0, 0, 0
    same = sum(map(bytes.__eq__, found, found[1:]))
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return same, len(set(found)), int((sizes <= 3).sum()), int(sizes.max())


def features(texts: list[bytes]) -> np.ndarray:
    """One row of finite numbers for each text; an empty text has zeros."""
    if not texts:
        return np.zeros((0, len(FEATURES)))
    n = rules.n_words(texts).astype(float)
    words, size = np.maximum(n, 1), np.maximum([len(t) for t in texts], 1)
    chars = rules.word_chars(texts)
    lines = np.maximum([t.count(b"\n") + 1 for t in texts], 1)
    own = np.array([_doubled(t) for t in texts], float)

    def share(found: bytes) -> np.ndarray:
        return np.array([len(t) - len(t.translate(None, found)) for t in texts], float)

    return np.column_stack(
        [
            np.log1p(n),
            chars / words,
            share(rules.SYMBOLS) / words,
            rules.n_dup_lines(texts) / lines,
            rules.n_repeat_words(texts) / words,
            rules.upper_share(texts),
            share(b"!?") / words,
            share(b"0123456789") / size,
            own[:, 0] / words,
            own[:, 1] / words,
            share(b".") / words,
            share(b",") / words,
            np.log1p(n / lines),
            own[:, 2] / words,
            np.log1p(own[:, 3]),
            share(bytes(range(128, 256))) / size,
        ]
    )


# --- the model --------------------------------------------------------------


@dataclass
class Additive:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[
                np.searchsorted(self.coarse[i], x[:, i], side="right"),
                np.searchsorted(self.coarse[j], x[:, j], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """The step of each bin: a tree over the ordered bins, split greedily."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            left = _gain(cg[at] - cg[a], ch[at] - ch[a])
            right = _gain(cg[b] - cg[at], ch[b] - ch[at])
            won = left + right - _gain(cg[b] - cg[a], ch[b] - ch[a])
            if won.max() > best[0]:
                best = (won.max(), k, at[won.argmax()])
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return step


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The step of each cell: the best cut of one side, then of each half on the other."""
    best, step = -1.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(gg)):
            new, won = np.zeros_like(gg), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                cells = _tree(gs, hs, 2)
                new[rows] = cells
                won += float((gs * cells - cells * cells * hs / 2).sum())
            if won > best:
                best, step = won, new.T if flip else new
    return step


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting; labels of one kind only, or none, give a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Additive(float(np.log(share / (1 - share))))
    if len(y) < 2 or y.min() == y.max():
        return model
    model.cuts = [_cuts(c, BINS) for c in x.T]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    model.coarse = [_cuts(c, GRID) for c in x.T]
    fine = [np.searchsorted(c, v, side="right") for c, v in zip(model.cuts, x.T, strict=True)]
    rough = [np.searchsorted(c, v, side="right") for c, v in zip(model.coarse, x.T, strict=True)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(
                np.bincount(fine[j], g, len(table)), np.bincount(fine[j], h, len(table)), LEAVES
            )
            table += step
            total += step[fine[j]]
    g, h = slopes()
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i):
            shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
            cell = rough[i] * shape[1] + rough[j]
            size = shape[0] * shape[1]
            ranked.append((-_gain(np.bincount(cell, g, size), np.bincount(cell, h, size)).sum(), i, j))
    for _, i, j in sorted(ranked)[:PAIRS]:
        model.pairs.append((i, j))
        model.grids.append(np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)))
    for _ in range(PAIR_ROUNDS):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            g, h = slopes()
            cell = rough[i] * grid.shape[1] + rough[j]
            step = RATE * _grid_tree(
                np.bincount(cell, g, grid.size).reshape(grid.shape),
                np.bincount(cell, h, grid.size).reshape(grid.shape),
            )
            grid += step
            total += step.ravel()[cell]
    return model


# --- on tables --------------------------------------------------------------


def held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id's decimal digits, modulo 3, is 1; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Additive:
    """Fit on the labelled documents that are not held out, at most ``rows`` of them.

    Labels that are NULL, or differ between rows of an id, count as none.
    """
    plain = documents(docs)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("top"))
        .where("y = top")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "y")
    )
    # at most ``rows`` ids, so the text side is never shuffled
    chosen = plain.join(F.broadcast(known), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features([t.encode() for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(list(found), pa.list_(pa.float64()))],
                names=["doc_id", "y", "x"],
            )

    found = chosen.select("doc_id", "y", "text").mapInArrow(measure, "doc_id long, y int, x array<double>")
    # of a repeated id the least features, whatever order the rows come in; at most ``rows`` ids
    once = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    got = sorted(once.collect(), key=lambda r: r.doc_id)
    x = np.array([r.x for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.y for r in got], float))


def scored(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every text; NULL and empty texts are scored by their zero features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                value = model.score(features([t.encode() for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row; without labels the score is constant."""
    result = scored(docs, train(docs, labels))
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
