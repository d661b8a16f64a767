"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Each rule measures a text and rejects it or not; a document stays if no rule
rejects it, so the order changes the work and never the verdict.  On a fixed-size
sample (the ROWS documents with the least hash of their id, whatever the size of
the table) every rule is timed and its share of rejections counted; the cascade
then runs the rules with the most rejections per second first, each on the
documents that the earlier ones left.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm.common import documents, small_batches

ROWS = 2000
SYMBOLS = b"#*$%&|<>"
GAPS = bytes([9, 10, 11, 12, 13, 32])

# --- measures of many texts at once; each takes UTF-8 texts and returns one number each


def n_words(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t.split()) for t in texts], np.int64)


def word_chars(texts: list[bytes]) -> np.ndarray:
    """Code points in words: bytes that are no separator and continue no character."""
    follow = bytes(range(0x80, 0xC0))
    return np.array([len(t.translate(None, GAPS + follow)) for t in texts], np.int64)


def n_symbols(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)


def n_dup_lines(texts: list[bytes]) -> np.ndarray:
    """Lines with a word that equal an earlier line."""
    out = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.strip(GAPS)]
        out.append(len(lines) - len(set(lines)))
    return np.array(out, np.int64)


def n_repeat_words(texts: list[bytes]) -> np.ndarray:
    """Words inside 3-word windows that the text has twice or more.  Case counts."""
    out = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        found = t.split()
        if len(found) < 4:
            continue
        ids: dict[bytes, int] = {}
        seq = np.array([ids.setdefault(w, len(ids)) for w in found], np.int64)
        size = len(ids)
        pairs = np.unique(seq[:-1] * size + seq[1:], return_inverse=True)[1]
        grams = pairs[:-1] * size + seq[2:]
        _, which, counts = np.unique(grams, return_inverse=True, return_counts=True)
        again = counts[which] > 1
        covered = np.zeros(len(seq), bool)
        for j in range(3):
            covered[j : j + len(again)] |= again
        out[k] = covered.sum()
    return out


def upper_share(texts: list[bytes]) -> np.ndarray:
    """Upper-case among the ASCII letters."""
    high, low = bytes(range(65, 91)), bytes(range(97, 123))
    up = np.array([len(t) - len(t.translate(None, high)) for t in texts], float)
    all_ = up + np.array([len(t) - len(t.translate(None, low)) for t in texts], float)
    return up / np.maximum(all_, 1)


def mark_share(texts: list[bytes]) -> np.ndarray:
    """Exclamation and question marks for each word."""
    marks = np.array([t.count(b"!") + t.count(b"?") for t in texts], float)
    return marks / np.maximum(n_words(texts), 1)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[list[bytes]], np.ndarray]


def _lines(texts: list[bytes]) -> np.ndarray:
    return np.array([sum(bool(x.strip(GAPS)) for x in t.split(b"\n")) for t in texts], np.int64)


def _word_length(texts: list[bytes]) -> np.ndarray:
    mean = word_chars(texts) / np.maximum(n_words(texts), 1)
    return (mean < 2) | (mean > 20)


#: Reject: too short, or half of the words in repeated windows (these two are the base);
#: a symbol for each fourth word; more than half of at least four lines repeated; mostly
#: capitals; a mark for each third word; words of an odd length.
RULES = (
    Rule("too_short", lambda t: n_words(t) < 50),
    Rule("repeated_words", lambda t: 100 * n_repeat_words(t) > 50 * n_words(t)),
    Rule("symbols", lambda t: 4 * n_symbols(t) > n_words(t)),
    Rule("repeated_lines", lambda t: (_lines(t) >= 4) & (2 * n_dup_lines(t) > _lines(t))),
    Rule("capitals", lambda t: upper_share(t) > 0.5),
    Rule("marks", lambda t: 3 * mark_share(t) > 1),
    Rule("word_length", _word_length),
)

BASE = ("too_short", "repeated_words")


def costs(sample: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) on the sample, best first: most rejections per second."""
    out = []
    for rule in rules:
        began = time.perf_counter()
        rejected = float(np.mean(rule.rejects(sample))) if sample else 0.0
        out.append((rule.name, max(time.perf_counter() - began, 1e-9), rejected))
    return sorted(out, key=lambda x: (-x[2] / x[1], x[1], x[0]))


def sampled(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """The ``rows`` documents of least id hash, found by their ids before any text moves.

    An id counts once, however many rows share it, and one of its rows is taken.
    """
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.join(F.broadcast(ids), "doc_id", "left_semi")  # at most ``rows`` ids
    return found.groupBy("doc_id").agg(F.min("text").alias("text"))


def plan_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = ROWS) -> list[str]:
    """Names of the rules in the order of the cascade.

    The rules are timed where the texts are; each task returns one line a rule.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            if texts:
                found = costs(texts, rules)
                yield pa.RecordBatch.from_pydict(
                    {
                        "rule": [x[0] for x in found],
                        "s": [x[1] for x in found],
                        "rejected": [x[2] * len(texts) for x in found],
                    }
                )

    lines = sampled(docs, rows).select("text").mapInArrow(measure, "rule string, s double, rejected double")
    found = lines.groupBy("rule").agg(F.sum("s").alias("s"), F.sum("rejected").alias("r")).collect()
    by = {x["rule"]: (-x["r"] / x["s"], x["s"]) for x in found}
    return sorted((r.name for r in rules), key=lambda name: (*by.get(name, (0.0, 0.0)), name))


def cascade(texts: list[bytes], rules: list[Rule]) -> np.ndarray:
    """True for the texts that no rule rejects; each rule sees what the earlier ones left."""
    kept = np.ones(len(texts), bool)
    left = np.arange(len(texts))
    for rule in rules:
        if not len(left):
            break
        rejected = np.asarray(rule.rejects([texts[i] for i in left]), bool)
        kept[left[rejected]] = False
        left = left[~rejected]
    return kept


def passing(
    docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, order: list[str] | None = None
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects; NULL and empty texts have no words and go."""
    order = order or plan_order(_own(docs, text_col), rules)
    by = {r.name: r for r in rules}
    ordered = [by[name] for name in order]

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(place).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array(cascade([(t or "").encode() for t in texts], ordered)))

    return docs.mapInArrow(run, docs.schema)


# --- the same for DuckDB -------------------------------------------------------


def rules_sql() -> str:
    gap = r"\x20\x09-\x0D"
    return rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^{gap}]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^{gap}]')) AS lines
        FROM documents
    ),
    gram AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
    ),
    again AS (
        SELECT doc_id, count(DISTINCT i + j) AS n FROM gram, (VALUES (0), (1), (2)) AS o(j)
        WHERE times > 1 GROUP BY doc_id
    ),
    m AS (
        SELECT d.doc_id, t, len(w)::BIGINT AS n_words,
               coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(again.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
               length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS up,
               length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS letters,
               length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS marks
        FROM d LEFT JOIN again USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 4 * n_symbols > n_words
                OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines) OR 2 * up > letters
                OR 3 * marks > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM m
    """


def _own(docs: DataFrame, text_col: str) -> DataFrame:
    """Texts under an id of their own content, for tables of any columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text"))


METRICS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The base metrics of each text, whether the base fails it, and the cascade's verdict.

    A NULL or empty text has no words, so the base fails it.  Rows that repeat an id
    are judged one by one.  A row that the base fails is never kept.
    """
    plain = documents(docs, id_col, text_col)
    order = plan_order(plain, rules)
    by = {r.name: r for r in rules}
    # the base is measured for every row anyway; the cascade decides on what it leaves
    ordered = [by[name] for name in order if name not in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t.encode() for t in part.column("text").to_pylist()]
                n, repeated = n_words(texts), n_repeat_words(texts)
                failed = (n < 50) | (100 * repeated > 50 * n)
                kept, left = ~failed, np.flatnonzero(~failed)
                kept[left] = cascade([texts[i] for i in left], ordered)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n), pa.array(word_chars(texts)), pa.array(n_symbols(texts)),
                        pa.array(n_dup_lines(texts)), pa.array(repeated), pa.array(failed),
                        pa.array(kept),
                    ],
                    names=[c.split()[0] for c in METRICS.split(", ")],
                )

    return plain.mapInArrow(run, METRICS)
