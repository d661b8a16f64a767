"""Importance resampling of documents towards a target text, by hashed word runs.

An untrained regular-expression split of the tokenizers library cuts the text (A-Z
in lower case) into words with offsets.  Windows over the offset pairs give every run
of 1 to ``longest`` consecutive words; a run, joined by one space, falls into the
bucket of its CRC-32.  Bucket counts of the corpus and of the target give each bucket
a gain; a document's weight is the floored mean gain of its runs, and a Gumbel value
hashed from its id turns the weight into a score, so that the highest scores are a
draw without replacement.

A text is split once: its buckets are written as two bytes a run, and both the counts
and the weights read them.  Texts are cut behind a character that is in no word, so
memory follows PIECE.  Ranks come from ranges of the order, never from one task.

NULL and empty texts and texts without words have no runs, weight 0 and a score, and
are never drawn (fewer than ``least_words`` words).  Repeated rows are documents of
their own; equal scores are settled by id and, among equal ids, arbitrarily.  A row
without an id has neither score nor rank.  Empty tables give no rows, and an empty
target gives gains of the corpus alone.  Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.operators.ordered import total_order_sum
from tidefunnel.operators.tables import staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # Fixed value: what a word is
BUCKETS = 10_000
SEED = 2024
PIECE = 1 << 12  # characters that are split at a time
KNOWN = 1 << 18  # runs whose buckets a task remembers


def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def pieces(text: str, size: int) -> list[str]:
    """``text`` cut behind characters that are in no word (one longer word stays whole)."""
    out, at = [], 0
    while at < len(text):
        end = at + size
        while end < len(text) and (text[end - 1] >= "\x80" or text[end - 1].isalnum()):
            end += 1
        out.append(text[at:end])
        at = end
    return out


class Buckets:
    """The bucket of each run of words of a text, in order of its first word, shortest first."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.split, self.known = longest, buckets, splitter(), {}

    def bucket(self, run: str) -> int:
        found = self.known.get(run)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = self.known[run] = zlib.crc32(run.encode()) % self.buckets
        return found

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """(words, buckets of all runs)."""
        lowered = text.encode().lower().decode()  # bytes know A-Z only
        words, found, tail = 0, [], []
        for piece in pieces(lowered, PIECE):
            # offset pairs (begin, end) of the words; runs over the cut join the last words before it
            pairs = self.split.pre_tokenize_str(piece)
            words += len(pairs)
            if self.longest == 1:
                found.append(np.fromiter(map(self.bucket, (w for w, _ in pairs)), np.uint32, len(pairs)))
                continue
            own = tail + [piece[a:b] for _, (a, b) in pairs]
            runs = [
                " ".join(own[i - k + 1 : i + 1])
                for i in range(len(tail), len(own))
                for k in range(1, min(self.longest, i + 1) + 1)
            ]
            found.append(np.fromiter(map(self.bucket, runs), np.uint32, len(runs)))
            tail = own[-(self.longest - 1) :]
        return words, np.concatenate(found) if found else np.zeros(0, np.uint32)


def _bucketed(source: DataFrame, id_col: str, text_col: str, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, runs): the buckets of each text as unsigned numbers of four or two bytes."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    rows = source.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        own = Buckets(longest, buckets)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [own.of(t.as_py() or "") for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array([b.astype(kind).tobytes() for _, b in found], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "runs"],
                )

    return rows.mapInArrow(run, "doc_id long, n_words long, runs binary")


def _counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """Runs of each bucket: one row for each bucket of a task, ``buckets`` rows at the driver."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for runs in batch.column("runs"):
                total += np.bincount(np.frombuffer(runs.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some), "n": pa.array(total[some])})

    counts = bucketed.select("runs").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of the target's share of a bucket over the corpus's, floored."""
    s, t, many = corpus.astype(float), target.astype(float), len(corpus)
    value = (t + 1) * (s.sum() + many) / ((s + 1) * (t.sum() + many))
    return np.floor(1000 * np.log(value)).astype(np.int64)


def resampled(
    source: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    least_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and, if drawn, its rank (else NULL)."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    bucketed = staged(_bucketed(source, id_col, text_col, longest, buckets), "buckets")
    aim = _bucketed(target.select(F.lit(0).alias("id"), F.col(target_col).alias("text")), "id", "text", longest, buckets)
    gain = gains(_counts(bucketed, buckets), _counts(aim, buckets))

    def weigh(batches):
        for batch in batches:
            sizes, weights = [], []
            for runs in batch.column("runs"):
                found = np.frombuffer(runs.as_buffer(), kind)
                sizes.append(len(found))
                weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    weighed = bucketed.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = staged(weighed.withColumn("score", F.col("weight") + noise), "scores")
    # a document can be drawn if it is long enough; without an id there is no score to draw by
    able = scored.where((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    most = able.count() * share[0] // share[1]
    ranked = total_order_sum(able, [F.desc("score"), F.asc("doc_id")], F.lit(1), "rank")
    rest = scored.where((F.col("n_words") < least_words) | F.col("score").isNull())
    drawn = F.when(F.col("rank") <= most, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, drawn.alias("rank")).unionByName(
        rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def resampling_sql() -> str:
    """The same for DuckDB; CRC-32 byte by byte over the distinct words, its table from the polynomial."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    bits = "i"
    for _ in range(8):
        bits = f"(SELECT CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM (SELECT {bits} AS c))"
    return rf"""
    WITH crc AS MATERIALIZED (SELECT list({bits} ORDER BY i) AS t FROM range(256) r(i)),
    d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
    b AS MATERIALIZED (SELECT {words} AS w FROM benchmark),
    seen AS MATERIALIZED (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
    bytes AS (
        SELECT word, list_transform(range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(encode(word)), (2 * i - 1)::BIGINT, 2))::BIGINT) AS x
        FROM seen
    ),
    bucket AS MATERIALIZED (
        SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, x), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295::BIGINT) % 10000 AS k
        FROM bytes, crc
    ),
    dw AS MATERIALIZED (SELECT row, k FROM (SELECT row_number() OVER () AS row, unnest(w) AS word FROM d) JOIN bucket USING (word)),
    s AS (SELECT k, count(*) AS s FROM dw GROUP BY k),
    t AS (SELECT k, count(*) AS t FROM (SELECT unnest(w) AS word FROM b) JOIN bucket USING (word) GROUP BY k),
    gain AS MATERIALIZED (
        SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
            / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
        FROM (SELECT unnest(range(10000)) AS k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)
    ),
    numbered AS (SELECT row_number() OVER () AS row, doc_id, len(w) AS n FROM d),
    weighed AS (
        SELECT row, doc_id, n, coalesce(g.w, 0) AS weight
        FROM numbered LEFT JOIN (
            SELECT row, ((sum(g) - ((sum(g) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS w
            FROM dw JOIN gain USING (k) GROUP BY row
        ) g USING (row)
    ),
    scored AS MATERIALIZED (
        SELECT doc_id, n, weight, weight + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
        FROM weighed
    ),
    ranked AS (
        SELECT doc_id, n, weight, score,
            CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) END AS r,
            count(*) FILTER (n >= 20) OVER () AS many
        FROM scored
    )
    SELECT doc_id, n::BIGINT AS n_features, weight, score, CASE WHEN r <= 10 * many // 100 THEN r END AS rank FROM ranked
    """
