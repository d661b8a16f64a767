"""Phrases whose words belong together, from a weighted graph of overlapping word runs.

Texts (A-Z in lower case) fall into pieces at punctuation and line ends, pieces into
words.  Everything is counted for each language.

1. A pass over the texts counts pairs of neighbours by a 64-bit number.  A pair seen
   fewer than ``least`` times is in no candidate; the frequent ones are marked in a
   bitmap of MARKS bits (a few rare pairs may be marked too, which costs work only).
2. The second pass gives one edge for each word: the longest run of up to ``longest``
   words from there whose pairs are all marked, as text.  Equal edges are added up; an
   edge of full length leads from the node of its first words to the node of its last
   ones, a shorter one corrects its node for the end of a piece (or of the marked run).
3. The count of a shorter phrase is the flow of its node: the sum of all edges that
   begin with it, full ones and corrections.
4. Unary paths are compacted: a node whose whole flow goes through one edge, in or
   out, is absorbed by that edge.  Counts can only fall along a path, so this removes
   exactly the phrases that lie in a longer one that is as frequent.
5. Each remaining phrase is cut at every place; the lowest score counts.  Products are
   decimals of 38 digits, exact up to 10**34 for count times words.

Long texts go in chunks of about CHUNK bytes that overlap by ``longest`` words, so
memory follows the chunk.  Common phrases are added up in the tasks and before the
shuffle, so a hot phrase or language is a few rows.

NULL and empty texts have no words; a NULL language is ``und``; ids are not read and
repeated rows count again.  Ties are settled by count, then by the phrase's bytes.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.llm.words import hash_words, mix, windows
from tidefunnel.operators.tables import staged

LEAST = 100
LONGEST = 5
FIRST = 2000
MARKS = 1 << 26  # bits that mark frequent pairs: 8 MB
CHUNK = 1 << 20  # bytes of text that a task works on at a time
HELD = 1 << 18  # different edges that a task adds up before it hands them on

# Piece ends and word gaps
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
BREAK = re.compile(rb"[.,;:!? \t\n-\r]")
KIND = np.zeros(256, np.uint8)
KIND[list(GAPS)] = 1
KIND[list(ENDS)] = 2
BLANK = bytes(32 if KIND[i] else i for i in range(256))


def chunks(text: bytes, ahead: int, size: int) -> list[tuple[bytes, int]]:
    """(bytes, how many of them own their words): parts of a text with ``ahead`` more words behind."""
    if len(text) <= size:
        return [(text, len(text))]
    more = re.compile(rb"(?:[.,;:!? \t\n-\r]*[^.,;:!? \t\n-\r]+){0,%d}" % ahead)
    out, at = [], 0
    while at < len(text):
        found = BREAK.search(text, at + size)
        end = found.start() if found else len(text)
        out.append((text[at : more.match(text, end).end()], end - at))
        at = end
    return out


def blocks(texts: list[bytes], ahead: int, size: int):
    """(bytes, owned): chunks joined by line ends, and which bytes own the words that begin there."""
    parts, total = [], 0
    for text in texts:
        for part, own in chunks(text, ahead, size):
            if parts and total + len(part) > size:
                yield _joined(parts)
                parts, total = [], 0
            parts.append((part, own))
            total += len(part) + 1
    if parts:
        yield _joined(parts)


def _joined(parts):
    data = b"\n".join(p for p, _ in parts)
    owned = np.zeros(len(data) + 1, bool)
    at = 0
    for part, own in parts:
        owned[at : at + own] = True
        at += len(part) + 1
    return data, owned


def pairs(data: bytes, owned: np.ndarray, lang: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each pair of neighbours, its first word, whether each word is owned)."""
    raw = np.frombuffer(data, np.uint8)
    kind = KIND[raw]
    begins = np.flatnonzero((kind == 0) & np.concatenate([[True], kind[:-1] > 0])) if len(raw) else np.zeros(0, np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(kind == 2) + 1, [len(raw)]])
    blank = np.frombuffer(data.translate(BLANK), np.uint8)
    words, at = hash_words(blank, cuts)
    found, _ = windows(words, at, 2)
    inside = np.ones(len(words), bool)
    inside[at[1:][at[1:] > 0] - 1] = False  # the last word of a piece begins no pair
    first = np.flatnonzero(inside)
    return mix(found ^ np.uint64(lang)), first, owned[begins]


def _languages(batch: pa.RecordBatch):
    """(language, a number for it, texts in bytes and lower case) for each language of a batch."""
    langs = batch.column("lang").dictionary_encode()
    code = langs.indices.to_numpy()
    for c, lang in enumerate(langs.dictionary.to_pylist()):
        number = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        texts = batch.column("text").take(pa.array(np.flatnonzero(code == c)))
        yield lang, number, [t.as_buffer().to_pybytes().lower() for t in texts]


def _rows(source: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return source.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def marked_pairs(rows: DataFrame, least: int, longest: int, marks: int = MARKS, size: int = CHUNK) -> np.ndarray:
    """Bitmap of the pairs seen at least ``least`` times; its ``marks`` bits are all the driver sees."""

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for _, number, texts in _languages(batch.slice(at, 512)):
                    for data, owned in blocks(texts, longest, size):
                        found, first, own = pairs(data, owned, number)
                        key, n = np.unique(found[own[first]], return_counts=True)
                        yield pa.RecordBatch.from_pydict({"pair": pa.array(key.view(np.int64)), "n": pa.array(n)})

    def mark(batches):
        bits = np.zeros(marks // 8, np.uint8)
        for batch in batches:
            pair = batch.column("pair").to_numpy().view(np.uint64)
            place = (pair % np.uint64(marks)).astype(np.int64)
            np.bitwise_or.at(bits, place >> 3, (1 << (place & 7)).astype(np.uint8))
        used = np.flatnonzero(bits.reshape(-1, min(4096, len(bits))).any(axis=1))
        parts = bits.reshape(-1, min(4096, len(bits)))[used]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(used), "bits": pa.array([p.tobytes() for p in parts], pa.binary())}
        )

    def merge(table: pa.Table) -> pa.Table:
        all_bits = [np.frombuffer(b.as_buffer(), np.uint8) for b in table.column("bits")]
        one = np.bitwise_or.reduce(all_bits)
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([one.tobytes()], pa.binary())})

    counts = rows.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    parts = counts.where(F.col("n") >= least).select("pair").mapInArrow(mark, "part long, bits binary")
    whole = parts.groupBy("part").applyInArrow(merge, "part long, bits binary")
    bits = np.zeros(marks // 8, np.uint8)
    for row in whole.collect():
        block = np.frombuffer(row.bits, np.uint8)
        bits[row.part * len(block) : (row.part + 1) * len(block)] = block
    return bits


def edges_of(data: bytes, owned: np.ndarray, number: int, bits: np.ndarray, longest: int) -> Counter:
    """The longest marked run from each word, at most ``longest`` words, with its count."""
    found, first, own = pairs(data, owned, number)
    place = (found % np.uint64(len(bits) * 8)).astype(np.int64)
    good = np.zeros(len(own) + longest, bool)
    good[first] = bits[place >> 3] >> (place & 7).astype(np.uint8) & 1
    length = np.ones(len(own), np.int64)
    running = np.ones(len(own), bool)
    for k in range(longest - 1):
        running &= good[k : k + len(own)]
        length += running
    words = data.translate(BLANK).split()
    edges: Counter = Counter()
    alone = np.flatnonzero(own & (length == 1)).tolist()
    edges.update(map(words.__getitem__, alone))
    for k in range(2, longest + 1):
        places = np.flatnonzero(own & (length == k)).tolist()
        edges.update([b" ".join(words[i : i + k]) for i in places])
    return edges


def _edges(rows: DataFrame, bits: np.ndarray, longest: int, size: int = CHUNK) -> DataFrame:
    """(lang, edge, n): all equal edges added up."""
    schema = pa.schema([("lang", pa.string()), ("edge", pa.binary()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, edges in held.items():
                columns = [pa.array([lang] * len(edges)), pa.array(list(edges), pa.binary()), pa.array(list(edges.values()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for lang, number, texts in _languages(batch.slice(at, 512)):
                    for data, owned in blocks(texts, longest, size):
                        held.setdefault(lang, Counter()).update(edges_of(data, owned, number, bits, longest))
                        if sum(map(len, held.values())) >= HELD:
                            yield from out()
        yield from out()

    edges = rows.mapInArrow(run, "lang string, edge binary, n long")
    return edges.groupBy("lang", F.col("edge").cast("string").alias("edge")).agg(F.sum("n").alias("n"))


def phrase_counts(
    source: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    text_col: str = "text",
    lang_col: str = "lang",
    marks: int = MARKS,
    size: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) with f >= least, up to ``longest`` words; (lang, n) words of each language)."""
    rows = _rows(source, text_col, lang_col)
    edges = staged(_edges(rows, marked_pairs(rows, least, longest, marks, size), longest, size), "edges")
    totals = edges.groupBy("lang").agg(F.sum("n").alias("n"))
    words = F.split("edge", " ")
    flows = edges.select("lang", "n", F.explode(F.sequence(F.lit(1), F.size(words))).alias("size"), words.alias("w"))
    flows = flows.groupBy("lang", F.array_join(F.slice("w", 1, F.col("size")), " ").alias("phrase")).agg(
        F.sum("n").alias("f"), F.first("size").alias("size")
    )
    return staged(flows.where(F.col("f") >= least), "phrases"), totals


def compacted(phrases: DataFrame) -> DataFrame:
    """Phrases without those whose whole flow goes through one edge into or out of their node."""
    words = F.split("phrase", " ")
    longer = phrases.where("size > 1").select("lang", words.alias("w"), "size", "f")
    ways = longer.select(
        "lang",
        F.explode(
            F.array(
                F.array_join(F.slice("w", 1, F.col("size") - 1), " "),
                F.array_join(F.slice("w", 2, F.col("size") - 1), " "),
            )
        ).alias("phrase"),
        "f",
    )
    absorbed = ways.groupBy("lang", "phrase").agg(F.max("f").alias("through"))
    return phrases.where("size > 1").join(absorbed, ["lang", "phrase"], "left").where(
        "through is null or through < f"
    ).drop("through")


def collocations(
    source: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    first: int = FIRST,
    text_col: str = "text",
    lang_col: str = "lang",
    marks: int = MARKS,
    size: int = CHUNK,
) -> DataFrame:
    """The ``first`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = phrase_counts(source, least, longest, text_col, lang_col, marks, size)
    w = F.split("phrase", " ")
    cuts = compacted(phrases).select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(w, 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice(w, F.col("k") + 1, longest), " ").alias("rest"),
    )
    counts = phrases.select("lang", "phrase", "f")
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    scored = scored.withColumn("above", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)")).withColumn(
        "below", wide["l"] * wide["r"]
    )
    scored = scored.withColumn("score", F.expr("cast(above div below as long)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = lowest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations_sql(least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> str:
    """Every run of words, and every longer candidate that holds a shorter one."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH piece AS MATERIALIZED (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
        FROM (SELECT lang, unnest(regexp_split_to_array({low}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
    ),
    start AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0),
    run AS (SELECT lang, w[i : i + k - 1] AS p FROM (SELECT lang, w, i, unnest(range(1, least({longest}, len(w) - i + 1) + 1)) AS k FROM start)),
    f AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM run GROUP BY lang, p HAVING count(*) >= {least}),
    total AS (SELECT lang, sum(len(w)) AS n FROM piece GROUP BY lang),
    cand AS (SELECT lang, p, f FROM f WHERE len(p) > 1),
    part AS (
        SELECT DISTINCT lang, p[i : i + k - 1] AS p, f
        FROM (SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i
              FROM (SELECT lang, p, f, unnest(range(2, len(p))) AS k FROM cand WHERE len(p) > 2))
    ),
    held AS (SELECT lang, p, max(f) AS longer FROM part GROUP BY lang, p),
    kept AS (SELECT c.lang, c.p, c.f FROM cand c LEFT JOIN held h ON h.lang = c.lang AND h.p = c.p WHERE longer IS NULL OR 100 * longer < 100 * c.f),
    cut AS (SELECT lang, p, f, unnest(range(1, len(p))) AS k FROM kept),
    scored AS (
        SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, n::BIGINT AS n, k,
            ((1000::HUGEINT * c.f * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
        FROM cut c JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : k]
        JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1 : len(c.p)] JOIN total t ON t.lang = c.lang
    ),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
            array_to_string(p, ' ') AS phrase, a, l, r, n, score
        FROM lowest
    )
    SELECT * FROM ranked WHERE rank <= {first}
    """
