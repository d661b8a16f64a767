"""Document fingerprints: one-permutation MinHash, optimal densification, packed low bits.

Every 5-word shingle is hashed once.  The high bits choose one of BINS bins, the
rest is its value; a bin keeps its least value.  An empty bin takes over the value
of a full bin that a hash of (bin, attempt) picks, the same for all documents, so
bins of two documents still agree with a chance equal to the similarity J.  Only
BITS low bits of each bin are stored; two different values share them with chance
1 / 2**BITS, which the estimate takes out again: J = (share - c) / (1 - c).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.llm import words
from tidefunnel.llm.common import documents, partitions
from tidefunnel.operators.tables import staged

BINS = 512
BITS = 2
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _least(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The least value of each bin for each document; EMPTY where no shingle fell."""
    n = len(begins) - 1
    out = np.full(n * BINS, EMPTY)
    hashed = words.mix(values ^ words.BYTE[11])
    shift = np.uint64(64 - (BINS - 1).bit_length())
    place = np.repeat(np.arange(n) * BINS, np.diff(begins)) + (hashed >> shift).astype(np.int64)
    np.minimum.at(out, place, hashed & ((np.uint64(1) << shift) - np.uint64(1)))
    return out.reshape(n, BINS)


def _filled(bins: np.ndarray) -> np.ndarray:
    """Optimal densification: empty bins copy the first full bin that their hashes name."""
    full = bins != EMPTY
    row, col = np.nonzero(~full & full.any(axis=1)[:, None])
    attempt = np.uint64(0)
    out = bins.copy()
    while len(row):
        attempt += np.uint64(1)
        with np.errstate(over="ignore"):
            to = words.mix(col.astype(np.uint64) * words.K + words.mix(np.array([attempt]))[0]) % np.uint64(BINS)
        to = to.astype(np.int64)
        hit = full[row, to]
        out[row[hit], col[hit]] = bins[row[hit], to[hit]]
        row, col = row[~hit], col[~hit]
    return out


def fingerprints(texts: list[str]) -> list[str]:
    """Hex of BINS * BITS bits for each text; "" for a text without words."""
    out: list[str] = []
    data, offsets = words.text_bytes(texts)
    for a, b in words.slices(offsets):
        found, at = words.shingles(
            *words.hash_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        )
        # mixed with the bin, so that a value that fills many bins has other bits in each
        least = words.mix(_filled(_least(found, at)) ^ words.mix(np.arange(BINS, dtype=np.uint64)))
        low = (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)
        bits = np.unpackbits(low[:, :, None], axis=2, bitorder="little")[:, :, :BITS]
        packed = np.packbits(bits.reshape(len(low), -1), axis=1)
        out += [
            p.tobytes().hex() if n else "" for p, n in zip(packed, np.diff(at).tolist(), strict=True)
        ]
    return out


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Estimated similarity of two fingerprints each; two texts without words are alike."""
    out = np.array([float(x == y) for x, y in zip(left, right, strict=True)])
    some = [i for i, (x, y) in enumerate(zip(left, right, strict=True)) if x and y]
    if some:
        x, y = (
            np.unpackbits(np.frombuffer(bytes.fromhex("".join(side[i] for i in some)), np.uint8))
            .reshape(len(some), BINS, BITS)
            for side in (left, right)
        )
        share, chance = (x == y).all(axis=2).mean(axis=1), 1 / (1 << BITS)
        out[some] = np.clip((share - chance) / (1 - chance), 0, 1)
    return out


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
STAGED = RESULT + ", part int, kind string, text string"
STEP = 1 << 22  # characters compared at a time


def _compared(ids: list, texts: list[str], following: list[str]):
    """Result rows for documents and the text behind each."""
    import hashlib

    import pandas as pd

    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following, strict=True)]
    # the following text is mostly the next row's own
    own = fingerprints(texts)
    later = own[1:] + fingerprints(following[-1:]) if following[:-1] == texts[1:] else fingerprints(following)
    changed = fingerprints(edited)
    return pd.DataFrame(
        {
            "doc_id": pd.array(ids, "Int64"),
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": own,
            "edited_fingerprint": changed,
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, later),
        }
    )


def _inside(batches: Iterator):
    """Rows of one range in order: results for all but the last; first and last as they are."""
    import pandas as pd
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    columns = [c.split()[0] for c in STAGED.split(",")]

    def edge(kind, doc, text):
        row = pd.DataFrame({"doc_id": pd.array([doc], "Int64"), "part": [part], "kind": [kind], "text": [text]})
        return row.reindex(columns=columns)

    ids, texts, size, first = [], [], 0, True
    for batch in batches:
        for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
            if first:
                yield edge("first", doc, text)
                first = False
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if size >= STEP and len(ids) > 1:
                done = _compared(ids[:-1], texts[:-1], texts[1:])
                yield done.assign(part=part, kind="done", text=None)[columns]
                ids, texts, size = ids[-1:], texts[-1:], len(text)
    if len(ids) > 1:
        done = _compared(ids[:-1], texts[:-1], texts[1:])
        yield done.assign(part=part, kind="done", text=None)[columns]
    if ids:
        yield edge("last", ids[-1], texts[-1])


def _to_arrow(function):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in STAGED.split(",")])

    def run(batches):
        for frame in function(batches):
            table = pa.Table.from_pandas(frame, schema=schema, preserve_index=False)
            yield from table.combine_chunks().to_batches()

    return run


def _edges(frames):
    for frame in frames:
        ids = [None if x != x or x is None else int(x) for x in frame.doc_id]
        if ids:
            yield _compared(ids, frame.text.tolist(), frame.following.tolist())


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited form, and how alike they and the next one are.

    The next document is the one with the next larger id (NULL ids come first,
    repeated ids in order of their text), after the last one the first.  A NULL
    text is empty; a text without words has the fingerprint "", and two such are
    alike (1.0).  A table of one row is its own next one.

    Documents are dealt out by ranges of their id once; the pairs over the edges of
    ranges are one row for each range and compared in a second step.
    """
    plain = documents(docs, id_col, text_col)
    dealt = plain.repartitionByRange(partitions(plain), "doc_id").sortWithinPartitions("doc_id", "text")
    table = staged(dealt.mapInArrow(_to_arrow(_inside), STAGED), "fingerprints")
    ends = Window.orderBy("part")
    firsts = table.where("kind = 'first'").select("part", F.col("text").alias("following"))
    whole = ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one number for each range is ordered; the texts meet their neighbours by it
    after = F.coalesce(F.lead("part").over(ends), F.first("part").over(whole)).alias("after")
    order = firsts.select("part").select("part", after)
    following = order.join(firsts.withColumnRenamed("part", "after"), "after").select("part", "following")
    rest = (
        table.where("kind = 'last'")
        .select("doc_id", "text", "part")
        .join(following, "part")
        .select("doc_id", "text", "following")
        .mapInPandas(_edges, RESULT)
    )
    return table.where("kind = 'done'").drop("part", "kind", "text").unionByName(rest)
