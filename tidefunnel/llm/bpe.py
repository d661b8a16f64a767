"""Byte-level BPE: ids of whole texts by a local rank file, and back to the raw bytes.

Texts over PIECE characters are cut before a white-space character that follows
another kind of character.  Every match of the splitting pattern that holds such a
character ends there, because white space only ever begins a match, so the matches
on both sides are those of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm.common import documents

PIECE = 1 << 16


def pieces(text: str, most: int = PIECE) -> list[str]:
    """The text in parts of at least ``most`` characters, cut at safe places only."""
    import regex

    if len(text) <= most:
        return [text]
    safe, out, a = regex.compile(r"(?<=\S)(?=\s)"), [], 0
    while (m := safe.search(text, a + most)) and m.start() < len(text):
        out.append(text[a : m.start()])
        a = m.start()
    out.append(text[a:])
    return out


def load_encoding(path: str, pattern: str):
    """The encoding of a file of lines "base64 rank"; no special tokens."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(encoding, text: str) -> list[int]:
    out: list[int] = []
    for piece in pieces(text):
        out += encoding.encode_ordinary(piece)
    return out


IDS = "doc_id long, ids array<int>"


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids.  NULL and empty texts have no ids; rows that repeat stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode(encoding, t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    return documents(docs, id_col, text_col).mapInArrow(run, IDS)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, raw: the bytes behind the ids, which need not be whole characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path, pattern)
        for batch in batches:
            raw = [encoding.decode_bytes(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "raw"]
            )

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, raw binary")


ROUND = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each text's ids and of the bytes they decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        encoding = load_encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode(encoding, t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([sha256(" ".join(map(str, x)).encode()).hexdigest() for x in ids]),
                        pa.array([sha256(encoding.decode_bytes(x)).hexdigest() for x in ids]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents(docs, id_col, text_col).mapInArrow(run, ROUND)
