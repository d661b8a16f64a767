"""Token ids in binary files, found again through a minimal perfect hash index.

Files
    ``ids-00000012.bin``: the ids of the documents of one range of ids, in
    ascending order, each id as a little-endian unsigned number of ``width``
    bytes (2 where the vocabulary allows it); nothing else, so any slice can be
    mapped into memory.  File numbers follow the ranges.
    ``index/``: one row for each bucket of keys, with the bits of its minimal
    perfect hash and the columns fingerprint, file, offset and count, by slot.

Writing: documents are dealt out by ranges of their id, sorted, encoded, and each
task writes its file under a name of its own and then renames it, so a second
attempt replaces the first with the same bytes.  Keys then go to buckets of about
KEYS by hash, and each bucket gets its index.

The hash has levels of GAMMA bits for each key left: a key that falls alone on a
bit stays there, the others go on to the next level.  A key's slot is the number
of set bits before its own, so slots are 0..n-1 without gaps.  A lookup reads one
bit a level, one rank, and compares the stored 32-bit fingerprint, so an unknown
key is turned down (but for one in four thousand million).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefunnel.llm.common import documents, partitions, small_batches
from tidefunnel.llm.words import K, mix
from tidefunnel.operators.tables import staged
from tidefunnel.session import work_folder

END = 1  # the id behind each document
GAMMA = 2.0
KEYS = 2048
CACHE = 1 << 18  # encoded words of one generation; a worker process keeps two
LEARNED = 4096  # new words that are encoded as one text
FLUSH = 1 << 22  # bytes of ids that a task gathers before it writes
MANIFEST = "doc_id long, copy long, file int, offset long, count long"
INDEX = (
    "bucket long, sizes array<long>, bits binary, fingerprint binary,"
    " file binary, offset binary, count binary"
)

# --- encoding ---------------------------------------------------------------

# Between an ASCII letter and an ASCII mark other than the apostrophe, the splitting of
# the vocabulary always ends a piece, as it does at white space.
EDGE = rb"[!-&(-/:-@\[-`{-~](?<=[a-z].)"
APART = rb" \g<0>"


def word_encoder(path: str, width: int) -> Callable[[str], bytes]:
    """text -> its ids as bytes, as :func:`group_encoder` gives them."""
    encode = group_encoder(path, width)
    return lambda text: encode([text])[0]


def group_encoder(path: str, width: int) -> Callable[[list[str]], list[bytes]]:
    """texts -> the ids of each as bytes; words that were met before come from a cache.

    The vocabulary lower-cases and drops white space, so a text's ids are those of
    its words one after the other, and a word's those of its pieces.  Texts with
    combining marks (which join across case) or with the signs of special tokens are
    encoded as they stand.
    """
    import re

    import regex
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    edge, marks = re.compile(EDGE), regex.compile(r"\p{M}")
    kind = np.dtype(f"<u{width}")
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, number in tokenizer.get_vocab().items():
        ends[number] = token.endswith("</w>")
    known: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}

    def plain(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, kind).tobytes() for x in found]

    def as_it_stands(text: str) -> bool:
        if "<|" in text or "|>" in text:
            return True
        if text.isascii():
            return False
        try:
            text.encode("latin-1")  # has no combining marks
            return False
        except UnicodeEncodeError:
            return bool(marks.search(text))

    def recall(words: set[bytes]) -> list[bytes]:
        """Words that the older generation does not know either; those that it knows move over."""
        new = []
        for w in words:
            if (ids := older.get(w)) is None:
                new.append(w)
            else:
                known[w] = ids
        return new

    def learn(new: list[bytes]) -> None:
        """Words of letters have one word end each, so many are encoded as one text."""
        for at in range(0, len(new), LEARNED):
            letters, rest = [], []
            for w in new[at : at + LEARNED]:
                alone = w.isalpha() if w.isascii() else w.decode().isalpha()
                (letters if alone else rest).append(w)
            ids = np.frombuffer(plain([b" ".join(letters).decode()])[0], kind)
            cuts = (np.flatnonzero(ends[ids]) + 1) * width
            if len(cuts) == len(letters):
                raw, a = ids.tobytes(), 0
                for w, b in zip(letters, cuts.tolist(), strict=True):
                    known[w] = raw[a:b]
                    a = b
            else:
                rest += letters
            known.update(zip(rest, plain([w.decode() for w in rest]), strict=True))

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal known, older
        cut = [None if as_it_stands(t) else edge.sub(APART, t.encode().lower()).split() for t in texts]
        met: set[bytes] = set()
        for words in cut:
            met.update(words or ())
        if new := recall(met.difference(known)):
            learn(new)
        out = [
            plain([t])[0] if words is None else b"".join(map(known.__getitem__, words))
            for t, words in zip(texts, cut, strict=True)
        ]
        if len(known) > CACHE:
            known, older = {}, known
        return out

    return encode


@lru_cache(maxsize=1)
def process_encoder(path: str, width: int) -> Callable[[list[str]], list[bytes]]:
    """The encoder of a worker process, whose words serve the tasks that follow."""
    return group_encoder(path, width)


# --- writing ----------------------------------------------------------------


def _writer(folder: str, path: str, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        task = TaskContext.get()
        file, encode = task.partitionId(), process_encoder(path, width)
        end = END.to_bytes(width, "little")
        fs, base = FileSystem.from_uri(folder)
        draft, out, at = f"{base}/.draft-{file:08d}-{task.taskAttemptId()}", None, 0
        last, copy, waiting, size = (), 0, [], 0
        for batch in small_batches(batches):
            rows = []
            found = encode(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                copy = copy + 1 if (doc,) == last else 0
                last = (doc,)
                ids += end
                rows.append((doc, copy, file, at, len(ids) // width))
                at += len(ids)
                size += len(ids)
                waiting.append(ids)
                if size >= FLUSH:
                    out = out or fs.open_output_stream(draft)
                    out.write(b"".join(waiting))
                    waiting, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)],
                names=["doc_id", "copy", "file", "offset", "count"],
            ) if rows else pa.RecordBatch.from_pylist([], _schema())
        if waiting:
            out = out or fs.open_output_stream(draft)
            out.write(b"".join(waiting))
        if out:
            out.close()
            fs.move(draft, f"{base}/ids-{file:08d}.bin")

    return write


KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _schema() -> pa.Schema:
    return pa.schema(list(zip(["doc_id", "copy", "file", "offset", "count"], KINDS, strict=True)))


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    width: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the id files and their index below ``folder``; return the manifest.

    Documents come in ascending id (a NULL id first, repeated ids by text); each
    ends with the id END.  ``copy`` numbers the rows that share an id from 0.
    A NULL or empty text is the end id alone; an empty table gives no file.
    """
    spark = docs.sparkSession
    plain = documents(docs, id_col, text_col)
    _make(folder)
    dealt = plain.repartitionByRange(partitions(plain), "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_writer(folder, vocabulary, width), MANIFEST).write.mode("overwrite").parquet(
        f"{folder}/manifest"
    )
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    buckets = max(1, -(-manifest.count() // KEYS))
    keyed = manifest.withColumn("bucket", _bucket(buckets))
    keyed.groupBy("bucket").applyInPandas(_indexed, INDEX).write.mode("overwrite").parquet(
        f"{folder}/index"
    )
    files = manifest.groupBy("file").agg(F.max(F.col("offset") + F.col("count") * width).alias("bytes"))
    (
        files.selectExpr(
            "file", "bytes",
            f"coalesce(sum(bytes) over (order by file rows between unbounded preceding and 1 preceding), 0)"
            f" div {width} as first",
        )
        .withColumns({"width": F.lit(width), "buckets": F.lit(buckets)})
        .write.mode("overwrite")
        .parquet(f"{folder}/files")
    )
    return manifest


def _make(folder: str) -> None:
    from pyarrow.fs import FileSystem

    fs, base = FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)


# --- the index --------------------------------------------------------------


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-(1 << 63))), "copy"), F.lit(buckets))


def key_numbers(doc_id, copy) -> np.ndarray:
    """A 64-bit number for each key; a NULL id counts as the least long."""
    ids = np.array([-(1 << 63) if x is None or x != x else int(x) for x in doc_id], np.int64)
    with np.errstate(over="ignore"):
        return mix(mix(ids.view(np.uint64)) + np.asarray(copy, np.uint64) * K)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.array([level + 1], np.uint64))[0]) % np.uint64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ K) >> np.uint64(32)).astype("<u4")


class Index:
    """The minimal perfect hash of one bucket: ``build`` from keys, ``slots`` of keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = [int(x) for x in sizes], bits
        self.rank = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> Index:
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two keys of a bucket have the same number")
        sizes, parts = [], []
        while len(keys):
            size = max(64, int(GAMMA * len(keys)))
            place = _place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = base + _place(keys[left], level, size)
            hit = self.bits[place]
            out[left[hit]] = self.rank[place[hit]]
            left, base = left[~hit], base + size
        return out


def _indexed(rows):
    import pandas as pd

    keys = key_numbers(rows.doc_id, rows["copy"])
    index = Index.build(keys)
    order = np.empty(len(keys), np.int64)
    order[index.slots(keys)] = np.arange(len(keys))
    rows = rows.iloc[order]
    return pd.DataFrame(
        {
            "bucket": [int(rows.bucket.iloc[0])],
            "sizes": [index.sizes],
            "bits": [np.packbits(index.bits).tobytes()],
            "fingerprint": [_fingerprint(keys[order]).tobytes()],
            "file": [rows.file.to_numpy("<u4").tobytes()],
            "offset": [rows.offset.to_numpy("<u8").tobytes()],
            "count": [rows["count"].to_numpy("<u8").tobytes()],
        }
    )


def _looked_up(wanted, index):
    import pandas as pd

    if not len(index) or not len(wanted):
        return pd.DataFrame({c: [] for c in ("doc_id", "copy", "file", "offset", "count")})
    own = index.iloc[0]
    bits = np.unpackbits(np.frombuffer(own.bits, np.uint8))[: sum(own.sizes)].astype(bool)
    keys = key_numbers(wanted.doc_id, wanted["copy"])
    slots = Index(own.sizes, bits).slots(keys)
    found = slots >= 0
    found[found] = np.frombuffer(own.fingerprint, "<u4")[slots[found]] == _fingerprint(keys[found])
    slots = slots[found]
    return wanted.loc[found, ["doc_id", "copy"]].assign(
        file=np.frombuffer(own.file, "<u4")[slots].astype(np.int32),
        offset=np.frombuffer(own.offset, "<u8")[slots].astype(np.int64),
        count=np.frombuffer(own["count"], "<u8")[slots].astype(np.int64),
    )


def locate(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(doc_id, copy) -> file, offset (bytes) and count (ids); unknown keys give no row."""
    files = spark.read.parquet(f"{folder}/files").select("buckets").first()
    buckets = files.buckets if files else 1
    wanted = keys.select("doc_id", "copy").withColumn("bucket", _bucket(buckets)).groupBy("bucket")
    index = spark.read.schema(INDEX).parquet(f"{folder}/index").groupBy("bucket")
    return wanted.cogroup(index).applyInPandas(_looked_up, MANIFEST)


READ = 1 << 22  # bytes of ids that one batch holds


def _reader(folder: str, width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        name, source = None, None
        columns = ("doc_id", "copy", "file", "offset", "count", "first")

        def full(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["doc_id", "copy", "start", "ids"],
            )

        for batch in batches:
            rows, size = [], 0
            for doc, copy, file, offset, count, first in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if file != name:
                    if source:
                        source.close()
                    name, source = file, fs.open_input_file(f"{base}/ids-{file:08d}.bin")
                source.seek(offset)
                rows.append((doc, copy, first + offset // width, source.read(count * width)))
                size += count * width
                if size >= READ:
                    yield full(rows)
                    rows, size = [], 0
            if rows:
                yield full(rows)
        if source:
            source.close()

    return read


def placed_keys(spark: SparkSession, folder: str, keys: DataFrame) -> tuple[DataFrame, int]:
    """The keys with their places and the ids before their file, sorted for reading; the width of an id."""
    files = spark.read.parquet(f"{folder}/files")
    width = (files.select("width").first() or {"width": 2})["width"]
    placed = locate(spark, folder, keys).join(files.select("file", "first"), "file")
    return placed.repartition("file").sortWithinPartitions("file", "offset"), width


def read_ids(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, copy, start (ids before it in all files), ids (binary of ``width`` bytes each).

    Keys are found through the index; each task reads its files in file order.
    """
    placed, width = placed_keys(spark, folder, keys)
    return placed.mapInArrow(_reader(folder, width), "doc_id long, copy long, start long, ids binary")


def read_checksums(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as 32-bit little-endian numbers.

    The ids that :func:`read_ids` gives, digested where they are read: one Python
    process a task, and no ids pass through Spark.
    """
    placed, width = placed_keys(spark, folder, keys)
    read = _reader(folder, width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in read(batches):
            numbers = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in batch.column("ids")]
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in numbers]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"),
                 pa.array([len(x) for x in numbers], pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return placed.mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str, width: int = 2) -> DataFrame:
    """Write all documents to a fresh shared folder and read them back through the index."""
    spark = docs.sparkSession
    folder = work_folder(spark, "token-files")
    write_ids(docs, folder, vocabulary, width)
    keys = (
        docs.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .count()
        .select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("copy"))
    )
    return read_checksums(spark, folder, keys)
