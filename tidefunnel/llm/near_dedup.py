"""Near-duplicate classes: fast similarity sketching, banding, exact verification.

1. Each text becomes its set of distinct 5-word shingles, a sketch and 64 bands.
2. Equal sets collapse to the smallest document id; only these go on.
3. Documents that share a band meet the smallest one of that bucket (its hub), so
   a bucket of n gives n - 1 pairs, not n * n.  Sketches estimate each pair; every
   document is compared with its most similar hub on their full sets.
4. Buckets whose documents are still in several components are looked at again, by
   the documents outside a bucket's largest component (outsiders), in blocks inside
   a task.  First each outsider meets its most similar partner in another component.
   Then each outsider names the components in which a sketch is still close, and is
   compared there with the full sets of close members until one link is confirmed.
   One link joins two components as well as many, so only that one comes out, and no
   link that would join two components is lost.
5. Components of the confirmed links name the classes.

A pair at similarity 0.75 shares no band with a chance of 3e-8, and the estimate of
such a pair falls under CLOSE = 0.62, five standard deviations below, as rarely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefunnel.llm import sketch as fast
from tidefunnel.llm import words
from tidefunnel.llm.common import documents, free_name
from tidefunnel.llm.components import components
from tidefunnel.operators.tables import staged

CLOSE = 0.62
OUTSIDERS, MEMBERS = 256, 1024  # sketches of a block; larger buckets take several
ASKING, ASKED = 64, 256  # full sets of a block
SKETCHED = "doc_id long, n_shingles long, same binary, bands array<long>, short binary"
SETS = "doc_id long, n long, same binary, shingle array<long>"


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """The sorted distinct shingles of each text, block by block."""
    data, offsets = words.text_bytes(batch.column("text"))
    for a, b in words.slices(offsets):
        found, at = words.shingles(
            *words.hash_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        )
        yield batch.column("doc_id").slice(a, b - a), [
            np.unique(found[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)
        ]


def _name(found: np.ndarray) -> bytes:
    """A name of a set, the same in every task."""
    import hashlib

    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, sets in _sets(batch):
            begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            table = fast.sketches(np.concatenate(sets), begins)
            band, short = fast.bands(table).view(np.int64), fast.short_form(table)
            rows = zip(sets, band, short, strict=True)
            columns = [
                (_name(s), b, x.tobytes())
                if len(s)
                else (None, None, None)
                for s, b, x in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.diff(begins), pa.int64()),
                    pa.array([c[0] for c in columns], pa.binary()),
                    pa.array([c[1] for c in columns], pa.list_(pa.int64())),
                    pa.array([c[2] for c in columns], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "same", "bands", "short"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, sets in _sets(batch):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_name(s) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "same", "shingle"],
            )


def _estimate(left: str, right: str) -> F.Column:
    """Share of equal sketch bytes, without the chance hits of one byte."""

    @F.pandas_udf("double")
    def estimate(a, b):
        import pandas as pd

        if not len(a):
            return pd.Series([], dtype=float)
        x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
        return pd.Series(((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256))

    return estimate(left, right)


def _share(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of a sketch to others, without the chance hits of one byte."""
    return ((one == others).mean(axis=1) - 1 / 256) / (1 - 1 / 256)


def _by_block(key: str, columns: tuple[str, ...], compare, names: tuple[str, ...]):
    """``compare`` on the rows of each block (key, i, j), which may span frames."""

    def run(frames):
        import pandas as pd

        block, held = None, []

        def compared():
            return compare(*map(np.concatenate, zip(*held, strict=True)))

        def frame_of(found):
            return pd.DataFrame(
                dict(zip(names, map(np.concatenate, zip(*found, strict=True)), strict=True))
            )

        for frame in frames:
            if not len(frame):
                continue
            keys = frame[[key, "i", "j"]].to_numpy()
            short = np.frombuffer(b"".join(frame.short), np.uint8).reshape(len(frame), -1)
            data = [short if c == "short" else frame[c].to_numpy() for c in columns]
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for i, j in zip([0, *cuts], [*cuts, len(frame)], strict=True):
                if held and tuple(keys[i]) != block:
                    found += compared()
                    held = []
                block = tuple(keys[i])
                held.append([c[i:j] for c in data])
            if found:
                yield frame_of(found)
        if held and (found := list(compared())):
            yield frame_of(found)

    return run


def _nearest(side, rep, label, short):
    """The most similar close partners of each outsider in another component."""
    mine, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for k in mine if len(other) else ():
        share = np.where(label[other] == label[k], 0, _share(short[k], short[other]))
        if share.max() >= CLOSE:
            y = other[share == share.max()][:1]
            yield np.repeat(rep[k], len(y)), rep[y], np.repeat(share.max(), len(y))


def _named(side, rep, label, short):
    """The other components in which an outsider has a close partner."""
    mine, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for k in mine if len(other) else ():
        close = np.unique(label[other[_share(short[k], short[other]) >= CLOSE]])
        close = close[close != label[k]]
        if len(close):
            yield np.repeat(rep[k], len(close)), close


def _first_link(percent: int):
    """One confirmed link of each asking document with the members of a component."""

    def compare(side, rep, short, shingle):
        mine, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for k in mine if len(other) else ():
            share, own = _share(short[k], short[other]), shingle[k]
            close = np.flatnonzero(share >= CLOSE)
            for y in other[close[np.argsort(-share[close], kind="stable")]]:
                n, m = len(own), len(shingle[y])
                if 100 * min(n, m) < percent * max(n, m):
                    continue
                both = len(np.intersect1d(own, shingle[y], assume_unique=True))
                if 100 * both >= percent * (n + m - both):
                    yield rep[[k]], rep[[y]]
                    break

    return compare


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Texts that are NULL or have no word are linked with nothing and stay.  Texts
    with fewer than five words are one shingle.  Rows that repeat an id get one
    row each; equal ids are one node, which each of its texts links.  A NULL id is a node of its own class and is
    linked with nothing.
    """
    plain = documents(docs, id_col, text_col)
    table = staged(plain.mapInArrow(_sketched, SKETCHED), "sketches")
    table = table.withColumn("same", F.when(F.col("doc_id").isNotNull(), F.col("same")))
    one = F.min(F.struct("doc_id", "short", "bands")).alias("one")
    classes = staged(
        table.where("same is not null")
        .groupBy("same")
        .agg(one)
        .select("same", F.col("one.doc_id").alias("rep"), "one.short", "one.bands"),
        "classes",
    )
    banded = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("m"))
    members = staged(banded.join(shared.where("m > 1"), "bucket"), "buckets")
    short = classes.select("rep", "same", "short")  # several rows for an id with several texts

    # ids with several texts are in several classes, which they join
    several = table.where("doc_id is not null and same is not null").groupBy("doc_id")
    several = several.agg(F.min("same").alias("one"), F.max("same").alias("other")).where("one <> other")
    own = table.join(several.select("doc_id"), "doc_id", "left_semi").join(classes.select("same", "rep"), "same")
    by_id = staged(own.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct(), "links")

    # full sets of all that share a bucket; their texts move once, at any size the same way
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = plain.hint("merge").join(ids, "doc_id", "left_semi")
    full = staged(texts.mapInArrow(_full_sets, SETS).dropDuplicates(["doc_id", "same"]), "sets")

    def estimated(pairs: DataFrame) -> DataFrame:
        a = short.select(F.col("rep").alias("a"), F.col("short").alias("x"))
        b = short.select(F.col("rep").alias("b"), F.col("short").alias("y"))
        found = pairs.join(a, "a").join(b, "b").withColumn("est", _estimate("x", "y"))
        return found.where(F.col("est") >= CLOSE).select("a", "b", "est")

    def most_similar(pairs: DataFrame) -> DataFrame:
        """One pair for each a: that of the largest estimate, then of the smallest b."""
        top = F.max(F.struct("est", (-F.col("b")).alias("less"))).alias("top")
        return pairs.groupBy("a").agg(top).select("a", (-F.col("top.less")).alias("b"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = full.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shingle").alias("sa"))
        y = full.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("shingle").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb")).cast("long")
        least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return staged(
            pairs.select(least, most)
            .distinct()
            .join(x, "a")
            .join(y, "b")
            .where(F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb"))
            .withColumn("both", both)
            .where(F.col("both") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("both")))
            .select("a", "b")
            .distinct(),
            "links",
        )

    def every(blocks: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    def blocks(asking: DataFrame, asked: DataFrame, key: str, columns: tuple[str, ...], compare, out: str) -> DataFrame:
        """``compare`` for each of ``rows`` blocks of asking with ``columns`` blocks of asked."""
        own_row = F.pmod(F.xxhash64("rep"), F.col("rows")).cast("int")
        own_column = F.pmod(F.xxhash64("rep"), F.col("columns")).cast("int")
        fields = (key, *columns, "i", "j")
        one = asking.withColumns({"i": own_row, "side": F.lit(0)}).withColumn("j", every("columns"))
        two = asked.withColumns({"j": own_column, "side": F.lit(1)}).withColumn("i", every("rows"))
        names = tuple(part.split()[0] for part in out.split(", "))
        return (
            one.select(*fields)
            .union(two.select(*fields))
            .repartition(key, "i", "j")
            .sortWithinPartitions(key, "i", "j", "side", "rep")
            .mapInPandas(_by_block(key, columns, compare, names), out)
        )

    def labelled(links: DataFrame) -> DataFrame:
        labels = components(links).withColumnRenamed("node", "rep")
        found = members.join(labels, "rep", "left")
        return found.select("bucket", "rep", F.coalesce("component", "rep").alias("label"))

    def across(found: DataFrame, compare, out: str) -> DataFrame:
        """Outsiders against the members of their bucket, where it has several components."""
        groups = found.groupBy("bucket", "label").agg(F.count("*").alias("c"))
        largest = groups.groupBy("bucket").agg(
            F.max(F.struct("c", "label")).alias("main"),
            F.sum("c").alias("m"),
            F.count("*").alias("labels"),
        )
        open_buckets = largest.where("labels > 1").select(
            "bucket",
            F.col("main.label").alias("main"),
            F.ceil((F.col("m") - F.col("main.c")) / OUTSIDERS).cast("int").alias("rows"),
            F.ceil(F.col("m") / MEMBERS).cast("int").alias("columns"),
        )
        rest = staged(found.join(open_buckets, "bucket").join(short, "rep"), "open")
        outsiders = rest.where("label <> main")
        return blocks(outsiders, rest, "bucket", ("side", "rep", "label", "short"), compare, out)

    def last_links(found: DataFrame) -> DataFrame:
        """Confirmed links of outsiders with the components that they name, one of each block."""
        asks = staged(across(found, _named, "rep long, label long").distinct(), "asks")
        asked = found.select("rep", "label").distinct()
        count = F.count("*")
        sizes = asks.groupBy("label").agg(F.ceil(count / ASKING).cast("int").alias("rows")).join(
            asked.groupBy("label").agg(F.ceil(count / ASKED).cast("int").alias("columns")), "label"
        )
        sets = full.select(F.col("doc_id").alias("rep"), "same", "shingle").join(short, ["rep", "same"])
        columns = ("side", "rep", "short", "shingle")
        return staged(
            blocks(
                asks.join(sizes, "label").join(sets, "rep"),
                asked.join(sizes, "label").join(sets, "rep"),
                "label", columns, _first_link(percent), "a long, b long",
            ),
            "links",
        )

    hubs = members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    links = by_id.union(confirmed(most_similar(estimated(hubs.distinct()))))
    nearest = across(labelled(links), _nearest, "a long, b long, est double")
    links = links.union(confirmed(most_similar(nearest)))
    links = links.union(last_links(staged(labelled(links), "labelled")))
    final = components(links)

    found = final.select(F.col("node").alias("rep"), "component")
    named = classes.select("same", "rep").join(found, "rep", "left").select("same", F.coalesce("component", "rep").alias("component"))
    return (
        table.join(named, "same", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class; rows that share an id stay together."""
    gone = near_duplicates(docs, id_col, text_col).where("not kept").select("doc_id").distinct()
    name = free_name("gone", docs.columns)
    gone = gone.withColumnRenamed("doc_id", name)
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")


# --- the same for DuckDB -------------------------------------------------------


def near_duplicate_sql() -> str:
    """All pairs with a common shingle, and everything that can be reached from each document."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, {words} AS w FROM documents),
    shingle AS MATERIALIZED (
        SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], chr(31))) AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
    ),
    size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    link AS MATERIALIZED (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ),
    reach(a, b) AS (
        SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
    ),
    least AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
           d.doc_id <= coalesce(m, d.doc_id) AS kept
    FROM d LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
    """
