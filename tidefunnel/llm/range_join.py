"""Exact range join of vectors within their label, over pivots and the triangle inequality.

Two vectors of one label and one length link if their cosine is at least a
threshold; on unit vectors that is a range r = sqrt(2 - 2 * threshold) of the
Euclidean metric.  The steps:

1. Equal vectors become one row with a count, so copies are never compared.
2. Pivots are drawn from each label by a hash: three, and one more for each
   PER_PIVOT vectors, PIVOT_NUMBERS numbers at most; a label without pivots is
   one cell.
3. A vector lives in the cell of its nearest pivot.  A neighbour across the
   border lies within r, so by the triangle inequality only vectors whose
   distances to the two pivots differ by at most 2 r can have one (and, the
   metric being Euclidean, only those within r of the plane between the two).
   Of a pair of cells one takes the other's border vectors as guests, in turn.
4. Cells are joined independently.  A cell with more than TILE rows is cut into
   tiles of two blocks of its rows, so no task holds more than two blocks.  A
   tile hands on a count of links and a root for each of its vectors, no pairs.
5. Components come from (vector, root) rows; the counts are summed.

Links are confirmed in double precision.  Results for odd rows: a vector that is
NULL, empty, all zero or holds NULL, NaN or an infinity, and a row without id or
label, links with nothing (no links, a component of its own; without an id no
component, not kept).  Vectors of different lengths do not link.  Repeated rows
are vectors of their own and link as copies.  Where one id has several vectors
each counts for itself; classes of copies with the same least id are one node.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefunnel.llm.components import components
from tidefunnel.operators.tables import staged

PER_PIVOT = 16_384  # vectors of a label for each pivot behind the third
PIVOT_NUMBERS = 1 << 22  # numbers in all pivots together: 32 MB
TILE = 8_192  # rows of one block of a cell
SALTS = 64  # parts that the rows of a group of copies are dealt to
SLACK = 1e-6  # added to every bound, far above rounding


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(all numbers, where each vector begins, lengths, whether it can be compared)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    begins = np.concatenate([[0], np.cumsum(sizes)])

    def count(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return upto[begins[1:]] - upto[begins[:-1]]

    usable = (count(~np.isfinite(flat)) == 0) & (count(flat != 0) > 0)
    return flat, begins, sizes, usable


def unit_matrix(flat: np.ndarray, begins: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The given vectors, all of one length, as rows of length one."""
    x = flat[begins[rows][:, None] + np.arange(size)]
    x = x * 2.0 ** -np.frexp(np.abs(x).max(axis=1))[1].astype(float)[:, None]  # exact, against overflow
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _keyed(source: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, vec, dim, key): ``key`` is a digest of the numbers, NULL if not comparable."""
    rows = source.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vec"),
    )
    kind = rows.schema["vec"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, labels, column = batch.columns
            flat, begins, sizes, usable = vectors_of(column)
            flat = flat + 0.0  # -0.0 and 0.0 are equal
            whole = usable & ~np.asarray(ids.is_null()) & ~np.asarray(labels.is_null())
            keys = [
                hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() if ok else None
                for a, b, ok in zip(begins[:-1], begins[1:], whole, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, labels, column, pa.array(sizes, pa.int32()), pa.array(keys, pa.binary())],
                names=["vec_id", "label", "vec", "dim", "key"],
            )

    return rows.mapInArrow(run, f"vec_id long, label string, vec {kind}, dim int, key binary")


CLASS = ["label", "dim", "key"]


def _pivots(classes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Unit pivots of each (label, length); PIVOT_NUMBERS numbers at most reach the driver."""
    many, widest = classes.agg(F.count("*"), F.max("dim")).first()
    if not many:
        return {}
    most = max(1, PIVOT_NUMBERS // widest)
    share = min(1.0, 8 * most / many)
    lot = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    drawn = classes.where(lot < int(share * (1 << 30))).withColumn("lot", lot)
    inside = Window.partitionBy("label", "dim")
    drawn = drawn.withColumns(
        {
            "turn": F.row_number().over(inside.orderBy("lot", "key")),
            "size": F.count("*").over(inside) / share,
        }
    ).where(F.col("turn") <= 3 + F.floor(F.col("size") / PER_PIVOT))
    taken = drawn.orderBy("turn", "lot", "label", "dim", "key").limit(most)
    found: dict[tuple[str, int], list] = {}
    for row in taken.select("label", "dim", "vec").collect():
        found.setdefault((row.label, row.dim), []).append(row.vec)
    out = {}
    for (label, dim), rows in found.items():
        x = np.array(rows, np.float64)
        out[label, dim] = unit_matrix(x.ravel(), np.arange(len(x)) * dim, np.arange(len(x)), dim)
    return out


def cells_of(x: np.ndarray, pivots: np.ndarray | None, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether it lives there): the home cell of each unit vector and its guest cells."""
    if pivots is None:
        n = len(x)
        return np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
    squares = np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0)
    home = squares.argmin(axis=1)
    least = squares[np.arange(len(x)), home]
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 0.0))[home]
    near = np.sqrt(squares) - np.sqrt(least)[:, None] <= 2 * reach + SLACK
    near &= squares - least[:, None] <= 2 * apart * (reach + SLACK) + SLACK
    cell = np.arange(len(pivots))[None, :]
    host = home[:, None]
    # cells a < b meet in a if a + b is even, else in b
    near &= (cell < host) == ((cell + host) % 2 == 0)
    near[np.arange(len(x)), home] = True
    row, where = np.nonzero(near)
    return row, where, where == home[row]


def _placed(batches, pivots, reach):
    """For each batch and (label, length): its columns, their rows, cells and homes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = batch.column("label").dictionary_encode()
        names, code = labels.dictionary.to_pylist(), labels.indices.to_numpy()
        flat, begins, sizes, _ = vectors_of(batch.column("vec"))
        for c, size in sorted(set(zip(code.tolist(), sizes.tolist(), strict=True))):
            own = pivots.get((names[c], size))
            rows = np.flatnonzero((code == c) & (sizes == size))
            step = len(rows) if own is None else max(1, (1 << 20) // len(own))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                row, cell, lives = cells_of(unit_matrix(flat, begins, part, size), own, reach)
                yield batch, names[c], size, part[row], cell, lives


def _crowded(classes: DataFrame, pivots, reach: float) -> dict[tuple[str, int, int], tuple[int, int]]:
    """Blocks of homes and of guests of each cell with over TILE rows (rows / TILE such cells at most)."""

    def run(batches):
        for _, label, size, row, cell, lives in _placed(batches, pivots, reach):
            where, code = np.unique(cell, return_inverse=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pa.array([label] * len(where), pa.string()),
                    "dim": pa.array([size] * len(where), pa.int32()),
                    "cell": pa.array(where, pa.int32()),
                    "homes": pa.array(np.bincount(code, lives).astype(np.int64)),
                    "guests": pa.array(np.bincount(code, ~lives).astype(np.int64)),
                }
            )

    counts = classes.select("label", "vec").mapInArrow(run, "label string, dim int, cell int, homes long, guests long")
    counts = counts.groupBy("label", "dim", "cell").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests"))
    return {
        (r.label, r.dim, r.cell): (max(1, -(-r.homes // TILE)), -(-r.guests // TILE))
        for r in counts.where(F.col("homes") + F.col("guests") > TILE).collect()
    }


def _tiles(classes: DataFrame, pivots, crowded, reach: float) -> DataFrame:
    """One row for each vector and tile that needs it; ``side`` 1 meets side 0 only."""
    kind = classes.schema["vec"].dataType.simpleString()

    def run(batches):
        for batch, label, size, row, cell, lives in _placed(batches, pivots, reach):
            lot = np.frombuffer(b"".join(k[:4] for k in batch.column("key").to_pylist()), np.uint32)[row].astype(np.int64)
            parts = [[np.zeros(0, np.int64)] * 5]
            for where in np.unique(cell):
                here = cell == where
                rows, alive = row[here], lives[here]
                homes, guests = crowded.get((label, size, int(where)), (1, 0))
                own = np.where(alive, lot[here] % homes, homes + lot[here] % guests if guests else 0)
                zero = np.zeros(len(rows), np.int64)
                if homes + guests == 1:
                    parts.append([rows, zero + where, zero, zero, (~alive).astype(np.int64)])
                    continue
                for other in range(homes + guests):
                    # guests meet blocks of homes only
                    meets = alive | (other < homes)
                    i, j = np.minimum(own, other)[meets], np.maximum(own, other)[meets]
                    side = ((own[meets] != i) | ~alive[meets]).astype(np.int64)
                    parts.append([rows[meets], zero[meets] + where, i, j, side])
            rows, cells, i, j, side = (np.concatenate(p) for p in zip(*parts, strict=True))
            taken = batch.select(["key", "rep", "n", "vec"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label] * len(rows), pa.string()),
                    pa.array(np.full(len(rows), size), pa.int32()),
                    *(pa.array(a, pa.int32()) for a in (cells, i, j, side)),
                    *taken.columns,
                ],
                names=["label", "dim", "cell", "i", "j", "side", "key", "rep", "n", "vec"],
            )

    return classes.select("label", "vec", "key", "rep", "n").mapInArrow(
        run,
        f"label string, dim int, cell int, i int, j int, side int, key binary, rep long, n long, vec {kind}",
    )


def linked(x: np.ndarray, side: np.ndarray, within: bool, weight: np.ndarray, rep: np.ndarray, least: float):
    """(links, root) of each row of a tile: side 0 meets side 1, and itself if ``within``."""
    order = np.lexsort((rep, side))
    x, weight, rep, mine = x[order], weight[order], rep[order], int((side == 0).sum())
    links = np.zeros(len(x), np.int64)
    by_rep = np.argsort(rep, kind="stable")
    parent = np.empty(len(x), np.int64)
    parent[by_rep] = np.arange(len(x))  # a node is named by its place among the ids
    for at in range(0, mine, 256):
        first = at if within else mine
        block = x[at : min(at + 256, mine)]
        close = block @ x[first:].T
        a, b = np.nonzero(close >= least - 1e-9)
        unsure = np.flatnonzero(np.abs(close[a, b] - least) < 1e-9)
        a, b = a + at, b + first
        keep = a < b
        for u in unsure[keep[unsure]]:
            p, q = x[a[u]], x[b[u]]
            keep[u] = np.dot(p, q) / np.sqrt(np.dot(p, p) * np.dot(q, q)) >= least
        a, b = a[keep], b[keep]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        while len(a):  # hang the larger root under the smaller, then shorten the ways
            one, two = parent[a], parent[b]
            apart = one != two
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            if not len(a):
                break
            low = np.arange(len(x))
            np.minimum.at(low, np.maximum(one, two), np.minimum(one, two))
            while (low[low] != low).any():
                low = low[low]
            parent = low[parent]
    root = rep[by_rep][parent]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return links[back], root[back]


def _compared(tiles: DataFrame, least: float) -> DataFrame:
    """(label, dim, key, rep, links, root) of the vectors of each tile that link there."""

    def run(table: pa.Table) -> pa.Table:
        flat, begins, sizes, _ = vectors_of(table.column("vec"))
        size = int(sizes[0])
        x = unit_matrix(flat, begins, np.arange(len(sizes)), size)
        side, rep, weight = (table.column(c).to_numpy() for c in ("side", "rep", "n"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        links, root = linked(x, side, i == j, weight, rep, least)
        out = table.select(["label", "dim", "key", "rep"])
        out = out.append_column("links", pa.array(links)).append_column("root", pa.array(root))
        return out.filter(pa.array(links > 0))

    return tiles.groupBy("label", "dim", "cell", "i", "j").applyInArrow(
        run, "label string, dim int, key binary, rep long, links long, root long"
    )


def linked_classes(
    source: DataFrame,
    threshold: float,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """(keyed rows, classes of equal vectors with links of each and its component).

    Classes have label, dim, key, ``rep`` (least id), ``n`` (rows), ``links`` (rows
    that a row of the class links with) and ``component``.
    """
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    keyed = _keyed(source, id_col, label_col, vector_col)
    classes = keyed.where("key is not null").groupBy(*CLASS).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")
    )
    classes = staged(classes, "vectors")
    pivots = _pivots(classes)
    crowded = _crowded(classes, pivots, reach)
    found = staged(_compared(_tiles(classes, pivots, crowded, reach), threshold), "links")
    links = found.groupBy(*CLASS).agg(F.sum("links").alias("more"))
    named = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    info = (
        classes.drop("vec")
        .join(links, CLASS, "left")
        .join(named, F.col("rep") == F.col("node"), "left")
        .select(
            *CLASS,
            "rep",
            "n",
            (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return keyed, info


def near_vectors(
    source: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row for each row of ``source``: vec_id, n_links, component_id, kept."""
    keyed, info = linked_classes(source, threshold, id_col, label_col, vector_col)
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt")
    rows = keyed.select("vec_id", *CLASS, salt)
    # a group of copies meets its result in SALTS parts
    parts = rows.where("key is not null").select(*CLASS, "salt").distinct().join(info, CLASS)
    return rows.join(parts, [*CLASS, "salt"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )


def range_join_sql(threshold: float = 0.93) -> str:
    """All pairs of a label, and everything that can be reached from each vector."""
    return f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'sum') > 0
    ),
    link AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= {threshold}
    ),
    reach(a, b) AS (
        SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
    ),
    many AS (SELECT a, count(*) AS n FROM link GROUP BY a),
    least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
           vec_id <= coalesce(m, vec_id) AS kept
    FROM embeddings e LEFT JOIN many ON many.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
    """
