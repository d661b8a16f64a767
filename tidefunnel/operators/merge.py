"""Keyed inserts and updates on tables without a transaction log.

A merge yields the new content of the table as a DataFrame; the caller writes
it.  Batches may repeat a key (even for most of their rows): they are reduced
to one row per key first, with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    update: list[str],
    order_by: list[str],
    stamp: tuple[str, Column] | None = None,
    change: str | None = None,
) -> DataFrame:
    """Insert rows with new keys; on a known key replace only ``update``.

    ``order_by`` ranks repeated keys within the batch: the first one (lowest)
    would be inserted and the following ones applied to it, so new rows take
    the ``update`` columns of the last and all others of the first.  ``stamp``
    sets a column on rows that the batch updated.  ``change`` names a further
    column that says 'insert' or 'update' on rows of the batch.
    """
    columns = target.columns
    incoming = [c for c in columns if c in batch.columns and c not in keys]
    ranked = batch.select(*keys, *incoming, *[c for c in order_by if c not in [*keys, *incoming]])
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    # the last row gives updated columns only, so that wide texts move once
    replaced = [c for c in incoming if c in update or (stamp is not None and c == stamp[0])]
    fields = F.struct(*incoming) if incoming else F.struct(F.lit(1).alias("_"))
    latest = F.struct(*replaced) if replaced else F.struct(F.lit(1).alias("_"))
    per_key = (
        ranked.where(complete)
        .groupBy(*keys)
        .agg(
            F.min_by(fields, F.struct(*order_by)).alias("first"),
            F.max_by(latest, F.struct(*order_by)).alias("last"),
        )
    )
    loose = ranked.where(~complete).select(*keys, fields.alias("first"), latest.alias("last"))
    new = per_key.unionByName(loose).withColumn("_in_batch", F.lit(True))
    # Align key names through aliases so that a full outer join keeps both sides.
    old = target.withColumn("_in_target", F.lit(True)).alias("o")
    joined = old.join(new.alias("n"), keys, "full_outer")
    known = F.coalesce(F.col("_in_target"), F.lit(False))
    touched = F.coalesce(F.col("_in_batch"), F.lit(False))
    out: list[Column] = []
    for c in columns:
        if c in keys:
            value = F.col(c)
        elif stamp is not None and c == stamp[0]:
            value = F.when(known & touched, stamp[1]).otherwise(
                F.when(known, F.col(f"o.{c}")).otherwise(
                    F.col(f"n.last.{c}") if c in incoming else stamp[1]
                )
            )
        elif c in update:
            value = F.when(touched, F.col(f"n.last.{c}")).otherwise(F.col(f"o.{c}"))
        elif c in incoming:
            value = F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.first.{c}"))
        else:
            value = F.col(f"o.{c}")
        out.append(value.alias(c))
    if change is not None:
        out.append(F.when(touched, F.when(known, "update").otherwise("insert")).alias(change))
    return joined.select(*out)


def append_new(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Append rows whose key is new; of repeated keys the first one wins."""
    fields = [c for c in target.columns if c not in keys]
    firsts = (
        batch.groupBy(*keys)
        .agg(F.min_by(F.struct(*fields) if fields else F.struct(F.lit(1)), F.struct(*order_by)).alias("row"))
        .select(*keys, *[F.col(f"row.{c}").alias(c) for c in fields])
    )
    fresh = firsts.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
