"""Last-wins upserts on a primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tableferry.session import stored


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key. An aggregate rather than a window: rows of a key combine
    where they are read, so a key that holds a third of them costs no more than others."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c)
                         for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """``existing`` (unique keys) with whole incoming rows put in; incoming always wins.

    The reduced incoming side is written once, so its size is known: where it is small the
    optimizer broadcasts its keys and the stored side is not shuffled at all.
    """
    newest = stored(last_wins(incoming, keys, order), "upsert")
    kept = existing.join(newest.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(newest.select(*existing.columns))


def upsert_partial(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """Upsert of records that carry only some columns.

    Columns the records lack keep their stored value, and are null for a new key.
    """
    carried = [c for c in existing.columns if c in incoming.columns and c not in keys]
    hidden = [c for c in order if c not in keys and c not in carried]
    newest = (
        last_wins(incoming.select(*keys, *carried, *hidden), keys, order)
        .select(*keys, F.struct(F.lit(True).alias("here"),
                                *[F.col(c) for c in carried]).alias("_new"))
    )
    joined = existing.join(newest, list(keys), "full_outer")
    return joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.`{c}`")).otherwise(F.col(c)).alias(c)
        if c in carried else F.col(c) for c in existing.columns])


def cells(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str],
          fields: str) -> DataFrame:
    """Each column as ``struct(*order, value)``, null in records that do not carry it; a record
    whose list of names is null carries all. Cells of several rounds merge to the same result in
    any order."""
    def cell(c: str):
        here = F.col(fields).isNull() | F.array_contains(fields, c)
        return F.when(here, F.struct(*order, F.col(f"`{c}`").alias("value"))).alias(c)
    return rows.select(*keys, *[cell(c) for c in columns])


def merged_cells(parts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest cell of each column of each key, by an aggregate like :func:`last_wins`."""
    def newest(c: str):
        at = F.when(F.col(f"`{c}`").isNotNull(), F.struct(*[F.col(f"`{c}`")[o] for o in order]))
        return F.max_by(F.col(f"`{c}`"), at).alias(c)
    columns = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[newest(c) for c in columns]) if columns else parts.distinct()


def cell_values(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    return merged.select(*[F.col(f"`{c}`") if c in keys else F.col(f"`{c}`")["value"].alias(c)
                           for c in merged.columns])
