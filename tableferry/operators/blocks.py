"""Ordered work without one task per key.

A window over a key puts every row of that key in one task, however many there are. The
helpers here cut the order column into blocks of a fixed span instead: inside a block an
ordinary window does the work, and what must cross a block border is carried by a table with
one row per block. An integer order that is unique within its key never puts more than
``span`` rows in a block, so no task depends on how the keys are distributed. Where values of
the order are far apart, blocks are cut by rank instead (:class:`Ranked`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableferry.session import stored

SPAN = 1_000_000
# cells that one pass of quantiles cuts a key into, and the sketch's accuracy
FAN, ACCURACY = 256, 10_000


@dataclass(frozen=True)
class Ranked:
    """In the place of a span: blocks of about ``rows`` rows of a key, wherever their order values
    lie. The rows of a block differ from that by the error of the sketch, some 5 percent."""

    rows: int = SPAN


def block_of(order: str, span: int) -> Column:
    """Block number of an integer order column (a monotone function of it)."""
    return F.expr(f"cast(`{order}` as bigint) div {int(span)}L")


def _behind(cuts: str, wanted: Column) -> Column:
    """How many of the sorted ``cuts`` are not larger than ``wanted``, by halving."""
    def halved(at, _):
        middle = F.shiftright(at["low"] + at["high"], 1)
        right = F.get(cuts, middle) <= wanted
        return F.when(at["low"] >= at["high"], at).when(right, F.struct(
            (middle + 1).alias("low"), at["high"].alias("high"))).otherwise(
            F.struct(at["low"].alias("low"), middle.alias("high")))

    size = F.size(cuts)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), halved,
                       lambda at: at["low"])


def rank_cuts(df: DataFrame, by: Sequence[str], order: str, rows: int) -> DataFrame:
    """``(_key0, ..., _cuts)``: for each key the sorted order values at which its blocks begin, all
    but the first one's.

    Quantile sketches are aggregates that combine where rows are read, so a hot key is no task of
    its own. A key of more than ``FAN`` blocks is cut in levels, each level with sketches of the
    cells of the one before; the driver sees the size of the largest cell only.
    """
    keys = [f"_key{i}" for i in range(len(by))]
    slim = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)],
                     F.col(order).cast("long").alias("_at"))

    def sketched(cells: DataFrame, names: list[str]) -> DataFrame:
        wanted = F.least(F.ceil(F.col("_n") / rows), F.lit(FAN)).cast("int")
        picked = F.transform(F.sequence(F.lit(1), wanted - 1), lambda i: F.element_at(
            "_q", F.floor(i * FAN / wanted).cast("int")))
        return stored(cells.groupBy(*names).agg(
            F.count(F.lit(1)).alias("_n"), F.percentile_approx(
                "_at", [i / FAN for i in range(1, FAN)], ACCURACY).alias("_q")
        ).select(*names, "_n", F.when(wanted > 1, picked).otherwise(
            F.array().cast("array<long>")).alias("_cuts")), "quantiles")

    def largest(cells: DataFrame) -> int:
        return cells.agg(F.max("_n")).first()[0] or 0

    cells = sketched(slim, keys)
    cuts, size = cells.select(*keys, "_cuts"), largest(cells)
    while size > rows * FAN:
        cells = sketched(_placed(slim, keys, "_at", cuts, "_cell"), [*keys, "_cell"])
        cuts = stored(cuts.unionByName(cells.select(*keys, "_cuts")).groupBy(*keys).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("_cuts")))).alias("_cuts")),
            "rank-cuts")
        before, size = size, largest(cells)
        if size >= before:  # equal order values cannot be cut
            break
    return cuts


def _placed(df: DataFrame, by: Sequence[str], order: str, cuts: DataFrame,
            out: str) -> DataFrame:
    names = {f"_key{i}": f"_cut{i}" for i in range(len(by))}
    index = cuts.withColumnsRenamed(names)
    same = [df[c].eqNullSafe(index[k]) for c, k in zip(by, names.values())]
    place = _behind("_cuts", F.col(order).cast("long")).cast("long")
    return df.join(index, same).withColumn(out, place).select(*df.columns, out)


def blocked(df: DataFrame, by: Sequence[str], order: str, span: int | Ranked,
            out: str = "_block") -> DataFrame:
    """``df`` with the block of each row, a monotone function of the order within its key.

    Blocks by rank need a key, and read keys and order once more in front of everything
    else; each row then searches the cuts of its key in place. The cuts are 8 bytes per block in all.
    """
    if not isinstance(span, Ranked):
        return df.withColumn(out, block_of(order, span))
    if not by:
        raise ValueError("blocks by rank need a key; dense_order does without")
    return _placed(df, by, order, rank_cuts(df, by, order, span.rows), out)


def dense_order(df: DataFrame, columns: Sequence[str], out: str = "ord") -> DataFrame:
    """Add an integer order for rows whose own order is sparse, not an integer, or several
    columns, and store the result.

    Rows are range-partitioned and sorted by ``columns``, so that ids given by partition and
    position follow that order and are consecutive within a partition: blocks of them are full.
    """
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return stored(ranged.withColumn(out, F.monotonically_increasing_id()), "ordered")


def numbered(df: DataFrame, order: str, by: Sequence[str] = (), span: int | Ranked = SPAN,
             out: str = "row_no") -> DataFrame:
    """Exact 1-based row number of ``order`` (per ``by`` if given)."""
    by = list(by)
    cut = blocked(df, by, order, span)
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    # one marker row per block, sorted in front of it, brings the count of all rows before
    marker = (
        cut.groupBy(*by, "_block").agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                F.lit(False).alias("_real"))
    )
    inside = Window.partitionBy(*by, "_block").orderBy("_real", order)
    return (
        cut.withColumn("_real", F.lit(True))
        .unionByName(marker, allowMissingColumns=True)
        .withColumn("_base", F.first("_base").over(inside))
        .withColumn(out, F.col("_base") + F.row_number().over(inside) - 1)
        .where("_real")
        .drop("_block", "_base", "_real")
    )


def with_previous(df: DataFrame, by: Sequence[str], order: str, values: Sequence[str],
                  span: int | Ranked = SPAN, prefix: str = "prev_") -> DataFrame:
    """Add the values of the preceding row of the same key as ``prev_*``.

    ``prev_seen`` is true where such a row exists.
    """
    by = list(by)
    cut = blocked(df, by, order, span).withColumn("_v", F.struct(*values))
    along = Window.partitionBy(*by).orderBy("_block")
    # one marker row per block holds the last row of the block before it
    marker = (
        cut.groupBy(*by, "_block").agg(F.max_by("_v", order).alias("_last"))
        .select(*by, "_block", F.lag("_last").over(along).alias("_v"),
                F.lit(False).alias("_real"))
    )
    inside = Window.partitionBy(*by, "_block").orderBy("_real", order)
    return (
        cut.withColumn("_real", F.lit(True))
        .unionByName(marker, allowMissingColumns=True)
        .withColumn("_p", F.lag("_v").over(inside))
        .where("_real")
        .select(
            *df.columns,
            F.col("_p").isNotNull().alias(f"{prefix}seen"),
            *[F.col(f"_p.{v}").alias(f"{prefix}{v}") for v in values],
        )
    )


def row_batches(df: DataFrame, order: str, rows: int, by: Sequence[str] = (),
                span: int | Ranked = SPAN, out: str = "batch_no") -> DataFrame:
    """Number consecutive batches of ``rows`` rows, from 0."""
    return (
        numbered(df, order, by, span, "_no")
        .withColumn(out, F.expr(f"cast((_no - 1) div {int(rows)} as bigint)"))
        .drop("_no")
    )


def latest_upto(probes: DataFrame, key: str, marks: DataFrame, mark_key: str,
                values: Sequence[str], by: Sequence[str] = (), span: int = SPAN) -> DataFrame:
    """As-of lookup: distinct ``(by, key)`` of ``probes`` with the ``values`` of the last mark
    whose ``mark_key`` is not larger. Both keys are integers, marks unique per ``by``."""
    by = list(by)
    v = F.struct(*values)
    both = stored(
        probes.select(*by, F.col(key).cast("long").alias("_key")).distinct()
        .withColumn("_kind", F.lit(2))
        .unionByName(marks.select(*by, F.col(mark_key).cast("long").alias("_key"),
                                  v.alias("_v")).withColumn("_kind", F.lit(1)),
                     allowMissingColumns=True), "asof",
    ).withColumn("_block", block_of("_key", span))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    marker = (
        both.groupBy(*by, "_block")
        .agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_key"))).alias("_last"))
        .select(*by, "_block", F.last("_last", ignorenulls=True).over(earlier).alias("_v"),
                F.lit(None).cast("long").alias("_key"), F.lit(0).alias("_kind"))
    )
    inside = Window.partitionBy(*by, "_block").orderBy("_key", "_kind").rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        both.unionByName(marker)
        .withColumn("_v", F.last("_v", ignorenulls=True).over(inside))
        .where("_kind = 2 and _v is not null")
        .select(*by, F.col("_key").alias(key), *[F.col(f"_v.{c}").alias(c) for c in values])
    )
