"""Range partitions of keyed tables: register them once, and assign rows to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tableferry.functions.literals import normalise_target, range_bounds
from tableferry.operators.blocks import SPAN, latest_upto
from tableferry.session import stored


def requested_ranges(messages: DataFrame, target: str = "target_table",
                     spec: str = "range_partition", batch: str = "batch_id") -> DataFrame:
    """Distinct ranges asked for by message headers."""
    lower, upper = range_bounds(F.col("asked"))
    return (
        messages.where((F.col(spec) != "") & (F.col(batch) != ""))
        .groupBy(F.col(target).alias("_target"), F.col(spec).alias("_spec"))
        # an aggregate result, so that the parsing below is not pushed in front of it and
        # done once per message
        .agg(F.min(spec).alias("asked"), F.min(target).alias("wanted"))
        .select(normalise_target(F.col("wanted")).alias("target_table"),
                lower.alias("lower"), upper.alias("upper"))
        .where("lower < upper").distinct()
    )


def unread_ranges(messages: DataFrame, target: str = "target_table",
                  spec: str = "range_partition", batch: str = "batch_id") -> DataFrame:
    """Distinct ``(target_table, asked)`` whose text is no range, or one that holds nothing."""
    asked = (messages.where((F.col(spec) != "") & (F.col(batch) != ""))
             .groupBy(F.col(target).alias("_target"), F.col(spec).alias("_spec"))
             .agg(F.min(spec).alias("asked"), F.min(target).alias("wanted")))
    lower, upper = range_bounds(F.col("asked"))
    return asked.where(F.coalesce(lower >= upper, F.lit(True))).select(
        normalise_target(F.col("wanted")).alias("target_table"), "asked")


def add_ranges(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """The registry with those requests that it does not hold yet."""
    new = requests.join(registry, ["target_table", "lower", "upper"], "left_anti")
    return registry.select("target_table", "lower", "upper").unionByName(
        new.select("target_table", "lower", "upper"))


def overlapping(registry: DataFrame) -> DataFrame:
    """Ranges that begin before one of their table that sorts in front of them has ended."""
    before = Window.partitionBy("target_table").orderBy("lower", "upper").rowsBetween(
        Window.unboundedPreceding, -1)
    return (registry.select("target_table", "lower", "upper").distinct()
            .withColumn("_ends", F.max("upper").over(before)).where("lower < _ends").drop("_ends"))


#: Ranges of all tables together up to which rows search them in place.
INDEXED = 100_000


def assign_ranges(rows: DataFrame, key: str, registry: DataFrame, target: str | None = None,
                  span: int = SPAN) -> DataFrame:
    """Rows with ``lower``/``upper`` of the range that holds their key, null if none does.

    Ranges of one table do not overlap (:func:`overlapping` lists those that do), so the only
    candidate is the last one that begins at or below the key. With a ``target`` column each row
    searches the sorted ranges of its table in place and no row is shuffled. Registries of more
    than ``INDEXED`` ranges, and those of a single table, are looked up once per distinct key,
    and the small result is joined back by equality. There is no range join over the rows.
    """
    by = [target] if target else []
    marks = registry.select(
        *([F.col("target_table").alias(target)] if target else []),
        F.col("lower").cast("long").alias("lower"), F.col("upper").cast("long").alias("upper"))
    if target:
        marks = stored(marks, "registry")
        if marks.count() <= INDEXED:
            return _searched(rows, key, marks, target)
    found = latest_upto(rows.select(*by, key), key, marks, "lower", ["lower", "upper"], by, span)
    held = stored(found.where(F.col(key) < F.col("upper")), "ranges")
    return rows.join(held, [*by, key], "left").select(*rows.columns, "lower", "upper")


def _searched(rows: DataFrame, key: str, marks: DataFrame, target: str) -> DataFrame:
    """One row for each table holds its ranges in order; rows find theirs by halving."""
    index = stored(marks.groupBy(F.col(target).alias("_target")).agg(
        F.array_sort(F.collect_set(F.struct("lower", "upper"))).alias("_ranges")), "range-index")
    wanted = F.col(key).cast("long")

    def halved(at, _):
        middle = F.shiftright(at["low"] + at["high"], 1)
        right = F.get("_ranges", middle)["lower"] <= wanted
        return F.when(at["low"] >= at["high"], at).when(right, F.struct(
            (middle + 1).alias("low"), at["high"].alias("high"))).otherwise(
            F.struct(at["low"].alias("low"), middle.alias("high")))

    size = F.size("_ranges")
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    behind = F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), halved,
                         lambda at: at["low"])
    joined = rows.join(index, rows[target] == index["_target"], "left")
    found = joined.withColumn("_range", F.when(behind > 0, F.get("_ranges", behind - 1)))
    holds = wanted < F.col("_range.upper")
    return found.select(*rows.columns, *[F.when(holds, F.col(f"_range.{c}")).alias(c)
                                         for c in ("lower", "upper")])
