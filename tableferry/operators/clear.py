"""Clear once per batch: which messages clear, and what is left afterwards.

A message clears its table (or partition) when its batch id differs from that of the message
before it with the same key. Both the comparison and the numbering of clears work in blocks of
message ids, so neither a table that gets most messages nor batches that alternate all the time
put a key into one task. What stays is decided by the last clear of each key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tableferry.functions.literals import partition_values
from tableferry.operators.blocks import SPAN, block_of, numbered, with_previous
from tableferry.session import stored

KEYS = ("clear_table", "partition")


def run_starts(messages: DataFrame, keys: Sequence[str] = KEYS, order: str = "msg_id",
               batch: str = "batch_id", span: int = SPAN) -> DataFrame:
    """First message of every run of one batch id per key: the messages that clear. Header
    values are never null."""
    asked = messages.where((F.col(keys[0]) != "") & (F.col(batch) != "")).select(
        *keys, order, batch)
    seen = with_previous(asked, keys, order, [batch], span)
    return seen.where(~F.col("prev_seen") | (F.col(f"prev_{batch}") != F.col(batch))).select(
        *keys, order, batch)


def clear_events(messages: DataFrame, keys: Sequence[str] = KEYS, order: str = "msg_id",
                 batch: str = "batch_id", span: int = SPAN) -> DataFrame:
    """The messages that trigger a clear, numbered per key from 1 in ``epoch``."""
    starts = run_starts(messages, keys, order, batch, span)
    return numbered(starts, order, keys, span, "epoch")


def last_clears(starts: DataFrame, keys: Sequence[str] = KEYS,
                order: str = "msg_id") -> DataFrame:
    """The last clear of each key, from run starts or clear events."""
    return starts.groupBy(*keys).agg(F.max(order).alias("cleared_at"))


def as_runs(messages: DataFrame, keys: Sequence[str] = KEYS, order: str = "msg_id",
            batch: str = "batch_id") -> DataFrame:
    """Messages that clear as intervals of one id: ``(*keys, batch, first, last)``."""
    return messages.where((F.col(keys[0]) != "") & (F.col(batch) != "")).select(
        *keys, batch, F.col(order).alias("first"), F.col(order).alias("last"))


def _last_batches(runs: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """Per key the batch of its last message, and the last message of any other batch."""
    tops = runs.groupBy(*keys, batch).agg(F.max("last").alias("last"))
    tops = stored(tops, "batch-ends")
    newest = tops.groupBy(*keys).agg(F.max_by(batch, "last").alias("_batch"))
    other = F.when(F.col(batch) != F.col("_batch"), F.col("last"))
    return stored(tops.join(newest, list(keys)).groupBy(*keys, "_batch").agg(
        F.max(other).alias("_other")), "last-batches")


def last_clears_of_runs(runs: DataFrame, keys: Sequence[str] = KEYS,
                        batch: str = "batch_id") -> DataFrame:
    """What :func:`last_clears` gives for the run starts of all messages: the first message
    behind the last one that is of another batch than the newest."""
    ends = _last_batches(runs, keys, batch)
    behind = F.coalesce(F.col("_other") + 1, F.lit(-2**63))
    newest = runs.join(ends, list(keys)).where(
        (F.col(batch) == F.col("_batch")) & (F.col("last") >= behind))
    return newest.groupBy(*keys).agg(F.min(F.greatest("first", behind)).alias("cleared_at"))


def open_runs(runs: DataFrame, keys: Sequence[str] = KEYS, batch: str = "batch_id",
              span: int = SPAN) -> DataFrame:
    """The intervals that later messages, also late ones, can still matter to: a fold, as
    ``open(a + b) = open(open(a) + open(b))``.

    Nothing in front of the last message of another batch can ever count again: that message only
    moves forward. Of what is behind it, neighbouring ids are one interval, as no message can come
    to lie between them; intervals end at multiples of ``span``, so that no task gets a whole key.
    """
    ends = _last_batches(runs, keys, batch)
    from_here = F.coalesce("_other", F.lit(-2**63))
    kept = runs.join(ends, list(keys)).where(F.col("last") >= from_here).select(
        *keys, batch, F.when(F.col(batch) == F.col("_batch"), F.col("first")).otherwise(
            F.col("last")).alias("first"), "last").distinct()
    inside = Window.partitionBy(*keys, batch, block_of("first", span)).orderBy("first", "last")
    before = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= before + 1, 0).otherwise(1)
    return (kept.withColumn("_begins", begins).withColumn("_no", F.sum("_begins").over(inside))
            .groupBy(*keys, batch, block_of("first", span).alias("_block"), "_no")
            .agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .select(*keys, batch, "first", "last"))


def surviving(rows: DataFrame, last: DataFrame, table: str,
              partition: str | Sequence[str] | None = None,
              order: str = "msg_id", keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows not removed by a later clear of their table or of their partition.

    ``last`` comes from :func:`last_clears`; an empty partition stands for the whole table, any
    other is a literal such as ``'jd'`` or ``(2021,7,13)``, whose values are compared one by one
    with the columns named by ``partition``. Where a clear names a partition there must be some.
    Rows stored before the topic have a null ``order``. A clear removes what is stored when
    it happens: rows of the same batch in other partitions than the declared one stay.

    ``last`` has one row per key. It is written once, so that the optimizer broadcasts it or
    not by its real size; a table that holds most rows is then never the shuffle key.
    """
    last = stored(last, "clears")
    has_part = len(keys) > 1
    empty = F.col(keys[1]) == "" if has_part else F.lit(True)
    whole = last.where(empty).select(F.col(keys[0]).alias("_t"),
                                     F.col("cleared_at").alias("_all"))
    out = rows.join(whole, F.col(table) == F.col("_t"), "left")
    bound = F.col("_all")
    if has_part and partition is not None:
        columns = [partition] if isinstance(partition, str) else list(partition)
        parts = last.where(~empty).groupBy(
            F.col(keys[0]).alias("_pt"), partition_values(F.col(keys[1]).cast("string")).alias("_pp")).agg(
                F.max("cleared_at").alias("_part"))
        own = F.array(*[F.col(c).cast("string") for c in columns])
        out = out.join(parts, (F.col(table) == F.col("_pt")) & (own == F.col("_pp")), "left")
        bound = F.greatest("_all", "_part")
    elif has_part and not last.where(~empty).isEmpty():
        raise ValueError("a clear names a partition, so the partition columns must be given")
    kept = bound.isNull() | F.coalesce(F.col(order) >= bound, F.lit(False))
    return out.where(kept).select(*rows.columns)
