"""Ordered fold with reset, run in parallel inside a lane.

Greedy packing and flushing walk the rows of a lane in order, add up a weight, and start a new
group when a limit is reached. Where a group starts depends on every row before it, so the
plain form is one task per lane. Here a lane is cut into blocks of its order column:

1. *Summaries.* One task per block, reading only order and weight, works out what the block
   does to any state that can enter it. The state is the size of the open group, so only its
   first few rows can be the first start inside the block; the rest follows from that choice.
2. *Chain.* The summaries of a lane, one row per block, are applied one after the other. This
   gives for each block where its first start is and to which block the rows before it belong.
3. *Assign.* Rows move to the block in which their group starts. Every such block begins with
   the start of a group, so it is folded from an empty state, as a stream of Arrow batches.

The full rows are shuffled once, and no task holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tableferry.operators.blocks import SPAN, Ranked, blocked
from tableferry.session import stored

ALWAYS = -(2**62)
NO_START = 2**63 - 1

SUMMARY = ("lane long, block long, shift long, threshold array<long>, start array<long>,"
           " leaves array<long>, starts array<long>")
CUTS = "lane long, block long, cut long, own_base long, prev_home long, prev_base long"


class Rule:
    """When the next group starts, as arithmetic on prefix arrays.

    ``before``: a row that would bring the open group to the limit starts the next one.
    ``after``: the row that brings it to the limit is the last of its group.
    ``timer``: the weight is a clock; a start is the first row at least ``limit`` past the last.

    With ``test`` and ``origin`` from :meth:`arrays`, the start after ``j`` is the first
    ``k > j`` with ``test[k] >= origin[j] + limit``; with entering state ``c`` the first start
    is the first ``k`` with ``c + test[k] >= limit``.
    """

    def __init__(self, when: str, limit: int, seed: int = 0):
        if when not in ("before", "after", "timer"):
            raise ValueError(f"unknown rule {when!r}")
        if seed and when != "before":
            raise ValueError("a seed is only defined for the before rule")
        self.when, self.limit, self.seed = when, int(limit), int(seed)

    def arrays(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        if self.when == "timer":
            clock = np.maximum.accumulate(weight)
            return clock, clock, 0
        upto = np.cumsum(weight)
        ahead = upto - weight
        test = upto if self.when == "before" else ahead
        return test, ahead - self.seed, int(upto[-1])

    def summarise(self, weight: np.ndarray, hard: np.ndarray, least: int):
        """Candidate first starts of a block, with the smallest state that selects each,
        the state on leaving the block, and how many groups start in it."""
        n = len(weight)
        test, origin, shift = self.arrays(weight)
        here = np.arange(n)
        jump = np.maximum(np.searchsorted(test, origin + self.limit), here + 1)
        hard_at = np.flatnonzero(hard)
        following = np.append(hard_at, n)[np.searchsorted(hard_at, here, side="right")]
        jump = np.append(np.minimum(jump, following), n)
        # pointer doubling: last start and number of starts after each row
        last = np.append(np.where(jump[:n] < n, jump[:n], here), n)
        count = np.append((jump[:n] < n).astype(np.int64), 0)
        while (jump[:n] < n).any():
            last = np.where(jump < n, last[np.minimum(jump, n)], last)
            count = count + count[jump]
            jump = jump[jump]
        end = int(hard_at[0]) if len(hard_at) else n - 1
        reach = np.append(test[:1] - 1, test[:-1])
        pick = (test > reach) & (reach + least < self.limit) & (here <= end)
        pick[0] = True
        if len(hard_at):
            pick[end] = True
        at = np.flatnonzero(pick)
        threshold = self.limit - test[at]
        if len(hard_at):
            threshold[at == end] = ALWAYS
        return at, threshold, shift - origin[last[at]], count[at] + 1, shift


class Folder:
    """Streaming fold over rows sorted by (lane, home, order), each home starting afresh."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.key = None
        self.group = -1
        self.state = 0

    def starts(self, lane, home, base, weight, hard) -> tuple[list[int], list[int]]:
        """Positions in this batch at which a group starts, and the group numbers."""
        n = len(lane)
        edges = np.flatnonzero((lane[1:] != lane[:-1]) | (home[1:] != home[:-1])) + 1
        edges = [0, *edges.tolist(), n]
        at: list[int] = []
        groups: list[int] = []
        limit = self.rule.limit
        for a, b in zip(edges[:-1], edges[1:]):
            test, origin, shift = self.rule.arrays(weight[a:b])
            hard_at = np.flatnonzero(hard[a:b])
            key = (int(lane[a]), int(home[a]))
            if key != self.key:
                self.key, self.group, j = key, int(base[a]) - 1, 0
            else:
                j = int(np.searchsorted(test, limit - self.state))
                if len(hard_at):
                    j = min(j, int(hard_at[0]))
            size, found = b - a, -1
            while j < size:
                found = j
                self.group += 1
                at.append(a + j)
                groups.append(self.group)
                nxt = max(int(np.searchsorted(test, origin[j] + limit)), j + 1)
                h = int(np.searchsorted(hard_at, j, side="right"))
                if h < len(hard_at):
                    nxt = min(nxt, int(hard_at[h]))
                j = nxt
            self.state = shift - int(origin[found]) if found >= 0 else self.state + shift
        return at, groups


def _long(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _flag(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool, copy=False)


def _cuts(keyed: DataFrame, rule: Rule) -> DataFrame:
    """One row per block: its first start, and the home of the rows before that."""

    def summarise(block: pa.Table) -> pa.Table:
        order = block.column("ord").to_numpy()
        by_order = np.argsort(order)
        order, weight = order[by_order], block.column("weight").to_numpy()[by_order]
        hard = (block.column("hard").to_numpy()[by_order] if "hard" in block.column_names
                else np.zeros(len(order), dtype=bool))
        least = block.column("least")[0].as_py() if "least" in block.column_names else rule.seed
        at, threshold, leaves, starts, shift = rule.summarise(weight, hard, least)
        return pa.table({
            "lane": block.column("lane")[:1], "block": block.column("block")[:1],
            "shift": [shift], "threshold": [threshold], "start": [order[at]],
            "leaves": [leaves], "starts": [starts]})

    def chain(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane = None
        state = home = base = following = 0
        for part in parts:
            out = []
            for s in part.itertuples(index=False):
                if s.lane != lane:
                    lane, home, base, following, i = s.lane, -1, -1, 0, 0
                else:
                    i = int(np.searchsorted(-np.asarray(s.threshold), -state))
                if i < len(s.start):
                    out.append((s.lane, s.block, s.start[i], following, home, base))
                    home, base = s.block, following
                    following += int(s.starts[i])
                    state = int(s.leaves[i])
                else:
                    out.append((s.lane, s.block, NO_START, -1, home, base))
                    state += int(s.shift)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CUTS.split(", ")])

    summaries = keyed.groupBy("lane", "block").applyInArrow(summarise, SUMMARY)
    return (
        summaries.repartition("lane").sortWithinPartitions("lane", "block")
        .mapInPandas(chain, CUTS)
    )


def homed(df: DataFrame, lane: str, order: str, weight: str, rule: Rule, hard: str | None = None,
          span: int | Ranked = SPAN) -> DataFrame:
    """``df`` with ``_lane, _ord, _weight, _hard, _home, _base``, clustered and sorted by
    (lane, home, order): each home is a run of whole groups."""
    def present(name):
        # rows without a place would be lost in the joins below
        missing = F.raise_error(F.lit(f"{name} must not be null")).cast("long")
        return F.coalesce(F.col(name).cast("long"), missing)

    prepared = blocked(df.select(
        "*",
        present(lane).alias("_lane"),
        present(order).alias("_ord"),
        F.col(weight).cast("long").alias("_weight"),
        (F.coalesce(F.col(hard), F.lit(False)) if hard else F.lit(False)).alias("_hard"),
    ), ["_lane"], "_ord", span)
    keyed = prepared.select(
        F.col("_lane").alias("lane"), F.col("_block").alias("block"),
        F.col("_ord").alias("ord"), F.col("_weight").alias("weight"),
        *([F.col("_hard").alias("hard")] if hard else []))
    if rule.when == "timer":
        keyed = _with_least_clock(keyed)
    cuts = stored(_cuts(keyed, rule), "cuts").select(
        F.col("lane").alias("_lane"), F.col("block").alias("_block"),
        "cut", "own_base", "prev_home", "prev_base")
    own = F.col("_ord") >= F.col("cut")
    return (
        prepared.join(cuts, ["_lane", "_block"])
        .withColumn("_home", F.when(own, F.col("_block")).otherwise(F.col("prev_home")))
        .withColumn("_base", F.when(own, F.col("own_base")).otherwise(F.col("prev_base")))
        .drop("_block", "cut", "own_base", "prev_home", "prev_base")
        .repartition("_lane", "_home")
        .sortWithinPartitions("_lane", "_home", "_ord")
    )


def _with_least_clock(keyed: DataFrame) -> DataFrame:
    """The timer's state is minus its last start, which is never later than the latest clock
    seen in earlier blocks; that bounds the candidates a summary has to keep."""
    earlier = Window.partitionBy("lane").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    latest = (
        keyed.groupBy("lane", "block").agg(F.max("weight").alias("_top"))
        .select("lane", "block", F.coalesce(-F.max("_top").over(earlier), F.lit(0))
                .alias("least"))
    )
    return keyed.join(latest, ["lane", "block"])


def sequential_groups(df: DataFrame, lane: str, order: str, weight: str, limit: int,
                      when: str = "before", seed: int = 0, hard: str | None = None,
                      out: str = "grp", start: str | None = None,
                      span: int | Ranked = SPAN) -> DataFrame:
    """Number the groups of the fold, per lane from 0, in a new column ``out``.

    ``order`` must be an integer, unique within its lane; ``weight`` must not be negative,
    and lanes not null. A true ``hard`` column forces a start at that row. ``start`` names a
    column that is true on the first row of each group. The input is read twice and must give
    the same rows each time; store it first if its source may change.
    """
    rule = Rule(when, limit, seed)
    rows = homed(df, lane, order, weight, rule, hard, span)
    names = df.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(rule)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            open_group = folder.group
            at, groups = folder.starts(*_inputs(batch))
            lengths = np.diff([0, *at, batch.num_rows])
            number = np.repeat(np.array([open_group, *groups], dtype=np.int64), lengths)
            added = [pa.array(number)]
            if start:
                first = np.zeros(batch.num_rows, dtype=bool)
                first[at] = True
                added.append(pa.array(first))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + added, [*names, out, *([start] if start else [])])

    schema = T.StructType([
        *df.schema.fields, T.StructField(out, T.LongType()),
        *([T.StructField(start, T.BooleanType())] if start else [])])
    return rows.mapInArrow(assign, schema)


def _inputs(batch: pa.RecordBatch):
    return (_long(batch, "_lane"), _long(batch, "_home"), _long(batch, "_base"),
            _long(batch, "_weight"), _flag(batch, "_hard"))


def assembled(df: DataFrame, lane: str, order: str, value: str, limit: int, seed: int = 0,
              weight_extra: int = 0, span: int | Ranked = SPAN) -> DataFrame:
    """Pack a string column into lists by the ``before`` rule: one row per group.

    The weight of a row is the UTF-8 length of ``value`` plus ``weight_extra``. Lists are cut
    out of the sorted Arrow buffers, so no row becomes a Python object and no second shuffle
    is needed to bring a group together.
    """
    rule = Rule("before", limit, seed)
    slim = df.select(
        F.col(lane).cast("long").alias("lane"), F.col(order).cast("long").alias("ord"),
        F.col(value).cast("string").alias("value"),
        (F.octet_length(value) + F.lit(weight_extra)).cast("long").alias("weight"))
    rows = homed(slim, "lane", "ord", "weight", rule, None, span).select(
        "_lane", "_ord", "_weight", "_hard", "_home", "_base", "value")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(rule)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # rows of the open group
        label: tuple[int, int] | None = None

        def closed(labels, cuts, values, order, weight) -> pa.RecordBatch:
            size = np.concatenate([[0], np.cumsum(weight)])
            cuts = np.asarray(cuts)
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in labels], pa.int64()),
                pa.array([x[1] for x in labels], pa.int64()),
                pa.array(order[cuts[:-1]]),
                pa.array(np.diff(cuts).astype(np.int64)),
                pa.array(size[cuts[1:]] - size[cuts[:-1]] - np.diff(cuts) * weight_extra),
                pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values),
            ], ["lane", "msg", "first_order", "n_rows", "n_bytes", "rows"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            inputs = _inputs(batch)
            at, groups = folder.starts(*inputs)
            value_col, order, weight = batch.column("value"), _long(batch, "_ord"), inputs[3]
            if not at:
                held.append((value_col, order, weight))
                continue
            done = at[-1]
            held.append((value_col.slice(0, done), order[:done], weight[:done]))
            before = sum(len(h[1]) for h in held) - done
            labels = [(int(inputs[0][i]), g) for i, g in zip(at, groups)]
            starts = [before + i for i in at]
            if label is not None:
                labels, starts = [label, *labels], [0, *starts]
            if len(starts) > 1:
                yield closed(labels[:-1], starts,
                             pa.concat_arrays([h[0] for h in held]),
                             np.concatenate([h[1] for h in held]),
                             np.concatenate([h[2] for h in held]))
            held = [(value_col.slice(done), order[done:], weight[done:])]
            label = labels[-1]
        if label is not None:
            order = np.concatenate([h[1] for h in held])
            yield closed([label], [0, len(order)], pa.concat_arrays([h[0] for h in held]),
                         order, np.concatenate([h[2] for h in held]))

    return rows.mapInArrow(
        assemble, "lane long, msg long, first_order long, n_rows long, n_bytes long,"
                  " rows array<string>")
