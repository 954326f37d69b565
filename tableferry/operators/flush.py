"""When buffered messages are written out: by rows, by time, on idle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tableferry.operators.blocks import SPAN, Ranked, with_previous
from tableferry.operators.fold import sequential_groups
from tableferry.session import stored

# Rows per insert of append and keyed targets and of the bounded job; seconds.
APPEND_ROWS = 50_000
KEYED_ROWS = 10_000
BOUNDED_ROWS = 100_000
INTERVAL_SECONDS = 60
IDLE_SECONDS = 15


def flush_by_rows(messages: DataFrame, n_rows: str, limit: int = APPEND_ROWS,
                  lane: str = "lane", order: str = "msg_id", when: str = "after",
                  span: int | Ranked = SPAN) -> DataFrame:
    """The flush each message falls into, as (lane, order, rows, grp). ``after``: a message
    that brings the buffer to the limit is flushed with it; ``before``: it starts the next."""
    slim = messages.select(lane, order, n_rows)
    return sequential_groups(slim, lane, order, n_rows, limit, when, span=span)


def flush_by_time(messages: DataFrame, n_rows: str, time: str, limit: int = APPEND_ROWS,
                  interval: float = INTERVAL_SECONDS, idle: float = IDLE_SECONDS,
                  lane: str = "lane", order: str = "msg_id", span: int | Ranked = SPAN) -> DataFrame:
    """Flush by rows, by elapsed time and on idle, replayed on publish times.

    Per lane in order: a gap of ``idle`` in front of a message closes the buffer; the message
    is added, and closes it at ``limit`` rows; it also closes it when ``interval`` has passed
    since the timer was set, which then is set to this message. Neither of the other two
    resets the timer, so it is a fold of its own; its firings, and the gaps, are forced starts
    for the fold over rows. Only order, rows and clock take part, and each step is stored,
    since the next one reads it twice.
    """
    slim = messages.select(
        lane, order, n_rows, F.unix_micros(F.col(time).cast("timestamp")).alias("_clock"))
    timed = sequential_groups(slim, lane, order, "_clock", round(interval * 1_000_000),
                              "timer", out="_timer", start="_start", span=span)
    timed = stored(timed.select(
        lane, order, n_rows, "_clock",
        (F.col("_start") & (F.col("_timer") > 0)).alias("_fired")), "timer")
    seen = with_previous(timed, [lane], order, ["_clock", "_fired"], span)
    gap = F.col("_clock") - F.col("prev__clock") >= round(idle * 1_000_000)
    forced = stored(seen.select(
        lane, order, n_rows,
        F.coalesce(F.col("prev__fired") | gap, F.lit(False)).alias("_forced")), "forced")
    return sequential_groups(forced, lane, order, n_rows, limit, "after", hard="_forced",
                             span=span).select(lane, order, n_rows, "grp")


def flush_summary(flushed: DataFrame, n_rows: str, lane: str = "lane",
                  order: str = "msg_id") -> DataFrame:
    return flushed.groupBy(lane, "grp").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(n_rows).cast("long").alias("n_rows"),
        F.min(order).alias("first_msg"), F.max(order).alias("last_msg"))
