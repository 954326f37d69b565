"""Mixing sources to target weights.

A source's weight is its share of tokens raised to an exponent, the same for all, and normalised.
The exponent, between 0 and 1, is found by bisection: the smallest one whose weights keep an
entropy at or below a target, or for which no source repeats more often than a limit. The token
budget is the one that reads the source with the fewest repeats exactly once, so no document is
left out. Each source is then read in passes; every pass is its own permutation of the source's
documents, the last one is cut where the source's budget is met (by the document that crosses it),
and the passes of all sources are laid out in blocks that each hold every source in proportion to
its budget, up to the chance of the permutation.

Defined results: a null source is a source of its own; a text without words, or null, has no
tokens, is read once and fills no budget; a source without tokens is read once; repeated rows are
each read; no documents give no rows; extra columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableferry.session import stored

MAX_REPEATS = 1.5
BLOCK_TOKENS = 1 << 20
STEPS = 60
PLACE_BITS, DIGIT_BITS, LEVELS = 60, 8, 3


def token_count(text: str = "text") -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def bisected(fits) -> float:
    """The smallest exponent in [0, 1] for which ``fits`` holds; 1 if it never does."""
    if fits(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def entropy_exponent(sums: DataFrame, target: float, points: int = 32, rounds: int = 6) -> float:
    """The smallest exponent in [0, 1] whose weights have an entropy of at most ``target`` nats.

    Any number of sources: one aggregate evaluates many exponents at once, and each round keeps
    the interval that holds the answer.
    """
    most = sums.agg(F.max("tokens")).first()[0]
    if not most:
        return 1.0
    log_share = F.ln(F.col("tokens") / F.lit(float(most)))
    low, high = 0.0, 1.0
    for _ in range(rounds):
        grid = [low + (high - low) * i / points for i in range(points + 1)]
        row = sums.where("tokens > 0").agg(*[
            c for i, e in enumerate(grid) for c in (
                F.sum(F.exp(log_share * e)).alias(f"z{i}"),
                F.sum(F.exp(log_share * e) * log_share * e).alias(f"s{i}"))]).first()
        entropy = [math.log(row[f"z{i}"]) - row[f"s{i}"] / row[f"z{i}"] for i in range(len(grid))]
        hit = next((i for i, h in enumerate(entropy) if h <= target), None)
        if hit is None:
            return 1.0
        if hit == 0:
            return grid[0]
        low, high = grid[hit - 1], grid[hit]
    return high


def source_budgets(counted: DataFrame, max_repeats: float | None = MAX_REPEATS,
                   entropy: float | None = None) -> DataFrame:
    """``(source, all_tokens, budget, passes)`` from rows ``(source, tokens)``."""
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give a repetition limit or an entropy")
    sums = stored(counted.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    low, high = sums.where("tokens > 0").agg(F.min("tokens"), F.max("tokens")).first()
    if low is None:
        exponent, high = 1.0, 1
    elif entropy is not None:
        exponent = entropy_exponent(sums, entropy)
    else:
        # weight over share is largest for the smallest source and smallest for the largest one
        exponent = bisected(lambda e: (high / low) ** (1 - e) <= max_repeats)
    share = F.col("tokens").cast("double") / F.lit(float(high))
    budget = F.round(F.lit(float(high)) * F.pow(share, F.lit(exponent))).cast("long")
    budget = F.when(F.col("tokens") > 0, F.greatest("tokens", budget)).otherwise(F.lit(0))
    return stored(sums.select(
        "source", F.col("tokens").alias("all_tokens"), budget.cast("long").alias("budget"))
        .withColumn("passes", F.greatest(F.lit(1), F.ceil(
            F.col("budget") / F.greatest(F.col("all_tokens"), F.lit(1)))).cast("int")),
        "mix-budgets")


def place_in(pass_no: Column) -> Column:
    """A document's place in the permutation of a pass: 60 bits of a digest."""
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                               pass_no.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def cuts(counted: DataFrame, sums: DataFrame) -> DataFrame:
    """``(source, cut)``: the last place that a source's last pass reads.

    Found digit by digit from token sums of hash prefixes, 256 to a source and level, so no task
    orders the documents of a source.
    """
    last = counted.join(sums.where("passes > 1").withColumnRenamed("source", "_s"),
                        F.col("source").eqNullSafe(F.col("_s")))
    last = stored(last.select("source", "doc_id", "tokens",
                              place_in(F.col("passes")).alias("place")), "mix-last")
    cells = sums.where("passes > 1").select(
        F.col("source").alias("_s"), F.lit(0).cast("long").alias("prefix"),
        (F.col("budget") - (F.col("passes") - 1) * F.col("all_tokens")).alias("left"))

    def inside(level):
        return last.join(cells, F.col("source").eqNullSafe(F.col("_s"))
                         & (F.shiftright("place", PLACE_BITS - DIGIT_BITS * level)
                            == F.col("prefix")))

    ordered = Window.partitionBy("_s").orderBy("digit")
    for level in range(LEVELS):
        digit = F.shiftright("place", PLACE_BITS - DIGIT_BITS * (level + 1))
        running = (inside(level).groupBy("_s", "left", digit.alias("digit"))
                   .agg(F.sum("tokens").alias("n"))
                   .withColumn("upto", F.sum("n").over(ordered.rowsBetween(
                       Window.unboundedPreceding, 0))))
        cells = stored(running.where("upto >= left").groupBy("_s").agg(
            F.min_by(F.struct(F.col("digit"), (F.col("left") - F.col("upto") + F.col("n"))
                              .alias("left")), "digit").alias("c"))
            .select("_s", F.col("c.digit").alias("prefix"), F.col("c.left").alias("left")),
            "mix-cells")
    before = F.coalesce(F.sum("tokens").over(Window.partitionBy("_s").orderBy(
        "place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return stored(inside(LEVELS).withColumn("before", before).where("before < left")
                  .groupBy("_s").agg(F.max("place").alias("cut")), "mix-cuts")


def planned(docs: DataFrame, max_repeats: float | None = MAX_REPEATS,
            entropy: float | None = None) -> DataFrame:
    """``docs`` once for each pass that reads them, with ``tokens, pass, place, block``.

    What is decided per source is one row per source, so the documents themselves are not
    shuffled. Documents whose places are equal, such as repeated rows, are cut together.
    """
    own = [c for c in docs.columns if c.lower() not in ("tokens", "pass", "place", "block")]
    docs = docs.select(own).withColumn("tokens", token_count())
    counted = stored(docs.select("doc_id", "source", "tokens"), "mix-rows")
    sums = source_budgets(counted, max_repeats, entropy)
    limits = sums.join(cuts(counted, sums), F.col("source").eqNullSafe(F.col("_s")),
                       "left").select(F.col("source").alias("_source"), "all_tokens",
                                      "budget", "passes", "cut")
    blocks = max(1, -(-(sums.agg(F.sum("budget")).first()[0] or 0) // BLOCK_TOKENS))
    read = docs.join(limits, F.col("source").eqNullSafe(F.col("_source")))
    read = (read.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
            .withColumn("place", place_in(F.col("pass")))
            .where("pass = 1 or pass < passes or place <= cut"))
    gone = (F.col("pass") - 1 + F.col("place") / F.lit(float(1 << PLACE_BITS)))
    part = gone * F.col("all_tokens") / F.greatest(F.col("budget"), F.lit(1))
    block = F.least(F.floor(part * blocks), F.lit(blocks - 1)).cast("long")
    return read.select(*own, "tokens", "pass", "place", block.alias("block"))


def mixed_documents(docs: DataFrame, max_repeats: float | None = MAX_REPEATS,
                    entropy: float | None = None) -> DataFrame:
    """``docs`` as often as the plan reads them, laid out block by block; a block is shuffled."""
    shuffled = F.xxhash64("place", "pass")
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    return (planned(rows, max_repeats, entropy).select("row", "block", shuffled.alias("at"))
            .repartitionByRange("block", "at").sortWithinPartitions("block", "at")
            .select("row.*"))
