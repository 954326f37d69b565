"""Partition literals, partition clauses, range specifications and target names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Column names that must be quoted in a partition clause.
RESERVED_WORDS = ("date", "data", "no")
# Fixed value: prefix of keyed target names.
KEYED_PREFIX = "impala::"

ITEM = r"'[^']*'|[^,()'\s]+"


def partition_values(literal: Column) -> Column:
    """``(2021,'Tom','Andersen')`` to its values, quotes removed."""
    items = F.regexp_extract_all(literal, F.lit(f"({ITEM})"), 1)
    return F.transform(items, lambda x: F.regexp_replace(x, "^'|'$", ""))


def partition_literal(*values: Column, quoted: tuple[bool, ...]) -> Column:
    """Values to the literal that names their partition."""
    parts = [F.concat(F.lit("'"), v.cast("string"), F.lit("'")) if q else v.cast("string")
             for v, q in zip(values, quoted)]
    if len(parts) == 1:
        return parts[0]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def partition_clause(partition: dict[str, tuple[Column, bool]]) -> Column:
    """``partition(`date`=20240101,platform='jd')``: name to (value, is text)."""
    terms = []
    for name, (value, is_text) in partition.items():
        quote = "'" if is_text else ""
        shown = f"`{name}`" if name in RESERVED_WORDS else name
        terms.append(F.concat(F.lit(f"{shown}={quote}"), value.cast("string"), F.lit(quote)))
    return F.concat(F.lit("partition("), F.concat_ws(",", *terms), F.lit(")"))


def normalise_target(name: Column) -> Column:
    """Drop the keyed prefix, and nothing else, from a target name."""
    return F.regexp_replace(name, f"^{KEYED_PREFIX}", "")


def range_bounds(spec: Column) -> tuple[Column, Column]:
    """``a <= VALUES < b`` (either side may be missing, ``<`` and ``<=`` on both, or
    ``VALUE = a``) to half-open integer bounds; null where the text is no such range."""
    low = r"^\s*(-?\d+)\s*(<=?)\s*(?i:VALUES)"
    high = r"(?i:VALUES)\s*(<=?)\s*(-?\d+)\s*$"
    one = r"^\s*(?i:VALUE)\s*=\s*(-?\d+)\s*$"
    whole = (r"^\s*(-?\d+\s*<=?\s*)?(?i:VALUES)(\s*<=?\s*-?\d+)?\s*$")

    def number(pattern, group):
        return F.regexp_extract(spec, pattern, group).try_cast("bigint")

    single = number(one, 1)
    step_low = F.when(F.regexp_extract(spec, low, 2) == "<", 1).otherwise(0)
    step_high = F.when(F.regexp_extract(spec, high, 1) == "<=", 1).otherwise(0)
    valid = spec.rlike(whole)
    lower = F.when(single.isNotNull(), single).when(
        valid, F.coalesce(number(low, 1) + step_low, F.lit(-(2**63)).cast("bigint")))
    upper = F.when(single.isNotNull(), single + 1).when(
        valid, F.coalesce(number(high, 2) + step_high, F.lit(2**63 - 1).cast("bigint")))
    return lower, upper
