"""Header checks, routing, quarantine and the audit table.

All checks of a message are one chain of expressions over one pass; nothing is read twice to
split good from bad.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableferry.functions.codec import (from_wire, named_fields, parsed, with_fields,
                                        with_records)
from tableferry.functions.headers import APPEND_TYPE, KEYED_TYPE
from tableferry.functions.literals import normalise_target

NORMAL, WAL, BAD_MSG, DIRTY = "normal", "wal", "bad_msg", "dirty"
SINKS = (APPEND_TYPE, KEYED_TYPE)


def route_of(db_type: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(db_type, F.lit("")), F.lit("default")))


def header(name: str) -> Column:
    return F.coalesce(F.col("properties")[name], F.lit(""))


def with_header(topic: DataFrame, *names: str) -> DataFrame:
    """Header entries as columns."""
    return topic.select("*", *[header(n).alias(n) for n in names])


def triaged(messages: DataFrame, fields: Sequence[str],
            known: DataFrame | Sequence[str] | None = None,
            sinks: Sequence[str] = SINKS, partial: bool = False) -> DataFrame:
    """Messages with ``route``, ``target``, ``rows`` (decoded, null if unreadable) and
    ``reason`` (null if good).

    Expects columns ``db_type``, ``target_table`` and ``data``. ``known`` names the keyed
    targets that exist: a list, or for a large catalog a table with a column ``target``, which
    should be read from files so that its size decides how it is joined. Target names are few
    and uneven, so messages are not to be shuffled by them. With ``partial``, each record says
    which columns it carries.
    """
    def decoded(checked: DataFrame) -> DataFrame:
        return checked.withColumn("rows", parsed(F.col("data"), fields))

    out = _judged(messages, known, sinks, (KEYED_TYPE,), decoded)
    return out.withColumn("rows", with_fields(F.col("rows"), F.col("data"))) if partial else out


def triaged_records(messages: DataFrame, known: DataFrame | Sequence[str],
                    sinks: Sequence[str] = SINKS) -> DataFrame:
    """As :func:`triaged` for a topic of many tables: ``rows`` holds the records whatever their
    columns are, and a target that is not ``known`` is an unknown one on every route."""
    return _judged(messages, known, sinks, tuple(sinks), with_records)


def for_target(checked: DataFrame, target: str, fields: Sequence[str],
               partial: bool = False) -> DataFrame:
    """The messages of :func:`triaged_records` for one target, with records in its columns."""
    return checked.where(F.col("target") == target).withColumn(
        "rows", named_fields(F.col("rows"), fields, partial))


def _judged(messages: DataFrame, known: DataFrame | Sequence[str] | None, sinks: Sequence[str],
            listed: Sequence[str], decoded: Callable[[DataFrame], DataFrame]) -> DataFrame:
    checked = messages.select(
        "*", route_of(F.col("db_type")).alias("route"),
        F.nullif(normalise_target(F.col("target_table")), F.lit("")).alias("target"))
    if known is None:
        checked = checked.withColumn("_known", F.lit(True))
    elif not isinstance(known, DataFrame):
        checked = checked.withColumn("_known", F.when(F.col("target").isin(list(known)), True))
    else:
        marks = known.select("target").distinct().withColumn("_known", F.lit(True))
        checked = checked.join(marks, "target", "left").select(*checked.columns, "_known")
    reason = (
        F.when(F.col("route") == "default", "no_db_type")
        .when(~F.col("route").isin(list(sinks)), "unroutable")
        .when(F.col("target").isNull(), "missing_target")
        .when(F.col("route").isin(list(listed)) & F.col("_known").isNull(), "unknown_target")
        .when(F.col("rows").isNull(), "undecodable")
    )
    return decoded(checked).withColumn("reason", reason).drop("_known")


def bad_messages(triaged_messages: DataFrame) -> DataFrame:
    return triaged_messages.where("reason is not null")


def good_rows(triaged_messages: DataFrame, fields: Sequence[str],
              keep: Sequence[str]) -> DataFrame:
    """Decoded records of the good messages, fields as text.

    The messages are not filtered by ``reason``: such a filter moves below the decoding and takes
    a second copy of it along.
    """
    good = F.when(F.col("reason").isNull(), F.col("rows"))
    return (
        triaged_messages.select(*keep, F.posexplode_outer(good).alias("row_pos", "_row"))
        .where("row_pos is not null")
        .select(*keep, "row_pos", *[F.col(f"_row.`{n}`").alias(n) for n in fields])
    )


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Align text fields to ``schema`` by name; ``dirty_fields`` lists those that do not fit.

    A field the rows lack becomes null, as does one whose text does not cast.
    """
    present = set(rows.columns)
    names = [f.name for f in schema.fields]
    keep = [c for c in rows.columns if c not in names]
    values, failures = [], []
    for f in schema.fields:
        if f.name not in present:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"`{f.name}`")
        value = from_wire(text, f.dataType)
        values.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            failures.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    failed = F.concat_ws(",", *failures) if failures else F.lit("")
    return rows.select(*keep, *values, F.nullif(failed, F.lit("")).alias("dirty_fields"))


def audit(channel: str, df: DataFrame, reason: Column, payload: Column) -> DataFrame:
    """Rows of the audit table."""
    def col(name, dtype):
        return (F.col(name) if name in df.columns else F.lit(None)).cast(dtype).alias(name)
    return df.select(F.lit(channel).alias("channel"), reason.alias("reason"),
                     col("topic", "string"), col("msg_id", "long"),
                     col("target_table", "string"), payload.cast("string").alias("payload"))


def audit_counts(triaged_messages: DataFrame, fields: Sequence[str],
                 schema: T.StructType) -> DataFrame:
    """Entries per channel and reason, from one pass over the messages.

    A bad message is one entry. Each decoded record is a ``wal`` entry, and then either a
    ``dirty`` or a ``normal`` one.
    """
    bad = F.when(F.col("reason").isNotNull(), F.array(F.struct(
        F.lit(BAD_MSG).alias("channel"), F.col("reason").alias("reason"),
        F.lit(1).cast("long").alias("n"))))
    types = {f.name: f.dataType for f in schema.fields}

    def is_dirty(row):
        checks = [row[n].isNotNull() & from_wire(row[n], types[n]).isNull()
                  for n in fields if n in types and not isinstance(types[n], T.StringType)]
        out = F.lit(False)
        for c in checks:
            out = out | c
        return out

    total = F.size("rows").cast("long")
    dirty = F.size(F.filter("rows", is_dirty)).cast("long")

    def entry(channel, reason, n):
        return F.struct(F.lit(channel).alias("channel"), F.lit(reason).alias("reason"),
                        n.alias("n"))

    good = F.array(entry(WAL, "decoded", total), entry(DIRTY, "type_mismatch", dirty),
                   entry(NORMAL, "written", total - dirty))
    return (
        triaged_messages.select(F.explode(F.coalesce(bad, good)).alias("e"))
        .select("e.*").where("n > 0")
        .groupBy("channel", "reason").agg(F.sum("n").alias("entries"))
    )
