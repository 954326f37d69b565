"""Routing headers: flat maps of strings, unset values as empty strings."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

# Header names of the two message kinds and their routing names.
APPEND_FIELDS = ("target_table", "batch_id", "source_table", "clear_table", "partition",
                 "cluster_name", "source_platform", "target_platform", "task_id")
KEYED_FIELDS = ("target_table", "source_table", "write_mode", "batch_id", "task_id",
                "source_platform", "target_platform", "range_partition")
APPEND_TYPE = "clickhouse"
KEYED_TYPE = "kudu"


def text_or_empty(value) -> Column:
    """A header value as text: columns as they are, null as ''; a false literal as ''."""
    if isinstance(value, Column):
        return F.coalesce(value.cast("string"), F.lit(""))
    return F.lit(str(value) if value else "")


def header_map(values: dict) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in values]),
                             F.array(*[text_or_empty(v) for v in values.values()]))


def _header(fields, db_type, given, extra) -> Column:
    values = {name: given.get(name) for name in fields}
    values["db_type"] = db_type
    values.update(extra)
    if not isinstance(values["batch_id"], Column) and not values["batch_id"]:
        # one id per header, so that all messages of a run are one batch
        values["batch_id"] = str(uuid.uuid4())
    return header_map(values)


def append_header(target_table, batch_id=None, source_table=None, clear_table=None,
                  partition=None, cluster_name=None, source_platform=None,
                  target_platform=None, task_id=None, **extra) -> Column:
    """Header for an append target. With ``clear_table`` the receiver clears it once per
    batch: the ``partition`` if given, else all of it."""
    given = dict(target_table=target_table, batch_id=batch_id, source_table=source_table,
                 clear_table=clear_table, partition=partition, cluster_name=cluster_name,
                 source_platform=source_platform, target_platform=target_platform,
                 task_id=task_id)
    return _header(APPEND_FIELDS, APPEND_TYPE, given, extra)


def keyed_header(target_table, source_table=None, write_mode="upsert", batch_id=None,
                 task_id=None, source_platform=None, target_platform=None,
                 range_partition=None, **extra) -> Column:
    """Header for a keyed target; further options become entries of their own."""
    given = dict(target_table=target_table, source_table=source_table, write_mode=write_mode,
                 batch_id=batch_id, task_id=task_id, source_platform=source_platform,
                 target_platform=target_platform, range_partition=range_partition)
    return _header(KEYED_FIELDS, KEYED_TYPE, given, extra)


def with_entries(header: Column, entries: dict) -> Column:
    """Set entries of a header, replacing those of the same name."""
    names = list(entries)
    kept = F.map_filter(header, lambda k, v: ~k.isin(names))
    return F.map_concat(kept, header_map(entries))


def enriched(header: Column, task_id, source_table, rows) -> Column:
    """Default ``task_id`` and ``source_table`` where empty, and set the row count."""
    def default(name, value):
        return F.coalesce(F.nullif(header[name], F.lit("")), text_or_empty(value))
    return with_entries(header, {
        "task_id": default("task_id", task_id),
        "source_table": default("source_table", source_table),
        "rows": rows,
    })
