"""The sending and receiving sides put together, in batch form."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableferry.functions.codec import FIELDS, encode_rows, encoded, parsed
from tableferry.functions.headers import APPEND_TYPE, KEYED_TYPE, enriched
from tableferry.operators import chunks as ch
from tableferry.operators.clear import KEYS, last_clears, run_starts, surviving
from tableferry.operators.fold import sequential_groups
from tableferry.operators.pack import MESSAGE_BYTES, oversize, pack_messages, to_topic
from tableferry.operators.ranges import (add_ranges, assign_ranges, overlapping,
                                         requested_ranges, unread_ranges)
from tableferry.operators.route import (BAD_MSG, DIRTY, audit, good_rows, triaged,
                                        triaged_records, typed, with_header)
from tableferry.operators.upsert import cell_values, cells, merged_cells, upsert

HEADERS = ("db_type", "target_table", "clear_table", "partition", "batch_id", "range_partition")


def send(rows: DataFrame, lane: Column, order: Column, header: Column, topic: str,
         publish_time: Column, n_lanes: int, limit: int = MESSAGE_BYTES, task_id: str = "",
         source_table: str = "", span: int = 1_000_000, strict: bool = True) -> DataFrame:
    """Rows to messages: encode, pack, add the header.

    A row larger than ``limit`` stops the job; with ``strict=False`` it is left out, and
    :func:`rejected` gives it for the audit. ``lane`` spreads rows over ``n_lanes`` ordered
    streams; ``order`` is an integer unique in its lane. ``rows`` is read twice and must give the
    same rows each time.
    """
    enc = rows.select(lane.cast("long").alias("lane"), order.cast("long").alias("ord"),
                      encoded(rows.schema).alias("enc"))
    packed = pack_messages(enc, limit=limit, strict=strict, span=span)
    full = enriched(header, task_id, source_table, F.col("n_rows"))
    return to_topic(packed, topic, full, publish_time, n_lanes)


def rejected(rows: DataFrame, topic: str, target_table: str = "",
             limit: int = MESSAGE_BYTES) -> DataFrame:
    """Audit entries of the rows that :func:`send` leaves out for their size."""
    large = oversize(encode_rows(rows), limit).withColumn(
        "topic", F.lit(topic)).withColumn("target_table", F.lit(target_table))
    return audit(BAD_MSG, large, F.lit("oversize"), F.col("enc"))


def unreadable(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Audit entries of the messages of a bounded set that cannot be decoded."""
    bad = messages.where(parsed(F.col("data"), schema.names).isNull())
    return audit(BAD_MSG, bad, F.lit("undecodable"), F.col("data"))


def left_out(checked: DataFrame, schema: T.StructType, registry: DataFrame | None = None,
             range_key: str | None = None, route: str = KEYED_TYPE) -> DataFrame:
    """Audit entries of decoded rows that are not applied: those with a field that does not fit,
    and those outside every range of their target; and of range requests that are none, and of ranges
    that overlap one in front of them."""
    mine = checked.where(F.col("route") == route)
    rows = typed(good_rows(mine, schema.names, ["target", "msg_id"]), schema).withColumn(
        "target_table", F.col("target"))
    payload = F.to_json(F.struct(*schema.names))
    out = audit(DIRTY, rows.where("dirty_fields is not null"), F.col("dirty_fields"), payload)
    if range_key:
        ranges = add_ranges(registry, requested_ranges(mine))
        placed = assign_ranges(rows.where("dirty_fields is null"), range_key, ranges, "target")
        out = out.unionByName(audit(DIRTY, placed.where("lower is null"), F.lit("no_range"),
                                    payload))
        out = out.unionByName(audit(BAD_MSG, unread_ranges(mine), F.lit("bad_range"),
                                    F.col("asked")))
        out = out.unionByName(audit(BAD_MSG, overlapping(ranges), F.lit("overlapping_range"),
                                    F.concat_ws("<=VALUES<", "lower", "upper")))
    return out


def receive(topic: DataFrame, schema: T.StructType,
            known: DataFrame | Sequence[str] | None = None, partial: bool = False) -> DataFrame:
    """Messages with header columns, checked and decoded but not yet split. ``partial`` is for
    keyed targets whose records may carry only some columns."""
    return triaged(with_header(topic, *HEADERS), schema.names, known, partial=partial)


def receive_many(topic: DataFrame, known: DataFrame | Sequence[str]) -> DataFrame:
    """As :func:`receive` for a topic that many tables share: every message is parsed once, and
    :func:`tableferry.operators.route.for_target` gives the records of one target its columns."""
    return triaged_records(with_header(topic, *HEADERS), known)


def with_aliases(messages: DataFrame, aliases: dict[str, str] | None) -> DataFrame:
    """``clear_table`` by the name of its target, where headers name the table behind it."""
    for physical, logical in (aliases or {}).items():
        messages = messages.withColumn("clear_table", F.when(
            F.col("clear_table") == physical, logical).otherwise(F.col("clear_table")))
    return messages


def apply_append(checked: DataFrame, schema: T.StructType, existing: DataFrame | None = None,
                 aliases: dict[str, str] | None = None,
                 partition: str | Sequence[str] | None = None,
                 span: int = 1_000_000) -> DataFrame:
    """Final rows of append targets: ``target`` and the columns of ``schema``.

    ``existing`` holds rows stored before, with a ``target`` column. ``aliases`` maps names
    used in ``clear_table`` to the target they belong to, where the two differ.
    """
    mine = checked.where(F.col("route") == APPEND_TYPE)
    last = last_clears(run_starts(with_aliases(mine, aliases), KEYS, span=span))
    rows = typed(good_rows(mine, schema.names, ["target", "msg_id"]), schema)
    rows = rows.where("dirty_fields is null").select("target", "msg_id", *schema.names)
    if existing is not None:
        rows = rows.unionByName(existing.select(
            "target", F.lit(None).cast("long").alias("msg_id"), *schema.names))
    return surviving(rows, last, "target", partition).select("target", *schema.names)


def apply_keyed(checked: DataFrame, schema: T.StructType, keys: Sequence[str],
                existing: DataFrame, registry: DataFrame | None = None,
                range_key: str | None = None, partial: bool = False) -> DataFrame:
    """Final rows of keyed targets. With ``partial``, as in :func:`receive`, a column that a record
    does not carry keeps its value, and is null for a new key. Rows outside every range of their target, or with a field
    that does not fit, are left out; :func:`left_out` audits them."""
    mine = checked.where(F.col("route") == KEYED_TYPE)
    fields = [*schema.names, FIELDS] if partial else schema.names
    rows = typed(good_rows(mine, fields, ["target", "msg_id"]), schema)
    rows = rows.where("dirty_fields is null").drop("dirty_fields")
    if range_key:
        ranges = add_ranges(registry, requested_ranges(mine))
        rows = assign_ranges(rows, range_key, ranges, "target").where("lower is not null")
    names = ["target", *schema.names]
    ids = ["target", *keys]
    stored_rows = existing.select(
        *names, F.lit(-1).cast("long").alias("msg_id"), F.lit(-1).alias("row_pos"))
    if partial:
        order, rest = ["msg_id", "row_pos"], [c for c in schema.names if c not in keys]
        all_rows = stored_rows.withColumn(FIELDS, F.lit(None).cast("array<string>")).unionByName(
            rows.select(*names, *order, FIELDS))
        merged = merged_cells(cells(all_rows, ids, rest, order, FIELDS), ids, order)
        return cell_values(merged, ids).select(*names)
    incoming = rows.select(*names, "msg_id", "row_pos")
    return upsert(stored_rows, incoming, ids, ["msg_id", "row_pos"]).select(*names)


def send_files(parts: DataFrame, table: str, partition: Column,
               is_overwrite: bool = True, transfer: str | None = None) -> DataFrame:
    """File parts to chunk messages, numbered in the order they are written. All parts of a send
    share its ``transfer`` id, by default a new one."""
    name = uuid.uuid4().hex if transfer is None else transfer
    return parts.select(
        F.monotonically_increasing_id().alias("msg_id"), "sync_id", "file", "total_parts",
        "cur_part", "md5_checksum", F.lit(is_overwrite).alias("is_overwrite"),
        F.lit(table).alias("table"), partition.alias("partition"),
        F.lit(name).alias("transfer"), "data")


#: What a segment keeps of the headers of its chunks.
LOADED = ("file", "table", "partition", "is_overwrite")


def load_files(chunks: DataFrame, part_bytes: int = ch.PART_BYTES,
               verified: bool = False, segment_bytes: int = ch.SEGMENT_BYTES) -> DataFrame:
    """Finished files of a chunk topic as segments with their target table and partition;
    :func:`tableferry.sources.landed.load_rows` loads their rows."""
    return ch.segments(ch.complete_parts(chunks, verified=verified), part_bytes, segment_bytes,
                       keep=LOADED)


def bounded_load(messages: DataFrame, schema: T.StructType, batch_rows: int,
                 lane: str = "lane", order: str = "msg_id", span: int = 1_000_000) -> DataFrame:
    """Records of a bounded set of messages with the number of the insert they belong to.
    Messages that cannot be read give none; :func:`unreadable` audits them."""
    rows = parsed(F.col("data"), schema.names)
    # not filtered: a filter would move below the parse and take a second one along
    sized = messages.withColumn("rows", rows).withColumn(
        "_n", F.coalesce(F.size("rows"), F.lit(0)).cast("long"))
    grouped = sequential_groups(sized, lane, order, "_n", batch_rows, "before", out="insert_no",
                                span=span)
    records = grouped.select(lane, order, "insert_no", F.posexplode("rows").alias("row_pos", "r"))
    texts = records.select(lane, order, "insert_no", "row_pos", "r.*")
    return typed(texts, schema)
