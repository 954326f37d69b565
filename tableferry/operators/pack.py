"""Encoded rows to size-bounded messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableferry.functions.codec import json_array
from tableferry.functions.headers import with_entries
from tableferry.operators.blocks import SPAN, Ranked
from tableferry.operators.fold import assembled

# Message limits in bytes of the current and the earlier producer.
MESSAGE_BYTES = 64 * 1024
EARLIER_MESSAGE_BYTES = 4 * 1024 * 1024
END_SIGN = "END_SIGN"


def oversize(encoded: DataFrame, limit: int = MESSAGE_BYTES, enc: str = "enc") -> DataFrame:
    """Rows that fit in no message, with their size."""
    return (encoded.withColumn("row_bytes", F.octet_length(enc).cast("long"))
            .where(F.col("row_bytes") > limit))


def sendable(encoded: DataFrame, limit: int = MESSAGE_BYTES, enc: str = "enc",
             strict: bool = False) -> DataFrame:
    """Rows that fit; with ``strict`` a larger one fails the job instead. A null row always
    does: it is no row, and dropping it would lose one."""
    encoded = encoded.withColumn(enc, F.when(F.col(enc).isNull(), F.raise_error(
        F.lit("an encoded row is null"))).otherwise(F.col(enc)))
    size = F.octet_length(enc)
    if strict:
        checked = F.when(size > limit, F.raise_error(F.concat(
            F.lit(f"row exceeds {limit} bytes: "), size.cast("string")))
        ).otherwise(F.col(enc))
        return encoded.withColumn(enc, checked)
    return encoded.where(size <= limit)


def pack_messages(encoded: DataFrame, lane: str = "lane", order: str = "ord",
                  enc: str = "enc", limit: int = MESSAGE_BYTES, strict: bool = False,
                  span: int | Ranked = SPAN) -> DataFrame:
    """Greedy packing per lane; a message is closed before a row would bring it to ``limit``."""
    rows = sendable(encoded, limit, enc, strict)
    return assembled(rows, lane, order, enc, limit, span=span)


def pack_json_array(encoded: DataFrame, lane: str = "lane", order: str = "ord",
                    enc: str = "enc", limit: int = EARLIER_MESSAGE_BYTES,
                    span: int | Ranked = SPAN, strict: bool = False) -> DataFrame:
    """Packing whose limit counts the brackets and commas of the JSON text as well."""
    packed = assembled(sendable(encoded, limit, enc, strict), lane, order, enc, limit, seed=1,
                       weight_extra=1, span=span)
    return packed.withColumn("data", json_array(F.col("rows")))


def to_topic(messages: DataFrame, topic, header: Column, publish_time: Column,
             n_lanes: int) -> DataFrame:
    """Packed messages as topic rows.

    The message number of a lane is spread to ``msg * n_lanes + lane``, which is unique over
    lanes and keeps the order inside each.
    """
    return messages.select(
        "lane",
        (F.col("msg") * n_lanes + F.col("lane")).alias("msg_id"),
        (topic if isinstance(topic, Column) else F.lit(topic)).alias("topic"),
        publish_time.cast("timestamp").alias("publish_time"),
        with_entries(header, {"rows": F.col("n_rows")}).alias("properties"),
        json_array(F.col("rows")).alias("data"),
    )


def send_stats(messages: DataFrame) -> DataFrame:
    """Rows, bytes and messages sent per lane."""
    return messages.groupBy("lane").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"), F.max("n_bytes").alias("largest"))


def text_messages(texts: DataFrame, lane: str, order: str, text: str,
                  with_end: bool = True) -> DataFrame:
    """Texts as byte payloads, with one end mark behind the last of each lane."""
    base = texts.select(F.col(lane).cast("long").alias("lane"),
                        F.col(order).cast("long").alias("msg_id"), F.col(text).alias("text"))
    sent = base
    if with_end:
        ends = base.groupBy("lane").agg((F.max("msg_id") + 1).alias("msg_id")).select(
            "lane", "msg_id", F.lit(END_SIGN).alias("text"))
        sent = base.unionByName(ends)
    return sent.select("lane", "msg_id", F.encode("text", "UTF-8").alias("data"))
