"""Topics: named logs of messages, stored as append-only tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import (Column, DataFrame, Observation, SparkSession, functions as F,
                         types as T)

from tableferry.operators.pack import END_SIGN
from tableferry.schemas import TOPIC
from tableferry.session import stored


def next_id(spark: SparkSession, path: str) -> int:
    """The id above all messages of a topic, 0 for a new one. Only the id column is read."""
    try:
        last = read_topic(spark, path).agg(F.max("msg_id")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    return 0 if last is None else last + 1


def publish(messages: DataFrame, path: str, own_ids: bool = False,
            schema: T.StructType = TOPIC) -> None:
    """Append messages to a topic, behind all that it holds: the ids of a send, which begin at 0,
    are moved above the topic's highest. One sender at a time publishes to a topic.

    ``own_ids`` keeps ids that a log has given already and that go on from its earlier ones.
    ``schema`` is ``CHUNK`` for a topic of file chunks.
    """
    first = 0 if own_ids else next_id(messages.sparkSession, path)
    (messages.withColumn("msg_id", F.col("msg_id") + F.lit(first).cast("long"))
     .select(*schema.names).write.mode("append").parquet(path))


def publish_counted(messages: DataFrame, path: str, rows: str = "rows", **options) -> dict[str, int]:
    """As :func:`publish`, with what was sent: ``messages``, ``rows`` by their headers, and
    ``bytes`` of payload. The numbers are observed by the job that writes; nothing runs twice."""
    seen = Observation("published")
    publish(messages.observe(
        seen, F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.col("properties")[rows].try_cast("bigint")), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("bytes")), path, **options)
    return seen.get


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


def stream_topic(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                 bytes_per_trigger: str | None = None) -> DataFrame:
    """The topic as a stream; what a subscription has read is kept in its checkpoint."""
    reader = spark.readStream.schema(TOPIC)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


@dataclass(frozen=True)
class Subscription:
    url: str
    topic: str
    name: str


def subscriptions(urls: str, topics: str, names: str) -> list[Subscription]:
    """``;``-separated lists to subscriptions; all three must be of the same length."""
    lists = [[x.strip() for x in text.strip("; ").split(";")] for text in (urls, topics, names)]
    if any(not all(x) for x in lists):
        raise ValueError("url, topic and subscription must not be empty")
    if len({len(x) for x in lists}) != 1:
        raise ValueError("there must be as many urls as topics and subscriptions")
    return [Subscription(*x) for x in zip(*lists)]


def fan_in(sources: dict[str, DataFrame]) -> DataFrame:
    """Several topics as one, each with a lane number of its own in ``source_lane``."""
    out = None
    for i, (name, df) in enumerate(sources.items()):
        one = df.withColumn("topic", F.lit(name)).withColumn("source_lane", F.lit(i))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no topics")
    return out


def until_end(messages: DataFrame, lane: str = "lane", order: str = "msg_id",
              data: str | Column = "data") -> DataFrame:
    """Messages in front of the first end mark of their lane, all of them if it has none.

    The first end per lane is found by an aggregate and is one row per lane, stored so that
    its size is known to the join.
    """
    payload = F.col(data) if isinstance(data, str) else data
    ends = messages.where(payload == END_SIGN).groupBy(lane).agg(F.min(order).alias("_end"))
    return (
        messages.join(stored(ends, "ends"), lane, "left")
        .where(F.col("_end").isNull() | (F.col(order) < F.col("_end")))
        .select(*messages.columns)
    )
