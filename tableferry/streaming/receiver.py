"""The receiving side as a Structured Streaming job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tableferry.operators.pack import END_SIGN
from tableferry.plans.sync import receive, receive_many
from tableferry.session import stored
from tableferry.sources.topics import Subscription, stream_topic
from tableferry.streaming.sinks import AuditSink, CatalogSink, EpochLog, Sink

ENDS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("lane", T.LongType()),
                     T.StructField("end", T.LongType())])
# Fixed value: seconds between flushes.
FLUSH_SECONDS = 60
# Fixed value: bytes of payload that a task decodes.
TASK_BYTES = 32 * 1024 * 1024


class EndMarks:
    """Where the lanes of a subscription have ended: the first end mark of each lane.

    The state is one row for each lane that has ended, kept by epoch as the sinks keep theirs, so
    that a retried micro-batch finds what it has written itself. A micro-batch drops the marks and
    what is behind them before anything is decoded. Ids of a lane that come in later micro-batches
    are expected to be larger; whatever comes late from in front of a mark is still loaded.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.log = EpochLog(spark, f"{checkpoint}-ends")

    def cut(self, batch: DataFrame, epoch_id: int, cursor: str) -> DataFrame:
        found = stored(batch.where(F.col("data") == END_SIGN).groupBy("topic", "lane").agg(
            F.min("msg_id").alias("end")), "ends")
        if not found.isEmpty():
            self.log.put("ends", found, epoch_id, cursor)
        ends = stored(self._ends({cursor: epoch_id}), "ends")
        return (batch.join(ends.select(F.col("topic").alias("_topic"), F.col("lane").alias("_lane"), "end"),
                           F.col("topic").eqNullSafe(F.col("_topic"))
                           & F.col("lane").eqNullSafe(F.col("_lane")), "left")
                .where(F.col("end").isNull() | (F.col("msg_id") < F.col("end")))
                .select(*batch.columns))

    def _ends(self, upto: dict[str, int]) -> DataFrame:
        return self.log.get("ends", ENDS, upto).groupBy("topic", "lane").agg(
            F.min("end").alias("end"))

    def ended(self, query: StreamingQuery) -> int:
        """How many lanes have ended."""
        last = query.lastProgress
        return 0 if last is None else self._ends({str(query.id): last["batchId"]}).count()


def await_end(query: StreamingQuery, checkpoint: str, lanes: int, poll: float = 1.0) -> None:
    """Let a query run until ``lanes`` lanes have ended, then stop it."""
    marks = EndMarks(SparkSession.active(), checkpoint)
    while query.isActive and marks.ended(query) < lanes:
        query.awaitTermination(poll)
    query.stop()


def spread(batch: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """Messages dealt evenly over tasks of about ``task_bytes`` of payload each. Decoded records,
    which are kept for all sinks, take a multiple of their text, and the text a multiple of the
    bytes of the file split it comes from. A batch that fits in one task stays as it is."""
    size = batch.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    tasks = -(-size // (task_bytes or TASK_BYTES))
    if tasks <= 1:
        return batch
    return batch.repartition(max(tasks, batch.sparkSession.sparkContext.defaultParallelism))


def cursor_of(batch: DataFrame) -> str:
    """The id that a checkpoint gives to its query for good. A new or lost checkpoint has
    another, so it never overwrites what an earlier one has written."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start(messages: DataFrame, schema: T.StructType, sinks: Sequence[Sink], checkpoint: str,
          known: DataFrame | Sequence[str] | None = None, once: bool = False,
          seconds: int = FLUSH_SECONDS,
          callback: Callable[[DataFrame, int], None] | None = None,
          partial: bool = False, wal: bool = False,
          until_end: bool = False) -> StreamingQuery:
    """Run a subscription: ``checkpoint`` is its cursor, and the trigger its flush rule.

    Offsets are committed after every sink has written the epoch. ``once`` reads what is there
    and ends, which also flushes everything. ``callback`` sees each micro-batch first. Sinks may
    be shared by several subscriptions. Audits are written ahead of the others. If there is none
    among them, bad messages and dirty rows, and with ``wal`` all decoded rows, go to one at
    ``{checkpoint}-audit``. With ``until_end`` a lane is read up to its first end mark, see
    :class:`EndMarks`.
    """
    sinks = sorted(sinks, key=lambda s: not isinstance(s, AuditSink))
    if not any(isinstance(s, AuditSink) for s in sinks):
        sinks.insert(0, AuditSink(messages.sparkSession, f"{checkpoint}-audit", schema, wal))
    marks = EndMarks(messages.sparkSession, checkpoint) if until_end else None
    return _run(messages, lambda batch: receive(batch, schema, known, partial), sinks, checkpoint,
                once, seconds, callback, marks)


def start_many(messages: DataFrame, sink: CatalogSink, checkpoint: str, once: bool = False,
               seconds: int = FLUSH_SECONDS,
               callback: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Run a subscription to a topic of many tables: each message is parsed once and loaded into
    its target by that target's columns. Other options as in :func:`start`."""
    return _run(messages, lambda batch: receive_many(batch, list(sink.targets)), [sink],
                checkpoint, once, seconds, callback)


def _run(messages: DataFrame, received: Callable[[DataFrame], DataFrame], sinks: Sequence[Sink],
         checkpoint: str, once: bool, seconds: int,
         callback: Callable[[DataFrame, int], None] | None,
         marks: EndMarks | None = None) -> StreamingQuery:
    def apply(batch: DataFrame, epoch_id: int) -> None:
        if callback is not None:
            callback(batch, epoch_id)
        cursor = cursor_of(batch)
        if marks is not None:
            batch = marks.cut(batch, epoch_id, cursor)
        checked = received(spread(batch)).persist()
        try:
            for sink in sinks:
                sink.write(checked, epoch_id, cursor)
        finally:
            checked.unpersist()

    writer = messages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if once
              else writer.trigger(processingTime=f"{seconds} seconds"))
    return writer.start()


def start_files(chunks: DataFrame, sink: Sink, checkpoint: str, once: bool = False,
                seconds: int = FLUSH_SECONDS) -> StreamingQuery:
    """Run a subscription to a topic of file chunks."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        sink.write(batch, epoch_id, cursor_of(batch))

    writer = (chunks.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if once
              else writer.trigger(processingTime=f"{seconds} seconds"))
    return writer.start()


def start_all(spark: SparkSession, subscriptions: Sequence[Subscription], schema: T.StructType,
              sinks: Sequence[Sink], checkpoints: str,
              opened: Callable[[SparkSession, Subscription], DataFrame] | None = None,
              files_per_trigger: int | None = None, bytes_per_trigger: str | None = None,
              **options) -> list[StreamingQuery]:
    """Run several subscriptions into the same sinks, each with a cursor of its own below
    ``checkpoints``. ``opened`` makes the stream of a subscription; by default its url is the
    folder that holds its topic, of which a micro-batch takes as many files or bytes as the limits
    say. ``options`` are those of :func:`start`."""
    def folder(spark: SparkSession, s: Subscription) -> DataFrame:
        return stream_topic(spark, f"{s.url}/{s.topic}", files_per_trigger, bytes_per_trigger)

    names = [f"{s.name}-{s.topic}" for s in subscriptions]
    if len(set(names)) != len(names):
        raise ValueError("a subscription is listed twice")
    return [start((opened or folder)(spark, s), schema, sinks, f"{checkpoints}/{name}", **options)
            for s, name in zip(subscriptions, names)]
