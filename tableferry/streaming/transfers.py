"""File transfers as keyed state: a file is reported once, as soon as all its parts are here.

A :class:`tableferry.streaming.sinks.FileSink` stores chunks whose checksum is right. The job here
follows that store as a stream of its own, of which it reads the headers only, so no payload is
hashed, shuffled or kept in state again, and a transfer is never reported before its chunks are
stored. State is a bit for each part of a transfer that is under way, and for a transfer that is
complete the note that it is. A timer reports transfers to which nothing comes any more.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tableferry.schemas import CHUNK, EVENTS
from tableferry.streaming.receiver import FLUSH_SECONDS, cursor_of
from tableferry.streaming.sinks import EPOCH_CHUNK, FileSink

COMPLETE, STALLED = "complete", "stalled"
STALL_SECONDS = 3600

_STATE = T.StructType([
    T.StructField("parts", T.BinaryType()), T.StructField("file", T.StringType()),
    T.StructField("total", T.IntegerType()), T.StructField("last", T.LongType()),
    T.StructField("done", T.BooleanType())])

# Fixed value: the store that keeps state with timers.
_SETTINGS = {"spark.sql.streaming.stateStore.providerClass":
             "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Transfer(StatefulProcessor):
    """One transfer of one file. Parts are numbered from ``base``; copies of a part set a bit that
    is set already, and parts beyond the total are not counted."""

    def __init__(self, stall_seconds: int = STALL_SECONDS, base: int = 1):
        self.stall, self.base = stall_seconds * 1000, base

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("transfer", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # every call on state or timers is a trip to the JVM, so a new transfer asks for neither
        known = self.state.get()
        bits, file, total, last, done = known or (b"", "", 0, -1, False)
        if done:
            return
        bits = int.from_bytes(bits, "little")
        for part in rows:
            file, total = part.file, max(total, part.total_parts)
            last = max(last, part.msg_id)
            bits |= 1 << part.cur_part - self.base
        have = (bits & (1 << total) - 1).bit_count()
        done = have >= total
        if known:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if not done:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stall)
        size = -(-bits.bit_length() // 8)
        self.state.update((b"" if done else bits.to_bytes(size, "little"), file, total, last, done))
        if done:
            yield self._event(key, file, COMPLETE, have, total, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Reported once for each pause; a transfer that goes on is complete in the end."""
        bits, file, total, last, done = self.state.get()
        if not done:
            have = (int.from_bytes(bits, "little") & (1 << total) - 1).bit_count()
            yield self._event(key, file, STALLED, have, total, last)

    @staticmethod
    def _event(key, file, event, have, total, last) -> Row:
        return Row(*EVENTS.names)(*key, file, event, have, total, last)


def events(heads: DataFrame, stall_seconds: int = STALL_SECONDS, base: int = 1) -> DataFrame:
    """Complete and stalled transfers of a stream of chunk headers."""
    return (heads.select("sync_id", F.coalesce("transfer", F.lit("")).alias("transfer"), "file",
                         "cur_part", "total_parts", "msg_id")
            .where("sync_id is not null and cur_part is not null and total_parts is not null")
            .groupBy("sync_id", "transfer").transformWithState(
                Transfer(stall_seconds, base), EVENTS, "append", "ProcessingTime"))


def start_transfers(spark: SparkSession, sink: FileSink, checkpoint: str, once: bool = False,
                    seconds: int = FLUSH_SECONDS, stall_seconds: int = STALL_SECONDS,
                    base: int = 1) -> StreamingQuery:
    """Follow the chunks that ``sink`` stores and note complete and stalled transfers in it.

    An epoch of chunks that was written again is read again, which changes nothing. With ``once``
    timers fire in the next run that has chunks, else by themselves.
    """
    stored = (spark.readStream.schema(EPOCH_CHUNK).option("ignoreMissingFiles", "true")
              .parquet(f"{sink.log.path}/chunks").select(*CHUNK.names[:-1]))

    def note(batch: DataFrame, epoch_id: int) -> None:
        sink.note(batch, epoch_id, cursor_of(batch))

    writer = (events(stored, stall_seconds, base).writeStream.foreachBatch(note)
              .outputMode("append").option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if once
              else writer.trigger(processingTime=f"{seconds} seconds"))
    wanted = dict(_SETTINGS)
    if once:
        # timers would ask for one batch without data after another, and the query never end
        wanted["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        return writer.start()  # the query keeps the settings that it starts with
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
