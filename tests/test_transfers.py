"""File transfers as state, and end marks in a stream."""

import time

import pytest
from pyspark.sql import functions as F

from tableferry.operators import chunks as ch
from tableferry.plans import sync
from tableferry.schemas import CHUNK
from tableferry.session import scratch
from tableferry.sources import topics
from tableferry.streaming import receiver, sinks, transfers


@pytest.fixture(scope="module")
def sent(spark):
    files = spark.createDataFrame([(f"f{i}", bytes([65 + i]) * (10 * i + 3)) for i in range(8)],
                                  "file string, content binary")
    return sync.send_files(ch.cut(files, "content", "file", 10), "t",
                           F.create_map(F.lit("day"), F.lit("1")), transfer="one").cache()


def run(spark, path, sink, out, stall=3600):
    stream = spark.readStream.schema(CHUNK).parquet(path)
    receiver.start_files(stream, sink, f"{out}/files", once=True).awaitTermination()
    transfers.start_transfers(spark, sink, f"{out}/transfers", once=True,
                              stall_seconds=stall).awaitTermination()


def reported(sink, event=transfers.COMPLETE):
    return sorted((r.file, r.n_parts, r.total_parts) for r in sink.events().where(
        F.col("event") == event).collect())


def test_every_file_is_reported_once_over_restarts(spark, sent):
    path, out = scratch(spark, "chunks"), scratch(spark, "files")
    first = "cur_part % 2 = 1 and file <> 'f7'"
    waves = [sent.where(first), sent.where(f"not ({first}) and file <> 'f6'"), sent,
             sent.where("file = 'f3'")]
    whole = {f"f{i}": i + 1 for i in range(8)}
    seen = [[("f0", 1, 1)], None, None, None]
    for wave, want in zip(waves, seen):
        topics.publish(wave, path, schema=CHUNK)
        # objects of a new process: all that is kept is in files
        sink = sinks.FileSink(spark, f"{out}/store", 10)
        run(spark, path, sink, out)
        if want:
            assert reported(sink) == want
    assert reported(sink) == sorted((f, n, n) for f, n in whole.items())
    by_state = {r.file: bytes(r.data) for r in sink.read_reported().collect()}
    assert by_state == {r.file: bytes(r.data) for r in sink.read().collect()}
    assert by_state["f3"] == b"D" * 33


def test_a_stalled_transfer_is_reported_and_may_go_on(spark, sent):
    path, out = scratch(spark, "chunks"), scratch(spark, "stalled")
    sink = sinks.FileSink(spark, f"{out}/store", 10)
    topics.publish(sent.where("file = 'f5' and cur_part < 4"), path, schema=CHUNK)
    run(spark, path, sink, out, stall=1)
    assert reported(sink) == []
    time.sleep(2)
    topics.publish(sent.where("file = 'f1'"), path, schema=CHUNK)
    run(spark, path, sink, out, stall=1)
    assert reported(sink, transfers.STALLED) == [("f5", 3, 6)] and reported(sink) == [("f1", 2, 2)]
    topics.publish(sent.where("file = 'f5' and cur_part > 3"), path, schema=CHUNK)
    run(spark, path, sink, out, stall=1)
    assert reported(sink) == [("f1", 2, 2), ("f5", 6, 6)]


def test_a_broken_chunk_counts_for_nothing_and_a_later_transfer_wins(spark, sent):
    path, out = scratch(spark, "chunks"), scratch(spark, "broken")
    sink = sinks.FileSink(spark, f"{out}/store", 10)
    bad = sent.where("file = 'f2'").withColumn("md5_checksum", F.when(
        F.col("cur_part") == 2, "wrong").otherwise(F.col("md5_checksum")))
    topics.publish(bad, path, schema=CHUNK)
    run(spark, path, sink, out)
    assert reported(sink) == [] and sink.bad().count() == 1
    again = sync.send_files(ch.cut(spark.createDataFrame([("f2", b"new" * 5)], "file string, content binary"),
                                   "content", "file", 10), "t", F.create_map(F.lit("d"), F.lit("1")), transfer="two")
    topics.publish(sent.where("file = 'f2'"), path, schema=CHUNK)
    topics.publish(again, path, schema=CHUNK)
    run(spark, path, sink, out)
    assert reported(sink) == [("f2", 2, 2), ("f2", 3, 3)]
    assert [bytes(r.data) for r in sink.read_reported().collect()] == [b"new" * 5]


def test_rows_of_files_do_not_depend_on_segments(spark):
    """Files of many segments and of one; a partition is replaced first, then added to."""
    from tableferry.sources import files, landed, tables
    root = scratch(spark, "source")
    rows = spark.range(3000).selectExpr("id", "concat('n', id) as name", "id % 2 as day")
    rows.write.option("maxRecordsPerFile", 400).partitionBy("day").parquet(root)
    n_files = files.list_files(spark, root, ".parquet").count()
    parts = files.file_parts(files.list_files(spark, root, ".parquet"), 1000)
    results = []
    for segment_bytes in (1000, 3000, 1 << 20):
        name = tables.fresh_name("landing")
        tables.create_target(spark, name, "id BIGINT, name STRING, day INT", scratch(spark, name), ["day"])
        spark.sql(f"INSERT INTO {name} VALUES (-1, 'old', 0), (-2, 'old', 1), (-3, 'old', 2)")
        day = F.regexp_extract("file", r"day=(\d)/", 1)
        sent = sync.send_files(parts, "t", F.create_map(F.lit("day"), day)).withColumn(
            "is_overwrite", day == "0")
        whole = sync.load_files(sent, 1000, segment_bytes=segment_bytes)
        listed = landed.load_rows(spark, whole, {"t": name})
        assert listed.count() == n_files and listed.where("n_bytes <= 0").count() == 0
        results.append(sorted((r.id, r.name, r.day) for r in spark.table(name).collect()))
    want = sorted([(i, f"n{i}", i % 2) for i in range(3000)] + [(-2, "old", 1), (-3, "old", 2)])
    assert results == [want] * 3


def test_lanes_end_at_their_first_mark(spark):
    from pyspark.sql import types as T
    from tableferry.functions.headers import append_header
    from tableferry.operators.pack import END_SIGN
    from tableferry.schemas import TOPIC
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    # lane 0 ends in the first wave, lane 1 in the second, lane 2 twice, lane 3 never
    ends = {(0, 8), (1, 21), (2, 18), (2, 26)}
    rows = [(i % 4, i, END_SIGN if (i % 4, i) in ends else '[{"k":%d}]' % i) for i in range(40)]
    messages = spark.createDataFrame(rows, "lane long, msg_id long, data string").select(
        "lane", "msg_id", F.lit("t").alias("topic"), F.timestamp_seconds("msg_id").alias("publish_time"),
        append_header("t", batch_id="b").alias("properties"), "data").select(*TOPIC.names)
    path, out = scratch(spark, "topic"), scratch(spark, "ends")
    sink = sinks.AppendSink(spark, f"{out}/rows", schema)
    for low, high in ((0, 15), (15, 30), (30, 40)):
        topics.publish(messages.where(f"msg_id >= {low} and msg_id < {high}"), path, own_ids=True)
        query = receiver.start(topics.stream_topic(spark, path), schema, [sink], f"{out}/cursor",
                               once=True, until_end=True)
        query.awaitTermination()
    want = {r.msg_id for r in topics.until_end(messages).collect()}
    assert {r.msg_id for r in sink.read().collect()} == want
    audit = sinks.AuditSink(spark, f"{out}/cursor-audit", schema)
    assert audit.read().count() == 0
    # a query that runs on is stopped once its lanes have ended
    query = receiver.start(topics.stream_topic(spark, path), schema, [], f"{out}/again", seconds=1,
                           until_end=True)
    receiver.await_end(query, f"{out}/again", 3, 0.2)
    assert not query.isActive
