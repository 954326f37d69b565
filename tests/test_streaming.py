"""The streaming receiver equals one pass over the whole topic."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from tableferry.functions.headers import header_map
from tableferry.plans import sync
from tableferry.schemas import TOPIC
from tableferry.session import scratch
from tableferry.sources import topics
from tableferry.streaming import receiver, sinks

K = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
KNOWN = ["t", "u"]


@pytest.fixture(scope="module")
def topic(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        data = rng.choice(['[{"k": %d, "v": "a%d"},{"k": %d, "v": "b%d"}]' % (
            rng.randint(0, 9), i, rng.randint(0, 9), i)] * 8 + ["[{", '[{"k": "x", "v": "d"}]'])
        rows.append((i % 3, i, "topic", rng.choice(["clickhouse", "Kudu", ""]),
                     rng.choice(["t", "u", "impala::t", "nope", ""]), f"b{i // 50}", data))
    df = spark.createDataFrame(rows, "lane long, msg_id long, topic string, db_type string,"
                                     " target_table string, batch_id string, data string")
    header = header_map({"db_type": F.col("db_type"), "target_table": F.col("target_table"),
                         "clear_table": F.when(F.col("msg_id") % 2 == 0, F.col("target_table")),
                         "batch_id": F.col("batch_id")})
    return df.select("lane", "msg_id", "topic", F.timestamp_seconds("msg_id").alias(
        "publish_time"), header.alias("properties"), "data").select(*TOPIC.names).cache()


def make(spark, out):
    return [sinks.AppendSink(spark, f"{out}/append", K),
            sinks.KeyedSink(spark, f"{out}/keyed", K, ["k"]),
            sinks.AuditSink(spark, f"{out}/audit", K)]


def state(targets):
    return [sorted(map(str, t.read().collect())) for t in targets]


@pytest.fixture(scope="module")
def whole(spark, topic):
    targets = make(spark, scratch(spark, "whole"))
    for t in targets:
        t.write(sync.receive(topic, K, KNOWN), 0)
    return state(targets)


def test_batch_result_is_the_composition_of_the_operators(spark, topic, whole):
    checked = sync.receive(topic, K, KNOWN)
    rows = sync.apply_append(checked, K).select("target", "k", "v")
    targets = make(spark, scratch(spark, "one"))
    targets[0].write(checked, 0)
    assert sorted(map(tuple, rows.collect())) == sorted(
        map(tuple, targets[0].read().select("target", "k", "v").collect()))
    assert len(whole[0]) > 0 and len(whole[1]) > 0 and len(whole[2]) > 0


def test_stop_restart_and_one_file_per_trigger(spark, topic, whole):
    path, out = scratch(spark, "topic"), scratch(spark, "out")
    targets = make(spark, out)
    for low, high in ((0, 60), (60, 130), (130, 240)):
        topics.publish(topic.where(f"msg_id >= {low} and msg_id < {high}").coalesce(1), path,
                       own_ids=True)
        query = receiver.start(topics.stream_topic(spark, path, 1), K, targets, f"{out}/cursor",
                               KNOWN, once=True)
        query.awaitTermination()
    assert set(targets[0].log.finished().values()) == {2}
    assert state(targets) == whole


def test_a_retried_epoch_replaces_itself_and_late_epochs_fit_in(spark, topic, whole):
    targets = make(spark, scratch(spark, "retry"))
    parts = [("msg_id >= 100", 0), ("msg_id < 100", 1)]
    for cond, epoch in parts + parts:
        for t in targets:
            t.write(sync.receive(topic.where(cond), K, KNOWN), epoch)
    assert state(targets) == whole


def test_compaction_changes_nothing_readers_see(spark, topic, whole):
    targets = make(spark, scratch(spark, "compact"))
    for epoch, cond in enumerate(["msg_id < 90", "msg_id >= 90 and msg_id < 170",
                                  "msg_id >= 170"]):
        for t in targets:
            t.write(sync.receive(topic.where(cond), K, KNOWN), epoch)
        if epoch == 1:
            targets[0].compact()
            targets[1].compact()
    assert state(targets) == whole
    assert targets[0].log.base(targets[0].row_schema)[1] == {"by-hand": 1}


def test_two_subscriptions_read_the_topic_separately(spark, topic):
    path, out = scratch(spark, "topic"), scratch(spark, "subs")
    topics.publish(topic, path)
    counts: dict = {}

    def count(name):
        def seen(batch, epoch):
            counts[name] = counts.get(name, 0) + batch.count()
        return seen

    for name in ("a", "b", "a"):
        receiver.start(topics.stream_topic(spark, path), K, [], f"{out}/{name}", KNOWN, once=True,
                       callback=count(name)).awaitTermination()
    assert counts == {"a": 240, "b": 240}


def test_an_unfinished_epoch_is_not_read(spark, topic):
    sink = make(spark, scratch(spark, "half"))[0]
    checked = sync.receive(topic, K, KNOWN)
    sink.write(checked.where("msg_id < 120"), 0)
    before = state([sink])
    # the job was lost after the rows of epoch 1, before its headers
    sink.log.put("rows", sink.read().select(*sink.row_schema.names), 1)
    assert state([sink]) == before
    sink.write(checked.where("msg_id >= 120"), 1)
    assert state([sink]) != before


def test_ranges_hold_from_the_epoch_that_asks_for_them(spark):
    def batch(rows):
        df = spark.createDataFrame(rows, "msg_id long, range_partition string, data string")
        header = header_map({"db_type": "kudu", "target_table": "impala::t", "batch_id": "b",
                             "range_partition": F.col("range_partition")})
        return sync.receive(df.select("msg_id", header.alias("properties"), "data",
                                      F.lit("x").alias("topic")), K, KNOWN)

    held = spark.createDataFrame([("t", 0, 5)], "target_table string, lower long, upper long")
    sink = sinks.KeyedSink(spark, scratch(spark, "ranged"), K, ["k"], "k", held)
    sink.write(batch([(1, "", '[{"k": 1, "v": "a"},{"k": 7, "v": "early"}]')]), 0)
    sink.write(batch([(2, "5<=VALUES<9", '[{"k": 7, "v": "b"},{"k": 9, "v": "out"}]')]), 1)
    sink.write(batch([(3, "", '[{"k": 8, "v": "c"}]')]), 2)
    assert sorted((r.k, r.v) for r in sink.read().collect()) == [(1, "a"), (7, "b"), (8, "c")]
    assert sorted(r.v for r in sink.uncovered().collect()) == ["early", "out"]


def test_file_chunks_wait_for_the_missing_part(spark, tmp_path):
    from tableferry.schemas import CHUNK
    from tableferry.sources import files
    from tableferry.streaming import sinks as s

    folder = tmp_path / "files with space"
    folder.mkdir()
    (folder / "a%20b.parquet").write_bytes(b"0123456789")
    (folder / "c.parquet").write_bytes(b"xyz")
    parts = files.file_parts(files.list_files(spark, str(folder)), 4)
    sent = sync.send_files(parts, "t", F.create_map(F.lit("day"), F.lit("20240101"))).cache()
    path, out = scratch(spark, "chunks"), scratch(spark, "files")
    sink = s.FileSink(spark, out, 4)
    for cond, done in (("cur_part <> 2", {b"xyz"}), ("cur_part = 2", {b"xyz", b"0123456789"})):
        sent.where(cond).select(*CHUNK.names).write.mode("append").parquet(path)
        stream = spark.readStream.schema(CHUNK).parquet(path)
        receiver.start_files(stream, sink, f"{out}/cursor", once=True).awaitTermination()
        got = sink.read().collect()
        assert {bytes(r.data) for r in got} == done
        assert {(r.table, r.partition["day"]) for r in got} == {("t", "20240101")}
        assert sink.pending().count() == 2 - len(done)


def test_a_failed_micro_batch_is_done_again_after_restart(spark, topic, whole):
    path, out = scratch(spark, "topic"), scratch(spark, "fails")
    topics.publish(topic, path)
    targets = make(spark, out)

    class Broken:
        def write(self, checked, epoch_id, cursor):
            raise RuntimeError("target is away")

    with pytest.raises(Exception, match="target is away"):
        receiver.start(topics.stream_topic(spark, path), K, [targets[0], Broken()],
                       f"{out}/cursor", KNOWN, once=True).awaitTermination()
    receiver.start(topics.stream_topic(spark, path), K, targets, f"{out}/cursor", KNOWN,
                   once=True).awaitTermination()
    assert state(targets) == whole


def message(k, v, msg_id, topic, kind="clickhouse"):
    return (0, msg_id, topic, {"db_type": kind, "target_table": "t"}, '[{"k": %d, "v": "%s"}]' % (k, v))


def topic_of(spark, rows):
    return spark.createDataFrame(rows, "lane long, msg_id long, topic string,"
                                       " properties map<string,string>, data string").withColumn(
        "publish_time", F.timestamp_seconds("msg_id")).select(*TOPIC.names)


def test_subscriptions_share_a_sink_and_a_new_cursor_overwrites_nothing(spark):
    url, out = scratch(spark, "topics"), scratch(spark, "shared")
    sink = sinks.AppendSink(spark, f"{out}/append", K)
    for i, name in enumerate(["a", "b"]):
        topics.publish(topic_of(spark, [message(10 * i + k, name, k, name) for k in range(5)]),
                       f"{url}/{name}")
    subs = topics.subscriptions(f"{url};{url}", "a;b", "s;s")
    for query in receiver.start_all(spark, subs, K, [sink], f"{out}/cursors", once=True):
        query.awaitTermination()
    first = sorted((r.k, r.v) for r in sink.read().collect())
    assert first == [(k, "a") for k in range(5)] + [(10 + k, "b") for k in range(5)]
    sink.compact()
    topics.publish(topic_of(spark, [message(k, "c", k, "c") for k in range(5)]), f"{url}/c")
    receiver.start(topics.stream_topic(spark, f"{url}/c"), K, [sink], f"{out}/other",
                   once=True).awaitTermination()
    assert sorted((r.k, r.v) for r in sink.read().collect()) == sorted(
        first + [(k, "c") for k in range(5)])
    with pytest.raises(ValueError, match="twice"):
        receiver.start_all(spark, [subs[0], subs[0]], K, [sink], f"{out}/cursors")


def test_bad_messages_are_audited_without_being_asked(spark):
    path, out = scratch(spark, "topic"), scratch(spark, "default")
    good, bad = message(1, "x", 0, "a"), message(2, "y", 1, "a")
    topics.publish(topic_of(spark, [good, (*bad[:4], "[{")]), path)
    receiver.start(topics.stream_topic(spark, path), K, [sinks.AppendSink(spark, f"{out}/t", K)],
                   f"{out}/cursor", once=True).awaitTermination()
    found = sinks.AuditSink(spark, f"{out}/cursor-audit", K).read().collect()
    assert [(r.channel, r.reason, r.msg_id) for r in found] == [("bad_msg", "undecodable", 1)]


@pytest.mark.parametrize("compact", [False, True])
def test_partial_records_set_only_what_they_carry(spark, compact):
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("k", "a", "b")])
    sink = sinks.KeyedSink(spark, scratch(spark, "partial"), schema, ["k"], partial=True)
    # by message: the epochs arrive out of order
    texts = ['[{"k": 1, "a": 1, "b": 1}]', '[{"k": 1, "b": 2},{"k": 2, "a": 5}]',
             '{"k": 1, "a": null}', '[{"k": 1, "a": 4},{"k": 1, "b": 9}]']
    for epoch, at in enumerate([[0], [3], [1, 2]]):
        rows = [(0, i, "a", {"db_type": "kudu", "target_table": "t"}, texts[i]) for i in at]
        sink.write(sync.receive(topic_of(spark, rows), schema, ["t"], partial=True), epoch)
        if compact:
            sink.compact()
    assert sorted((r.k, r.a, r.b) for r in sink.read().collect()) == [(1, 4, 9), (2, 5, None)]


def test_clears_by_the_name_behind_a_target(spark):
    sink = sinks.AppendSink(spark, scratch(spark, "alias"), K, aliases={"t_local": "t"})
    for epoch, batch in enumerate(["x", "y"]):
        row = (*message(epoch, batch, epoch, "a"),)
        head = {**row[3], "clear_table": "t_local", "batch_id": batch}
        sink.write(sync.receive(topic_of(spark, [(*row[:3], head, row[4])]), K), epoch)
    assert [r.v for r in sink.read().collect()] == ["y"]


def test_a_file_sent_again_does_not_mix_with_its_older_version(spark):
    from tableferry.operators import chunks as ch
    from tableferry.schemas import CHUNK

    path, out = scratch(spark, "chunks"), scratch(spark, "again")
    sink = sinks.FileSink(spark, out, 4)
    for n, (content, lost) in enumerate([(b"OLDOOLDOOLDO", 0), (b"NEWNNEW", 0), (b"LATELATE", 2)]):
        df = spark.createDataFrame([("f", content)], "file string, content binary")
        sent = sync.send_files(ch.cut(df, "content", "file", 4), "t",
                               F.create_map(F.lit("day"), F.lit("1")))
        sent = sent.withColumn("md5_checksum", F.when(
            F.col("cur_part") == lost, "-").otherwise(F.col("md5_checksum")))
        topics.publish(sent, path, schema=CHUNK)
        stream = spark.readStream.schema(CHUNK).parquet(path)
        receiver.start_files(stream, sink, f"{out}/cursor", once=True).awaitTermination()
        got = [bytes(r.data) for r in sink.read().collect()]
        assert got == [[b"OLDOOLDOOLDO"], [b"NEWNNEW"], [b"NEWNNEW"]][n]
    assert [(r.reason, r.target_table) for r in sink.bad().collect()] == [("checksum", "t")]
