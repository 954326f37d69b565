"""What must hold from run to run, and that no row goes without a trace."""

import pytest
from pyspark.sql import functions as F, types as T

from tableferry.functions import codec, headers
from tableferry.operators import clear, pack, ranges
from tableferry.plans import sync
from tableferry.sources import topics

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])


def sent(rows, batch, **options):
    header = headers.append_header("t", batch_id=batch, clear_table="t")
    return sync.send(rows, F.lit(0), F.col("k"), header, "topic", F.lit("2024-01-01 00:00:00"), 1,
                     span=50, **options)


def test_second_run_goes_on_and_replaces(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    topics.publish(sent(rows, "a", limit=500), path)
    first = topics.next_id(spark, path)
    topics.publish(sent(rows.where("k < 30"), "b", limit=500), path)
    topic = topics.read_topic(spark, path)
    assert topic.count() == topic.select("msg_id").distinct().count()
    assert first > 0 and topic.where(F.col("msg_id") >= first).count() > 0
    left = sync.apply_append(sync.receive(topic, SCHEMA), SCHEMA)
    assert sorted(r.k for r in left.collect()) == list(range(30))


def test_oversize_rows_stop_or_are_audited(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y" * 900), (3, None)], SCHEMA)
    with pytest.raises(Exception, match="exceeds"):
        sent(rows, "a", limit=500).collect()
    messages = sent(rows, "a", limit=500, strict=False)
    assert sum(int(r.properties["rows"]) for r in messages.collect()) == 2
    audit = sync.rejected(rows, "topic", "t", 500).collect()
    assert [(r.reason, r.target_table) for r in audit] == [("oversize", "t")]


def test_null_rows_stop_the_job(spark):
    rows = spark.createDataFrame([(0, 1, "x"), (0, 2, None)], "lane long, ord long, enc string")
    with pytest.raises(Exception, match="null"):
        pack.sendable(rows).collect()


def test_literals_clear_their_partitions(spark):
    rows = spark.createDataFrame(
        [(1, "t", "(2021,7,13)", "A", 7, 13), (2, "t", "(2021,7,14)", "B", 7, 14),
         (3, "t", "(2021,7,15)", "C", 7, 15), (4, "t", "(2021,7,15)", "C", 7, 15),
         (5, "t", "(2021,7,13)", "D", 7, 13)],
        "msg_id long, clear_table string, partition string, batch_id string, m int, d int"
    ).withColumn("y", F.lit(2021))
    last = clear.last_clears(clear.run_starts(rows, span=2))
    left = clear.surviving(rows, last, "clear_table", ["y", "m", "d"])
    assert sorted(r.msg_id for r in left.collect()) == [2, 3, 4, 5]
    with pytest.raises(ValueError):
        clear.surviving(rows, last, "clear_table")


def test_instants_keep_their_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_seconds(s) AS t FROM VALUES (1730611800), (1730615400) v(s)")
        encoded = [r.enc for r in codec.encode_rows(df).select("enc").collect()]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        back = spark.createDataFrame([(f"[{e}]",) for e in encoded], "data string").select(
            F.unix_seconds(codec.from_wire(codec.parsed(F.col("data"), ["t"])[0]["t"],
                                           T.TimestampType())).alias("s"))
        assert sorted(r.s for r in back.collect()) == [1730611800, 1730615400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("data, good", [
    ('[{"k":"1"}]', True), (' {"k":"1"} ', True), ("[]", True), ('[{"k":"1"}] xyz', False),
    ("[null]", False), ('[{"k":"1"},null]', False), ('{"k":"1"', False), (None, False)])
def test_broken_payloads_are_unreadable(spark, data, good):
    df = spark.createDataFrame([(data,)], "data string")
    assert (df.select(codec.parsed(F.col("data"), ["k"]).alias("r")).first().r is not None) == good


def test_bad_ranges_and_uncovered_rows_are_audited(spark):
    heads = spark.createDataFrame(
        [("impala::t", "20210804-20210805", "b"), ("impala::t", "1<=VALUES<5", "b"),
         ("impala::t", "5<=VALUES<5", "b")], "target_table string, range_partition string, batch_id string")
    assert {r.asked for r in ranges.unread_ranges(heads).collect()} == {
        "20210804-20210805", "5<=VALUES<5"}
    header = headers.keyed_header("impala::t", batch_id="b", range_partition="1<=VALUES<5")
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    messages = sync.send(rows, F.lit(0), F.col("k"), header, "topic",
                         F.lit("2024-01-01 00:00:00"), 1)
    checked = sync.receive(messages, SCHEMA, ["t"])
    registry = spark.createDataFrame([], "target_table string, lower long, upper long")
    out = sync.left_out(checked, SCHEMA, registry, "k")
    assert out.count() == 6 and {r.reason for r in out.collect()} == {"no_range"}


def test_unreadable_messages_of_a_bounded_set_are_audited(spark):
    messages = spark.createDataFrame([(0, 1, '[{"k":"1"}]'), (0, 2, '[{"k"')],
                                     "lane long, msg_id long, data string")
    out = sync.unreadable(messages, SCHEMA).collect()
    assert [(r.msg_id, r.reason) for r in out] == [(2, "undecodable")]
