"""Routing, quarantine, clearing, upserts, ranges."""

import random

import pytest
from pyspark.sql import Window, functions as F, types as T

from tableferry.operators import clear, ranges, route, upsert
from tableferry.plans import sync

K = T.StructType([T.StructField("k", T.IntegerType())])


def test_reasons_of_bad_messages(spark):
    good = '[{"k": 1}]'
    rows = [(1, "", "t", good), (2, None, "t", good), (3, "hdfs", "t", good),
            (4, "KUDU", "", good), (5, "Kudu", "impala::nope", good), (6, "ClickHouse", "t", "["),
            (7, "clickhouse", "anything", good), (8, "kudu", "impala::t", good)]
    df = spark.createDataFrame(rows, "msg_id long, db_type string, target_table string, data string")
    reasons = {r.msg_id: r.reason for r in route.triaged(df, ["k"], ["t"]).collect()}
    assert reasons == {1: "no_db_type", 2: "no_db_type", 3: "unroutable", 4: "missing_target",
                       5: "unknown_target", 6: "undecodable", 7: None, 8: None}
    table = spark.createDataFrame([("t",), ("t",)], "target string")
    again = {r.msg_id: r.reason for r in route.triaged(df, ["k"], table).collect()}
    assert again == reasons


def test_typed_aligns_by_name_and_reports_misfits(spark):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.IntegerType()),
                           T.StructField("c", T.DoubleType())])
    df = spark.createDataFrame([(1, "7", "x"), (2, "seven", "y"), (3, None, None)],
                               "msg_id long, a string, b string")
    got = [tuple(r) for r in route.typed(df, schema).orderBy("msg_id").collect()]
    assert got == [(1, "x", 7, None, None), (2, "y", None, None, "a"), (3, None, None, None, None)]


def messages(spark, rows):
    """(msg_id, partition, batch) of one table, each with one row in the declared partition."""
    return spark.createDataFrame(rows, "msg_id long, partition string, batch_id string").withColumn(
        "clear_table", F.lit("t"))


def test_one_clear_per_batch_and_partition(spark):
    msgs = messages(spark, [(1, "13", "A"), (2, "14", "B"), (3, "15", "C"), (4, "15", "C")])
    events = clear.clear_events(msgs)
    assert sorted(r.msg_id for r in events.collect()) == [1, 2, 3]
    rows = msgs.withColumn("target", F.lit("t"))
    kept = clear.surviving(rows, clear.last_clears(events), "target", "partition")
    assert sorted(r.partition for r in kept.collect()) == ["13", "14", "15", "15"]


def test_batches_that_alternate_clear_again(spark):
    msgs = messages(spark, [(i, "", b) for i, b in enumerate("AABBAB")])
    events = clear.clear_events(msgs, ["clear_table"], span=2).orderBy("msg_id").collect()
    assert [(e.msg_id, e.batch_id, e.epoch) for e in events] == [
        (0, "A", 1), (2, "B", 2), (4, "A", 3), (5, "B", 4)]


def test_messages_without_table_or_batch_clear_nothing(spark):
    rows = [(1, "", "A", ""), (2, "", "", "t"), (3, "", "A", "t")]
    df = spark.createDataFrame(rows, "msg_id long, partition string, batch_id string, clear_table string")
    assert [r.msg_id for r in clear.clear_events(df).collect()] == [3]


@pytest.mark.parametrize("span", [9, 10**6])
def test_clears_match_a_plain_window(spark, span):
    rng = random.Random(span)
    rows = [(i, rng.choice(["", "p", "q"]), rng.choice("AB")) for i in rng.sample(range(900), 300)]
    msgs = messages(spark, rows)
    w = Window.partitionBy("clear_table", "partition").orderBy("msg_id")
    want = msgs.withColumn("b", F.lag("batch_id").over(w)).where(
        "b is null or b <> batch_id").select("msg_id")
    got = clear.clear_events(msgs, span=span).select("msg_id")
    assert sorted(got.collect()) == sorted(want.collect())


def test_other_partitions_of_the_batch_are_only_appended_to(spark):
    """A clear drops the declared partition; rows of the batch that lie elsewhere are added."""
    last = clear.last_clears(clear.clear_events(messages(spark, [(5, "p", "A"), (6, "p", "A")])))
    rows = spark.createDataFrame(
        [("t", None, "p", 1), ("t", None, "q", 2), ("t", 3, "p", 3), ("t", 3, "q", 4),
         ("t", 5, "p", 5), ("t", 6, "q", 6), ("u", None, "p", 7)],
        "target string, msg_id long, part string, n int")
    kept = clear.surviving(rows, last, "target", "part")
    assert sorted(r.n for r in kept.collect()) == [2, 4, 5, 6, 7]


def topic(spark, rows):
    """(msg_id, db_type, target, clear_table, batch, data)"""
    df = spark.createDataFrame(rows, "msg_id long, db_type string, target_table string,"
                                     " clear_table string, batch_id string, data string")
    names = ["db_type", "target_table", "clear_table", "batch_id"]
    return df.select("msg_id", F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])
                     .alias("properties"), "data", F.lit("topic").alias("topic"))


def test_a_bad_message_still_clears(spark):
    t = topic(spark, [(1, "clickhouse", "t", "t", "A", '[{"k":1}]'),
                      (2, "clickhouse", "t", "t", "B", "broken"),
                      (3, "clickhouse", "t", "t", "B", '[{"k":3}]')])
    got = sync.apply_append(sync.receive(t, K), K)
    assert [r.k for r in got.collect()] == [3]


def test_clear_name_may_differ_from_the_target(spark):
    t = topic(spark, [(1, "clickhouse", "all", "local", "A", '[{"k":1}]')])
    old = spark.createDataFrame([("all", 9), ("other", 8)], "target string, k int")
    checked = sync.receive(t, K)
    with_alias = sync.apply_append(checked, K, old, {"local": "all"})
    without = sync.apply_append(checked, K, old)
    assert sorted(r.k for r in with_alias.collect()) == [1, 8]
    assert sorted(r.k for r in without.collect()) == [1, 8, 9]


def test_last_write_wins_also_inside_a_message(spark):
    rows = spark.createDataFrame(
        [(1, "a", 10, 0), (1, "b", 10, 1), (2, "c", 9, 0), (1, "d", 8, 5)],
        "k int, v string, msg_id long, row_pos int")
    got = upsert.last_wins(rows, ["k"], ["msg_id", "row_pos"])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "b"), (2, "c")]
    old = spark.createDataFrame([(1, "old", 99, 0), (3, "kept", 99, 0)],
                                "k int, v string, msg_id long, row_pos int")
    merged = upsert.upsert(old, rows, ["k"], ["msg_id", "row_pos"])
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, "b"), (2, "c"), (3, "kept")]


def test_partial_upsert_keeps_missing_columns_and_writes_nulls(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, v string, x double")
    new = spark.createDataFrame([(1, None, 5), (3, "c", 6)], "k int, v string, o int")
    got = upsert.upsert_partial(old, new, ["k"], ["o"])
    assert sorted((r.k, r.v, r.x) for r in got.collect()) == [
        (1, None, 1.0), (2, "b", 2.0), (3, "c", None)]


def test_ranges_are_added_once(spark):
    reg = spark.createDataFrame([("t", 1, 5)], "target_table string, lower long, upper long")
    msgs = spark.createDataFrame(
        [("impala::t", "1<=VALUES<5", "b"), ("t", "5<=VALUES<9", "b"), ("t", "5<=VALUES<9", "c"),
         ("t", "9<=VALUES<12", ""), ("t", "bad", "b"), ("t", "", "b"), ("t", "7<=VALUES<7", "b")],
        "target_table string, range_partition string, batch_id string")
    got = ranges.add_ranges(reg, ranges.requested_ranges(msgs))
    assert sorted(map(tuple, got.collect())) == [("t", 1, 5), ("t", 5, 9)]


@pytest.mark.parametrize("span", [50, 10**6])
def test_rows_find_their_range(spark, span):
    rng = random.Random(span)
    cuts = sorted(rng.sample(range(-300, 1000), 24))
    held = list(zip(cuts[::2], cuts[1::2])) + [(2000, 2**63 - 1)]
    reg = spark.createDataFrame(held, "lower long, upper long")
    keys = [rng.randint(-400, 2600) for _ in range(400)] + [7] * 200
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key long")
    got = ranges.assign_ranges(rows, "key", reg, span=span).collect()
    assert len(got) == len(keys)
    for r in got:
        want = [(a, b) for a, b in held if a <= r.key < b] or [(None, None)]
        assert (r.lower, r.upper) == want[0]
