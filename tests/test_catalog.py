"""Topics of many tables, payloads read to their end, and clears without replay."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F, types as T

from tableferry.functions import codec
from tableferry.functions.headers import header_map
from tableferry.operators import clear, route
from tableferry.plans import sync
from tableferry.schemas import TOPIC
from tableferry.session import scratch
from tableferry.sources import topics
from tableferry.streaming import receiver, sinks

PAYLOADS = {
    '[{"k":"1"}]': 1, '{"k":"1"}': 1, ' \n{"k":"1"}\t': 1, '[]': 0, '[{"k":{"a":[1]}},{"z":2}]': 2,
    '{"k":"1"} {"k":"2"}': None, '[{"k":"1"}][{"k":"2"}]': None, '[{"k":"1"}] xyz]': None,
    '[{"k":1},5]': None, '[5]': None, '[null]': None, '[{"k":1},null]': None, '': None,
    '{"k":1},{"k":2}': None, '[{"k":1}]],[[{"k":2}]': None, '[[{"k":1}]]': None, '"x"': None,
    '{"k":1': None, '[{"k":1},{"k":}]': None, 'null': None, '[{"k":1}],"x":[2]': None,
    '[{"k":1}],[{"k":"0"}]': None}


@pytest.mark.parametrize("form", ["text", "records"])
def test_a_payload_is_read_to_its_end(spark, form):
    df = spark.createDataFrame([(t,) for t in PAYLOADS] + [(None,)], "data string")
    read = (df.withColumn("rows", codec.parsed(F.col("data"), ["k"])) if form == "text"
            else codec.with_records(df))
    got = {r.data: r.n for r in read.select("data", F.when(
        F.col("rows").isNotNull(), F.size("rows")).alias("n")).collect()}
    assert got == {**PAYLOADS, None: None}


A = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("when", T.DateType())])
B = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.DoubleType()),
                  T.StructField("tags", T.ArrayType(T.StringType()))])


@pytest.fixture(scope="module")
def shared(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        target = rng.choice(["a", "b", "impala::c", "nobody", ""])
        data = rng.choice(['[{"k":%d,"when":"2024-01-0%d"}]' % (i, 1 + i % 9),
                           '[{"k":"k%d","x":%d.25,"tags":["p","q%d"]},{"k":"z"}]' % (i % 7, i, i),
                           '[{"k":true}] {"k":1}', "[{"])
        rows.append((i, rng.choice(["clickhouse", "kudu", "other"]), target, f"b{i // 60}", data))
    df = spark.createDataFrame(rows, "msg_id long, db_type string, target_table string,"
                                     " batch_id string, data string")
    header = header_map({"db_type": F.col("db_type"), "target_table": F.col("target_table"),
                         "clear_table": F.when(F.col("msg_id") % 3 == 0, F.col("target_table")),
                         "batch_id": F.col("batch_id"), "range_partition": F.when(
                             F.col("msg_id") % 20 == 0, "no range").otherwise("")})
    return df.select(F.lit(0).cast("long").alias("lane"), "msg_id", F.lit("t").alias("topic"),
                     F.timestamp_seconds("msg_id").alias("publish_time"),
                     header.alias("properties"), "data").select(*TOPIC.names).cache()


def targets_of(spark, out):
    return {"a": sinks.AppendSink(spark, f"{out}/a", A), "b": sinks.AppendSink(spark, f"{out}/b", B),
            "c": sinks.KeyedSink(spark, f"{out}/c", B, ["k"])}


def state(*frames):
    return [sorted(map(str, f.collect())) for f in frames]


def test_many_tables_load_as_each_by_itself(spark, shared):
    """One receiver of all equals a batch of one schema for each target."""
    path, out = scratch(spark, "topic"), scratch(spark, "many")
    sink = sinks.CatalogSink(spark, f"{out}/audit", targets_of(spark, f"{out}/rows"))
    for low, high in ((0, 70), (70, 150)):
        topics.publish(shared.where(f"msg_id >= {low} and msg_id < {high}"), path, own_ids=True)
        receiver.start_many(topics.stream_topic(spark, path), sink, f"{out}/cursor",
                            once=True).awaitTermination()
    alone = targets_of(spark, f"{out}/alone")
    for name, target in alone.items():
        checked = sync.receive(shared, target.schema)
        target.write(checked.where(F.col("target") == name), 0)
        got, want = state(sink.targets[name].read(), target.read())
        assert got == want and got
    reasons = {r.reason: r.n for r in sink.audited().groupBy("reason").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    checked = sync.receive_many(shared, list(alone)).where("reason is not null")
    want = {r.reason: r.n for r in checked.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {"unknown_target", "undecodable", "unroutable", "missing_target"} == set(want)
    assert {k: v for k, v in reasons.items() if k in want} == want
    assert reasons["bad_range"] >= 1 and any(r.startswith("type_mismatch:") for r in reasons)


def test_many_tables_are_parsed_once(spark, shared):
    checked = sync.receive_many(shared, ["a", "b"])
    rows = None
    for name, schema in (("a", A), ("b", B)):
        one = route.good_rows(route.for_target(checked, name, schema.names), schema.names, ["msg_id"])
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            route.typed(one, schema).explain("formatted")
        # an expression is shown once in the operator that evaluates it
        assert text.getvalue().count("parseJson") <= 1 + text.getvalue().count("InMemoryRelation")
        rows = one.count()
    assert rows


def last_of_heads(heads):
    return state(clear.last_clears(clear.run_starts(heads)))[0]


@pytest.mark.parametrize("seed", range(4))
def test_runs_fold_to_the_clears_of_all_messages(spark, seed):
    """A, B, A and messages that arrive late, in any order of parts."""
    rng = random.Random(seed)
    rows = [(i, rng.choice("tu"), rng.choice(["", "p"]), rng.choice("AAAB") if i % 40 > 3 else "C")
            for i in range(200)]
    heads = spark.createDataFrame(rows, "msg_id long, clear_table string, partition string,"
                                        " batch_id string").cache()
    parts = [[] for _ in range(5)]
    for i in range(200):
        parts[rng.randrange(5)].append(i)
    folded = None
    for ids in parts:
        new = clear.as_runs(heads.where(F.col("msg_id").isin(ids)))
        folded = spark.createDataFrame(clear.open_runs(
            new if folded is None else folded.unionByName(new)).collect(), new.schema)
    assert state(clear.last_clears_of_runs(folded))[0] == last_of_heads(heads)
    # what is left is the newest run of each key and the message in front of it
    assert folded.count() < 60


def test_a_long_batch_folds_to_one_interval(spark):
    heads = spark.range(5000).select(F.col("id").alias("msg_id"), F.lit("t").alias("clear_table"),
                                     F.lit("").alias("partition"), F.when(
        F.col("id") < 10, "A").otherwise("B").alias("batch_id"))
    left = clear.open_runs(clear.as_runs(heads)).collect()
    assert sorted((r.batch_id, r.first, r.last) for r in left) == [("A", 9, 9), ("B", 10, 4999)]
    assert clear.open_runs(clear.as_runs(heads.limit(0))).collect() == []


def test_vacuum_keeps_what_readers_see(spark, shared):
    out = scratch(spark, "vacuum")
    target = targets_of(spark, out)["a"]
    whole = targets_of(spark, f"{out}-whole")["a"]
    whole.write(sync.receive(shared, A).where("target = 'a'"), 0)
    for epoch, at in enumerate(("msg_id % 3 = 1", "msg_id % 3 = 0", "msg_id % 3 = 2")):
        target.write(sync.receive(shared, A).where("target = 'a'").where(at), epoch)
        target.compact()
        target.vacuum()
        target.vacuum()
        assert target.log.finished() == {"by-hand": epoch}
        assert target.log.get("rows", target.row_schema, {"by-hand": epoch}).count() == 0
    assert state(target.read()) == state(whole.read())
