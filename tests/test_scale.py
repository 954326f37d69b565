"""Work that must grow with its input, and no faster."""

import json
import time

import pytest
from pyspark.sql import Row, functions as F

from tableferry.functions.codec import FIELDS, parsed, with_fields
from tableferry.operators import chunks as ch
from tableferry.session import scratch
from tableferry.sources import landed, tables
from tableferry.streaming import receiver, transfers


def test_names_of_records_are_read_once_for_a_message(spark):
    records = [{"a": i, "b": None} if i % 2 else {"a": i} for i in range(12_000)]
    messages = spark.createDataFrame([(json.dumps(records),), ('{"b": 1}',), ("broken",)],
                                     "data string")
    rows = messages.select("data", parsed(F.col("data"), ["a", "b"]).alias("rows"))
    began = time.time()
    got = rows.select("data", with_fields(F.col("rows"), F.col("data")).alias("rows")).collect()
    # read again for each record, this is 3 GB of text
    assert time.time() - began < 60
    long, single, broken = (r.rows for r in got)
    assert [r[FIELDS] for r in long] == [["a", "b"] if i % 2 else ["a"] for i in range(12_000)]
    assert [(r.a, r.b, r[FIELDS]) for r in single] == [(None, "1", ["b"])]
    assert broken is None


def test_decoded_messages_are_dealt_over_tasks(spark, monkeypatch):
    messages = spark.createDataFrame([("x" * 1000,)] * 100, "data string").coalesce(1)
    monkeypatch.setattr(receiver, "TASK_BYTES", 4000)
    many = receiver.spread(messages)
    sizes = many.rdd.glom().map(len).collect()
    assert len(sizes) == 25 and max(sizes) <= 8 and sum(sizes) == 100
    monkeypatch.setattr(receiver, "TASK_BYTES", 200_000)
    assert receiver.spread(messages) is messages
    nothing = messages.where("data = ''")
    assert receiver.spread(nothing) is nothing


@pytest.mark.parametrize("format", ["text", "parquet"])
def test_partitions_are_loaded_together(spark, monkeypatch, format):
    """Many partitions, one load; only those whose files hold no row are loaded alone. Files of
    different columns and types go to one table."""
    def written(rows):
        path = scratch(spark, "one")
        rows.coalesce(1).write.format(format).save(path)
        found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
        return bytes(found[0].content) if found else b""

    def segment(day, rows, adds=False):
        name = f"f{day}{adds}"
        return (name, 0, written(rows), name, "t", {"day": str(day)}, not adds)

    line = "CAST(id + 10 * {0} AS STRING) AS line"
    other = "id + 10 * {0} AS line" if format == "parquet" else line
    whole = spark.createDataFrame(
        [segment(d, spark.range(2).selectExpr((other if d % 2 else line).format(d))) for d in range(6)]
        + [segment(6, spark.range(1).where("id < 0").selectExpr(line.format(0)))]
        + [segment(5, spark.range(1).selectExpr("'more' AS line"), adds=True)],
        "sync_id string, segment int, data binary, file string, table string,"
        " partition map<string,string>, is_overwrite boolean")
    name = tables.fresh_name("together")
    tables.create_target(spark, name, "line STRING, day INT", scratch(spark, name), ["day"])
    spark.sql(f"INSERT INTO {name} VALUES ('old', 3), ('old', 6), ('old', 7)")
    alone, load = [], tables.load_partition
    monkeypatch.setattr(tables, "load_partition", lambda df, target, partition, over=True: (
        alone.append(partition), load(df, target, partition, over)))
    landed.load_rows(spark, whole, {"t": name}, format=format)
    want = [(str(i + 10 * d), d) for d in range(6) for i in range(2)] + [("more", 5), ("old", 7)]
    assert sorted(tuple(r) for r in spark.table(name).collect()) == sorted(want)
    assert alone == [{"day": "6"}]


def test_a_new_transfer_takes_two_trips_to_the_state():
    calls = []

    class Known:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    class Handle:
        def __getattr__(self, name):
            return lambda *args: calls.append(name) or []

    def part(number, total):
        return Row(cur_part=number, file="f", total_parts=total, msg_id=number)

    clock = type("Clock", (), {"getCurrentProcessingTimeInMs": lambda self: 0})()
    one = transfers.Transfer()
    one.handle, one.state = Handle(), Known()
    (event,) = one.handleInputRows(("s", ""), iter([part(1, 1)]), clock)
    assert event.event == transfers.COMPLETE and calls == ["get", "update"]
    assert not list(one.handleInputRows(("s", ""), iter([part(1, 1)]), clock))
    two = transfers.Transfer()
    two.handle, two.state = Handle(), Known()
    calls.clear()
    assert not list(two.handleInputRows(("t", ""), iter([part(2, 2)]), clock))
    assert calls == ["get", "registerTimer", "update"]
    (event,) = two.handleInputRows(("t", ""), iter([part(1, 2)]), clock)
    assert event.event == transfers.COMPLETE and "listTimers" in calls


def test_parts_do_not_carry_the_content_of_their_file(spark):
    data = bytes(range(256)) * 10
    files = spark.createDataFrame([("a", data), ("b", b""), ("c", None)], "file string, content binary")
    parts = ch.cut(files, "content", "file", 1000)
    got = sorted((r.file, r.cur_part, r.total_parts, r.data and bytes(r.data)) for r in parts.collect())
    assert got == [("a", i + 1, 3, data[1000 * i:1000 * i + 1000]) for i in range(3)] + [
        ("b", 1, 1, b""), ("c", 1, 1, None)]
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" in plan[plan.index("Generate"):] and "substring" not in plan[:plan.index("Generate")]
