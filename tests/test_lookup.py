"""Ranges searched in place, files of every kind listed, sized exports, counts of a send."""

import contextlib
import io
import os
import random

from pyspark.sql import functions as F

from tableferry.functions.headers import append_header
from tableferry.operators import ranges
from tableferry.plans import sync
from tableferry.session import scratch
from tableferry.sources import files, tables, topics


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_rows_search_the_ranges_of_their_table(spark, monkeypatch):
    rng = random.Random(5)
    held = {}
    for name in "abc":
        cuts = sorted(rng.sample(range(-500, 500), 2 * rng.choice([1, 7, 20])))
        held[name] = list(zip(cuts[::2], cuts[1::2]))
    held["a"].append((1000, 2**63 - 1))
    reg = spark.createDataFrame([(t, *r) for t, rs in held.items() for r in rs],
                                "target_table string, lower long, upper long")
    keys = [(i, rng.choice("abcd"), rng.choice([None, *range(-520, 520)])) for i in range(600)]
    keys += [(600, "a", 2**62), (601, None, 5)]
    rows = spark.createDataFrame(keys, "id long, target string, key long")
    want = {i: next((r for r in held.get(t, []) if k is not None and r[0] <= k < r[1]), (None, None))
            for i, t, k in keys}
    found = ranges.assign_ranges(rows, "key", reg, "target")
    assert {r.id: (r.lower, r.upper) for r in found.collect()} == want
    plan = plan_of(found)
    assert "Exchange hashpartitioning" not in plan and "NestedLoop" not in plan
    monkeypatch.setattr(ranges, "INDEXED", 3)
    again = ranges.assign_ranges(rows, "key", reg, "target")
    assert {r.id: (r.lower, r.upper) for r in again.collect()} == want


def test_overlaps_are_listed_and_audited(spark):
    reg = spark.createDataFrame([("t", 1, 5), ("t", 4, 9), ("t", 9, 10), ("u", 1, 50), ("u", 2, 3),
                                 ("u", 40, 60), ("v", 1, 2), ("v", 1, 2)],
                                "target_table string, lower long, upper long")
    got = sorted(map(tuple, ranges.overlapping(reg).collect()))
    assert got == [("t", 4, 9), ("u", 2, 3), ("u", 40, 60)]


def test_empty_and_hidden_files_are_parts_too(spark, tmp_path):
    for name, size in (("a.txt", 5), ("sub/_x.txt", 3), ("sub/.y.txt", 2), ("sub/deep/empty.txt", 0),
                       ("sub/z.other", 9), ("_temporary/0/t.txt", 7), ("with space/b c.txt", 4)):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    listed = files.list_files(spark, str(tmp_path), ".txt")
    sizes = {r.path.rsplit("/", 1)[-1]: r.length for r in listed.collect()}
    assert sizes == {"a.txt": 5, "_x.txt": 3, ".y.txt": 2, "empty.txt": 0, "b c.txt": 4}
    parts = {(r.file.rsplit("/", 1)[-1], r.cur_part): bytes(r.data)
             for r in files.file_parts(listed, 4).collect()}
    assert parts == {("a.txt", 1): b"xxxx", ("a.txt", 2): b"x", ("_x.txt", 1): b"xxx",
                     (".y.txt", 1): b"xx", ("empty.txt", 1): b"", ("b c.txt", 1): b"xxxx"}
    assert [r.path.rsplit("/", 1)[-1] for r in files.list_files(
        spark, str(tmp_path), ".txt", recursive=False).collect()] == ["a.txt"]


def test_exports_are_files_of_the_size_asked_for(spark):
    narrow = spark.range(400_000).select("id")
    wide = spark.range(100_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"),
                                       F.md5(F.col("id").cast("string")).alias("m"))
    for df, size in ((narrow, 400_000), (wide, 1_500_000)):
        path = scratch(spark, "sized")
        n = tables.export_sized(df, path, size)
        lengths = [r.length for r in files.list_files(spark, path).collect()]
        assert len(lengths) == n > 2 and all(0.75 * size <= x <= 1.25 * size for x in lengths), lengths
        assert spark.read.parquet(path).exceptAll(df).isEmpty()
        assert spark.read.parquet(path).count() == df.count()


def test_a_send_is_counted_by_the_job_that_writes(spark):
    rows = spark.range(500).select("id", F.concat(F.lit("name"), "id").alias("name"))
    sent = sync.send(rows, F.col("id") % 2, F.col("id"), append_header("t", batch_id="b"), "topic",
                     F.current_timestamp(), 2, limit=1000)
    path = scratch(spark, "counted")
    got = topics.publish_counted(sent, path)
    back = topics.read_topic(spark, path)
    assert got == {"messages": back.count(), "rows": 500,
                   "bytes": back.agg(F.sum(F.octet_length("data"))).first()[0]}
