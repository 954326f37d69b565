"""Packing, flushing, files."""

import hashlib
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.operators import chunks as ch, flush, pack
from tableferry.sources import files, topics


def encoded(spark, texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)],
                                 "lane long, ord long, enc string")


def test_limit_is_checked_before_adding_and_includes_equality(spark):
    df = encoded(spark, ["a" * 4, "b" * 5, "c", "d" * 10, "e"])
    got = pack.pack_messages(df, limit=10).orderBy("msg").collect()
    assert [m.rows for m in got] == [["a" * 4, "b" * 5], ["c"], ["d" * 10], ["e"]]


def test_oversize_rows_are_set_aside_or_stop_the_job(spark):
    df = encoded(spark, ["ok", "x" * 11, "é" * 6])
    assert [r.row_bytes for r in pack.oversize(df, 10).orderBy("ord").collect()] == [11, 12]
    assert [m.rows for m in pack.pack_messages(df, limit=10).collect()] == [["ok"]]
    with pytest.raises(PySparkException, match="row exceeds 10 bytes"):
        pack.pack_messages(df, limit=10, strict=True).collect()


def test_no_rows_give_no_messages(spark):
    none = encoded(spark, ["a"]).where("ord < 0")
    assert pack.pack_messages(none).count() == 0
    assert pack.pack_json_array(none).count() == 0


def test_json_messages_are_valid_and_below_the_limit(spark):
    rng = random.Random(5)
    texts = [json.dumps([i, "x" * rng.randint(0, 20)]) for i in range(200)]
    got = pack.pack_json_array(encoded(spark, texts), limit=128, span=64).orderBy("msg").collect()
    assert [json.dumps(r) for m in got for r in json.loads(m.data)] == texts
    assert all(len(m.data) <= 128 for m in got if m.n_rows > 1)


def replayed(rows, limit, interval, idle):
    """(lane, msg_id, seconds, n) -> group by walking each lane."""
    out = {}
    for lane in {r[0] for r in rows}:
        group, held, timer, last, is_open = -1, 0, None, None, False
        for _, msg, t, n in sorted(r for r in rows if r[0] == lane):
            timer = t if timer is None else timer
            if is_open and last is not None and t - last >= idle:
                is_open = False
            if not is_open:
                group, held, is_open = group + 1, 0, True
            held += n
            out[lane, msg] = group
            if held >= limit:
                is_open = False
            if t - timer >= interval:
                is_open, timer = False, t
            last = t
    return out


@pytest.mark.parametrize("span", [40, 10**6])
def test_timed_flush_matches_a_replay(spark, span):
    rng = random.Random(span)
    rows, now = [], 0
    for i in range(260):
        now += rng.choice([-2, 0, 1, 2, 3, 20])
        rows.append((rng.choice([0, 0, 1]), i, now, rng.randint(1, 9)))
    df = spark.createDataFrame(rows, "lane long, msg_id long, s long, n long").withColumn(
        "at", F.timestamp_seconds("s"))
    got = flush.flush_by_time(df, "n", "at", 25, 30, 15, span=span).collect()
    assert {(r.lane, r.msg_id): r.grp for r in got} == replayed(rows, 25, 30, 15)


def content(spark, sizes):
    rng = random.Random(9)
    rows = [(f"dir/f{i}.bin", rng.randbytes(n)) for i, n in enumerate(sizes)]
    return rows, spark.createDataFrame(rows, "path string, content binary")


@pytest.mark.parametrize("segment", [32, 10**6])
def test_files_come_back_whole_in_segments(spark, segment):
    rows, df = content(spark, [0, 1, 16, 17, 160, 333])
    sent = ch.cut(df, "content", "path", 16).withColumn("msg_id", F.expr("uuid()")).withColumn(
        "msg_id", F.xxhash64("file", "cur_part"))
    twice = sent.unionByName(sent).repartition(5)
    got = ch.reassemble(twice, 16, segment).orderBy("file", "segment").collect()
    whole = {}
    for r in got:
        assert len(r.data) <= max(segment, 16)
        whole[r.file] = whole.get(r.file, b"") + bytes(r.data)
    assert whole == {p: bytes(c) for p, c in rows}
    if segment == 32:
        assert max(r.segment for r in got) == 10


def test_last_delivery_of_a_part_counts_and_damage_does_not(spark):
    data = [("f", 1, 2, b"old", 1), ("f", 1, 2, b"new", 2), ("f", 2, 2, b"end", 3),
            ("g", 1, 1, b"bad", 4)]
    df = spark.createDataFrame(data, "file string, cur_part int, total_parts int, data binary,"
                                     " msg_id long")
    df = df.withColumn("sync_id", F.md5("file")).withColumn(
        "md5_checksum", F.when(F.col("file") == "g", "0").otherwise(F.md5("data")))
    got = ch.reassemble(df).collect()
    assert [(r.file, bytes(r.data)) for r in got] == [("f", b"newend")]
    assert [(r.file, r.n_parts) for r in ch.incomplete(df).collect()] == [("g", 0)]
    assert [(r.file, r.cur_part) for r in ch.missing_parts(df).collect()] == [("g", 1)]


def test_header_styles(spark):
    _, df = content(spark, [40])
    zero = ch.cut(df, "content", "path", 16, 0, "batch").orderBy("cur_batch").collect()
    assert [(r.file, r.cur_batch, r.total_batch) for r in zero] == [
        ("dir/f0.bin", i, 3) for i in range(3)]
    named = ch.cut(df, "content", "path", 16, header_style="named")
    assert named.columns == ["file", "_seq", "data"] and named.first().file == "f0.bin"
    with pytest.raises(ValueError):
        ch.cut(df, "content", "path", header_style="other")


def test_named_chunks_append_until_the_end_mark(spark):
    df = spark.createDataFrame(
        [(0, 1, "a", b"one "), (0, 2, "b", b"x"), (0, 3, "a", b"two"), (0, 4, None, b"END_SIGN"),
         (0, 5, "a", b"late")], "lane long, msg_id long, file string, data binary")
    until = topics.until_end(df, data=F.decode("data", "UTF-8")).where("file is not null")
    got = {r.file: bytes(r.data) for r in ch.append_by_name(until, span=100).collect()}
    assert got == {"a": b"one two", "b": b"x"}


def test_files_on_disk_are_read_in_parts(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    blobs = {"a.parquet": b"x" * 100, "sub/b.parquet": bytes(range(256)), "c.txt": b"no",
             "e.parquet": b""}
    for name, data in blobs.items():
        (tmp_path / name).write_bytes(data)
    top = files.list_files(spark, str(tmp_path), recursive=False)
    assert [r.path.split("/")[-1] for r in top.collect()] == ["a.parquet"]
    listed = files.list_files(spark, str(tmp_path))
    parts = files.file_parts(listed, 64, tasks=3).collect()
    got = {}
    for r in sorted(parts, key=lambda r: (r.file, r.cur_part)):
        assert r.md5_checksum == hashlib.md5(r.data).hexdigest()
        assert r.sync_id == hashlib.md5(r.file.encode()).hexdigest()
        got[r.file.split("/")[-1]] = got.get(r.file.split("/")[-1], b"") + bytes(r.data)
    assert got == {k.split("/")[-1]: v for k, v in blobs.items() if k not in ("c.txt", "e.parquet")}
