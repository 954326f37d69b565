"""Blocked numbering, previous row and as-of lookup against plain windows and loops."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tableferry.operators import blocks

SPANS = [13, 10**6]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-400, 2000), 500)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randint(0, 3)) for i in ids]
    return spark.createDataFrame(data, "g string, o long, v int").repartition(4).cache()


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("by", [[], ["g"]])
def test_numbers(rows, by, span):
    want = rows.withColumn("row_no", F.row_number().over(Window.partitionBy(*by).orderBy("o")))
    got = blocks.numbered(rows, "o", by, span)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("span", SPANS)
def test_previous(rows, span):
    w = Window.partitionBy("g").orderBy("o")
    want = rows.select("g", "o", "v", F.lag("o").over(w).isNotNull().alias("prev_seen"),
                       F.lag("v").over(w).alias("prev_v"), F.lag("o").over(w).alias("prev_o"))
    got = blocks.with_previous(rows, ["g"], "o", ["v", "o"], span)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("span", SPANS)
def test_batches_hold_exactly_n_rows(rows, span):
    sizes = [r[1] for r in blocks.row_batches(rows, "o", 120, span=span)
             .groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [120] * 4 + [20]


@pytest.mark.parametrize("span", SPANS)
def test_latest_mark_at_or_below_a_key(spark, span):
    rng = random.Random(2)
    marks = [("x", m, m * 10) for m in rng.sample(range(0, 500), 20)] + [("y", 100, 1)]
    probes = [(rng.choice("xyz"), rng.randint(-20, 600)) for _ in range(300)]
    got = blocks.latest_upto(spark.createDataFrame(probes, "t string, k long"), "k",
                             spark.createDataFrame(marks, "t string, m long, v long"), "m",
                             ["m", "v"], ["t"], span).collect()
    want = {}
    for t, k in probes:
        below = [(m, v) for a, m, v in marks if a == t and m <= k]
        if below:
            want[t, k] = max(below)
    assert {(r.t, r.k): (r.m, r.v) for r in got} == want
    assert len(got) == len(want)


def test_dense_order_follows_any_sort_key_and_fills_blocks(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), f"{rng.random():.12f}", i) for i in range(400)]
    df = spark.createDataFrame(data, "g string, key string, i int").repartition(4)
    got = blocks.dense_order(df, ["key", "i"]).orderBy("ord").collect()
    assert [(r.key, r.i) for r in got] == sorted((k, i) for _, k, i in data)
    assert len({r.ord // 1_000_000 for r in got}) <= spark.sparkContext.defaultParallelism * 2


def test_blocks_by_rank_are_full_whatever_the_order(spark, monkeypatch):
    rng = random.Random(7)
    ids = [*range(3000), *(rng.randrange(-2**62, 2**62) for _ in range(3000)),
           *(2**40 + i * 10**9 for i in range(3000))]
    lanes = ["hot" if rng.random() < 0.9 else rng.choice(["a", "b", None]) for _ in ids]
    df = spark.createDataFrame(list(zip(lanes, ids)), "g string, o long").repartition(4)
    for fan in (256, 4):  # one level of cuts, and several
        monkeypatch.setattr(blocks, "FAN", fan)
        cut = blocks.blocked(df, ["g"], "o", blocks.Ranked(100)).toPandas()
        sizes = cut.groupby(["g", "_block"], dropna=False).size()
        assert len(cut) == len(ids) and sizes.max() <= 130
        assert len(sizes) <= 4 + 2.1 * len(ids) / 100
        for _, part in cut.groupby("g", dropna=False):
            assert part.sort_values("o")["_block"].is_monotonic_increasing
    assert blocks.blocked(df.limit(0), ["g"], "o", blocks.Ranked(100)).count() == 0
    with pytest.raises(ValueError):
        blocks.blocked(df, [], "o", blocks.Ranked(100))


def test_numbers_and_previous_rows_in_blocks_by_rank(rows):
    for f in (lambda s: blocks.numbered(rows, "o", ["g"], s),
              lambda s: blocks.with_previous(rows, ["g"], "o", ["v"], s)):
        assert sorted(f(blocks.Ranked(20)).collect(), key=str) == sorted(
            f(10**6).collect(), key=str)
