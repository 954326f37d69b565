"""The parallel fold against a plain loop over the rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.operators.fold import Folder, Rule, assembled, sequential_groups

SCHEMA = "lane long, ord long, w long, hard boolean"


def plain(rows, limit, when, seed=0):
    """(lane, ord) -> group by walking each lane in order."""
    out = {}
    for lane in {r[0] for r in rows}:
        group, size, opened, since = -1, None, False, None
        for _, order, w, hard in sorted(r for r in rows if r[0] == lane):
            if when == "timer":
                start = since is None or w >= since + limit
                since = w if start else since
            elif when == "before":
                start = size is None or hard or size + w >= limit
                size = seed + w if start else size + w
            else:
                start = not opened or hard
                size = w if start else size + w
                opened = size < limit
            group += start
            out[lane, order] = group
    return out


def make(n, lanes, seed, weights=(0, 40), hard=0.0, clock=False):
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(n):
        now += rng.randint(-3, 9)
        rows.append((rng.choice([0] * 3 + list(range(lanes))), i * rng.choice([1, 1, 3]) + i,
                     now if clock else rng.randint(*weights), rng.random() < hard))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("when,limit,seed,weights,hard", [
    ("before", 100, 0, (0, 40), 0.0),
    ("before", 100, 1, (1, 140), 0.0),
    ("before", 100000, 0, (0, 40), 0.0),
    ("after", 50, 0, (1, 5), 0.0),
    ("after", 50, 0, (0, 80), 0.1),
    ("before", 60, 0, (1, 20), 0.05),
])
@pytest.mark.parametrize("span", [40, 10**6])
def test_groups_match_plain_loop(spark, when, limit, seed, weights, hard, span):
    rows = make(300, 3, seed=limit + span, weights=weights, hard=hard)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sequential_groups(df, "lane", "ord", "w", limit, when, seed,
                            hard="hard", span=span).collect()
    assert {(r.lane, r.ord): r.grp for r in got} == plain(rows, limit, when, seed)
    assert len(got) == len(rows)


@pytest.mark.parametrize("span", [30, 10**6])
def test_timer_matches_plain_loop(spark, span):
    rows = make(250, 3, seed=span, clock=True)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sequential_groups(df, "lane", "ord", "w", 37, "timer", span=span).collect()
    assert {(r.lane, r.ord): r.grp for r in got} == plain(rows, 37, "timer")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 50),
       st.sampled_from(["before", "after"]), st.integers(1, 9), st.data())
def test_block_summary_is_exact_for_every_entering_state(weights, limit, when, cut, data):
    """Folding a block from a summary equals folding it behind a real prefix."""
    hard = [data.draw(st.booleans()) if data.draw(st.integers(0, 9)) == 0 else False
            for _ in weights]
    rows = [(0, i, w, h) for i, (w, h) in enumerate(zip(weights, hard))]
    expected = plain(rows, limit, when)
    rule = Rule(when, limit)
    state, following, got = None, 0, {}
    for a in range(0, len(weights), cut):
        w, h = np.array(weights[a:a + cut]), np.array(hard[a:a + cut])
        at, threshold, leaves, starts, shift = rule.summarise(w, h, 0)
        i = 0 if state is None else int(np.searchsorted(-threshold, -state))
        if i < len(at):
            got[a + int(at[i])] = following
            following += int(starts[i])
            state = int(leaves[i])
        else:
            state += shift
    for pos, group in got.items():
        assert expected[0, pos] == group
        assert pos == 0 or expected[0, pos - 1] == group - 1
    assert following == expected[0, len(weights) - 1] + 1


@pytest.mark.parametrize("span", [50, 10**6])
def test_assembled_keeps_every_row_in_order_and_below_the_limit(spark, span):
    rng = random.Random(3)
    rows = [(i % 3 if i % 2 else 0, i, "é" * rng.randint(0, 30) + str(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "lane long, ord long, enc string").repartition(6)
    got = assembled(df, "lane", "ord", "enc", limit=200, span=span).collect()
    expected = plain([(a, b, len(c.encode()), False) for a, b, c in rows], 200, "before")
    seen = []
    for m in sorted(got, key=lambda m: (m.lane, m.msg)):
        assert m.n_rows == len(m.rows)
        assert m.n_bytes == sum(len(x.encode()) for x in m.rows)
        assert m.n_rows == 1 or m.n_bytes < 200
        mine = [b for a, b, _ in rows if a == m.lane and expected[a, b] == m.msg]
        assert m.first_order == min(mine)
        seen += [(m.lane, x) for x in m.rows]
    assert seen == [(a, c) for a, b, c in sorted(rows)]


def test_folder_state_survives_batch_borders():
    rule = Rule("before", 10)
    w = np.array([4, 4, 4, 4, 9, 1, 1])
    whole = Folder(rule).starts(*[np.zeros(7, int)] * 3, w, np.zeros(7, bool))
    split = Folder(rule)
    at, groups = [], []
    for a, b in ((0, 2), (2, 3), (3, 7)):
        z = np.zeros(b - a, int)
        x, g = split.starts(z, z, z, w[a:b], z.astype(bool))
        at += [a + i for i in x]
        groups += g
    assert (at, groups) == whole


def test_rejects_unknown_rule():
    with pytest.raises(ValueError):
        Rule("sometimes", 3)


@pytest.mark.parametrize("row", [(None, 1, 1, False), (0, None, 1, False)])
def test_rows_without_a_place_stop_the_job(spark, row):
    df = spark.createDataFrame([row, (0, 5, 1, False)], SCHEMA)
    with pytest.raises(PySparkException, match="must not be null"):
        sequential_groups(df, "lane", "ord", "w", 10).collect()


def test_groups_with_a_third_of_all_rows_in_one_lane(spark):
    """The hot lane is spread over blocks: no partition of the sorted rows holds it whole."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("lane"),
        F.col("id").alias("ord"), F.lit(7).cast("long").alias("w"))
    got = sequential_groups(df, "lane", "ord", "w", 100, span=1000)
    agg = got.groupBy("lane", "grp").agg(F.count("*").alias("n"), F.sum("w").alias("s"))
    assert agg.where("s >= 100").count() == 0
    assert agg.agg(F.sum("n")).first()[0] == 30000
    hot = agg.where("lane = 0").count()
    n = df.where("lane = 0").count()
    assert hot == -(-n // 14)
