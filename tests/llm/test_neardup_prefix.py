"""Prefixes by true frequencies lose no pair: compared with all pairs, in plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tableferry.llm import neardup


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} - {()})


def alike(x: set, y: set) -> bool:
    return bool(x | y) and 100 * len(x & y) >= 75 * len(x | y)


def corpus() -> list[tuple[int, str]]:
    """Edited copies, a passage in most texts, repeated rows, an id of two texts, no words."""
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]

    passage, rows = words(40), []
    for base in range(16):
        own = words(60)
        for copy in range(4):
            edited = list(own)
            for _ in range(copy):
                edited[rng.randrange(60)] = rng.choice(words(1))
            rows.append((10 * base + copy, " ".join(passage * (base % 3 > 0) + edited)))
    rows += [(200 + i, " ".join(passage + words(rng.randrange(4, 90)))) for i in range(30)]
    rows += [rows[0], rows[0], (20, rows[30][1]), (300, ""), (301, None), (302, "one"),
             (303, "one")]
    return rows


def met(frame) -> set:
    first = frame.select("shingle", "doc_id").collect()
    by: dict = {}
    for r in first:
        by.setdefault(r.shingle, set()).add(r.doc_id)
    return {(a, b) for ids in by.values() for a in ids for b in ids if a < b}


def test_prefixes_meet_in_every_pair(spark):
    rows = corpus()
    chosen = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "component", F.col("doc_id")).withColumn("node", F.monotonically_increasing_id())
    got = met(neardup.rarest(chosen))
    sets = [(i, shingles(t or "")) for i, t in rows]
    true = {(a, b) for a, x in sets for b, y in sets if a < b and alike(x, y)}
    assert len(true) > 40 and true <= got
    # texts that only share the passage do not meet
    assert len(got) < 3 * len(true)


def test_one_component_and_no_rows_meet_nobody(spark):
    schema = "node long, doc_id long, component long, text string"
    same = spark.createDataFrame([(1, 1, 1, "a b c d e f"), (2, 2, 1, "a b c d e f")], schema)
    assert neardup.rarest(same).count() == 0
    assert neardup.rarest(same.where("false")).count() == 0
