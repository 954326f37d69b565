"""Divergence of sources against plain Python, and the joint tables against counting."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, total int"


def plain(rows, min_docs=3, scale=10**9, top=200):
    """The whole audit by its definition."""
    docs = [(r[2] or "", r[3] or "", re.findall(
        "[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or "")))
        for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in seen.items() if n >= min_docs]
        counts = {s: Counter() for s in {d[1] for d in docs if d[0] == lang}}
        for d in docs:
            if d[0] == lang:
                counts[d[1]].update(t for t in d[2] if t in set(kept))

        def p(count, total):
            return 1 + scale * (count + 1) // (total + len(kept))

        whole = sum(counts.values(), Counter())
        q = {t: p(whole[t], sum(whole.values())) for t in kept}
        ps = {s: {t: p(c[t], sum(c.values())) for t in kept} for s, c in counts.items()}
        for s in counts:
            pairs = [(o, sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept))
                     for o in counts if o != s]
            terms = [(t, (ps[s][t] - q[t]) ** 2 // q[t]) for t in kept
                     if counts[s][t] and ps[s][t] > q[t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1)
                        for i, (item, value) in enumerate(found[:last])]
    return sorted(out)


def audited(spark, rows, **options):
    df = divergence.audit(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n, sources=5):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(60)]
    return [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 40))),
             rng.choice(["en", "de"]), f"s{int(rng.random() ** 3 * sources)}", 1, "x", 2)
            for i in range(n)]


NASTY = [(1, None, None, None, 0, "", 0), (2, "", "", "b", 0, "", 0), (None, "Ab ab, AB", None, "b", 0, "", 0),
         (3, "ab", "", None, 0, "", 0), (3, "ab", "", None, 0, "", 0), (4, "ÄB äb \x85 Σ", "xx", "one", 0, "", 0),
         (5, "zz " * 5000 + "q" * 20000, "yy", "a", 0, "", 0), (6, "zz", "yy", "ä", 0, "", 0),
         (7, "zz", "yy", "B", 0, "", 0), (8, "123 _-", "yy", "none", 0, "", 0)]


@pytest.mark.parametrize("rows", [corpus(1, 80), corpus(2, 300, 12), NASTY, NASTY + corpus(3, 40)],
                         ids=["some", "more", "nasty", "both"])
def test_audit_is_that_of_its_definition(spark, rows):
    assert audited(spark, rows) == plain(rows)


def test_top_and_minimum_are_parameters(spark):
    rows = corpus(4, 60)
    assert audited(spark, rows, min_docs=5, scale=1000, top=3) == plain(rows, 5, 1000, 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(df).collect() == []


def test_parts_of_long_texts_and_small_blocks_change_nothing(spark, monkeypatch):
    rows = corpus(5, 120)
    want = plain(rows)
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", 40)
    assert audited(spark, rows) == want
    text = b"ab cd  efg " * 50 + b"x" * 99
    parts = list(divergence._parts(text, 16))
    assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def tables_of(levels, columns):
    out = Counter()
    for a, level, b, other, n in divergence.joint_tables(levels, columns):
        for cell in zip(a.tolist(), level.tolist(), b.tolist(), other.tolist(), n.tolist()):
            out[cell[:4]] += cell[4]
    return out


@pytest.mark.parametrize("columns", [2, 5, 16, 1024])
def test_joint_tables_count_terms(columns):
    rng = np.random.default_rng(columns)
    levels = rng.poisson(1.5, (37, 6)) * rng.integers(0, 9, (37, 1))
    want = Counter((a, int(r[a]), b, int(r[b])) for r in levels
                   for a, b in itertools.combinations(range(6), 2))
    assert tables_of(levels, columns) == want


def test_joint_tables_without_terms_have_every_pair():
    got = tables_of(np.zeros((0, 3), np.int64), 8)
    assert set(got) == {(0, 0, 1, 0), (0, 0, 2, 0), (1, 0, 2, 0)} and not any(got.values())


def test_each_pair_of_a_language_covers_all_its_terms(spark):
    docs = spark.createDataFrame(corpus(6, 200), SCHEMA)
    kept = divergence.kept_counts(docs)
    sums = divergence.joint_counts(kept, divergence.groups_of(docs)).groupBy(
        "lang", "source", "other").agg(F.sum("n_terms").alias("n"))
    terms = {r.lang: r.n for r in kept.groupBy("lang").agg(
        F.count_distinct("term").alias("n")).collect()}
    assert all(r.n == terms[r.lang] for r in sums.collect())
