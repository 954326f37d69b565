"""Corpus operators against brute force, libraries, and the cases that break them."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import (bpe, components, langid, mixing, neardup, quality, repeats, sharding,
                            topk, toxicity, winnow)
from tableferry.llm.common import WordHasher

DOCS = "doc_id long, text string, source string, ids string, _n int, kept string"
NASTY = ["", None, " \t\n", "a", "It's  the DON'T x\u0085y\u001cz 12345 ?!…", "Σίσυφος ΑΣ İstanbul",
         "é ẛ̣ ﬁ 한국어 ไทย 👩‍👩‍👧", "<|endoftext|>x <|startoftext|> <|endof", "x" * 3000,
         "word " * 4000, "same text here now again", "same text here now again"]


@pytest.fixture(scope="module")
def nasty(spark):
    rows = [(i, t, "s" if i % 2 else None, "clash", 7, "clash") for i, t in enumerate(NASTY)]
    return spark.createDataFrame(rows + [rows[3], (None, "no id", "s", "", 1, "")], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def merges():
    import public_tokenizers
    return bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))


def words(text):
    return [w for w in (text or "").encode().split()]


def test_ids_are_those_of_the_library(spark, nasty, merges):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    every = "".join(f"a{chr(c)}b " for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000)
    docs = nasty.unionByName(spark.createDataFrame([(99, every, "", "", 0, "")], DOCS))
    for lexicon_words in (3, 1000):
        got = bpe.decode(bpe.encode(docs, merges, lexicon_words=lexicon_words), merges).collect()
        assert len(got) == len(NASTY) + 3
        for r in got:
            want = library.encode(r.text or "", add_special_tokens=False).ids
            assert r.ids == want
            assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_transducer_holds_its_words_only_and_shares_endings(merges):
    entries = {a + b: merges.merge(a + b) for a in ("re", "un", "pre", "x") for b in
               ("form", "forming", "formed", "formation")}
    blob = bpe.Transducer.compiled(entries)
    found = bpe.Transducer(blob)
    assert all(found.get(w) == ids for w, ids in entries.items())
    assert all(found.get(w) is None for w in ("", "r", "reform!", "preforms", "formed", "é"))
    assert len(found.finals) < 30
    assert bpe.Transducer(bpe.Transducer.compiled({})).get("a") is None


def test_long_and_short_merges_agree(merges):
    rng = random.Random(3)
    for _ in range(50):
        word = "".join(rng.choice("abeinorst") for _ in range(rng.randint(1, 60)))
        ids = [merges.inner[b] for b in word.encode()]
        ids[-1] = merges.final[word.encode()[-1]]
        assert merges._merge_long(ids) == merges.merge(word)


def test_merging_and_finding_many_words_is_as_one_by_one(merges):
    rng = random.Random(4)
    words = ["".join(rng.choice("abeinorsté日") for _ in range(rng.randint(1, 40)))
             for _ in range(800)] + ["a", "é", "aaaa" * 60, "on" * 300]
    assert [x.tolist() for x in merges.merge_all([w.encode() for w in words])] == [
        merges.merge(w) for w in words]
    assert merges.merge_all([]) == []
    kept = {w: merges.merge(w) for w in words[::3]}
    found = bpe.Transducer(bpe.Transducer.compiled(kept)).find([w.encode() for w in words])
    assert [x and x.tolist() for x in found] == [kept.get(w) for w in words]


def test_mixture_keeps_its_limits(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{int(math.sqrt(i)) % 7}", "", 0, "") for i in range(3000)]
    docs = spark.createDataFrame(rows + [rows[5], (9001, None, "s1", "", 0, ""),
                                         (9002, "x", None, "", 0, "")], DOCS)
    plan = mixing.planned(docs, max_repeats=3.0).toPandas()
    assert (plan[plan["pass"] == 1].groupby("doc_id").size().sum()) == 3003
    once = plan[plan["pass"] == 1].groupby("source", dropna=False).tokens.sum()
    read = plan.groupby("source", dropna=False).tokens.sum()
    rate = read / once
    assert abs(rate.max() / rate.min() - 3) < 0.1 and rate.min() == 1
    counted = docs.select("source", mixing.token_count().alias("tokens"))
    half = mixing.source_budgets(counted, None, 2.0).toPandas()
    p = half.budget / half.budget.sum()
    assert -(p[p > 0] * np.log(p[p > 0])).sum() <= 2.0 + 1e-2
    assert mixing.mixed_documents(docs).columns == docs.columns
    with pytest.raises(ValueError):
        mixing.source_budgets(counted, None, None)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (None, [1.0] * 6),
             (303, []), (304, [3e30] * 6), (305, [1.0, 1.0]), (50, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.quantised(df, "vec_id", "embedding", 256)
    got = {}
    for r in topk.top_k(vectors.where("id % 50 = 0"), vectors, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ok = [(i, [math.floor(256 * x) for x in np.array(v, np.float32).tolist()]) for i, v in rows
          if i is not None and v is not None and all(x is not None and x == x for x in v)]
    want = {}
    for q, v in ok:
        if q % 50 == 0:
            best = sorted(((max(min(sum(a * b for a, b in zip(v, c)), 2**63 - 1), -2**63), i)
                           for i, c in ok if i != q), key=lambda x: (-x[0], x[1]))[:5]
            want.setdefault(q, []).extend((n, i, s) for n, (s, i) in enumerate(best, 1))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    none = vectors.where("id < 0")
    assert topk.top_k(none, vectors).count() == 0 and topk.top_k(vectors, none).count() == 0


def test_toxicity_finds_misspelling_and_spares_quotation():
    rng = random.Random(2)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]

    def text(term=None):
        body = rng.sample(plain, 20)
        return " ".join(body[:10] + ([term] if term else []) + body[10:])

    sample = [(text(rng.choice(["grobnik", "zandork"])), 1) for _ in range(200)] \
        + [(text(), 0) for _ in range(400)]
    model = toxicity.ToxicityModel(sample)
    scorer = toxicity.Scorer(model)
    clean, exact, misspelt, disguised, quoted = scorer.scores([
        text(), text("grobnik!"), text("grobnnik"), text("GR0BNIK"), text('"grobnik"')])
    assert clean < 0.2 and min(exact, misspelt, disguised) > 0.5 and quoted < 0.5
    assert scorer.lexicon.match("grobnxxik") == 0 and scorer.lexicon.match("robnik") > 0
    assert toxicity.ToxicityModel([]).terms == {}


def test_every_rare_term_forgives_an_error():
    rng = random.Random(12)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    terms = ["".join(rng.choice("klmnoprstuvz") for _ in range(8)) for _ in range(40)]

    def text(term=None):
        body = rng.sample(plain, 20)
        return " ".join(body[:10] + ([term] if term else []) + body[10:])

    model = toxicity.ToxicityModel([(text(terms[i % 40]), 1) for i in range(400)]
                                   + [(text(), 0) for _ in range(800)])
    scorer = toxicity.Scorer(model)
    misspelt = [t[:4] + "x" + t[5:] for t in terms]  # each term is in 2.5 percent of toxic texts
    assert min(scorer.scores([text(t) for t in misspelt])) > 0.5
    assert max(scorer.scores([text(t[:3] + "xxx" + t[6:]) for t in terms])) < 0.2


def test_short_terms_and_stems_keep_their_own_budget():
    lexicon = toxicity.Lexicon({"abcd": 2.0, "abcdefg": 1.0}, {"mnop": 3.0, "mnopqrs": 1.0},
                               {"abcdefg", "mnopqrs"})
    assert [lexicon.match(w) for w in ("abcd", "abxd", "abcdexg", "abxdexg")] == [2.0, 0, 0.8, 0]
    assert [lexicon.match(w) for w in ("mnopz", "mnxpz", "mnxpqrsz")] == [3.0, 0, 0.8]


def test_lexicon_walk_is_levenshtein():
    lexicon = toxicity.Lexicon({"abcde": 1.0, "abxde": 2.0}, {}, {"abcde", "abxde"})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _next(row, x, b, i)
        return row[-1]

    def _next(row, x, b, i):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    for letters in itertools.product("abcdex", repeat=5):
        word = "a" + "".join(letters)[:4]
        near = min(distance(word, "abcde"), distance(word, "abxde"))
        assert (lexicon.match(word) > 0) == (near <= 1)


def test_lexicon_walk_equals_brute_force_at_any_first_letter():
    rng = random.Random(9)
    terms = {"grobnik": 3.0, "abcde": 2.0, "aabbcc": 2.5, "bcde": 1.0, "cabbage": 1.5, "eabcd": 1.2}
    stems = {"acedb": 2.2, "dcba": 0.7, "bbadca": 1.7}
    lexicon = toxicity.Lexicon(terms, stems, {t for t in terms | stems if len(t) >= 5})

    def one_off(word, swaps):
        letters = "abcdegiknorx"
        out = {word[:i] + word[i + 1:] for i in range(len(word))}
        out |= {word[:i] + c + word[i + k:] for i in range(len(word) + 1) for c in letters
                for k in (0, 1)}
        if swaps:
            out |= {word[:i] + word[i + 1] + word[i] + word[i + 2:] for i in range(len(word) - 1)}
        return out

    near = {t: one_off(t, len(t) >= 6) if len(t) >= 5 else {t} for t in terms | stems}

    def brute(word):
        best = 0.0
        for t, w in terms.items():
            best = max(best, w if word == t else 0.8 * w if word in near[t] else 0.0)
        for s, w in stems.items():
            best = max(best, w if word.startswith(s) else
                       0.8 * w if any(word[:k] in near[s] for k in range(len(word) + 1)) else 0.0)
        return best

    tried = {"".join(w) for n in range(6) for w in itertools.product("abcde", repeat=n)}
    for t in sorted(terms | stems):
        tried |= one_off(t, True) | set(rng.sample(
            sorted(x for y in one_off(t, True) for x in one_off(y, True)), 2000))
    assert {w: lexicon.match(w) for w in tried} == {w: brute(w) for w in tried}
    for word in ("robnik", "xgrobnik", "probnik", "rgobnik", "grobnki"):
        assert lexicon.match(word) == 0.8 * 3.0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    lengths = [0, 1, 2, 5, 6, 3, 0]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(starts[-1], 3))
    labels = langid.viterbi(scores, starts, 0.7)
    for a, b in zip(starts, starts[1:]):
        def value(path):
            return sum(scores[a + i, s] for i, s in enumerate(path)) \
                - 0.7 * sum(x != y for x, y in zip(path, path[1:]))
        best = max(map(value, itertools.product(range(3), repeat=int(b - a))))
        assert abs(value(labels[a:b].tolist()) - best) < 1e-9
        if b > a:
            assert abs(value(langid.viterbi_one(scores[a:b].tolist(), 0.7)) - best) < 1e-9


def test_languages_of_spans_and_scripts(spark, nasty, empty):
    sample = [("the cat and the dog with this house", "en"), ("der hund und die katze mit dem haus", "de"),
              ("кошка и собака в этом доме", "ru")] * 5
    model = langid.LanguageModel(sample)
    docs = spark.createDataFrame([(1, "the dog and the house der hund und die katze mit dem haus und die"),
                                  (2, "собака и дом"), (3, "123 ..."), (4, None), (5, "한국어")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identified(docs, model, penalty=3.0).collect()}
    assert got[1].lang_pred == "de" and [s.lang for s in got[1].spans] == ["en", "de"]
    assert got[2].lang_pred == "ru" and got[2].score == 1.0
    assert got[3].lang_pred == got[4].lang_pred == "und" and got[3].score == 0
    assert got[5].lang_pred in model.langs
    assert langid.identified(nasty, model).count() == nasty.count()
    assert langid.identified(empty, langid.fitted(empty.withColumn("lang", F.lit("x")))).count() == 0


def test_shards_keep_copies_together(spark, nasty, empty):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 400), "", "", 0, "") for i in range(2000)] \
        + [(5000 + i, "copy", "", "", 0, "") for i in range(700)]
    docs = nasty.unionByName(spark.createDataFrame(rows, DOCS))
    out = sharding.shard_documents(docs).toPandas()
    assert len(out) == docs.count()
    assert out.groupby("group_key").shard.nunique().max() == 1
    assert all(sorted(x.slot) == list(range(len(x))) for _, x in out.groupby("shard"))
    sums = out.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 4200 and len(sums) == 16  # one text is 20,000 bytes
    assert set(out[out.text_crc32 == zlib.crc32(b"copy")]["size"]) == {5}
    assert sharding.shard_documents(empty).count() == 0


def test_differencing_halves_a_known_set():
    parts = [([0, x], [None, (x, 0, x)]) for x in (8, 7, 6, 5, 4)]
    sums, trees = sharding.differenced(parts, 2)
    assert sums == [14, 16]
    assert sorted(x for t in trees for x, _, _ in sharding.leaves(t)) == [4, 5, 6, 7, 8]


def brute_repeats(docs, window=13):
    first = {}
    for i, t in sorted(docs):
        w = words(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(13, 60))] for _ in range(6)]
    docs = []
    for i in range(150):
        w = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.4:
                w += rng.choice(passages)
            elif kind < 0.5:
                w += ["run"] * rng.randint(5, 200)
            elif kind < 0.6:
                w += ["a", "b"] * rng.randint(5, 30)
            else:
                w += [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]
        docs.append((i * 3, " ".join(w)))
    docs += [(1000, None), (1001, ""), (1002, " \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in repeats.without_repeats(df).collect()}
    assert got == brute_repeats(docs)


def test_repeats_of_odd_tables(nasty, empty):
    out = repeats.without_repeats(nasty).toPandas()
    assert len(out) == nasty.count() and out.n_removed.sum() == 0
    assert repeats.without_repeats(empty).count() == 0


def test_anchors_depend_on_the_window_only():
    rng = np.random.default_rng(1)
    hasher = WordHasher(1 << 10)
    shared = [b"s%d" % x for x in rng.integers(0, 30, 40)]
    texts = [b" ".join([b"p%d" % x for x in rng.integers(0, 9, n)] + shared
                       + [b"q%d" % x for x in rng.integers(0, 9, n)]) for n in (0, 1, 7)]
    found = hasher.words(texts)
    r = repeats.Regions(found.hashes, found.starts)
    anchors = {}
    for a, t, b, c in zip(r.anchor.tolist(), r.text.tolist(), r.begin.tolist(), r.count.tolist()):
        anchors.update({(t, k): a for k in range(b, b + c)})
    for k in range(40 - 12):
        assert len({anchors[t, n + k] for t, n in enumerate((0, 1, 7))}) == 1


def brute_near(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else \
            ({tuple(w)} if w else set())
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            ra, rb = root(a), root(b)
            least[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(n)] for n in (6, 12, 40, 80, 150, 300)]
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 25))):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 9)}"
        if rng.random() < 0.3:
            w = passage + [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 40))]
        docs.append((i, " ".join(w).upper() if i % 9 == 0 else "\t".join(w)))
    docs += [(900, None), (901, ""), (902, "One two"), (903, "one TWO"), (904, "Ä b"), (905, "ä b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("a", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in neardup.near_duplicates(df).collect()}
    assert got == brute_near(docs)
    assert neardup.kept_documents(df).count() == sum(k for _, _, k in got.values())


def test_near_duplicates_of_odd_tables(nasty, empty):
    assert neardup.near_duplicates(nasty).count() == nasty.count()
    kept = neardup.kept_documents(nasty)
    assert kept.columns == nasty.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 11 not in ids and None in ids
    assert neardup.near_duplicates(empty).count() == 0


def test_registers_estimate_likeness():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    for j in (0.0, 0.4, 0.75, 0.9):
        n = int(2000 * 2 * j / (1 + j))
        a, b = np.unique(pool[:2000]), np.unique(pool[2000 - n:4000 - n])
        est = neardup.estimated(neardup.registers(a)[None], neardup.registers(b)[None])[0]
        assert abs(est - j) < 0.16


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.id: r.component for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got.values()) == {1, 100} and len(got) == 80


def test_winnowing_keeps_its_guarantee():
    rng = random.Random(6)
    w = winnow.Winnower(5, 8)
    for _ in range(60):
        shared = "".join(rng.choice("abcd é") for _ in range(12))
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert set(w.kept(a + shared + b)[1]) & set(w.kept(b + shared + a)[1])
    text = "".join(rng.choice("ab") for _ in range(200))
    positions, hashes = w.kept(text)
    grams = [int(w.kept(text[i:i + 5])[1][0]) for i in range(196)]
    want = sorted({max((i for i in range(s, s + 8) if grams[i] == min(grams[s:s + 8])))
                   for s in range(196 - 7)})
    assert positions.tolist() == want and hashes.tolist() == [grams[i] for i in want]


def test_edits_against_brute_force(spark, nasty, empty):
    rows = [r for r in nasty.collect() if r.doc_id is not None]
    order = sorted(((r.doc_id, r.text or "") for r in rows), reverse=True)
    want, w = [], winnow.Winnower()
    for k, (i, t) in enumerate(order):
        h = len(t) // 2
        edited = t[:len(t) - h] + order[(k + 1) % len(order)][1][:h]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), winnow.written(*w.kept(t))))
    got = winnow.edit_check(nasty).where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert winnow.edit_check(empty).count() == 0
    kept = winnow.fingerprints(nasty).collect()
    assert len(kept) == len(rows) + 1 and all(len(r.positions) == len(r.hashes) for r in kept)


def test_quality_learns_and_survives_odd_input(spark, nasty, empty):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) for _ in range(80)]
    bad = [" ".join(rng.choice(["###", "$$$", "@@", "zz!!"]) for _ in range(60)) for _ in range(80)]
    model = quality.QualityModel([x for p in zip([(t, 1) for t in good], [(t, 0) for t in bad]) for x in p])
    docs = spark.createDataFrame([(1, " ".join(rng.sample(good[0].split(), 60))),
                                  (2, " ".join(rng.sample(bad[0].split(), 60)))],
                                 "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert got[1] > 0.7 and got[2] < 0.3
    assert all(0 <= r.score <= 1 for r in quality.scored(nasty, model).collect())
    for sample in ([], [("x", 1)], [("", 0), ("", 1)]):
        quality.QualityModel(sample)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.scored(empty, quality.fitted(empty, labels)).count() == 0
    assert toxicity.scored(nasty, toxicity.fitted(nasty, labels)).count() == nasty.count()


@pytest.mark.parametrize("letters", [1024, 4096])
def test_words_that_a_polynomial_takes_for_equal_stay_apart(spark, merges, letters):
    """A Thue-Morse word and its complement."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(letters))
    b = a.translate(str.maketrans("ab", "ba"))
    hashes = WordHasher().words([f"{a} {b} {a}".encode()]).hashes
    assert hashes[0] == hashes[2] != hashes[1]

    rows = [(0, f"{a} {b} {a}")]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), merges).first()
    assert got.ids == [i for w in (a, b, a) for i in merges.merge(w)]

    words_ = [f"w{i}" for i in range(14)]
    docs = spark.createDataFrame([(i, " ".join(words_[:6] + [w] + words_[6:]))
                                  for i, w in enumerate((a, b))], "doc_id long, text string")
    assert [r.n_removed for r in repeats.without_repeats(docs).collect()] == [0, 0]
    assert [r.kept for r in neardup.near_duplicates(docs).collect()] == [True, True]


def test_distinct_words_are_compared_by_their_bytes():
    words_ = WordHasher().words([b" aa  b\taa", b"", b"b aa\n", "é aa".encode()])
    found, of, counts = words_.distinct()
    assert found == [b"aa", b"b", "é".encode()]
    assert of.tolist() == [0, 1, 0, 1, 0, 2, 0] and counts.tolist() == [4, 2, 1]
    assert words_.starts.tolist() == [0, 3, 3, 5, 7]
    found, of, counts = WordHasher().words([]).distinct()
    assert found == [] and len(of) == len(counts) == 0
