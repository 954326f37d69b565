"""All stages of the pipeline, one after the other, against plain Python versions."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
from test_operators import brute_near, brute_repeats
from tableferry.llm import mixing, toxicity
from tableferry.llm.common import labelled_sample


def brute_readings(docs):
    """How often each row of (doc_id, text, source) is read."""
    tokens = {i: len((t or "").split()) for i, t, _ in docs}
    sums = defaultdict(int)
    for i, _, s in docs:
        sums[s] += tokens[i]
    low, high = min(sums.values()), max(sums.values())
    e = mixing.bisected(lambda e: (high / low) ** (1 - e) <= mixing.MAX_REPEATS)
    out = Counter(i for i, *_ in docs)
    for s, total in sums.items():
        left = max(total, round(high * (total / high) ** e)) - total

        def place(i):
            return int(hashlib.md5(f"{i}|2".encode()).hexdigest()[:15], 16), i

        for i in sorted((i for i, _, of in docs if of == s), key=place):
            if left > 0:
                out[i] += 1
                left -= tokens[i]
    return out


def test_stages_together(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for i in range(240):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            w.insert(5, rng.choice(["grobnik", "zandork", "grobnk"]))
        if i % 5 == 1:
            w.insert(9, passage)
        text = rows[i - 1][1] + " end" if i % 10 == 3 else " ".join(w)
        rows.append((i, text, "ab"[i % 7 == 0], len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)],
                                   "doc_id long, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "substring_dedup", "mixing", "bpe"]

    def step(name, df):
        out = stages[name](spark, df, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(out.schema).parquet(f"{tmp_path}/{name}")

    def held(df):
        return sorted(map(tuple, df.select("doc_id", "text", "source", "n_chars").collect()))

    scorer = toxicity.Scorer(toxicity.ToxicityModel(labelled_sample(docs, labels, "toxic", 5000)))
    clean = step("toxicity", docs)
    want = [r for r in rows if scorer.scores([r[1]])[0] < 0.5]
    assert held(clean) == want and 0 < len(want) < len(rows)
    single = step("near_dedup", clean)
    groups = brute_near([r[:2] for r in want])
    less = [r for r in want if groups[r[0]][2]]
    assert held(single) == less and len(less) < len(want)
    cut = step("substring_dedup", single)
    kept = brute_repeats([r[:2] for r in less])
    want = [(i, t if not kept[i][1] else kept[i][2], s, len(t if not kept[i][1] else kept[i][2]))
            for i, t, s, _ in less]
    assert held(cut) == want and any(k[1] for k in kept.values())
    mixed = step("mixing", cut)
    readings = brute_readings([r[:3] for r in want])
    assert held(mixed) == sorted(r for r in want for _ in range(readings[r[0]]))
    assert max(readings.values()) > 1
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for i, t, s, _ in held(mixed):
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((i, s, len(ids), ids, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, step("bpe", mixed).collect())) == sorted(expected)
