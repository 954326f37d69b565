"""Languages of texts and of their spans.

A word's letters fall in script ranges, which leave the languages that use them. Each of those
gets a score for the word from its character n-grams; Viterbi over the words of a text, with a
penalty for every switch, labels spans of one language. A text's language is the one with the
most letters in its spans.

The model is learned from at most SAMPLE_ROWS rows whose language is known and which are not held
out, and keeps every n-gram of their words. Defined results: ``und`` with score 0 and no spans for texts that are null, empty or without
letters, and for every text if nothing was learned; equal letter counts go to the language whose
name sorts first; words of an unknown script are scored by all languages alike, and join their
neighbours; every word of a long text takes part.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tableferry.llm.common import WordHasher, extended, held_out

SAMPLE_ROWS = 2_000
SWITCH = 6.0
RANGE_BITS = 7  # code points are grouped by 128
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def gram_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the 1- to 3-grams of all words, borders marked, and the number of the word each
    belongs to."""
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"),
                           np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), sizes + 2)
    inner = np.ones(len(points), bool)
    ends = np.cumsum(sizes + 2)
    inner[ends - 1] = inner[ends - sizes - 2] = False
    keys, of = [points[inner]], [word[inner]]
    for n in (2, 3):
        whole = word[n - 1:] == word[:len(word) - n + 1]
        key = points[:len(points) - n + 1].copy()
        for i in range(1, n):
            key = (key << 21) | points[i:len(points) - n + 1 + i]
        keys.append(key[whole])
        of.append(word[n - 1:][whole])
    return np.concatenate(keys), np.concatenate(of)


class LanguageModel:
    """N-gram scores and script ranges, as plain values that travel to tasks."""

    def __init__(self, sample: list[tuple[str, str]]):
        self.langs = sorted({lang for _, lang in sample})
        n = len(self.langs)
        words = [Counter() for _ in self.langs]
        for text, lang in sample:
            at = self.langs.index(lang)
            for word, count in Counter(WORD.findall(text.lower())).items():
                words[at][word] += min(count, 3)  # a text that repeats a word says little more
        ranges: dict[int, list[int]] = defaultdict(lambda: [0] * n)
        found = []
        for at, counts in enumerate(words):
            for word, count in counts.items():
                for r in {ord(c) >> RANGE_BITS for c in word}:
                    ranges[r][at] += count
            weights = np.array(list(counts.values()), float)
            keys, of = gram_keys(list(counts))
            known, back = np.unique(keys, return_inverse=True)
            found.append((known, np.bincount(back, weights[of], len(known))))
        self.keys = np.unique(np.concatenate([k for k, _ in found])) if found \
            else np.zeros(0, np.int64)
        counts = np.zeros((len(self.keys), n))
        for at, (known, count) in enumerate(found):
            counts[np.searchsorted(self.keys, known), at] = count
        # the last row is for n-grams that were not seen
        counts = np.vstack([counts, np.zeros(n)]) + 0.5
        self.table = np.log(counts / counts.sum(axis=0)) if n else counts
        # a range belongs to the languages that have at least a thousandth of its words
        self.ranges = {r: tuple(c * 1000 >= sum(many) for c in many)
                       for r, many in ranges.items()}

    def scorer(self):
        """A function from words to an array of scores, one row a word.

        A score is the log-likelihood of the word's n-grams, a third of it as they overlap, against
        the best language, and not below -20; languages that the word's script rules out get -40.
        A word of an unknown script gets 0 throughout.
        """
        n = len(self.langs)
        every = (1 << n) - 1
        masks: dict[str, tuple[int, bool]] = {}

        def mask(c: str) -> tuple[int, bool]:
            if c not in masks:
                known = self.ranges.get(ord(c) >> RANGE_BITS)
                masks[c] = (every, False) if known is None else (
                    sum(1 << i for i, ok in enumerate(known) if ok), True)
            return masks[c]

        plain = mask("a") == (every, True) and mask("é") == (every, True)

        def scored(words: list[str]) -> np.ndarray:
            if not words:
                return np.zeros((0, n))
            keys, of = gram_keys(words)
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            at[self.keys[at] != keys] = len(self.keys)
            sums = np.column_stack([np.bincount(of, self.table[at, i], len(words))
                                    for i in range(n)]) / 3
            allowed, unknown = np.ones((len(words), n), bool), np.zeros(len(words), bool)
            for k, w in enumerate(words):
                if plain and max(w) < "\u0100":  # both ranges are open to all languages
                    continue
                some, bits = False, every
                for c in set(w):
                    b, ok = mask(c)
                    bits &= b
                    some |= ok
                if not some or not bits:
                    unknown[k] = True
                elif bits != every:
                    allowed[k] = [(bits >> i) & 1 for i in range(n)]
            best = np.where(allowed, sums, -np.inf).max(axis=1, keepdims=True)
            out = np.where(allowed, np.maximum(sums - best, -20.0), -40.0)
            out[unknown] = 0.0
            return out

        return scored


def fitted(docs: DataFrame, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learned from at most ``rows`` rows, as many of each language as there are languages,
    in the order of a hash of their id."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                       & (F.length(F.coalesce("text", F.lit(""))) > 0))
    langs = [r.lang for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang")
             .limit(rows).collect()]
    if not langs:
        return LanguageModel([])
    each = max(1, rows // len(langs))
    ids = None
    for lang in langs:
        some = known.where(F.col("lang") == lang).select("doc_id", "lang").orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(each)
        ids = some if ids is None else ids.unionByName(some)
    got = known.join(F.broadcast(ids.distinct()), ["doc_id", "lang"]).select(
        "text", "lang", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return LanguageModel([(r.text, r.lang) for r in got.toLocalIterator()])


def viterbi_one(scores: list[list[float]], penalty: float) -> list[int]:
    """The best labels of one text, word by word."""
    total, back = scores[0], []
    for row in scores[1:]:
        best = max(total)
        switched = best - penalty
        back.append((total.index(best), [t < switched for t in total]))
        total = [(t if t >= switched else switched) + x for t, x in zip(total, row)]
    now = total.index(max(total))
    labels = [now]
    for best, moved in reversed(back):
        now = best if moved[now] else now
        labels.append(now)
    return labels[::-1]


def viterbi(scores: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word, for many texts at once.

    ``scores`` holds the words of all texts one after the other. Step ``t`` handles word ``t`` of
    each text that has one, so the work per step is one array operation over the texts; the few
    longest texts, for which a step would have little to do, are labelled one by one.
    """
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = starts[:-1][order], lengths[order]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    # a step costs about as much as ten words on their own
    alone = int(np.argmin(np.concatenate([[0], np.cumsum(lengths)])
                          + 10 * np.append(lengths, 0)))
    for a, n in zip(begin[:alone].tolist(), lengths[:alone].tolist()):
        if n:
            labels[a:a + n] = viterbi_one(scores[a:a + n].tolist(), penalty)
    begin, lengths = begin[alone:], lengths[alone:]
    steps = int(lengths[0]) if len(lengths) else 0
    if not steps:
        return labels
    came = np.zeros((len(scores), scores.shape[1]), bool)  # the best way into a label: a switch
    best_at = np.zeros(len(scores), np.int16)              # the best label of the word before
    live = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right").tolist()
    total = scores[begin[:live[0]]].copy()
    last = np.zeros(len(lengths), np.int16)
    for t in range(1, steps):
        n = live[t]
        if n < len(total):
            last[n:len(total)] = total[n:].argmax(axis=1)
            total = total[:n]
        at = begin[:n] + t
        best_at[at] = total.argmax(axis=1)
        switched = total.max(axis=1)[:, None] - penalty
        came[at] = switched > total
        total = np.maximum(total, switched) + scores[at]
    last[:len(total)] = total.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        n = live[t]
        at, now = begin[:n] + t, last[:n]
        labels[at] = now
        last[:n] = np.where(came[at, now], best_at[at], now)
    some = lengths > 0
    labels[begin[some]] = last[some]
    return labels


def identified(docs: DataFrame, model: LanguageModel, column: str = "text",
               penalty: float = SWITCH) -> DataFrame:
    """Add ``lang_pred``, ``score`` (the share of its letters) and ``spans``, an array of
    ``(start, end, lang)`` in words that have letters."""
    langs, unknown = model.langs, UNKNOWN
    span = T.StructType([T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()),
                         T.StructField("lang", T.StringType())])
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                     ("lang", pa.string())]))

    def make():
        score, hasher = model.scorer(), WordHasher()
        known: dict[bytes, int] = {}  # row of a piece, -1 without letters
        rows: list[np.ndarray] = []

        def learn(pieces: list[bytes]) -> None:
            """Rows (scores, letters) for pieces not met before."""
            new = [p for p in pieces if p not in known]
            letters = ["".join(WORD.findall(p.decode().lower())) for p in new]
            with_letters = [w for w in letters if w]
            base = sum(map(len, rows))
            rows.append(np.column_stack([score(with_letters),
                                         np.array([len(w) for w in with_letters], float)]))
            for p, w in zip(new, letters):
                known[p] = base if w else -1
                base += bool(w)

        def work(values):
            words = hasher.words([v.encode() for v in values])
            found, of, _ = words.distinct()
            if not langs:
                return [pa.array([unknown] * len(values)), pa.array([0.0] * len(values)),
                        pa.array([[]] * len(values), arrow_span)]
            if len(known) > 300_000:
                known.clear()
                rows.clear()
            learn(found)
            rows[:] = [np.concatenate(rows)]
            at = np.array([known[p] for p in found], np.int64)[of]
            has = at >= 0
            # pieces without letters are no words
            starts = np.concatenate([[0], np.cumsum(has)])[words.starts]
            each = rows[0][at[has]]
            letters, labels = each[:, -1], viterbi(each[:, :-1], starts, penalty)
            preds, scores, spans = [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if a == b:
                    preds.append(unknown)
                    scores.append(0.0)
                    spans.append([])
                    continue
                part = labels[a:b]
                share = np.bincount(part, letters[a:b], len(langs))
                top = int(share.argmax())
                cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b - a]
                preds.append(langs[top])
                scores.append(float(share[top] / share.sum()))
                spans.append([{"start": i, "end": j, "lang": langs[part[i]]}
                              for i, j in zip(cuts, cuts[1:])])
            return [pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                    pa.array(spans, arrow_span)]

        return work

    return extended(docs, [T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("spans", T.ArrayType(span))], make, column)
