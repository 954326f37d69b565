"""Toxicity by a lexicon that forgives misspelling, and the context of each hit.

The lexicon is learned: words, and word beginnings, that occur in toxic labelled texts far more
often than in others. It is kept as a trie. The Levenshtein automata of its terms are intersected
with the trie: a state is the set of (trie node, errors so far) that a word can still be in, made
when first met, so a word is matched in one walk over its letters. A hit is then judged by the
window of words around it: inside quotation marks or after a word of reporting it counts as
quoted, otherwise as abuse; hits close together weigh more. A logistic curve turns the sums, and
how much of them was matched with an error, into the probability of label 1. Every term and stem
of FUZZY_LETTERS or more letters may have one error, shorter ones none: a letter too many,
missing or wrong at any place, the first one too, or two neighbouring letters swapped where it has
SWAP_LETTERS or more.

Learned from at most SAMPLE_ROWS labelled rows, none held out. Defined results: null counts as
empty; a text without hits gets the curve's score for no hits; with no usable labels the score is
the rate of label 1 with add-half smoothing; whole texts are read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tableferry.llm.common import WordHasher, extended, labelled_sample, logistic

SAMPLE_ROWS = 5_000
MIN_SHARE = 0.004   # of the toxic sample that a term must newly explain
FUZZY_LETTERS = 5   # that a term or stem must have to be matched with an error
SWAP_LETTERS = 6    # that it must have for two swapped letters to count as one error
EDIT, SWAP = 1, 2
COVER = 2           # terms that a toxic text should be explained by
STEMS = range(4, 8)
WINDOW = 12
FEATURES = 6
STATES, PIECES_KNOWN = 50_000, 100_000  # that a task keeps before it starts anew
PIECES = re.compile(r"[\s,;:/|()\[\]{}<>\"“”„«»‘’…]+|(?<=[^\W\d_]{4})[.!?&#%+=~-]+")
QUOTES = "\"“”„«»‘’"
# fixed values: look-alikes of letters, and words that report what others said
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
REPORTING = frozenset("said says quote quoted wrote called term word words".split())


def plain(piece: str) -> str:
    """A lower-case piece as a word: look-alike signs inside it read as letters, other signs
    left out."""
    if piece.isalpha():
        return piece
    return "".join(c for c in piece.strip("!$@*.'-").translate(LOOKALIKE) if c.isalpha())


def words_in(piece: str) -> list[str]:
    """The words of a piece between white space."""
    piece = piece.lower()
    bare = piece.rstrip(".,;:!?")
    if bare.isalpha():
        return [bare]
    return [w for w in map(plain, PIECES.split(piece)) if w]


class Lexicon:
    """A trie of terms and stems, walked by lazily made Levenshtein states.

    A state holds (node, error, letter owed): ``error`` is 0, EDIT for a letter too many, missing
    or wrong, at any place, or SWAP for two neighbouring letters in the other order, of which the
    second is owed until it is read. A negative node is ``~`` of a stem that has been read.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float], fuzzy: set[str]):
        self.next: list[dict[str, int]] = [{}]
        self.weight: dict[int, float] = {}
        self.stem: dict[int, float] = {}
        self.allow: list[int] = [0]  # errors that some term at or below the node may have
        self.forgiving: tuple[dict[int, int], dict[int, int]] = {}, {}  # of terms, of stems
        for table, into in ((terms, self.weight), (stems, self.stem)):
            for term in sorted(table):
                errors = 0
                if term in fuzzy:
                    errors = EDIT | SWAP if len(term) >= SWAP_LETTERS else EDIT
                node = 0
                self.allow[0] |= errors
                for c in term:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.allow.append(0)
                    node = self.next[node][c]
                    self.allow[node] |= errors
                into[node] = table[term]
                self.forgiving[into is self.stem][node] = errors
        self.states: list[frozenset] = []
        self.ids: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, pairs: set[tuple[int, int, str]]) -> int:
        """The number of a state; a letter of a term left out of the word is followed here."""
        pairs = set(pairs)
        for node, error, owed in list(pairs):
            if node >= 0 and not error:
                pairs.update((below, EDIT, "") for below in self.next[node].values()
                             if self.allow[below] & EDIT)
        # anything may follow a stem
        pairs.update([(~node, error, "") for node, error, owed in pairs
                      if not owed and self._ends(node, error, 1)])
        key = frozenset(pairs)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return self.ids[key]

    def _ends(self, node: int, error: int, kind: int) -> bool:
        """Whether a term (kind 0) or stem (1) ends at the node and may have the error."""
        errors = self.forgiving[kind].get(node)
        return errors is not None and errors & error == error

    def _moved(self, state: int, c: str) -> int:
        out = set()
        for node, error, owed in self.states[state]:
            if node < 0:
                out.add((node, error, ""))
                continue
            if owed:
                if owed == c:
                    out.add((node, error, ""))
                continue
            below = self.next[node].get(c)
            if below is not None:
                out.add((below, error, ""))
            if error:
                continue
            if self.allow[node] & EDIT:
                out.add((node, EDIT, ""))
            for first, b in self.next[node].items():
                if self.allow[b] & EDIT:
                    out.add((b, EDIT, ""))
                second = self.next[b].get(c)
                if second is not None and first != c and self.allow[second] & SWAP:
                    out.add((second, SWAP, first))
        return self._state(out) if out else -1

    def match(self, word: str) -> float:
        """The weight of the best term or stem that the word matches, 0 for none."""
        return self.found(word)[0]

    def found(self, word: str) -> tuple[float, bool]:
        """The weight of the best term or stem that the word matches, and whether with an error."""
        state, moves = self.start, self.moves
        for c in word:
            to = moves[state].get(c)
            if to is None:
                if len(self.states) > STATES:
                    self.states, self.ids, self.moves = [], {}, []
                    self.start = self._state({(0, 0, "")})
                    return self.found(word)
                to = moves[state][c] = self._moved(state, c)
            if to < 0:
                return 0.0, False
            state = to
        best = 0.0, False
        for node, error, owed in self.states[state]:
            if node < 0:
                worth = self.stem[~node]
            elif owed or not self._ends(node, error, 0):
                continue
            else:
                worth = self.weight[node]
            best = max(best, (worth * (0.8 if error else 1.0), bool(error)))
        return best


def learned_terms(sample: list[tuple[set[str], int]]) -> tuple[dict, dict, set[str]]:
    """Terms, stems, and those of both to be matched with an error: all of FUZZY_LETTERS or more.

    Candidates are words, and beginnings of several words, with a high log ratio for label 1.
    They are taken in the order of how many toxic texts they newly explain, so that words which
    only come along in copies of one text are not learned.
    """
    n = [sum(1 for _, l in sample if l == k) for k in (0, 1)]
    if not min(n):
        return {}, {}, set()
    least = max(2, math.ceil(MIN_SHARE * n[1]))
    toxic = [found for found, l in sample if l]
    holders: dict[tuple[str, str], list[int]] = {}
    for i, found in enumerate(toxic):
        for w in found:
            holders.setdefault(("word", w), []).append(i)
        for s in {w[:k] for w in found for k in STEMS if len(w) > k}:
            holders.setdefault(("stem", s), []).append(i)
    holders = {c: who for c, who in holders.items() if len(who) >= least}
    several = Counter(s for w in {w for found in toxic for w in found}
                      for s in {w[:k] for k in STEMS if len(w) > k})
    words, stems = ({w for kind, w in holders if kind == want} for want in ("word", "stem"))
    other = Counter()
    for found, l in sample:
        if not l:
            other.update(("word", w) for w in found & words)
            other.update(("stem", s) for s in {w[:k] for w in found for k in STEMS
                                               if len(w) > k} & stems)
    ratio = {c: math.log((len(who) + 0.5) / (n[1] + 1)) - math.log((other[c] + 0.5) / (n[0] + 1))
             for c, who in holders.items()}
    wanted = {c for c, r in ratio.items() if r >= (2.5 if c[0] == "word" else 3.5)
              and (c[0] == "word" or several[c[1]] >= 4)}
    left = [COVER] * len(toxic)
    heap = [(-len(holders[c]), c[0] == "stem", -len(c[1]), c) for c in wanted]
    heapq.heapify(heap)
    chosen: list[tuple[str, str]] = []
    while heap:
        old, *_, c = heapq.heappop(heap)
        gain = sum(1 for i in holders[c] if left[i] > 0)
        if gain < least:
            continue
        if gain < -old:
            heapq.heappush(heap, (-gain, c[0] == "stem", -len(c[1]), c))
            continue
        chosen.append(c)
        for i in holders[c]:
            left[i] -= 1
    terms = {w: ratio[kind, w] for kind, w in chosen if kind == "word"}
    stems = {s: ratio[kind, s] for kind, s in chosen if kind == "stem"}
    return terms, stems, {w for w in terms | stems if len(w) >= FUZZY_LETTERS}


class ToxicityModel:
    """Lexicon and curve, as plain values that travel to tasks."""

    def __init__(self, sample: list[tuple[str, int]]):
        found = [({w for p in set(t.split()) for w in words_in(p)}, l) for t, l in sample]
        self.terms, self.stems, self.fuzzy = learned_terms(found)
        scorer = Scorer(self)
        x = np.array([scorer.features(t) for t, _ in sample], float).reshape(-1, FEATURES)
        self.weights = logistic(x, np.array([l for _, l in sample], float), ridge=0.1)


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.model = model
        self.lexicon = Lexicon(model.terms, model.stems, model.fuzzy)
        self.known: dict[bytes, tuple[float, bool]] = {}
        self.hasher = WordHasher(1 << 12)

    def weight(self, piece: bytes) -> tuple[float, bool]:
        """The weight of a piece, and whether it was matched with an error."""
        found = self.known.get(piece)
        if found is None:
            if len(self.known) > PIECES_KNOWN:
                self.known.clear()
            found = self.known[piece] = max(map(self.lexicon.found, words_in(piece.decode())),
                                            default=(0.0, False))
        return found

    def hits(self, text: str) -> list[tuple[int, float, bool, bool]]:
        """(piece number, weight, with an error, quoted) of each hit."""
        pieces = text.encode().split()
        return self._judged(pieces, [self.weight(p) for p in pieces])

    def _judged(self, pieces: list[bytes], weights: list[tuple[float, bool]]):
        out = []
        marks = [0]
        for p in pieces:
            marks.append(marks[-1] + sum(c in QUOTES for c in p.decode()))
        for i, (weight, misspelt) in enumerate(weights):
            if not weight:
                continue
            own = pieces[i].decode()
            opened = marks[i] - marks[max(0, i - WINDOW)] + (own[0] in QUOTES)
            closed = marks[min(len(pieces), i + WINDOW)] - marks[i + 1] + (own[-1] in QUOTES)
            near = {plain(p.decode().lower()) for p in pieces[max(0, i - 3):i]}
            out.append((i, weight, misspelt,
                        bool(opened % 2 and closed) or bool(near & REPORTING)))
        return out

    def features(self, text: str) -> tuple[float, ...]:
        return self._summed(self.hits(text))

    @staticmethod
    def _summed(hits) -> tuple[float, ...]:
        """Abuse, abuse at its densest window, quoted hits, whether there is any abuse, and how
        much of the abuse and whether all of it was matched with an error: where ordinary words
        lie near a term, the curve learns to trust such hits less."""
        abuse = dense = quoted = erring = 0.0
        recent: list[tuple[int, float]] = []
        for i, weight, misspelt, is_quoted in hits:
            if is_quoted:
                quoted += weight
                continue
            abuse += weight
            erring += weight * misspelt
            recent = [(j, w) for j, w in recent if j > i - WINDOW] + [(i, weight)]
            dense = max(dense, sum(w for _, w in recent))
        return (math.log1p(abuse), math.log1p(dense), math.log1p(quoted), float(abuse > 0),
                math.log1p(erring), float(abuse > 0 and erring == abuse))

    def scores(self, values: list[str]) -> np.ndarray:
        words = self.hasher.words([v.encode() for v in values])
        found, of, _ = words.distinct()
        weights = np.array([self.weight(p)[0] for p in found])[of] if found else np.zeros(0)
        hit = np.concatenate([[0], np.cumsum(weights > 0)])[words.starts]
        rows = [self.features(v) if b > a else (0.0,) * FEATURES
                for v, a, b in zip(values, hit[:-1], hit[1:])]
        w = self.model.weights
        x = np.array(rows, float).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic",
           rows: int = SAMPLE_ROWS) -> ToxicityModel:
    return ToxicityModel(labelled_sample(docs, labels, label, rows))


def scored(docs: DataFrame, model: ToxicityModel, column: str = "text",
           out: str = "score") -> DataFrame:
    """Add the probability that each text is toxic."""

    def make():
        scorer = Scorer(model)
        return lambda values: [pa.array(scorer.scores(values), pa.float64())]

    return extended(docs, [T.StructField(out, T.DoubleType())], make, column)
