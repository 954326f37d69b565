"""BPE encoding and decoding with a transducer lexicon.

The most frequent words of the corpus, with the ids that the merges give them, are compiled into
a minimal acyclic transducer: states share prefixes and suffixes, every arc carries a number, and
the sum of the numbers along a word is the row of its ids. The automaton is one block of bytes
that each task maps into memory. A word outside of it is merged exactly, pair by pair.

The ids are those of the tokenizer file whatever words the lexicon holds.

Defined results: null and empty texts have no ids and decode to the empty text; the strings of
the special tokens become their ids; texts of any length are encoded whole; rows are independent,
so repeated rows get equal results; extra columns are kept, one named like an output is replaced.
Decoding skips null ids and stops the job at an id that the vocabulary lacks.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tableferry.llm.common import WordHasher, extended, sliced, texts
from tableferry.session import stored

LEXICON_WORDS = 131_072
SHIFT = 20
NO_PAIR = 1 << 62
MARK = "\0"
MERGED_BYTES = 1 << 17  # words that are merged at once
PIECES_KNOWN, WORDS_KNOWN = 200_000, 150_000  # that a task keeps before it starts anew


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    chars = dict(zip(plain, map(chr, plain))) | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


class Merges:
    """The tables of a word-end BPE tokenizer file, as plain values that travel to tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = [vocab[c] for c in byte_chars()]
        self.final = [vocab[c + end] for c in byte_chars()]
        # one number orders pairs by rank and names what they become
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault((vocab[a] << SHIFT) | vocab[b],
                                  (rank << SHIFT) | vocab[a + b])
        keys = sorted(self.pairs)
        self._keys = np.array(keys, np.int64)
        self._ranks = np.array([self.pairs[k] for k in keys], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for table in (vocab, self.special):
            for token, i in table.items():
                self.tokens[i] = token
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = steps[0]["pattern"]["Regex"]

    def merge(self, word: str) -> list[int]:
        """The ids of one word: always the pair of lowest rank, leftmost first."""
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        if len(ids) > 200:
            return self._merge_long(ids)
        none, get, mask = NO_PAIR, self.pairs.get, (1 << SHIFT) - 1
        ranks = [get((a << SHIFT) | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            new = ids[i] = best & mask
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1] << SHIFT) | new, none)
            if i < len(ranks):
                ranks[i] = get((new << SHIFT) | ids[i + 1], none)
        return ids

    def merge_all(self, words: list[bytes]) -> list[array]:
        """The ids of many words: each round merges in every word what :meth:`merge` would merge
        next there, by array operations over all words that still have a pair."""
        out: list = [None] * len(words)
        short = []
        for i, word in enumerate(words):
            if len(word) > 200:
                out[i] = array("i", self.merge(word.decode()))
            else:
                short.append(i)
        part = np.cumsum([len(words[i]) for i in short], dtype=np.int64) // MERGED_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(short)]
        for begin, end in zip(cuts, cuts[1:]):
            at = short[begin:end]
            for i, ids in zip(at, self._merged([words[i] for i in at])):
                out[i] = ids
        return out

    def _merged(self, words: list[bytes]) -> list[array]:
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids, ends = np.array(self.inner, np.int64)[raw], np.cumsum(sizes)
        ids[ends - 1] = np.array(self.final, np.int64)[raw[ends - 1]]
        of = np.repeat(np.arange(len(words)), sizes)
        ranks = self._ranked(ids, of, np.arange(len(ids)))
        done = []
        while len(ids):
            begins = np.flatnonzero(np.diff(of, prepend=-1))
            best = np.repeat(np.minimum.reduceat(ranks, begins),
                             np.diff(begins, append=len(ids)))
            open_ = best < NO_PAIR
            done.append((of[~open_], ids[~open_]))
            ids, of, ranks, best = ids[open_], of[open_], ranks[open_], best[open_]
            at = np.flatnonzero(ranks == best)
            at = at[np.diff(of[at], prepend=-1) != 0]  # the leftmost of each word
            ids[at] = best[at] & ((1 << SHIFT) - 1)
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, of, ranks = ids[kept], of[kept], ranks[kept]
            at -= np.arange(len(at))
            ranks[at] = self._ranked(ids, of, at)
            at = at[at > 0] - 1
            ranks[at] = self._ranked(ids, of, at)
        of = np.concatenate([d[0] for d in done])
        flat = np.concatenate([d[1] for d in done])[np.argsort(of, kind="stable")]
        flat = array("i", flat.astype(np.int32).tobytes())
        ends = np.cumsum(np.bincount(of, minlength=len(words))).tolist()
        return [flat[begin:end] for begin, end in zip([0, *ends], ends)]

    def _ranked(self, ids: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and result of the pairs that begin at ``at``, where both are of one word."""
        after = np.minimum(at + 1, len(ids) - 1)
        keys = (ids[at] << SHIFT) | ids[after]
        place = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        same = (after > at) & (of[at] == of[after]) & (self._keys[place] == keys)
        return np.where(same, self._ranks[place], NO_PAIR)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words: a heap of pairs over a linked list."""
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1)
                if (r := get((ids[i] << SHIFT) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        gone = -1
        while heap:
            rank, i = heapq.heappop(heap)
            if ids[i] == gone or after[i] >= n:
                continue
            j = after[i]
            if get((ids[i] << SHIFT) | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank & ((1 << SHIFT) - 1), gone
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    r = get((ids[left] << SHIFT) | ids[after[left]])
                    if r is not None:
                        heapq.heappush(heap, (r, left))
        return [i for i in ids if i != gone]


def words_of(pattern: str, special: dict[str, int]):
    """A function from a text to its words; special tokens come as their ids. Its ``plain`` cuts
    texts in which no special token can be."""
    split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
    marks = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
                       + ")") if special else None
    normal, category = unicodedata.is_normalized, unicodedata.category

    def by_library(text: str) -> list[str]:
        """Code points that Python's Unicode data does not know yet: ask the library's."""
        from tokenizers import Regex, normalizers, pre_tokenizers
        text = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
        cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        return [w for w, _ in cut.pre_tokenize_str(text)]

    def plain(text: str) -> list[str]:
        if not text.isascii():
            if any(category(c) == "Cn" for c in set(text)):
                return by_library(text)
            if not normal("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # no final form: each letter by itself
        return split(text.lower())

    def words(text: str) -> list:
        if text.isascii() and text.isalpha():
            return [text.lower()]
        if marks is None or "<" not in text or not marks.search(text):
            return plain(text)
        out: list = []
        for part in marks.split(text):
            out += [special[part]] if part in special else plain(part)
        return out

    words.plain = plain
    return words


# ---- the lexicon ----------------------------------------------------------------------------

class Transducer:
    """A minimal acyclic transducer from words to rows of ids, in one block of bytes."""

    HEAD = 8

    @staticmethod
    def compiled(entries: dict[str, list[int]]) -> bytes:
        """Built from sorted words; a state is closed as soon as no later word can enter it."""
        keys = sorted(w.encode() for w in entries)
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (is final, words below, arcs)
        path: list[list] = [[False, []]]  # open states of the last word
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                at = register.get(key)
                if at is None:
                    at = register[key] = len(states)
                    states.append((final, final + sum(states[t][1] for _, t in arcs), arcs))
                path[-1][1].append((last[len(path) - 1], at))

        for key in keys:
            same = 0
            while same < len(last) and same < len(key) and last[same] == key[same]:
                same += 1
            close(same)
            path.extend([False, []] for _ in range(len(key) - same))
            path[-1][0] = True
            last = key
        close(0)
        states.append((path[0][0], len(keys), path[0][1]))
        first, labels, targets, skips, finals = [0], bytearray(), [], [], bytearray()
        for final, _, arcs in states:
            skip = int(final)
            for label, target in arcs:
                labels.append(label)
                targets.append(target)
                skips.append(skip)
                skip += states[target][1]
            first.append(len(labels))
            finals.append(final)
        ids = [entries[k.decode()] for k in keys]
        rows = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=rows[1:])
        flat = np.array([i for x in ids for i in x], np.int32)
        parts = [np.array(x, np.int32).tobytes() for x in (first, targets, skips, rows, flat)]
        parts += [bytes(labels), bytes(finals)]
        head = np.array([len(p) for p in parts] + [0] * (Transducer.HEAD - len(parts)), np.int64)
        return head.tobytes() + b"".join(parts)

    def __init__(self, blob: bytes):
        # one file of this task, mapped and already unlinked: pages are shared and reclaimable
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self._map)
        sizes = view[:8 * self.HEAD].cast("q").tolist()
        at, parts = 8 * self.HEAD, []
        for i, size in enumerate(sizes[:7]):
            parts.append(np.frombuffer(view[at:at + size], np.int32 if i < 5 else np.uint8))
            at += size
        first, self.targets, self.skips, self.rows, ids, labels, self.finals = parts
        self.ids = array("i", ids.tobytes())
        self.start = len(first) - 2
        self.arcs = (np.repeat(np.arange(len(first) - 1), np.diff(first)) << 8) | labels

    def get(self, word: str) -> list[int] | None:
        found = self.find([word.encode()])[0]
        return None if found is None else found.tolist()

    def find(self, words: list[bytes]) -> list[array | None]:
        """The ids of each word, None where it is not in the lexicon. All words take a step of the
        automaton at a time; arcs are sorted by state and label."""
        if not words or not len(self.arcs):
            return [None] * len(words)
        sizes = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(sizes) - sizes
        state, row = np.full(len(words), self.start), np.zeros(len(words), np.int64)
        walking, depth = np.arange(len(words)), 0
        while len(walking := walking[sizes[walking] > depth]):
            asked = (state[walking] << 8) | raw[begins[walking] + depth]
            arc = np.minimum(np.searchsorted(self.arcs, asked), len(self.arcs) - 1)
            there = self.arcs[arc] == asked
            state[walking[~there]] = -1
            walking, arc = walking[there], arc[there]
            row[walking] += self.skips[arc]
            state[walking] = self.targets[arc]
            depth += 1
        known = (state >= 0) & (self.finals[state] == 1)
        row = np.where(known, row, 0)
        return [self.ids[a:b] if k else None for k, a, b in zip(
            known.tolist(), self.rows[row].tolist(), self.rows[row + 1].tolist())]


def frequent_words(docs: DataFrame, merges: Merges, n: int = LEXICON_WORDS,
                   column: str = "text") -> list[str]:
    """At most ``n`` of the most frequent words over all texts; counts are added up in tasks
    first. Which words these are changes the cost of encoding only."""

    def task(batches):
        hasher, counts = WordHasher(), Counter()

        def flush():
            pairs = list(counts.items())
            counts.clear()
            for at in range(0, len(pairs), 20_000):
                part = pairs[at:at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode() for w, _ in part], pa.string()),
                     pa.array([c for _, c in part], pa.int64())], names=["word", "n"])

        for batch in sliced(batches, column):
            found, _, count = hasher.words([t.encode() for t in texts(batch, column)]).distinct()
            for word, c in zip(found, count.tolist()):
                counts[word] += c
            if len(counts) > 300_000:
                yield from flush()
        yield from flush()

    counted = docs.select(column).mapInArrow(task, "word string, n long")
    # pieces between white space; one so long that it is no entry is merged where it occurs
    added = stored(counted.where(F.length("word") <= 64).groupBy("word").agg(
        F.sum("n").alias("n")), "bpe-words")
    # the least count in steps of a tenth that leaves no more than n words, from a table of some
    # hundred steps, so that tasks send the chosen words only
    step = F.floor(F.log("n") * 10)
    steps = {r.step: r.words for r in added.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("words")).collect()}
    room, least = n, None
    for at in sorted(steps, reverse=True):
        room -= steps[at]
        if room < 0:
            break
        least = at
    if least is None:
        return []
    words, totals = words_of(merges.pattern, merges.special), Counter()
    for r in added.where(step >= least).toLocalIterator():
        for word in words(r.word):
            if isinstance(word, str):
                totals[word] += r.n
    return sorted(totals, key=lambda w: (-totals[w], w))[:n]


def encode(docs: DataFrame, merges: Merges, column: str = "text", out: str = "ids",
           lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Add the ids of ``column`` as array<int> ``out``.

    ASCII white space always ends a word, so a text's ids are those of its pieces in order, and
    each distinct piece of a batch is looked up once.
    """
    blob = Transducer.compiled({w: merges.merge(w)
                                for w in frequent_words(docs, merges, lexicon_words, column)})

    def make():
        words, lexicon = words_of(merges.pattern, merges.special), Transducer(blob)

        known: dict[bytes, array] = {}
        # pieces differ by their marks more than by their words
        looked: dict[str, array] = {}
        hasher = WordHasher()

        def look_up(pieces: list[bytes]) -> None:
            if len(known) > PIECES_KNOWN:
                known.clear()
            if len(looked) > WORDS_KNOWN:
                looked.clear()
            fresh = [p for p in pieces if p not in known]
            # white space ends a word, so pieces joined by it and a mark are cut in one go, all but
            # those that may hold a special token or the mark itself
            odd = [p for p in fresh if b"<" in p or b"\0" in p]
            if odd:
                fresh = [p for p in fresh if b"<" not in p and b"\0" not in p]
            found = words.plain(f" {MARK} ".join([p.decode() for p in fresh] + [""]))
            if found.count(MARK) != len(fresh):
                odd, fresh, found = odd + fresh, [], []
            apart = [words(p.decode()) for p in odd]
            ask = {*found, *(w for ws in apart for w in ws if w.__class__ is str)}
            ask = list(ask.difference(looked))
            data = [w.encode() for w in ask]
            ids = lexicon.find(data)
            rest = [i for i, x in enumerate(ids) if x is None]
            for i, x in zip(rest, merges.merge_all([data[i] for i in rest])):
                ids[i] = x
            looked.update(zip(ask, ids))
            none = array("i")
            parts = [none if w == MARK else looked[w] for w in found]
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            ends = ends[[i for i, w in enumerate(found) if w == MARK]].tolist()
            flat = array("i", b"".join(parts))
            known.update(zip(fresh, [flat[a:b] for a, b in zip([0, *ends], ends)]))
            for piece, ws in zip(odd, apart):
                known[piece] = array("i", [i for w in ws for i in (
                    (w,) if w.__class__ is int else looked[w])])

        def work(values):
            pieces = hasher.words([v.encode() for v in values])
            found, of, _ = pieces.distinct()
            look_up(found)
            ids = [known[p] for p in found]
            sizes = np.array([len(x) for x in ids], np.int64)
            begins = np.cumsum(sizes) - sizes
            table = np.frombuffer(b"".join(ids), np.int32)
            size = sizes[of]
            ends = np.cumsum(size)
            place = np.arange(int(size.sum())) + np.repeat(begins[of] - (ends - size), size)
            offsets = np.concatenate([[0], ends])[pieces.starts].astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(table[place]))]

        return work

    return extended(docs, [T.StructField(out, T.ArrayType(T.IntegerType()))], make, column)


def decode(df: DataFrame, merges: Merges, column: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of the ids: the file names no decoder, so tokens are joined by one space."""
    tokens = pa.array(merges.tokens)
    kept = [c for c in df.columns if c.lower() != out.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.StringType())])

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column(column)
                # a list's nulls are skipped; a list that is null decodes to the empty text
                named = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(pc.fill_null(
                        pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]), pa.int32()),
                    tokens.take(ids.flatten()))
                joined = pc.binary_join(named, " ") if not ids.flatten().null_count else pa.array(
                    [" ".join(t for t in x if t is not None) for x in named.to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [joined.cast(pa.string())],
                    names=kept + [out])

    return df.mapInArrow(task, schema)
