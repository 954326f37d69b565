"""Substring dedup by recompression.

A text is a sequence of word names. Runs of an equal word are named, then in each round pairs: a
name's bit puts it on the left or the right side, and a left symbol followed by a right one
becomes a new symbol. Names are hashes of what they stand for, so every task gives the same name
to the same run or pair and no table of names has to be passed around. Equal substrings get equal
interior symbols; for each symbol the words its parse depends on are known, and where they lie
inside a window, the symbol occurs in every other occurrence of the window too.

So a window of ``window`` words has an anchor that depends on its words only: among the symbols
whose context it holds the one with the smallest name, those of three or more words first; its own
hash if it holds none (inside long runs). The context takes in the word on either side and the
anchor names it too, as short symbols alone recur in texts that have nothing else in common. Neighbouring windows with one anchor are a region. The work is then:

1. anchors of all texts, the smallest and the largest document of each (hot ones are reduced in
   tasks first); an anchor of one document only cannot belong to a repeat. A bitmap of fixed size
   keeps most regions of such anchors from being shuffled in the next step;
2. regions of the shared anchors by anchor and content: every document but the smallest of a group
   loses the whole region, and the smallest stands for the group;
3. where an anchor has regions of different content, the windows of those representatives are
   compared one by one;
4. the words that windows found so cover are removed.

Every window is judged on the input. What decides a removal is a 64-bit content hash within one
64-bit anchor. The anchor is the name of a symbol and its neighbours, or for a window without
one a second hash of its words, made apart from the first. Both rest on 64-bit word hashes.

Defined results: null and empty texts, and texts with fewer words than a window, lose nothing; a
window repeated within one document only is kept; rows that share a doc_id are one document to
each other, so they lose nothing to each other; a row without id loses nothing; no documents give
no rows; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tableferry.llm.common import U64, WordHasher, mixed, sliced, texts
from tableferry.session import stored

WINDOW = 13
ROUNDS = 2
MOST_WINDOWS = 64
FILTER_BITS = 26
PART_BITS = 12
NONE = U64(0xFFFFFFFFFFFFFFFF)


def chained(parts, seed: int) -> np.ndarray:
    """A hash of a tuple of arrays, element by element."""
    h = np.full(len(parts[0]), seed, U64)
    for p in parts:
        h = mixed((h ^ p) * U64(0x9E3779B97F4A7C15))
    return h


def window_hashes(names: np.ndarray, window: int) -> np.ndarray:
    """A content hash of the ``window`` names from each place on."""
    n = max(0, len(names) - window + 1)
    spread, own = mixed(names + U64(1)), np.zeros(n, U64)
    for i in range(window):
        own = own * U64(0x9E3779B97F4A7C15) + spread[i:n + i]
    return mixed(own)


def second_hashes(names: np.ndarray, window: int, at: np.ndarray) -> np.ndarray:
    """Another hash of the windows at some places, by another polynomial of other values."""
    out = np.zeros(len(at), U64)
    for i in range(window):
        out = out * U64(0xC2B2AE3D27D4EB4F) + mixed(names[at + i] ^ U64(0x165667B19E3779F9))
    return mixed(out + U64(7))


class Parse:
    """Symbols of concatenated texts after rounds of naming.

    ``name``; ``start, stop``: the words of a symbol; ``low, high``: the words its parse depends
    on, which reach one place over the border of a text where the parse depends on the border.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS):
        # a border place before and after every text, with names of their own
        n_texts = len(starts) - 1
        text = np.repeat(np.arange(n_texts), np.diff(starts))
        at = np.arange(len(words)) + 2 * text + 1
        total = len(words) + 2 * n_texts
        name = np.zeros(total, U64)
        self.real = np.zeros(total, bool)
        name[at], self.real[at] = words, True
        self.text = np.full(total, -1, np.int64)
        self.text[at] = text
        self.word_at = at
        self.name = name
        self.start = np.arange(total)
        self.stop = self.start + 1
        self.low, self.high = self.start.copy(), self.stop.copy()
        self.fixed = ~self.real
        self._runs()
        for r in range(rounds):
            self._pairs(r)

    def _cut(self, first: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray):
        ends = np.append(first[1:], len(self.name)) - 1
        self.start, self.stop = self.start[first], self.stop[ends]
        self.name, self.low, self.high = name, low, high
        self.fixed = self.fixed[first]

    def _runs(self) -> None:
        n = len(self.name)
        if not n:
            return
        same = (self.name[1:] == self.name[:-1]) & ~self.fixed[1:] & ~self.fixed[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        count = np.diff(np.append(first, n)).astype(U64)
        name = np.where(count > 1, chained((self.name[first], count), 1), self.name[first])
        last = np.append(first[1:], n) - 1
        # that a run ends depends on its neighbours
        low = self.low[np.maximum(first - 1, 0)]
        high = self.high[np.minimum(last + 1, n - 1)]
        self._cut(first, name, low, high)

    def _pairs(self, r: int) -> None:
        n = len(self.name)
        if n < 2:
            return
        left = (mixed(self.name + U64(r + 1)) & U64(1)).astype(bool) & ~self.fixed
        right = ~left & ~self.fixed
        joined = left[:-1] & right[1:]  # a left symbol never ends a pair, so pairs are apart
        second = np.concatenate([[False], joined])
        begins = np.concatenate([joined, [False]])
        first = np.flatnonzero(~second)
        other = np.minimum(first + 1, n - 1)
        pair = begins[first]
        name = np.where(pair, chained((self.name[first], self.name[other]), r + 2),
                        self.name[first])
        # a pair depends on its halves; a symbol alone on the neighbour that did not join it
        low = np.where(~pair & right[first], self.low[np.maximum(first - 1, 0)], self.low[first])
        high = np.where(pair | left[first], self.high[other], self.high[first])
        self._cut(first, name, np.minimum(low, self.low[first]), high)


class Regions:
    """Regions of concatenated texts: ``anchor, content, text, begin`` (first window, in words
    of its text) and ``count`` (windows)."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, window: int = WINDOW,
                 rounds: int = ROUNDS):
        p = Parse(words, starts, rounds)
        total = len(p.real)
        sums = np.zeros(total + 1, np.int64)
        np.cumsum(p.real, out=sums[1:])
        begin = np.arange(max(0, total - window + 1))
        whole = sums[window:] - sums[:total - window + 1] == window if len(begin) else begin > 0
        # best anchor of every window: symbols of three and more words first, then the name
        size = p.stop - p.start
        places = np.zeros(total, U64)
        places[p.word_at] = words
        fits = np.flatnonzero(~p.fixed)
        low = np.minimum(p.low, p.start - 1)
        high = np.maximum(p.high, p.stop + 1)
        fits = fits[high[fits] - low[fits] <= window]
        low, high, size = low[fits], high[fits], size[fits]
        name = chained((p.name[fits], places[p.start[fits] - 1], places[p.stop[fits]]), 7)
        rank_ = np.where(size >= 3, 0, np.where(size == 2, 1, 2)).astype(U64) << U64(58) \
            | (name >> U64(6))
        best = np.full(total + window, NONE, U64)
        for back in range(window):
            at = high - window + back
            ok = (at <= low) & (at >= 0)
            np.minimum.at(best, at[ok], rank_[ok])
        own = window_hashes(places, window)
        best = best[:len(own)]
        alone = np.flatnonzero(best == NONE)
        anchor = best
        anchor[alone] = second_hashes(places, window, alone)
        at = np.flatnonzero(whole)
        anchor, text = anchor[at], p.text[at]
        if not len(at):
            self.anchor = self.content = np.zeros(0, U64)
            self.text = self.begin = self.count = np.zeros(0, np.int64)
            return
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])
        first = np.flatnonzero(new)
        # long regions, as runs of one word make them, are cut
        offset = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        first = np.flatnonzero(offset % MOST_WINDOWS == 0)
        self.count = np.diff(np.append(first, len(at)))
        self.anchor, self.text, self.place = anchor[first], text[first], at[first]
        self.begin = self.place - (starts[self.text] + 2 * self.text + 1)
        # content: the hashes of the region's windows, in order
        content = np.zeros(len(first), U64)
        for i in range(int(self.count.max())):
            more = np.flatnonzero(self.count > i)
            content[more] = mixed(content[more] * U64(3) + own[self.place[more] + i])
        self.content = content


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U64).view(np.int64), pa.int64())


def checks(values: list[bytes]) -> np.ndarray:
    """24 bits of each text, which tell apart rows that share a doc_id."""
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(v) & 0xFFFFFF for v in values], U64)


def bitmap(anchors: DataFrame) -> np.ndarray:
    """A bit for each value of the low bits of the anchors, 8 MB whatever their number is. Tasks
    put together parts of 32 KB, so that the driver gets 256 rows at most."""
    low = F.col("anchor").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = anchors.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(anchor & 63 as int))")).alias("bits"))

    def part(table: pa.Table) -> pa.Table:
        word = table.column("word").to_numpy()
        bits = np.zeros(1 << PART_BITS, np.int64)
        bits[word & ((1 << PART_BITS) - 1)] = table.column("bits").to_numpy()
        return pa.table({"part": pa.array([int(word[0]) >> PART_BITS], pa.int64()),
                         "bits": pa.array([bits.tobytes()], pa.binary())})

    parts = words.groupBy(F.shiftright("word", PART_BITS)).applyInArrow(
        part, "part long, bits binary")
    out = np.zeros((1 << (FILTER_BITS - 6 - PART_BITS), 1 << PART_BITS), np.int64)
    for r in parts.toLocalIterator():
        out[r.part] = np.frombuffer(r.bits, np.int64)
    return out.reshape(-1).view(U64)


def regions(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS,
            wanted: np.ndarray | None = None) -> DataFrame:
    """``(anchor, content, doc_id, span)`` of every region. A span holds the first window's
    place (32 bits), the check of the text (24) and the number of windows (8).

    ``wanted`` is a :func:`bitmap`; regions whose anchor has no bit in it are left out.
    """

    def task(batches):
        hasher = WordHasher()
        for batch in sliced(batches, "text"):
            data = [t.encode() for t in texts(batch, "text")]
            words = hasher.words(data)
            got = Regions(words.hashes, words.starts, window, rounds)
            if not len(got.anchor):
                continue
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)[got.text]
            span = (got.begin.astype(U64) << U64(32)) | (checks(data)[got.text] << U64(8)) \
                | got.count.astype(U64)
            some = np.arange(len(ids))
            if wanted is not None:
                low = got.anchor & U64((1 << FILTER_BITS) - 1)
                some = np.flatnonzero(wanted[(low >> U64(6)).astype(np.int64)]
                                      >> (low & U64(63)) & U64(1))
            for at in range(0, len(some), 50_000):
                cut = some[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [_long(got.anchor[cut]), _long(got.content[cut]), pa.array(ids[cut]),
                     _long(span[cut])], names=["anchor", "content", "doc_id", "span"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(
        task, "anchor long, content long, doc_id long, span long")


def windows_of(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``(anchor, hash, doc_id, span)`` of each window of the wanted regions ``(doc_id, anchor,
    span)``; the span is that of the single window."""
    listed = wanted.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"),
                                          F.collect_list("span").alias("spans"))

    def task(batches):
        hasher = WordHasher()
        for batch in sliced(batches, "text"):
            data = [t.encode() for t in texts(batch, "text")]
            words = hasher.words(data)
            own = window_hashes(words.hashes, window)
            check = checks(data)
            for i in range(batch.num_rows):
                anchor = np.array(batch.column("anchors")[i].as_py(), np.int64)
                span = np.array(batch.column("spans")[i].as_py(), np.int64).view(U64)
                mine = ((span >> U64(8)) & U64(0xFFFFFF)) == check[i]
                anchor, span = anchor[mine], span[mine]
                if not len(span):
                    continue
                count = (span & U64(0xFF)).astype(np.int64)
                row = np.repeat(np.arange(len(span)), count)
                step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = (span >> U64(32)).astype(np.int64)[row] + step
                single = (begin.astype(U64) << U64(32)) | (check[i] << U64(8)) | U64(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[row]), _long(own[words.starts[i] + begin]),
                     pa.array([batch.column("doc_id")[i].as_py()] * len(row), pa.int64()),
                     _long(single)], names=["anchor", "hash", "doc_id", "span"])

    return docs.select("doc_id", "text").join(listed, "doc_id").mapInArrow(
        task, "anchor long, hash long, doc_id long, span long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, span)``: windows, as spans, that also start in a document of smaller id."""
    shared = stored(regions(docs, window, rounds).groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").select("anchor"), "repeat-anchors")
    # the bits only keep most of the other regions out of the shuffle; the join decides
    found = regions(docs, window, rounds, bitmap(shared))
    near = stored(found.join(shared, "anchor"), "repeat-regions")
    firsts = stored(near.groupBy("anchor", "content").agg(F.min("doc_id").alias("first")),
                    "repeat-firsts")
    varied = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    marked = stored(near.join(firsts, ["anchor", "content"]), "repeat-marked")
    whole = marked.where("doc_id > first").select("doc_id", "span")
    stand = marked.where("doc_id = first").join(varied, "anchor", "left_semi")
    single = stored(windows_of(docs, stand, window), "repeat-windows")
    least = single.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first"))
    edges = single.join(least, ["anchor", "hash"]).where("doc_id > first").select("doc_id", "span")
    return whole.union(edges)


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``, the words left joined by a space."""
    new = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
           T.StructField("kept", T.StringType())]
    names = {f.name for f in new}
    columns = [c for c in docs.columns if c.lower() not in names]
    spans_name = "_spans"
    while spans_name in {c.lower() for c in columns}:
        spans_name += "_"
    schema = T.StructType([docs.schema[c] for c in columns] + new)
    listed = repeated_spans(docs, window, rounds).groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_list("span").alias(spans_name))
    rows = docs.select(columns)
    joined = rows.join(listed, rows["doc_id"] == listed["_id"], "left")

    def task(batches):
        for batch in sliced(batches, "text"):
            out = [[], [], []]
            for text, spans in zip(texts(batch, "text"), batch.column(spans_name).to_pylist()):
                data = text.encode()
                words = data.split()
                removed = np.zeros(len(words) + 1, np.int64)
                if spans:
                    span = np.array(spans, np.int64).view(U64)
                    span = span[((span >> U64(8)) & U64(0xFFFFFF)) == checks([data])[0]]
                    begin = (span >> U64(32)).astype(np.int64)
                    np.add.at(removed, begin, 1)
                    np.add.at(removed, begin + (span & U64(0xFF)).astype(np.int64)
                              + window - 1, -1)
                gone = np.cumsum(removed)[:-1] > 0
                out[0].append(len(words))
                out[1].append(int(gone.sum()))
                kept = words if not gone.any() else [words[i] for i in np.flatnonzero(~gone)]
                out[2].append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                   pa.array(out[2], pa.string())], names=columns + [f.name for f in new])

    return joined.select(*[rows[c] for c in columns], spans_name).mapInArrow(task, schema)
