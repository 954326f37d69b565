"""What the operators share: bounded batches, added columns, held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICE_BYTES = 2 << 20
U64 = np.uint64


def sliced(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds about ``limit`` bytes in each; a single
    longer value stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """Values of a text column, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def extended(df: DataFrame, fields: list[T.StructField], make: Callable,
             column: str = "text") -> DataFrame:
    """``df`` with columns that ``make()(texts)`` computes for each bounded batch.

    ``make`` runs once per task and returns the function of the batches. A column of ``df``
    with the name of a new one (in any case) is replaced.
    """
    new = [f.name for f in fields]
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in new}]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def task(batches):
        work = make()
        for batch in sliced(batches, column):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + work(texts(batch, column)), names=kept + new)

    return df.mapInArrow(task, schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class WordHasher:
    """Words of many texts at once, by array operations on their bytes.

    Words are what lies between the ASCII white space 0x20 and 0x09 to 0x0D. The hash of a word of
    up to ``LONG`` bytes is a polynomial over its bytes mod 2^64, taken from running sums: a
    difference of two sums, times a power, is the value of the bytes between, wherever the word
    stands. Such polynomials are equal for some longer words, whatever their base is, so those
    are hashed one by one.
    """

    BASE = 0x9E3779B97F4A7C15
    LONG = 64

    def __init__(self, size: int = 1 << 21):
        self._values = mixed(np.arange(1, 257, dtype=U64) * U64(self.BASE))
        self._size, self._up, self._down = size, None, None

    def _grow(self, n: int) -> None:
        up, down = np.full(n, self.BASE, U64), np.full(n, pow(self.BASE, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        self._up, self._down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)

    def words(self, data: list[bytes]) -> Words:
        joined = b" ".join(data) + b" "
        raw = np.frombuffer(joined, np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edges = np.flatnonzero(np.diff(space, prepend=True))
        begin, end = edges[0::2], edges[1::2]
        offsets = np.zeros(len(data) + 1, np.int64)
        np.cumsum([len(d) + 1 for d in data], out=offsets[1:])
        return Words(self, joined, space, begin, end, np.searchsorted(begin, offsets))

    def hashes(self, words: Words) -> np.ndarray:
        import xxhash
        raw, begin, end = np.frombuffer(words.joined, np.uint8), words.begin, words.end
        if self._up is None or len(raw) + 1 > len(self._up):
            self._grow(max(self._size, 2 * len(raw)))
        sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(self._values[raw] * self._down[:len(raw)], out=sums[1:])
        out = mixed((sums[end] - sums[begin]) * self._up[begin] + (end - begin).astype(U64))
        for i in np.flatnonzero(end - begin > self.LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(words.joined[begin[i]:end[i]])
        return out


@dataclass
class Words:
    """Words of texts: the bytes, where each word begins and ends, and the number of the first
    word of each text (one more at the end)."""

    hasher: WordHasher
    joined: bytes
    space: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray

    @cached_property
    def hashes(self) -> np.ndarray:
        """The hash of each word."""
        return self.hasher.hashes(self)

    def distinct(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct words, the number of each word among them, and their counts. Words are
        compared by their bytes."""
        offsets = np.zeros(len(self.begin) + 1, np.int64)
        np.cumsum(self.end - self.begin, out=offsets[1:])
        data = np.frombuffer(self.joined, np.uint8)[~self.space]
        words = pa.Array.from_buffers(pa.large_binary(), len(self.begin), [
            None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        of, known = words.indices.to_numpy(), words.dictionary
        _, ends, data = known.buffers()
        at = np.frombuffer(ends, np.int64)[:len(known) + 1].tolist() if len(known) else []
        data = data.to_pybytes() if len(known) else b""
        return ([data[a:b] for a, b in zip(at, at[1:])], of,
                np.bincount(of, minlength=len(known)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the constant last) of a logistic regression by Newton steps.

    With one class only, or no rows, all weights are 0 but the constant.
    """
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if len(set(y.tolist())) < 2:
        return w
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str,
                    rows: int) -> list[tuple[str, int]]:
    """At most ``rows`` (text, label) pairs that models may learn from, to the driver.

    Rows are taken in the order of a hash of their id. A repeated label row counts once (the
    largest label), null labels, null ids and held-out ids are left out. ``rows`` bounds what a
    classifier is fitted on; scoring covers every row.
    """
    wanted = (labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    got = (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
           .join(F.broadcast(wanted), "doc_id"))
    return [(r._text, r._label) for r in got.select("_text", "_label", "doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows).toLocalIterator()]
