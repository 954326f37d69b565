"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; each window of ``window`` consecutive hashes
keeps its smallest one, the rightmost of equal ones, with its position. Two texts that share
``k + window - 1`` code points in a row share a kept hash.

Defined results: null counts as empty; the empty text keeps nothing, and its likeness is 1 to
another empty one and 0 to any other; a text shorter than a k-gram is hashed whole; a text with
fewer k-grams than a window is one window. Equal texts, repeated rows too, have equal
fingerprints. Extra columns are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tableferry.llm.common import U64, extended, mixed, sliced
from tableferry.operators import blocks
from tableferry.session import stored

K, WINDOW = 12, 24
BASE = 0x9E3779B97F4A7C15
ROWS_PER_BUCKET = 500


class Winnower:
    """Rolling hashes and window minima of texts of any length."""

    def __init__(self, k: int = K, window: int = WINDOW):
        self.k, self.window = k, window
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        inverse = pow(BASE, -1, 1 << 64)
        up, down = np.full(n, BASE, U64), np.full(n, inverse, U64)
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)

    def kept(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(positions, 32-bit hashes) of the kept k-grams, in order of position."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, k = len(points), min(self.k, len(points))
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        if n + 1 > len(self.up):
            self._grow(2 * n)
        # sums of c * B^-i; a difference times B^i is the hash of the k-gram at i, mod 2^64
        sums = np.zeros(n + 1, U64)
        np.cumsum((points.astype(U64) + U64(1)) * self.down[:n], out=sums[1:])
        grams = (sums[k:] - sums[:-k]) * self.up[:n - k + 1]
        hashes = mixed(grams) >> U64(32)
        # the smallest number has the smallest hash and, among equal ones, the last position
        keys = (hashes << U64(32)) | (U64(0xFFFFFFFF) - np.arange(len(hashes), dtype=U64))
        width = min(self.window, len(keys))
        least, span = keys, 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        least = least[np.concatenate([[True], least[1:] != least[:-1]])]
        return ((U64(0xFFFFFFFF) - (least & U64(0xFFFFFFFF))).astype(np.uint32),
                (least >> U64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two arrays of kept hashes."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def written(positions: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as text: for each kept k-gram 2 hex digits of the step from the position of
    the one before (a window is at most 255 long) and 8 of its hash."""
    out = np.empty(len(positions), [("step", "u1"), ("hash", ">u4")])
    out["step"], out["hash"] = np.diff(positions.astype(np.int64), prepend=0), hashes
    return out.tobytes().hex()


def fingerprints(docs: DataFrame, column: str = "text", k: int = K,
                 window: int = WINDOW) -> DataFrame:
    """Add the kept ``positions`` and ``hashes`` of each text as arrays."""
    kind = T.ArrayType(T.LongType())

    def make():
        winnower = Winnower(k, window)

        def work(values):
            got = [winnower.kept(v) for v in values]
            return [pa.array([x[i].astype(np.int64) for x in got], pa.list_(pa.int64()))
                    for i in (0, 1)]

        return work

    return extended(docs, [T.StructField("positions", kind), T.StructField("hashes", kind)],
                    make, column)


def bucket_of(starts: np.ndarray):
    """A function of an id column: the number of the last of the sorted ``starts`` that is not
    larger, null for null."""

    @F.arrow_udf(T.LongType())
    def bucket(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(starts, ids.fill_null(0).to_numpy(zero_copy_only=False), "right") - 1
        return pa.array(at, pa.int64(), mask=np.asarray(ids.is_null()))

    return bucket


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``(bucket, borrowed, doc_id, text)`` in which each document is followed by the next
    one of descending ``doc_id``: sorted within partitions, buckets whole.

    A bucket is a span of ids cut from row counts, so that it holds at most about ROWS_PER_BUCKET
    rows however ids are spread; rows of one id are never parted. The first document of the following bucket is borrowed as the last row of each; the last
    bucket borrows the first document of all. Repeated ids follow each other by text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = blocks.dense_order(docs.select("doc_id").where("doc_id is not null"), ["doc_id"])
    cuts = (ids.groupBy(blocks.block_of("ord", ROWS_PER_BUCKET)).agg(F.min("doc_id").alias("low"),
                                                                    F.max("doc_id").alias("high"))
            .toPandas())
    starts = np.unique(cuts["low"].to_numpy(np.int64))
    high = int(cuts["high"].max()) if len(cuts) else None
    docs = docs.withColumn("bucket", bucket_of(starts)("doc_id"))
    heads = docs.groupBy("bucket").agg(F.max("doc_id").alias("head"))
    heads = stored(heads.where(F.col("bucket").isNotNull()), "winnow-heads")
    lower = blocks.with_previous(heads, [], "bucket", ["head"], span=1000 * 1000)
    borrowed = lower.select("bucket", F.coalesce("prev_head", F.lit(high)).alias("doc_id"))
    # a few rows of ids; where they are many, a filter made of them goes below the shuffle of texts
    lent = docs.drop("bucket").join(borrowed, "doc_id").withColumn("borrowed", F.lit(1))
    rows = docs.withColumn("borrowed", F.lit(0)).unionByName(lent)
    return (rows.repartition("bucket")
            .sortWithinPartitions("bucket", "borrowed", F.desc("doc_id"), F.desc("text")))


def edit_check(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half replaced by the start
    of the next document. A row without id is its own next document."""

    def task(batches):
        winnower = Winnower(k, window)
        held = None  # (bucket, doc_id, text, kept)
        out = []

        def emit(row, text, kept):
            _, doc_id, own, mine = row
            half = len(own) // 2
            edited = own[:len(own) - half] + text[:half]
            its = winnower.kept(edited)
            out.append((doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(),
                        written(*mine), written(*its), likeness(mine[1], its[1]),
                        likeness(mine[1], kept[1])))

        def batch_of(rows):
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next"])

        for batch in sliced(batches, "text"):
            for bucket, borrowed, doc_id, text in zip(*(batch.column(c).to_pylist() for c in (
                    "bucket", "borrowed", "doc_id", "text"))):
                kept = winnower.kept(text)
                if held is not None:
                    emit(held, text, kept)
                held = None if borrowed else (bucket, doc_id, text, kept)
                if bucket is None:
                    emit(held, text, kept)
                    held = None
                if len(out) >= 200:
                    yield batch_of(out)
                    out.clear()
        if out:
            yield batch_of(out)

    return with_next(docs).select("bucket", "borrowed", "doc_id", "text").mapInArrow(
        task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
