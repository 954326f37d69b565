"""Near duplicates by HyperMinHash.

A document's set is its distinct word shingles. A shingle's hash picks one of 128 buckets; the
smallest hash of each is kept as its number of leading zeros and ten bits of mantissa. Bands of
compressed registers propose pairs; the share of equal registers, corrected for chance collisions
and, in sets of very different size, for what their sizes allow, drops pairs that are far from the
threshold; the rest is confirmed on full sets.

Equal sets are one class from the start, and classes are linked, not their copies. A bucket of a
band does not emit its pairs: everyone is compared with the smallest id, then components are
formed. Only buckets that still hold several components go on, and their documents are joined
exactly by the rarest shingles of each set, across components.

Defined results: only A-Z are lower-cased; null, empty and blank texts have no set and are
linked with nothing; shorter texts than a shingle are one shingle; rows that share a doc_id are
one node, linked by the set of any of them; a row without id is kept and linked with nothing; no
documents give no rows; extra columns are kept by :func:`kept_documents`, which of rows that share
an id keeps the one whose text sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tableferry.llm.common import U64, WordHasher, mixed, sliced, texts
from tableferry.llm.components import components
from tableferry.session import stored

SHINGLE = 5
THRESHOLD = (75, 100)
BANDS, ROWS = 32, 4
BUCKETS = BANDS * ROWS
MANTISSA = 10
EMPTY = 0xFFFF
MARGIN = 0.22      # four to six standard deviations of an estimate
SMALL_SET = 64    # estimates of smaller sets are not used
HUB_ROUNDS = 2
# bytes of text that a task works on at once; arrays of these steps take some 50 times that
SLICE = 512 << 10


def shingle_hashes(data: list[bytes], hasher: WordHasher, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = hasher.words([t.lower() for t in data])  # bytes: A-Z only
    spread, starts = words.hashes, words.starts
    n = max(0, len(spread) - k + 1)
    grams = np.zeros(n, U64)
    for i in range(k):
        grams = grams * U64(0x9E3779B97F4A7C15) + spread[i:n + i]
    grams = mixed(grams)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            short = np.full(1, b - a, U64)
            for x in spread[a:b]:
                short = short * U64(0x9E3779B97F4A7C15) + x
            out.append(mixed(short))
        else:
            out.append(np.zeros(0, U64))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers: leading zeros of the bucket's smallest hash and its mantissa."""
    low = np.full(BUCKETS, 1 << 53, np.int64)
    np.minimum.at(low, (hashes & U64(BUCKETS - 1)).astype(np.int64),
                  (hashes >> U64(11)).astype(np.int64))
    exponent = np.frexp(np.maximum(low, 1).astype(np.float64))[1].astype(np.int64)
    zeros = 53 - exponent
    digits = (np.left_shift(low, zeros) >> (52 - MANTISSA)) & ((1 << MANTISSA) - 1)
    return np.where(low == 1 << 53, EMPTY, (zeros << MANTISSA) | digits).astype(np.uint16)


def estimated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers. Two different minima give equal registers with a
    chance of about 1 in 3 * 2^MANTISSA; that share of the unequal ones is taken off."""
    used = (a != EMPTY) | (b != EMPTY)
    equal = ((a == b) & used).sum(axis=1) / np.maximum(used.sum(axis=1), 1)
    chance = 1 / (3 << MANTISSA)
    return (equal - chance) / (1 - chance)


def sketched(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, set_hash, sketch)`` of every row."""

    def task(batches):
        hasher = WordHasher(2 * SLICE)
        for batch in sliced(batches, "text", SLICE):
            sets = shingle_hashes([t.encode() for t in texts(batch, "text")], hasher)
            sums = [mixed(s + U64(1)).sum(dtype=U64).tobytes()
                    + np.bitwise_xor.reduce(mixed(s + U64(2)), initial=0).astype(U64).tobytes()
                    for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(sums, pa.binary()),
                 pa.array([registers(s).tobytes() for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "set_hash", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        task, "doc_id long, n_shingles long, set_hash binary, sketch binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """``(key, doc_id)`` for each band with at least one register in use."""

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint16)
                rows = rows.reshape(-1, BANDS, ROWS)
                keys = np.ascontiguousarray(rows).view(U64).reshape(-1, BANDS)
                used = (rows != EMPTY).any(axis=2)
                keys = mixed(mixed(keys) + np.arange(1, BANDS + 1, dtype=U64))
                who, band = np.nonzero(used)
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[who, band].view(np.int64)), pa.array(ids[who])],
                    names=["key", "doc_id"])

    return classes.select("doc_id", "sketch").mapInArrow(task, "key long, doc_id long")


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and estimates do not rule out."""
    num, den = THRESHOLD
    left = classes.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"),
                          F.col("sketch").alias("sa"))
    right = classes.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"),
                           F.col("sketch").alias("sb"))
    # |A n B| / |A u B| is at most min / max
    sized = pairs.join(left, "a").join(right, "b").where(
        F.least("na", "nb") * den >= F.greatest("na", "nb") * num)

    def task(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                    .reshape(-1, BUCKETS) for c in ("sa", "sb"))
            few = np.minimum(batch.column("na").to_numpy(), batch.column("nb").to_numpy()) \
                < SMALL_SET
            ok = few | (estimated(a, b) >= num / den - MARGIN)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))],
                names=["a", "b"])

    return sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(task, "a long, b long")


def confirmed(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough; ``chosen`` has the texts ``(doc_id, text)``."""
    num, den = THRESHOLD
    ta = chosen.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = chosen.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def task(batches):
        hasher = WordHasher(2 * SLICE)
        for batch in sliced(batches, "tb", SLICE):
            keep, last, own = [], None, None
            for a, x, y in zip(batch.column("a").to_pylist(), texts(batch, "ta"),
                               texts(batch, "tb")):
                if a != last:
                    last, own = a, shingle_hashes([x.encode()], hasher)[0]
                other = shingle_hashes([y.encode()], hasher)[0]
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(den * both >= num * (len(own) + len(other) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")],
                names=["a", "b"])

    return pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(
        task, "a long, b long")


def shingled(chosen: DataFrame) -> DataFrame:
    """``(shingle, node, component, n)``: every distinct shingle of each row of ``chosen``, and
    how many the row has."""

    def task(batches):
        hasher = WordHasher(2 * SLICE)
        for batch in sliced(batches, "text", SLICE):
            sets = shingle_hashes([t.encode() for t in texts(batch, "text")], hasher)
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.zeros(0, U64)
            each = [batch.column("node").to_numpy(), batch.column("component").to_numpy(), size]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), *(pa.array(np.repeat(c, size)) for c in each)],
                names=["shingle", "node", "component", "n"])

    return chosen.select("node", "component", "text").mapInArrow(
        task, "shingle long, node long, component long, n long")


def narrowed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of shingles that several components hold, of the nodes that can still have a
    partner in another one: at least 75 percent of such a set are shingles of this kind.

    ``place`` is the shingle's place in its set, ``n`` the size of the set. The order is by the
    number of sets that hold a shingle, so shingles of one component come first; they need no row.
    """
    num, den = THRESHOLD
    held = stored(rows.groupBy("shingle").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.count(F.lit(1)).alias("sets")).where("lo <> hi").select("shingle", "sets"), "near-held")
    own = Window.partitionBy("node")
    shared = (rows.select("shingle", "node", "n").join(held, "shingle")
              .withColumn("_shared", F.count(F.lit(1)).over(own))
              .withColumn("_rank", F.row_number().over(own.orderBy("sets", "shingle"))))
    return shared.where(F.col("_shared") * den >= F.col("n") * num).join(nodes, "node").select(
        "shingle", "node", "component", "doc_id", "n",
        (F.col("n") - F.col("_shared") + F.col("_rank")).alias("place"))


def rarest(chosen: DataFrame) -> DataFrame:
    """``(shingle, doc_id, component, n, rest)``: the prefix of each set in an order of all
    shingles, with the number of shingles in the set and from this one on.

    Two sets of the wanted similarity share a shingle among the first ``n - ceil(0.75 n) + 1`` of
    each, whatever the order is, as long as it is one for all. Here the shingles of fewest sets
    come first, so that passages which many documents share are met last. Narrowing once takes
    away sets that only share passages; those left make a smaller table, which is narrowed again
    as their partners may be gone.
    """
    num, den = THRESHOLD
    nodes = chosen.select("node", "doc_id", "component")
    rows = stored(narrowed(shingled(chosen), nodes), "near-narrow")
    rows = stored(narrowed(rows, nodes), "near-narrow")
    return rows.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * num / den) + 1).select(
        "shingle", "doc_id", "component", "n", (F.col("n") - F.col("place") + 1).alias("rest"))


def still_open(met: DataFrame, comps: DataFrame, *more) -> tuple[DataFrame, DataFrame]:
    """The rows ``(key, doc_id, component)`` of all buckets, and the buckets of several
    components with what ``more`` aggregates of them."""
    named = stored(met.join(comps, met["doc_id"] == comps["id"], "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("component")), "near-named")
    keys = named.groupBy("key").agg(F.min("component").alias("lo"),
                                    F.max("component").alias("hi"), *more).where("lo <> hi")
    return named, keys


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between classes, enough of them to give every component."""
    num, den = THRESHOLD
    rows = stored(band_keys(classes), "near-bands")
    low = rows.groupBy("key").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    met = stored(rows.join(low.where("n > 1").drop("n"), "key"), "near-met")
    chosen = stored(docs.join(met.select("doc_id").distinct(), "doc_id", "left_semi"),
                    "near-texts")
    star = met.where("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    pairs = stored(likely(star.distinct(), classes), "near-pairs")
    found = stored(confirmed(pairs, chosen), "near-links")
    comps = stored(components(found), "near-components")
    # the same in the buckets that are still open, around one document of each by chance
    for seed in range(HUB_ROUNDS):
        hub = F.min_by("doc_id", F.xxhash64("key", "doc_id", F.lit(seed))).alias("_hub")
        open_, keys = still_open(met, comps, hub)
        hubs = keys.select("key", "_hub").join(comps, keys["_hub"] == comps["id"], "left").select(
            "key", "_hub", F.coalesce("component", "_hub").alias("_hub_component"))
        star = open_.join(hubs, "key").where("component <> _hub_component").select(
            F.least("_hub", "doc_id").alias("a"), F.greatest("_hub", "doc_id").alias("b"))
        again = stored(likely(star.distinct().join(pairs, ["a", "b"], "left_anti"), classes),
                       "near-pairs")
        pairs = pairs.union(again)
        found = stored(found.union(confirmed(again, chosen)), "near-links")
        comps = stored(components(found), "near-components")
    open_, keys = still_open(met, comps)
    left = stored(open_.join(keys.select("key"), "key").select("doc_id", "component")
                  .distinct(), "near-left")
    texts_left = stored(chosen.join(left, "doc_id").withColumn(
        "node", F.monotonically_increasing_id()), "near-rest")
    first = stored(rarest(texts_left), "near-shared")
    # of n tokens in order, those from the shared one on must be enough for the overlap
    other = first.select("shingle", F.col("doc_id").alias("b"), F.col("n").alias("_n"),
                         F.col("rest").alias("_rest"), F.col("component").alias("_c"))
    more = first.join(other, "shingle").where(
        (F.col("doc_id") < F.col("b")) & (F.col("component") != F.col("_c"))
        & (F.least("n", "_n") * den >= F.greatest("n", "_n") * num)
        & (F.least("rest", "_rest") * (num + den) >= (F.col("n") + F.col("_n")) * num)).select(
            F.col("doc_id").alias("a"), "b").distinct()
    more = stored(more.join(pairs, ["a", "b"], "left_anti"), "near-more")
    return stored(found.union(confirmed(more, texts_left)), "near-found")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row."""
    sketches = stored(sketched(docs), "near-sketches")
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy("set_hash").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch")), "near-classes")
    named = links(docs.select("doc_id", "text"), classes)
    comps = components(named)
    whole = classes.join(comps, classes["doc_id"] == comps["id"], "left").select(
        "set_hash", F.coalesce("component", "doc_id").alias("_component"))
    slim = sketches.select("doc_id", "n_shingles", "set_hash")
    return slim.join(whole, "set_hash", "left").select(
        "doc_id", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id"),
        F.coalesce(F.col("_component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group, the one of the smallest id, with all its columns."""
    found = stored(near_duplicates(docs), "near-result")
    ids = found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    named = docs.join(ids, docs["doc_id"] == ids["_id"], "left_semi")
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return named.unionByName(docs.where("doc_id is null"))
    # rows that share an id: one stays
    order = Window.partitionBy("doc_id").orderBy("text")
    rows = named.select("doc_id", "text", F.struct("*").alias("row"))
    return (rows.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
            .unionByName(docs.where("doc_id is null")))
