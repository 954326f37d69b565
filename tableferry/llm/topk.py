"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A term is a vector component. Rows are packed into candidate blocks, a block keeps the postings
(row, weight) of each term; every term of the query rows scatters weight times posting into dense
score arrays, one array per query. A partition step selects the best of the block, and a ranked
merge joins the blocks. The query set meets all rows block by block: both sides are packed first,
so a join row is a pair of blocks, and no pair of vectors is ever a row.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do
rows without id; an empty vector scores 0; a missing component counts as 0 where lengths differ;
ties go to the smaller id; rows that share an id are each a candidate of the others' queries but
never of their own id's, and each is a query. Scores are exact, and held to the range of a long
where components are huge. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tableferry.session import stored

CANDIDATE_BLOCK = 1024
QUERY_BLOCK = 2048
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``(id, vec)`` of the rows that take part, components as floor(scale * x) in doubles."""
    sound = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
                    .cast("double")).alias("vec"))


def packed(rows: DataFrame, size: int, by_partition: bool = False) -> DataFrame:
    """Rows packed into blocks ``(block, n, width, ids, data)``, ids ascending in a block."""

    def task(batches):
        held: list[tuple[int, list[float]]] = []
        seq = 0
        part = TaskContext.get().partitionId()

        def block(rows):
            rows.sort(key=lambda r: r[0])
            width = max(len(v) for _, v in rows)
            data = np.zeros((len(rows), width))
            for i, (_, v) in enumerate(rows):
                data[i, :len(v)] = v
            number = part if by_partition else (part << 32) | seq
            return pa.RecordBatch.from_pylist([{
                "block": number, "n": len(rows), "width": width,
                "ids": np.array([i for i, _ in rows], np.int64).tobytes(),
                "data": data.tobytes()}], schema=pa.schema([
                    ("block", pa.int64()), ("n", pa.int32()), ("width", pa.int32()),
                    ("ids", pa.binary()), ("data", pa.binary())]))

        for batch in batches:
            held += zip(batch.column("id").to_pylist(), batch.column("vec").to_pylist())
            while len(held) >= size:
                yield block(held[:size])
                held, seq = held[size:], seq + 1
        if held:
            yield block(held)

    return rows.mapInArrow(task, "block long, n int, width int, ids binary, data binary")


def block_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores of all queries for a block of candidates, a term at a time."""
    terms = min(q.shape[1], c.shape[1])
    bound = float(np.abs(q[:, :terms]).max(initial=0)) * float(np.abs(c).max(initial=0)) * terms
    if bound < 2.0 ** 53:
        kind = np.float64  # whole numbers below 2^53 are exact in doubles
    else:
        kind = object
        q, c = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
                for m in (q, c))
    scores = np.zeros((len(q), len(c)), kind)
    for term in range(terms):
        posting, asking = np.flatnonzero(c[:, term]), np.flatnonzero(q[:, term])
        if not len(posting) or not len(asking):
            continue
        add = np.multiply.outer(q[asking, term], c[posting, term])
        if len(posting) == len(c) and len(asking) == len(q):
            scores += add
        else:
            scores[np.ix_(asking, posting)] += add
    return scores


def best_of(row: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) of one dense array, ties to smaller ids; ids ascend."""
    open_ = np.flatnonzero(ids != own)
    row = row[open_]
    if len(row) > k:
        edge = np.partition(row, len(row) - k)[len(row) - k]
        above = np.flatnonzero(row > edge)
        pick = np.concatenate([above, np.flatnonzero(row == edge)[:k - len(above)]])
    else:
        pick = np.arange(len(row))
    return [(min(max(int(row[i]), LONG_MIN), LONG_MAX), int(ids[open_[i]])) for i in pick]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the exact ``k`` best candidates of every query.

    Both sides are ``(id, vec)`` as :func:`quantised` gives them.
    """
    spark = queries.sparkSession
    queries = queries.withColumn("copy", F.monotonically_increasing_id())
    queries = stored(queries, "topk-queries")
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    salts = max(1, -(-spark.sparkContext.defaultParallelism * 4 // n_blocks))
    asking = packed(queries.repartition(n_blocks).select("id", "vec"), 1 << 62, True)
    asking = asking.select(F.col("block").alias("q_block"), F.col("n").alias("q_n"),
                           F.col("width").alias("q_width"), F.col("ids").alias("q_ids"),
                           F.col("data").alias("q_data"),
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    # a block meets every block of queries; the salt spreads its meetings over tasks
    giving = packed(candidates, CANDIDATE_BLOCK).select(
        "*", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("q_block"))
    met = giving.join(asking, ["q_block", "salt"])

    def task(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                ids = np.frombuffer(r["ids"], np.int64)
                data = np.frombuffer(r["data"]).reshape(r["n"], r["width"])
                q_ids = np.frombuffer(r["q_ids"], np.int64)
                q_data = np.frombuffer(r["q_data"]).reshape(r["q_n"], r["q_width"])
                out = []
                for start in range(0, len(q_ids), 512):
                    part = block_scores(q_data[start:start + 512], data)
                    for i, row in enumerate(part, start):
                        out += [(int(q_ids[i]), (r["q_block"] << 32) | i, vec_id, score)
                                for score, vec_id in best_of(row, ids, int(q_ids[i]), k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[n] for o in out], pa.int64()) for n in range(4)],
                    names=["query_id", "row", "vec_id", "score"])

    parts = met.select("q_block", "n", "width", "ids", "data", "q_n", "q_width", "q_ids",
                       "q_data").mapInArrow(
        task, "query_id long, row long, vec_id long, score long")
    # the rank limit is pushed below the shuffle: each task sends at most k rows of a query
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
