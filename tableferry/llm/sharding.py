"""Shards of near-equal bytes from indivisible groups, by Karmarkar-Karp differencing.

The law is ``bytes``. Equal texts are one group and go to one shard. A partial partition holds
one sum per shard; the two with the largest spread are combined again and again, the largest sum
of one with the smallest of the other, until one is left.

Groups are cut into buckets by their hash and each bucket is differenced in one task; the partial
partitions that are left, one per bucket, are the items of the next level, until one bucket holds
them all. Which position each item took is kept per level, and composed on the way back.

Defined results: a null text has no bytes and counts as empty; repeated rows are copies of a
group; a row without id is placed like any other; no documents give no rows; extra columns are
ignored. A group with more than a shard's share of bytes fills its shard alone.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tableferry.session import stored

SHARDS = 16
BUCKET_ITEMS = 4096
HOT_SHARE = 512
SLOT_ROWS = 2000


def differenced(parts: list[tuple[list[int], list]], shards: int) -> tuple[list[int], list]:
    """Combine partial partitions, largest spread first, until one is left.

    A part is (sums ascending, trees); trees[i] tells what is in position i: nothing (None), an
    item ``(item, slot, size)``, or a pair of trees, so that combining costs O(shards).
    """
    heap = [(sums[0] - sums[-1], n, sums, trees) for n, (sums, trees) in enumerate(parts)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a, ta = heapq.heappop(heap)
        _, _, b, tb = heapq.heappop(heap)
        merged = sorted(((a[i] + b[shards - 1 - i], i) for i in range(shards)))
        sums = [s for s, _ in merged]
        trees = [(ta[i], tb[shards - 1 - i]) for _, i in merged]
        heapq.heappush(heap, (sums[0] - sums[-1], n, sums, trees))
        n += 1
    return heap[0][2], heap[0][3]


def leaves(tree):
    """The items of a tree, without recursion."""
    stack = [tree]
    while stack:
        node = stack.pop()
        if node is not None and len(node) == 2:
            stack += node
        elif node is not None:
            yield node


def combined(items: DataFrame, shards: int) -> DataFrame:
    """Per ``bucket``: which position each ``(item, slot)`` of its partial partitions takes.

    ``items`` has ``bucket, item, sums``; the result ``bucket, item, slot, position, size``.
    """

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for item, sums in zip(pdf["item"], pdf["sums"]):
            full = [0] * (shards - len(sums)) + [int(s) for s in sums]
            order = sorted(range(shards), key=lambda i: full[i])
            first = shards - len(sums)
            parts.append(([full[i] for i in order],
                          [(item, i - first, full[i]) if i >= first else None
                           for i in order]))
        _, trees = differenced(parts, shards)
        rows = [(item, slot, at, size) for at, tree in enumerate(trees)
                for item, slot, size in leaves(tree)]
        out = pd.DataFrame(rows, columns=["item", "slot", "position", "size"])
        out["bucket"] = pdf["bucket"].iloc[0]
        return out

    return items.select("bucket", "item", "sums").groupBy("bucket").applyInPandas(
        bucket, "bucket long, item long, slot int, position int, size long")


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """``(item, shard)`` for groups ``(item, size)`` with unique long ``item``."""
    n = groups.count()
    levels = []
    items = groups.select("item", F.array("size").alias("sums"))
    while True:
        buckets = max(1, -(-n // BUCKET_ITEMS))
        items = items.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
        level = stored(combined(items, shards), "kk-level")
        levels.append(level)
        if buckets == 1:
            break
        sums = level.groupBy("bucket", "position").agg(F.sum("size").alias("size"))
        zeros = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda p: F.struct(
            p.alias("position"), F.lit(0).cast("long").alias("size")))
        items = sums.groupBy(F.col("bucket").alias("item")).agg(
            F.map_from_entries(F.collect_list(F.struct("position", "size"))).alias("_m")).select(
                "item", F.transform(zeros, lambda z: F.coalesce(
                    F.try_element_at("_m", z["position"]), z["size"])).alias("sums"))
        n = buckets
    place = levels.pop().select("item", "slot", F.col("position").alias("shard"))
    while levels:
        above = place.select(F.col("item").alias("bucket"), F.col("slot").alias("position"),
                             "shard")
        place = levels.pop().join(above, ["bucket", "position"]).select("item", "slot", "shard")
    return place.select("item", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, group_key, shard, slot)``: a slot is the document's place in
    its shard, gapless from 0."""
    text = F.coalesce("text", F.lit(""))
    slim = stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("group_key")), "shard-rows")
    n = slim.count()
    groups = slim.groupBy("group_key").agg(F.sum("size").alias("size"),
                                           F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.withColumn("item", F.monotonically_increasing_id()), "shard-groups")
    placed = stored(groups.join(group_shards(groups, shards), "item")
                    .select("group_key", "shard", "copies"), "shard-placed")
    # at most HOT_SHARE groups can hold so many rows: they are broadcast, so that no task of the
    # join of the others gets more copies of a text than that share
    hot = F.col("copies") > max(n // HOT_SHARE, 50)
    hot_rows = F.broadcast(placed.where(hot).drop("copies").withColumnRenamed("shard", "_hot"))
    marked = slim.join(hot_rows, "group_key", "left")
    done = marked.where(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "shard")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(
        placed.where(~hot).drop("copies"), "group_key")
    return numbered(stored(done.unionByName(rest.select(done.columns)), "shard-assigned"), n)


def numbered(rows: DataFrame, n: int) -> DataFrame:
    """Number the rows of each shard from 0: counts of small buckets are summed up first, so no
    window holds more than a bucket's rows or a row per bucket."""
    buckets = max(1, min(n // SLOT_ROWS, 1 << 16))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    along = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "group_key")
    return (rows.join(starts, ["shard", "_bucket"])
            .withColumn("slot", F.col("_start") + F.row_number().over(inside) - 1)
            .drop("_bucket", "_start"))
