"""Buckets of ids that are spread unevenly."""

import hashlib

from tableferry.llm import winnow


def test_a_far_id_fills_no_bucket(spark):
    ids = [*range(3000), *range(7_000_000, 7_001_000), 10**15, -(10**12)]
    docs = spark.createDataFrame([(i, f"text {i} of many") for i in ids] + [(None, "no id")],
                                 "doc_id long, text string")
    sizes = winnow.with_next(docs).where("bucket is not null").groupBy("bucket").count().toPandas()
    assert sizes["count"].max() <= winnow.ROWS_PER_BUCKET + 1
    order = sorted(ids, reverse=True)
    want = {}
    for i, j in zip(order, order[1:] + order[:1]):
        own, other = f"text {i} of many", f"text {j} of many"
        half = len(own) // 2
        want[i] = hashlib.sha256((own[:len(own) - half] + other[:half]).encode()).hexdigest()
    got = {r.doc_id: r.edited_sha256 for r in winnow.edit_check(docs).collect()}
    assert len(got) == len(ids) + 1 and got.pop(None)
    assert got == want
