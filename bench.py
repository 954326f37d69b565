"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableferry.plans.queries import QUERIES  # noqa: E402
from tableferry.session import local_session  # noqa: E402

HEADLINE = ("source_query", "encode_rows", "pack_messages", "send_stats", "topic_write_read",
            "route_messages", "decode_rows", "audit_counts", "flush_by_rows", "pack_messages_blocks",
            "clear_events", "partition_reload", "upsert_last_wins", "range_partition_assign",
            "file_chunks", "file_reassemble", "layout_partition_counts", "sync_append",
            "sync_upsert", "sync_files", "sync_bounded", "stream_resume")


def main(names) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # one small query first, so that the first timed one does not pay for the start
    QUERIES["pack_messages"](spark, "/root/testdata/sf0.001").collect()
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "sync_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
