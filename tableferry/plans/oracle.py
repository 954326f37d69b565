"""The registered queries as plain SQL on the same tables, for DuckDB."""

from __future__ import annotations

from tableferry.plans import fixtures as fx

LIMIT = 2048
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
EVENT_COLUMNS = (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                 ("event_type", "string"), ("value", "double"), ("props", "string"))


def fold(rows: str, limit: int, when: str, seed: int = 0) -> str:
    """Common table expressions ending in ``f(lane, ord, w, grp)``: one row at a time.

    ``rows`` selects lane, ord, w and whatever else should stay in ``numbered``.
    """
    if when == "before":
        step = (f"CASE WHEN f.size + n.w >= {limit} THEN f.grp + 1 ELSE f.grp END AS grp,"
                f" CASE WHEN f.size + n.w >= {limit} THEN {seed} + n.w ELSE f.size + n.w END"
                " AS size")
    else:
        step = (f"CASE WHEN f.size >= {limit} THEN f.grp + 1 ELSE f.grp END AS grp,"
                f" CASE WHEN f.size >= {limit} THEN n.w ELSE f.size + n.w END AS size")
    return f"""
WITH RECURSIVE numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lane ORDER BY ord) AS rn FROM ({rows}) r),
f AS (
  SELECT lane, rn, ord, w, CAST(0 AS BIGINT) AS grp, CAST({seed} + w AS BIGINT) AS size
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.lane, n.rn, n.ord, n.w, {step}
  FROM f JOIN numbered n ON n.lane = f.lane AND n.rn = f.rn + 1)"""


MESSAGES = f"m AS ({fx.MSG})"

REASON = """
CASE WHEN db_type = '' THEN 'no_db_type'
     WHEN lower(db_type) NOT IN ('clickhouse', 'kudu') THEN 'unroutable'
     WHEN target_table = '' THEN 'missing_target'
     WHEN lower(db_type) = 'kudu' AND regexp_replace(target_table, '^impala::', '') NOT IN
          (SELECT concat('tmp.', event_type) FROM events) THEN 'unknown_target'
     WHEN NOT json_valid(data) THEN 'undecodable' END"""

CHECKED = f"""{MESSAGES},
checked AS (SELECT *, {REASON} AS reason, lower(db_type) AS route,
                   regexp_replace(target_table, '^impala::', '') AS target FROM m),
records AS (
  SELECT *, json_extract_string(item, '$.k') AS k, CAST(pos AS INTEGER) AS row_pos
  FROM (SELECT *, unnest(range(n_rows)) AS pos FROM checked WHERE reason IS NULL) x)"""


def bad(reason: str) -> str:
    return (f"WITH {CHECKED} SELECT lane, msg_id, topic, target_table, reason FROM checked"
            f" WHERE reason = '{reason}'")


def flushed(when: str) -> str:
    rows = f"SELECT lane, msg_id AS ord, n_rows AS w FROM ({fx.MSG}) m"
    return fold(rows, 500, when) + """
SELECT lane, grp, count(*) AS n_messages, CAST(sum(w) AS BIGINT) AS n_rows,
       min(ord) AS first_msg, max(ord) AS last_msg FROM f GROUP BY lane, grp"""


TIMED = f"""
WITH RECURSIVE {MESSAGES},
numbered AS MATERIALIZED (
  SELECT lane, msg_id, n_rows, epoch_us(publish_time) AS t,
         row_number() OVER (PARTITION BY lane ORDER BY msg_id) AS rn FROM m),
f AS (
  SELECT lane, msg_id, n_rows, t, rn, CAST(0 AS BIGINT) AS grp, t AS t0,
         CAST(n_rows AS BIGINT) AS held, n_rows >= 500 AS closed
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT lane, msg_id, n_rows, t, rn,
         CASE WHEN fresh THEN grp + 1 ELSE grp END,
         CASE WHEN t - t0 >= 21600000000 THEN t ELSE t0 END,
         CASE WHEN fresh THEN n_rows ELSE held + n_rows END,
         (CASE WHEN fresh THEN n_rows ELSE held + n_rows END) >= 500
           OR t - t0 >= 21600000000
  FROM (SELECT n.lane, n.msg_id, n.n_rows, n.t, n.rn, f.grp, f.t0, f.held,
               f.closed OR n.t - f.t >= 3600000000 AS fresh
        FROM f JOIN numbered n ON n.lane = f.lane AND n.rn = f.rn + 1) s)
SELECT lane, grp, count(*) AS n_messages, CAST(sum(n_rows) AS BIGINT) AS n_rows,
       min(msg_id) AS first_msg, max(msg_id) AS last_msg FROM f GROUP BY lane, grp"""


def clears(keys: str) -> str:
    part = "part" if "part" in keys else "'' AS part"
    return f"""
SELECT clear_table, {part}, msg_id, batch_id,
       row_number() OVER (PARTITION BY {keys} ORDER BY msg_id) AS epoch
FROM (SELECT *, lag(batch_id) OVER (PARTITION BY {keys} ORDER BY msg_id) AS before
      FROM ({fx.CLEAR}) c) d
WHERE before IS DISTINCT FROM batch_id"""


def reloaded(keys: str) -> str:
    return f"""
SELECT msg_id, clear_table, part, value FROM (
  SELECT *, max(CASE WHEN before IS DISTINCT FROM batch_id THEN msg_id END)
            OVER (PARTITION BY {keys}) AS cleared
  FROM (SELECT *, lag(batch_id) OVER (PARTITION BY {keys} ORDER BY msg_id) AS before
        FROM ({fx.CLEAR}) c) d) e
WHERE msg_id >= cleared"""


def entries(table: str, key: str, pairs: list[tuple[str, str]]) -> str:
    names = ", ".join(f"'{n}'" for n, _ in pairs)
    values = ", ".join(v for _, v in pairs)
    return f"SELECT {key}, unnest([{names}]) AS entry, unnest([{values}]) AS value FROM {table}"


DOCS = ("SELECT doc_id, concat('doc_', doc_id, '.txt') AS file, encode(text) AS content,"
        " strlen(text) AS n FROM documents")


def document_parts(part: int = 1024) -> str:
    return f"""
SELECT *, array_slice(content, CAST(i * {part} + 1 AS BIGINT), CAST((i + 1) * {part} AS BIGINT))
          AS data
FROM (SELECT *, greatest(ceil(n / {part}.0), 1) AS total,
             unnest(range(CAST(greatest(ceil(n / {part}.0), 1) AS BIGINT))) AS i
      FROM ({DOCS}) d) p"""


HOLDS = "(doc_id % 10 = 0 AND total >= 2) OR doc_id % 10 = 1"

RANGE_ROWS = """
ranges AS (
  SELECT DISTINCT concat('tmp.', event_type) AS target_table, lower, upper FROM (
    SELECT event_type, CAST(20240101 AS BIGINT) AS lower, CAST(20240108 AS BIGINT) AS upper
    FROM events
    UNION ALL
    SELECT event_type,
           CASE WHEN day(ts) < 8 THEN 20240101 WHEN day(ts) < 15 THEN 20240108 ELSE 20240115 END,
           CASE WHEN day(ts) < 8 THEN 20240108 WHEN day(ts) < 15 THEN 20240115 ELSE 20240122 END
    FROM events WHERE day(ts) < 22) u)"""

LATEST = """
row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn"""

TEXT_BUCKETS = """
SELECT CAST(floor(doc_id / 250.0) AS BIGINT) AS bucket, CAST(sum(strlen(text) + 1) AS BIGINT)
         AS n_bytes,
       string_agg(concat(text, chr(10)), '' ORDER BY doc_id) AS content
FROM documents GROUP BY 1"""

ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderday FROM orders"""

SENTINEL = f"""{MESSAGES},
marked AS (SELECT *, min(CASE WHEN msg_id % 997 = 996 THEN msg_id END) OVER (PARTITION BY lane)
                  AS stop FROM m),
bounded AS (SELECT * FROM marked WHERE stop IS NULL OR msg_id < stop)"""

BOUNDED_ROWS = f"""
SELECT lane, msg_id AS ord, n_rows AS w, item FROM (
  SELECT *, min(CASE WHEN msg_id % 997 = 996 THEN msg_id END) OVER (PARTITION BY lane) AS stop
  FROM ({fx.MSG}) m) b
WHERE (stop IS NULL OR msg_id < stop) AND json_valid(data)"""

ORACLE: dict[str, str] = {
    "source_query": "SELECT o_custkey AS shop, o_orderkey AS id, o_orderstatus AS status,"
                    " 'jd' AS platform FROM orders",
    "source_table": "SELECT * FROM customer",
    "row_batches": """
SELECT CAST(floor((rn - 1) / 1000.0) AS BIGINT) AS batch_no, count(*) AS n_rows,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) o
GROUP BY 1""",
    "named_rows": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
    "describe_table": " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS column_name, '{t}' AS data_type,"
        f" (SELECT count({n}) FROM events) AS n_values" for i, (n, t) in enumerate(EVENT_COLUMNS)),
    "templated_query": """
SELECT event_type, '(20240115,20240116)' AS partition, count(*) AS n_all,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16')
         AS n_day
FROM events GROUP BY event_type""",
    "topic_write_read": f"""WITH {MESSAGES}
SELECT lane, msg_id, topic, target_table, CAST(n_rows AS STRING) AS n_rows,
       md5(data) AS data_md5 FROM m""",
    "topic_read": f"""WITH {MESSAGES}
SELECT lane, msg_id, epoch_us(publish_time) AS published_us, batch_id FROM m""",
    "topic_fan_in": """
SELECT o_orderkey AS msg_id, o_orderstatus AS data, 'orders' AS topic,
       CAST(0 AS INTEGER) AS source_lane FROM orders
UNION ALL SELECT c_custkey, c_mktsegment, 'customers', 1 FROM customer
UNION ALL SELECT event_id, event_type, 'events', 2 FROM events""",
    "read_until_sentinel": f"WITH {SENTINEL} SELECT lane, msg_id FROM bounded",
    "file_listing": f"SELECT bucket, n_bytes FROM ({TEXT_BUCKETS}) b",
    "file_parts_plan": f"SELECT bucket, n_bytes, CAST(ceil(n_bytes / 1024.0) AS BIGINT)"
                       f" AS n_parts FROM ({TEXT_BUCKETS}) b",
    "catalog_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "sample_rows": "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey"
                   " LIMIT 10",
    "export_parquet": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "project_literal": "SELECT c_mktsegment AS segment, c_custkey AS shop_id, 'tb' AS platform,"
                       " CAST(20210804 AS INTEGER) AS day FROM customer",
    "row_mapper": "SELECT c_custkey AS shop_id, c_name, lower(c_mktsegment) AS segment,"
                  " c_nationkey % 5 AS region_hint FROM customer",
    "row_mapper_python": "SELECT c_custkey AS shop_id, replace(c_name, 'Customer', 'Shop')"
                         " AS name, substr(c_mktsegment, 1, 2) AS initials FROM customer",
    "encode_rows": "SELECT o_orderkey, CAST(json_object('o_orderkey', o_orderkey, 'o_custkey',"
                   " o_custkey, 'o_orderstatus', o_orderstatus, 'o_orderpriority',"
                   " o_orderpriority) AS STRING) AS enc FROM orders",
    "decode_rows": f"""WITH {MESSAGES}
SELECT msg_id, CAST(pos AS INTEGER) AS row_pos, json_extract_string(item, '$.k') AS k
FROM (SELECT *, unnest(range(n_rows)) AS pos FROM m WHERE json_valid(data)) x""",
    "oversize_rows": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS row_bytes FROM documents"
                     " WHERE strlen(text) > 8192",
    "align_types": f"""WITH {MESSAGES}
SELECT msg_id, CAST(pos AS INTEGER) AS row_pos, CAST(replace(batch_id, '-', '') AS INTEGER) AS day,
       TRY_CAST(json_extract_string(item, '$.k') AS INTEGER) AS k, CAST(NULL AS STRING) AS note,
       CASE WHEN TRY_CAST(json_extract_string(item, '$.k') AS INTEGER) IS NULL THEN 'k' END
         AS dirty_fields
FROM (SELECT *, unnest(range(n_rows)) AS pos FROM m WHERE json_valid(data)) x""",
    "pack_messages": fold(f"SELECT *, strlen(enc) AS w FROM ({fx.ROW}) q", LIMIT, "before") + """
SELECT f.lane, f.grp AS msg, min(f.ord) AS first_order, count(*) AS n_rows,
       CAST(sum(f.w) AS BIGINT) AS n_bytes, md5(string_agg(n.enc, ',' ORDER BY f.ord)) AS rows_md5
FROM f JOIN numbered n USING (lane, ord) GROUP BY f.lane, f.grp""",
    "pack_json_array": fold("""
SELECT lane, ord, enc, strlen(enc) + 1 AS w FROM (
  SELECT o_orderkey % 4 AS lane, o_orderkey AS ord, CAST(json_object('o_orderkey', o_orderkey,
         'o_custkey', o_custkey, 'o_orderstatus', o_orderstatus) AS STRING) AS enc
  FROM orders) e""", LIMIT, "before", 1) + """,
g AS (SELECT f.lane, f.grp, count(*) AS n_rows,
             concat('[', string_agg(n.enc, ',' ORDER BY f.ord), ']') AS data
      FROM f JOIN numbered n USING (lane, ord) GROUP BY f.lane, f.grp)
SELECT lane, grp AS msg, n_rows, CAST(strlen(data) AS BIGINT) AS data_bytes,
       md5(data) AS data_md5 FROM g""",
    "append_header": entries("orders", "o_orderkey", [
        ("target_table", "concat('tmp.', lower(o_orderstatus))"),
        ("batch_id", "strftime(o_orderdate, '%Y-%m-%d')"), ("source_table", "'orders'"),
        ("clear_table", "CASE WHEN o_orderkey % 2 = 0 THEN 'tmp.clear_all' ELSE '' END"),
        ("partition", "concat('''', o_orderstatus, '''')"), ("cluster_name", "''"),
        ("source_platform", "'jd'"), ("target_platform", "''"),
        ("task_id", "CAST(o_custkey AS STRING)"), ("db_type", "'clickhouse'")]),
    "keyed_header": entries("customer", "c_custkey", [
        ("target_table", "concat('impala::tmp.', lower(c_mktsegment))"),
        ("source_table", "'customer'"), ("write_mode", "'upsert'"),
        ("batch_id", "concat('n', c_nationkey)"), ("task_id", "''"), ("source_platform", "''"),
        ("target_platform", "''"), ("range_partition", "'20210804<=VALUES<20210805'"),
        ("db_type", "'kudu'"), ("priority", "CAST(c_nationkey % 3 AS STRING)")]),
    "header_enrich": entries(f"({fx.MSG}) m", "msg_id", [
        ("task_id", "CASE WHEN msg_id % 2 = 0 THEN concat('t', lane) ELSE 'sync_task' END"),
        ("source_table", "topic"), ("db_type", "db_type"),
        ("rows", "CAST(n_rows AS STRING)")]),
    "send_stats": fold(f"SELECT *, strlen(enc) AS w FROM ({fx.ROW}) q", LIMIT, "before") + """,
g AS (SELECT lane, grp, count(*) AS n, sum(w) AS b FROM f GROUP BY lane, grp)
SELECT lane, count(*) AS messages, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(sum(b) AS BIGINT) AS n_bytes, CAST(max(b) AS BIGINT) AS largest FROM g GROUP BY lane""",
    "text_messages": """
SELECT doc_id % 4 AS lane, doc_id AS msg_id, CAST(strlen(text) AS BIGINT) AS n_bytes,
       md5(text) AS data_md5 FROM documents
UNION ALL
SELECT doc_id % 4, max(doc_id) + 1, 8, md5('END_SIGN') FROM documents GROUP BY 1""",
    "route_messages": f"""WITH {MESSAGES}
SELECT msg_id, CASE WHEN db_type = '' THEN 'default' ELSE lower(db_type) END AS route FROM m""",
    "normalise_target": f"""WITH {MESSAGES}
SELECT msg_id, CASE WHEN starts_with(target_table, 'impala::') THEN substr(target_table, 9)
                    ELSE target_table END AS target FROM m""",
    "bad_missing_target": bad("missing_target"),
    "unknown_target": bad("unknown_target"),
    "bad_undecodable": bad("undecodable"),
    "bad_messages": f"""WITH {CHECKED}
SELECT 'bad_msg' AS channel, reason, topic, msg_id, target_table, md5(data) AS payload
FROM checked WHERE reason IS NOT NULL""",
    "wal_rows": f"""WITH {CHECKED}
SELECT 'wal' AS channel, 'decoded' AS reason, topic, msg_id, target_table,
       concat('{{"k":"', k, '","row_pos":', row_pos, '}}') AS payload FROM records""",
    "dirty_rows": f"""WITH {CHECKED}
SELECT msg_id, row_pos, target, 'k' AS dirty_fields FROM records
WHERE TRY_CAST(k AS INTEGER) IS NULL""",
    "audit_counts": f"""WITH {CHECKED}
SELECT 'bad_msg' AS channel, reason, count(*) AS entries FROM checked
WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'wal', 'decoded', count(*) FROM records
UNION ALL SELECT 'dirty', 'type_mismatch', count(*) FROM records
WHERE TRY_CAST(k AS INTEGER) IS NULL HAVING count(*) > 0
UNION ALL SELECT 'normal', 'written', count(*) FROM records WHERE TRY_CAST(k AS INTEGER) IS NOT NULL
""",
    "flush_by_rows": flushed("after"),
    "flush_before_add": flushed("before"),
    "flush_by_time": TIMED,
    "lane_stats": f"""WITH {MESSAGES}
SELECT lane, count(*) AS messages, CAST(sum(n_rows) AS BIGINT) AS n_rows,
       min(msg_id) AS first_msg, max(msg_id) AS last_msg FROM m GROUP BY lane""",
    "stream_resume": f"""WITH {CHECKED},
heads AS (SELECT target, msg_id, lag(batch_id) OVER (PARTITION BY target ORDER BY msg_id) AS before,
                 batch_id FROM checked WHERE route = 'clickhouse' AND target <> ''),
cleared AS (SELECT target, max(msg_id) AS cleared_at FROM heads
            WHERE before IS DISTINCT FROM batch_id GROUP BY target),
clean AS (SELECT *, TRY_CAST(k AS INTEGER) AS kk FROM records
          WHERE TRY_CAST(k AS INTEGER) IS NOT NULL)
SELECT 'append' AS kind, target, msg_id, row_pos, kk AS k FROM clean JOIN cleared USING (target)
WHERE route = 'clickhouse' AND msg_id >= cleared_at
UNION ALL
SELECT 'keyed', target, msg_id, row_pos, kk FROM (
  SELECT *, row_number() OVER (PARTITION BY target, kk ORDER BY msg_id DESC, row_pos DESC) AS rn
  FROM clean WHERE route = 'kudu') y WHERE rn = 1""",
    "append_by_position": f"SELECT date, platform, snick AS shop_id, shop_id AS snick,"
                          f" dialog_count FROM ({fx.STAT_SQL}) s",
    "append_by_name": f"SELECT date, platform, CAST(NULL AS STRING) AS shop_id, snick,"
                      f" dialog_count FROM ({fx.STAT_SQL}) s",
    "clear_events": f"{clears('clear_table')} UNION ALL {clears('clear_table, part')}",
    "truncate_reload": reloaded("clear_table"),
    "partition_reload": reloaded("clear_table, part"),
    "partition_literal": """
SELECT o_orderkey, concat('(', year(o_orderdate), ',', month(o_orderdate), ',''',
                          o_orderpriority, ''')') AS literal, CAST(3 AS BIGINT) AS n_values,
       concat_ws('/', year(o_orderdate), month(o_orderdate), o_orderpriority) AS partition_values
FROM orders""",
    "partition_clause": """
SELECT o_orderkey, concat('partition(`date`=', strftime(o_orderdate, '%Y%m%d'), ',platform=''',
                          o_orderstatus, ''')') AS clause FROM orders""",
    "upsert_last_wins": f"""
WITH old AS (SELECT *, {LATEST} FROM orders WHERE o_orderkey % 2 = 0),
new AS (SELECT *, {LATEST} FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM new WHERE rn = 1
UNION ALL
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM old
WHERE rn = 1 AND o_custkey NOT IN (SELECT o_custkey FROM new)""",
    "upsert_partial": f"""
WITH old AS (SELECT * FROM (SELECT *, {LATEST} FROM orders WHERE o_orderkey % 2 = 0) a
             WHERE rn = 1),
new AS (SELECT * FROM (SELECT *, {LATEST} FROM orders WHERE o_orderkey % 2 = 1) b WHERE rn = 1)
SELECT coalesce(new.o_custkey, old.o_custkey) AS o_custkey, old.o_orderkey AS stored_key,
       coalesce(new.o_orderstatus, old.o_orderstatus) AS o_orderstatus, old.o_orderpriority
FROM old FULL OUTER JOIN new ON old.o_custkey = new.o_custkey""",
    "upsert_sub_batches": """
SELECT o_orderstatus, CAST(floor((rn - 1) / 500.0) AS BIGINT) AS batch_no, count(*) AS n_rows,
       max(o_orderkey) AS last_key
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn
      FROM orders) o GROUP BY 1, 2""",
    "range_partition_add": f"WITH {RANGE_ROWS} SELECT target_table, lower, upper FROM ranges",
    "range_partition_assign": f"""
WITH {RANGE_ROWS}, e AS (SELECT event_id, concat('tmp.', event_type) AS target,
                                {fx.DAY_SQL} AS day FROM events)
SELECT event_id, target, day, lower, upper FROM e LEFT JOIN ranges
ON target = target_table AND day >= lower AND day < upper""",
    "layout_partition_counts": f"""
SELECT date, platform, count(*) AS n_rows, CAST(sum(dialog_count) AS BIGINT) AS dialogs
FROM ({fx.STAT_SQL}) s GROUP BY date, platform""",
    "clone_schema": f"SELECT date, platform, shop_id, snick, dialog_count FROM ({fx.STAT_SQL}) s",
    "load_partition": f"SELECT shop_id, dialog_count AS n, CAST(20240101 AS INTEGER) AS day"
                      f" FROM ({fx.STAT_SQL}) s",
    "file_chunks": f"""
SELECT md5(file) AS sync_id, file, CAST(total AS INTEGER) AS total_parts,
       CAST(i + 1 AS INTEGER) AS cur_part, md5(data) AS md5_checksum,
       CAST(octet_length(data) AS INTEGER) AS n_bytes FROM ({document_parts()}) c""",
    "file_chunks_zero_based": f"""
SELECT file, CAST(total AS INTEGER) AS total_batch, CAST(i AS INTEGER) AS cur_batch,
       md5(data) AS md5_checksum FROM ({document_parts()}) c""",
    "chunk_checksum": f"""
SELECT doc_id * 1000 + i + 1 + copy * 1000000000000 AS msg_id, md5(file) AS sync_id,
       CAST(i + 1 AS INTEGER) AS cur_part,
       doc_id % 10 <> 1 OR md5(data) = reverse(md5(data)) AS ok
FROM (SELECT *, unnest(range(1, CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 2 END)) AS copy
      FROM ({document_parts()}) c) d
WHERE NOT (doc_id % 10 = 0 AND i = 1)""",
    "file_reassemble": f"""
SELECT md5(file) AS sync_id, file, CAST(0 AS INTEGER) AS segment,
       CAST(total AS BIGINT) AS n_parts, CAST(n AS BIGINT) AS n_bytes, md5(content) AS data_md5
FROM (SELECT *, greatest(ceil(n / 1024.0), 1) AS total FROM ({DOCS}) d) p WHERE NOT ({HOLDS})""",
    "file_incomplete": f"""
SELECT md5(file) AS sync_id, file, CAST(total AS INTEGER) AS total_parts,
       CAST(CASE WHEN doc_id % 10 = 1 THEN 0 ELSE total - 1 END AS INTEGER) AS n_parts
FROM (SELECT *, greatest(ceil(n / 1024.0), 1) AS total FROM ({DOCS}) d) p WHERE {HOLDS}""",
    "file_missing_parts": f"""
SELECT md5(file) AS sync_id, file, CAST(i + 1 AS INTEGER) AS cur_part FROM ({document_parts()}) c
WHERE doc_id % 10 = 1 OR (doc_id % 10 = 0 AND i = 1)""",
    "file_append_by_name": f"""
SELECT file, doc_id AS segment, CAST(greatest(ceil(n / 1024.0), 1) AS BIGINT) AS n_parts,
       md5(content) AS data_md5 FROM ({DOCS}) d""",
    "sync_append": f"SELECT 'tmp.orders_all' AS target, * FROM ({ORDERS}) o",
    "sync_upsert": f"""
WITH latest AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC)
                AS rn FROM ({ORDERS}) o)
SELECT 'tmp.last_order' AS target, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderday
FROM latest WHERE rn = 1
UNION ALL
SELECT 'tmp.last_order', CAST(-1 AS BIGINT), c_custkey, '-', 0.0, '' FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)""",
    "sync_append_two_runs":
        f"SELECT 'tmp.orders' AS target, * FROM ({ORDERS}) o WHERE o_orderstatus = 'F'",
    "sync_upsert_two_runs": f"""
SELECT 'tmp.by_order' AS target, o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'OLD' END AS o_orderstatus,
       o_totalprice, o_orderday FROM ({ORDERS}) o""",
    "sync_upsert_partial": f"""
WITH o AS ({ORDERS}),
a AS (SELECT o_custkey, max(o_orderkey) AS k, arg_max(o_orderstatus, o_orderkey) AS s FROM o
      WHERE o_orderkey % 2 = 0 GROUP BY 1),
b AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS p FROM o
      WHERE o_orderkey % 2 = 1 GROUP BY 1),
c AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s FROM o
      WHERE o_orderkey % 5 = 0 GROUP BY 1),
old AS (SELECT c_custkey AS o_custkey, -1 AS k, '-' AS s, 0.0 AS p, '' AS d FROM customer),
ids AS (SELECT o_custkey FROM a UNION SELECT o_custkey FROM b UNION SELECT o_custkey FROM c
        UNION SELECT o_custkey FROM old)
SELECT 'tmp.last_order' AS target, CAST(coalesce(a.k, old.k) AS BIGINT) AS o_orderkey, o_custkey,
       coalesce(c.s, a.s, old.s) AS o_orderstatus,
       CAST(coalesce(b.p, old.p) AS DOUBLE) AS o_totalprice, old.d AS o_orderday
FROM ids LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (o_custkey)
         LEFT JOIN c USING (o_custkey) LEFT JOIN old USING (o_custkey)""",
    "sync_oversize": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "clear_by_literal": """
WITH e AS (SELECT event_id AS msg_id, event_type, user_id % 3 AS part,
                  floor(event_id / 400.0) AS batch FROM events),
k AS (SELECT *, max(batch) OVER (PARTITION BY event_type) AS one,
             max(batch) OVER (PARTITION BY part, event_type) AS two FROM e)
SELECT 'one' AS keyed_by, msg_id, event_type, part FROM k WHERE batch = one
UNION ALL SELECT 'two', msg_id, event_type, part FROM k WHERE batch = two""",
    "sync_files": """
SELECT md5(unnest(string_split(text, chr(10)))) AS line_md5,
       CAST(CAST(floor(doc_id / 250.0) AS BIGINT) AS STRING) AS bucket FROM documents""",
    "sync_file_rows": f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderday, o_orderstatus FROM ({ORDERS}) o
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, 'older', o_orderstatus FROM ({ORDERS}) o
WHERE o_orderkey % 100 = 0 AND o_orderstatus = 'P'""",
    "stream_files": """
SELECT concat('doc_', doc_id, '.txt') AS file,
       CAST(greatest(ceil(strlen(text) / 1024.0), 1) AS BIGINT) AS n_parts,
       CAST(1 AS BIGINT) AS n_reports, md5(text) AS data_md5
FROM documents WHERE doc_id % 9 <> 0""",
    "stream_until_end": f"""WITH {SENTINEL}
SELECT msg_id, CAST(pos AS INTEGER) AS row_pos,
       TRY_CAST(json_extract_string(item, '$.k') AS INTEGER) AS k
FROM (SELECT *, unnest(range(n_rows)) AS pos FROM bounded WHERE json_valid(data)) x
WHERE TRY_CAST(json_extract_string(item, '$.k') AS INTEGER) IS NOT NULL""",
    "sync_files_twice": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS content FROM documents),
v AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 9 <> 0
                          THEN unhex(substr(hex(content), 1, 2 * (octet_length(content) // 2)))
                          ELSE content END AS content FROM d)
SELECT concat('doc_', doc_id, '.txt') AS file,
       CAST(greatest(ceil(octet_length(content) / 1024.0), 1) AS BIGINT) AS n_parts,
       md5(content) AS data_md5 FROM v""",
    "sync_bounded": fold(BOUNDED_ROWS, 500, "before") + """
SELECT f.lane, f.ord AS msg_id, f.grp AS insert_no, CAST(u.pos AS INTEGER) AS row_pos,
       TRY_CAST(json_extract_string(u.item, '$.k') AS INTEGER) AS k
FROM f JOIN (SELECT lane, ord, item, unnest(range(w)) AS pos FROM numbered) u USING (lane, ord)
WHERE TRY_CAST(json_extract_string(u.item, '$.k') AS INTEGER) IS NOT NULL""",
    "sync_many_tables": f"""
SELECT 'tmp.orders' AS target, o_orderkey AS id, concat_ws('|', o_orderkey, o_custkey,
       coalesce(o_orderstatus, '-'), o_orderday, CAST(round(o_totalprice * 100) AS BIGINT)) AS content
FROM ({ORDERS}) o
UNION ALL SELECT 'tmp.customers', c_custkey, concat_ws('|', c_custkey, c_name,
       CAST(round(c_acctbal * 100) AS BIGINT)) FROM customer
UNION ALL SELECT 'tmp.events', event_id, concat_ws('|', event_id, event_type, CAST(ts AS DATE),
       CAST(round(value * 100) AS BIGINT)) FROM events
UNION ALL SELECT 'audit', 0, 'unknown_target'""",
    "stream_compact_clears": f"""
WITH m AS (SELECT msg_id, clear_table, part,
                  CASE WHEN msg_id % 1000 < 300 THEN 'again' ELSE batch_id END AS batch_id
           FROM ({fx.CLEAR}) c),
starts AS (SELECT *, lag(batch_id) OVER (PARTITION BY clear_table ORDER BY msg_id) AS before FROM m),
last AS (SELECT clear_table, max(msg_id) AS cleared_at FROM starts
         WHERE before IS DISTINCT FROM batch_id GROUP BY 1)
SELECT clear_table AS target, msg_id, part FROM m JOIN last USING (clear_table)
WHERE msg_id >= cleared_at""",
}

# the same results over many blocks
ORACLE["pack_messages_blocks"] = ORACLE["pack_messages"]
ORACLE["pack_messages_sparse"] = ORACLE["pack_messages"].replace(
    f"({fx.ROW}) q", f"(SELECT * REPLACE (ord * 2654435761 % 4294967291 AS ord) FROM ({fx.ROW}) r) q")
ORACLE["clear_events_blocks"] = ORACLE["clear_events"]
