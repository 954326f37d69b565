"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableferry.functions import codec, headers, literals
from tableferry.operators import (blocks, chunks as ch, clear, flush, mapper, pack, ranges,
                                  route, upsert)
from tableferry.plans import fixtures as fx, sync
from tableferry.schemas import CHUNK
from tableferry.session import scratch, stored
from tableferry.sources import files, landed, tables, topics
from tableferry.sources.tables import table
from tableferry.streaming import receiver, sinks, transfers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LIMIT = 2048
K = T.StructType([T.StructField("k", T.IntegerType())])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(rows: str) -> F.Column:
    return F.md5(F.array_join(rows, ","))


# ---- sources -------------------------------------------------------------------------------

@query
def source_query(spark, sf_dir):
    tables.register(spark, sf_dir, ["orders"])
    return tables.source(spark, "SELECT o_custkey AS shop, o_orderkey AS id, o_orderstatus AS"
                                " status, 'jd' AS platform FROM orders")


@query
def source_table(spark, sf_dir):
    tables.register(spark, sf_dir, ["customer"])
    return tables.source(spark, src_table="customer")


@query
def row_batches(spark, sf_dir):
    batched = blocks.row_batches(table(spark, sf_dir, "orders").select("o_orderkey"),
                                 "o_orderkey", 1000)
    return batched.groupBy("batch_no").agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"))


@query
def named_rows(spark, sf_dir):
    records = tables.named_records(table(spark, sf_dir, "customer"))
    return records.select(F.col("record.c_custkey").alias("id"),
                          F.col("record.c_name").alias("name"),
                          F.col("record.c_mktsegment").alias("segment"))


@query
def describe_table(spark, sf_dir):
    return tables.described(table(spark, sf_dir, "events"))


@query
def templated_query(spark, sf_dir):
    tables.register(spark, sf_dir, ["events"])
    params = tables.day_params("2024-01-15")
    partition = tables.rendered("({{ds_nodash}},{{ next_ds_nodash }})", params)
    return tables.source(spark, """
        SELECT event_type, :partition AS partition, count(*) AS n_all,
               count_if(ts >= CAST(:ds AS TIMESTAMP_NTZ) AND ts < CAST(:next_ds AS TIMESTAMP_NTZ))
                 AS n_day
        FROM events GROUP BY event_type""",
                         args={"ds": params["ds"], "next_ds": params["next_ds"],
                               "partition": partition})


def _topic_of_messages(spark, sf_dir) -> DataFrame:
    """The message fixture in the stored form of a topic."""
    msgs = fx.messages(spark, sf_dir)
    header = headers.header_map({
        "db_type": F.col("db_type"), "target_table": F.col("target_table"),
        "clear_table": literals.normalise_target(F.col("target_table")), "partition": "",
        "batch_id": F.col("batch_id"), "rows": F.col("n_rows")})
    return msgs.select("lane", "msg_id", "topic",
                       F.col("publish_time").cast("timestamp").alias("publish_time"),
                       header.alias("properties"), "data")


@query
def topic_write_read(spark, sf_dir):
    path = scratch(spark, "topic")
    topics.publish(_topic_of_messages(spark, sf_dir), path)
    return topics.read_topic(spark, path).select(
        "lane", "msg_id", "topic", F.col("properties")["target_table"].alias("target_table"),
        F.col("properties")["rows"].alias("n_rows"), F.md5("data").alias("data_md5"))


@query
def topic_read(spark, sf_dir):
    path, out = scratch(spark, "topic"), scratch(spark, "subscription")
    topics.publish(_topic_of_messages(spark, sf_dir), path)
    read = topics.stream_topic(spark, path).select(
        "lane", "msg_id", F.unix_micros("publish_time").alias("published_us"),
        F.col("properties")["batch_id"].alias("batch_id"))
    stream = (read.writeStream.option("checkpointLocation", f"{out}/cursor")
              .trigger(availableNow=True).format("parquet").start(f"{out}/rows"))
    stream.awaitTermination()
    return spark.read.schema(read.schema).parquet(f"{out}/rows")


@query
def topic_fan_in(spark, sf_dir):
    """Three topics, each by a cursor of its own, into one sink."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("msg_id"), F.col("o_orderstatus").alias("data"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("msg_id"), F.col("c_mktsegment").alias("data"))
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"), F.col("event_type").alias("data"))
    url, out = scratch(spark, "topics"), scratch(spark, "fan-in")
    header = headers.append_header("tmp.all", batch_id="run-1")
    for name, rows in (("orders", orders), ("customers", customers), ("events", events)):
        topics.publish(rows.select(
            F.lit(0).cast("long").alias("lane"), "msg_id", F.lit(name).alias("topic"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("publish_time"),
            header.alias("properties"), F.to_json(F.array(F.struct("data"))).alias("data")),
            f"{url}/{name}", own_ids=True)
    names = ["orders", "customers", "events"]
    subs = topics.subscriptions(f"{url};{url};{url};", ";".join(names), "s;s;s")
    schema = T.StructType([T.StructField("data", T.StringType())])
    sink = sinks.AppendSink(spark, f"{out}/rows", schema)
    for running in receiver.start_all(spark, subs, schema, [sink], f"{out}/cursors", once=True):
        running.awaitTermination()
    listed = F.array(*[F.lit(n) for n in names])
    return sink.read().select("msg_id", "data", "topic", (F.array_position(
        listed, F.col("topic")) - 1).cast("int").alias("source_lane"))


@query
def read_until_sentinel(spark, sf_dir):
    marked = fx.messages(spark, sf_dir).withColumn("data", F.when(
        F.col("msg_id") % 997 == 996, pack.END_SIGN).otherwise(F.col("data")))
    return topics.until_end(marked.select("lane", "msg_id", "data")).select("lane", "msg_id")


def _text_files(spark, sf_dir) -> str:
    """Documents written as text files, 250 per file and folder."""
    path = scratch(spark, "texts")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.expr("doc_id div 250").alias("bucket"))
    (docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
     .select("bucket", "text").write.partitionBy("bucket").text(path))
    return path


def _bucket(path: str) -> F.Column:
    return F.regexp_extract(path, r"bucket=(\d+)/", 1).cast("long").alias("bucket")


@query
def file_listing(spark, sf_dir):
    listed = files.list_files(spark, _text_files(spark, sf_dir), ".txt")
    return listed.groupBy(_bucket("path")).agg(F.sum("length").alias("n_bytes"))


@query
def file_parts_plan(spark, sf_dir):
    listed = files.list_files(spark, _text_files(spark, sf_dir), ".txt")
    planned = ch.plan_parts(listed, "length", 1024)
    return planned.groupBy(_bucket("path")).agg(
        F.sum("length").alias("n_bytes"), F.sum("total_parts").alias("n_parts"))


@query
def catalog_counts(spark, sf_dir):
    tables.register(spark, sf_dir)
    present = set(tables.tables_of(spark))
    return tables.row_counts(spark, [t for t in tables.TABLES if t in present])


@query
def sample_rows(spark, sf_dir):
    return tables.first_rows(table(spark, sf_dir, "customer"), ["c_custkey"], 10).select(
        "c_custkey", "c_name", "c_nationkey")


@query
def export_parquet(spark, sf_dir):
    path = scratch(spark, "export")
    out = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    tables.export_parquet(out, path, 5000)
    return spark.read.schema(out.schema).parquet(path)


# ---- row transforms ------------------------------------------------------------------------

@query
def project_literal(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("shop_id"),
        F.lit("tb").alias("platform"), F.lit(20210804).alias("day"))


@query
def row_mapper(spark, sf_dir):
    def mapped(df):
        return (df.withColumn("segment", F.lower("c_mktsegment"))
                .withColumn("region_hint", F.col("c_nationkey") % 5)
                .withColumnRenamed("c_custkey", "shop_id")
                .drop("c_mktsegment", "c_acctbal", "c_nationkey"))
    return mapper.map_rows(table(spark, sf_dir, "customer"), mapped)


@query
def row_mapper_python(spark, sf_dir):
    def mapped(row: dict) -> dict:
        return {"shop_id": row["c_custkey"], "name": row["c_name"].replace("Customer", "Shop"),
                "initials": row["c_mktsegment"][:2]}
    source = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return mapper.map_records(source, mapped, "shop_id long, name string, initials string")


@query
def encode_rows(spark, sf_dir):
    source = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return codec.encode_rows(source).select("o_orderkey", "enc")


@query
def decode_rows(spark, sf_dir):
    return codec.decode_rows(fx.messages(spark, sf_dir).select("msg_id", "data"), ["k"])


@query
def oversize_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack.oversize(docs, 8192, "text").select("doc_id", "row_bytes")


@query
def align_types(spark, sf_dir):
    target = T.StructType([T.StructField("day", T.IntegerType()), *K.fields,
                           T.StructField("note", T.StringType())])
    decoded = codec.decode_rows(fx.messages(spark, sf_dir).select(
        "msg_id", F.regexp_replace("batch_id", "-", "").alias("day"), "data"), ["k"])
    return route.typed(decoded, target)


# ---- messages ------------------------------------------------------------------------------

@query
def pack_messages(spark, sf_dir):
    return pack.pack_messages(fx.rows(spark, sf_dir), limit=LIMIT).select(
        "lane", "msg", "first_order", "n_rows", "n_bytes", _joined("rows").alias("rows_md5"))


@query
def pack_json_array(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    enc = source.select(
        (F.col("o_orderkey") % 4).alias("lane"), F.col("o_orderkey").alias("ord"),
        codec.encoded(source.schema, ["o_orderkey", "o_custkey", "o_orderstatus"]).alias("enc"))
    return pack.pack_json_array(enc, limit=LIMIT).select(
        "lane", "msg", "n_rows", F.octet_length("data").cast("long").alias("data_bytes"),
        F.md5("data").alias("data_md5"))


@query
def append_header(spark, sf_dir):
    header = headers.append_header(
        target_table=F.concat(F.lit("tmp."), F.lower("o_orderstatus")),
        batch_id=F.date_format("o_orderdate", "yyyy-MM-dd"), source_table="orders",
        clear_table=F.when(F.col("o_orderkey") % 2 == 0, F.lit("tmp.clear_all")),
        partition=F.concat(F.lit("'"), F.col("o_orderstatus"), F.lit("'")), source_platform="jd",
        target_platform=0, task_id=F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(header).alias("entry", "value"))


@query
def keyed_header(spark, sf_dir):
    header = headers.keyed_header(
        target_table=F.concat(F.lit("impala::tmp."), F.lower("c_mktsegment")),
        batch_id=F.concat(F.lit("n"), F.col("c_nationkey")), source_table="customer",
        range_partition="20210804<=VALUES<20210805", priority=F.col("c_nationkey") % 3)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(header).alias("entry", "value"))


@query
def header_enrich(spark, sf_dir):
    base = headers.header_map({
        "task_id": F.when(F.col("msg_id") % 2 == 0, F.concat(F.lit("t"), F.col("lane"))),
        "source_table": "", "db_type": F.col("db_type")})
    rich = headers.enriched(base, "sync_task", F.col("topic"), F.col("n_rows"))
    return fx.messages(spark, sf_dir).select("msg_id", F.explode(rich).alias("entry", "value"))


@query
def send_stats(spark, sf_dir):
    return pack.send_stats(pack.pack_messages(fx.rows(spark, sf_dir), limit=LIMIT))


@query
def text_messages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 4).alias("lane"), "doc_id", "text")
    return pack.text_messages(docs, "lane", "doc_id", "text").select(
        "lane", "msg_id", F.octet_length("data").cast("long").alias("n_bytes"),
        F.md5("data").alias("data_md5"))


# ---- receiving -----------------------------------------------------------------------------

def _checked(spark, sf_dir) -> DataFrame:
    return route.triaged(fx.messages(spark, sf_dir), ["k"], fx.KNOWN_TARGETS)


@query
def route_messages(spark, sf_dir):
    return fx.messages(spark, sf_dir).select(
        "msg_id", route.route_of(F.col("db_type")).alias("route"))


@query
def normalise_target(spark, sf_dir):
    return fx.messages(spark, sf_dir).select(
        "msg_id", literals.normalise_target(F.col("target_table")).alias("target"))


def _bad(spark, sf_dir, reason):
    return route.bad_messages(_checked(spark, sf_dir)).where(F.col("reason") == reason).select(
        "lane", "msg_id", "topic", "target_table", "reason")


@query
def bad_missing_target(spark, sf_dir):
    return _bad(spark, sf_dir, "missing_target")


@query
def unknown_target(spark, sf_dir):
    return _bad(spark, sf_dir, "unknown_target")


@query
def bad_undecodable(spark, sf_dir):
    return _bad(spark, sf_dir, "undecodable")


@query
def bad_messages(spark, sf_dir):
    checked = _checked(spark, sf_dir)
    return route.audit(route.BAD_MSG, route.bad_messages(checked), F.col("reason"),
                       F.md5("data"))


@query
def wal_rows(spark, sf_dir):
    rows = route.good_rows(_checked(spark, sf_dir), ["k"], ["topic", "msg_id", "target_table"])
    return route.audit(route.WAL, rows, F.lit("decoded"), F.to_json(F.struct("k", "row_pos")))


@query
def dirty_rows(spark, sf_dir):
    rows = route.good_rows(_checked(spark, sf_dir), ["k"], ["msg_id", "target"])
    return route.typed(rows, K).where("dirty_fields is not null").select(
        "msg_id", "row_pos", "target", "dirty_fields")


@query
def audit_counts(spark, sf_dir):
    return route.audit_counts(_checked(spark, sf_dir), ["k"], K)


@query
def flush_by_rows(spark, sf_dir):
    flushed = flush.flush_by_rows(fx.messages(spark, sf_dir).drop("data"), "n_rows", 500)
    return flush.flush_summary(flushed, "n_rows")


@query
def flush_before_add(spark, sf_dir):
    flushed = flush.flush_by_rows(fx.messages(spark, sf_dir).drop("data"), "n_rows", 500,
                                  when="before")
    return flush.flush_summary(flushed, "n_rows")


@query
def flush_by_time(spark, sf_dir):
    flushed = flush.flush_by_time(fx.messages(spark, sf_dir).drop("data"), "n_rows",
                                  "publish_time", 500, 6 * 3600, 3600)
    return flush.flush_summary(flushed, "n_rows")


@query
def lane_stats(spark, sf_dir):
    return fx.messages(spark, sf_dir).groupBy("lane").agg(
        F.count("*").alias("messages"), F.sum("n_rows").alias("n_rows"),
        F.min("msg_id").alias("first_msg"), F.max("msg_id").alias("last_msg"))


@query
def stream_resume(spark, sf_dir):
    """Half of the topic, a stop, the other half under the same subscription."""
    path, out = scratch(spark, "topic"), scratch(spark, "received")
    topic = stored(_topic_of_messages(spark, sf_dir), "messages")
    append = sinks.AppendSink(spark, f"{out}/append", K)
    keyed = sinks.KeyedSink(spark, f"{out}/keyed", K, ["k"])
    for part in (F.col("msg_id") % 2 == 0, F.col("msg_id") % 2 == 1):
        topics.publish(topic.where(part), path, own_ids=True)
        receiver.start(topics.stream_topic(spark, path), K, [append, keyed], f"{out}/cursor",
                       fx.KNOWN_TARGETS, once=True).awaitTermination()
    names = ["target", "msg_id", "row_pos", "k"]
    return (append.read().select(F.lit("append").alias("kind"), *names)
            .unionByName(keyed.read().select(F.lit("keyed").alias("kind"), *names)))


# ---- targets -------------------------------------------------------------------------------

STAT_DDL = "`date` INT, platform STRING, shop_id STRING, snick STRING, dialog_count BIGINT"


@query
def append_by_position(spark, sf_dir):
    name = tables.fresh_name("by_position")
    tables.create_target(spark, name, STAT_DDL, scratch(spark, name))
    stats = fx.stats(spark, sf_dir)
    tables.append_by_position(stats.select("date", "platform", "snick", "shop_id",
                                           "dialog_count"), name)
    return spark.table(name)


@query
def append_by_name(spark, sf_dir):
    name = tables.fresh_name("by_name")
    tables.create_target(spark, name, STAT_DDL, scratch(spark, name))
    tables.append_by_name(fx.stats(spark, sf_dir).select("dialog_count", "snick", "date",
                                                         "platform"), name)
    return spark.table(name)


@query
def clear_events(spark, sf_dir):
    return _clear_events(spark, sf_dir)


def _clear_events(spark, sf_dir, span: int = blocks.SPAN) -> DataFrame:
    msgs = fx.clears(spark, sf_dir)
    by_table = clear.clear_events(msgs, ["clear_table"], span=span).withColumn("part", F.lit(""))
    by_part = clear.clear_events(msgs, ["clear_table", "part"], span=span)
    return by_table.unionByName(by_part)


def _reloaded(spark, sf_dir, keys):
    msgs = fx.clears(spark, sf_dir)
    last = clear.last_clears(clear.run_starts(msgs, keys), keys)
    kept = clear.surviving(msgs, last, "clear_table", "part", keys=keys)
    return kept.select("msg_id", "clear_table", "part", "value")


@query
def truncate_reload(spark, sf_dir):
    return _reloaded(spark, sf_dir, ["clear_table"])


@query
def partition_reload(spark, sf_dir):
    return _reloaded(spark, sf_dir, ["clear_table", "part"])


@query
def partition_literal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    literal = literals.partition_literal(
        F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderpriority"),
        quoted=(False, False, True))
    values = literals.partition_values(F.col("literal"))
    return (orders.select("o_orderkey", literal.alias("literal"))
            .withColumn("v", values)
            .select("o_orderkey", "literal", F.size("v").cast("long").alias("n_values"),
                    F.array_join("v", "/").alias("partition_values")))


@query
def partition_clause(spark, sf_dir):
    clause = literals.partition_clause({
        "date": (F.date_format("o_orderdate", "yyyyMMdd").cast("int"), False),
        "platform": (F.col("o_orderstatus"), True)})
    return table(spark, sf_dir, "orders").select("o_orderkey", clause.alias("clause"))


@query
def upsert_last_wins(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    order = ["o_orderdate", "o_orderkey"]
    stored_rows = upsert.last_wins(orders.where("o_orderkey % 2 = 0"), ["o_custkey"], order)
    return upsert.upsert(stored_rows, orders.where("o_orderkey % 2 = 1"), ["o_custkey"],
                         order).drop("o_orderdate")


@query
def upsert_partial(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    stored_rows = upsert.last_wins(orders.where("o_orderkey % 2 = 0"), ["o_custkey"],
                                   ["o_orderdate", "o_orderkey"])
    stored_rows = stored_rows.select("o_custkey", F.col("o_orderkey").alias("stored_key"),
                                     "o_orderstatus", "o_orderpriority")
    incoming = orders.where("o_orderkey % 2 = 1").select(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    return upsert.upsert_partial(stored_rows, incoming, ["o_custkey"],
                                 ["o_orderdate", "o_orderkey"])


@query
def upsert_sub_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    batched = blocks.row_batches(orders, "o_orderkey", 500, ["o_orderstatus"])
    return batched.groupBy("o_orderstatus", "batch_no").agg(
        F.count("*").alias("n_rows"), F.max("o_orderkey").alias("last_key"))


def _range_requests(spark, sf_dir) -> DataFrame:
    """Messages that ask for the week of their day, in the first three weeks of the month."""
    day = F.dayofmonth("ts")
    spec = (F.when(day < 8, "20240101<=VALUES<20240108")
            .when(day < 15, "20240108 <= VALUES < 20240115")
            .when(day < 22, "20240115<=VALUES<20240122").otherwise(""))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("impala::tmp."), F.col("event_type")).alias("target_table"),
        spec.alias("range_partition"), F.to_date("ts").cast("string").alias("batch_id"))


def _registry(spark, sf_dir) -> DataFrame:
    """Every target starts with the first week."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("tmp."), F.col("event_type")).alias("target_table"),
        F.lit(20240101).cast("long").alias("lower"),
        F.lit(20240108).cast("long").alias("upper")).distinct()


@query
def range_partition_add(spark, sf_dir):
    requests = ranges.requested_ranges(_range_requests(spark, sf_dir))
    return ranges.add_ranges(_registry(spark, sf_dir), requests)


@query
def range_partition_assign(spark, sf_dir):
    requests = ranges.requested_ranges(_range_requests(spark, sf_dir))
    registry = ranges.add_ranges(_registry(spark, sf_dir), requests)
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('tmp.', event_type) AS target", f"{fx.DAY_SPARK} AS day")
    return ranges.assign_ranges(rows, "day", registry, "target")


@query
def layout_partition_counts(spark, sf_dir):
    path = scratch(spark, "layout")
    tables.write_layout(fx.stats(spark, sf_dir), path, ["date", "platform"],
                        ["shop_id", "snick"])
    return (spark.read.schema(STAT_DDL).parquet(path)
            .groupBy("date", "platform").agg(
                F.count("*").alias("n_rows"), F.sum("dialog_count").alias("dialogs")))


@query
def clone_schema(spark, sf_dir):
    first, second = tables.fresh_name("cloned"), tables.fresh_name("clone")
    tables.create_target(spark, first, STAT_DDL, scratch(spark, first), ["`date`", "platform"])
    tables.clone_schema(spark, second, first, scratch(spark, second))
    tables.append_by_name(fx.stats(spark, sf_dir), second)
    return spark.table(second).select("date", "platform", "shop_id", "snick", "dialog_count")


@query
def load_partition(spark, sf_dir):
    """Both halves go into one partition: the first load replaces it, the second adds."""
    name = tables.fresh_name("loaded")
    tables.create_target(spark, name, "shop_id STRING, n BIGINT, day INT", scratch(spark, name),
                         ["day"])
    stats = fx.stats(spark, sf_dir).select("shop_id", F.col("dialog_count").alias("n"))
    part = {"day": 20240101}
    tables.load_partition(stats.where("n >= 2"), name, part)
    tables.load_partition(stats.where("n = 1"), name, part)
    tables.load_partition(stats.where("n >= 2"), name, part, is_overwrite=False)
    return spark.table(name)


# ---- files ---------------------------------------------------------------------------------

PART = 1024


def _document_files(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("file"),
        F.encode("text", "UTF-8").alias("content"), "doc_id")


def _document_chunks(spark, sf_dir) -> DataFrame:
    """Chunks of all documents; part 2 of every tenth is lost and the checksum of another
    tenth is wrong. Every third file is delivered twice."""
    sent = ch.cut(_document_files(spark, sf_dir), "content", "file", PART)
    sent = sent.withColumn("msg_id", F.col("doc_id") * 1000 + F.col("cur_part"))
    sent = sent.where((F.col("doc_id") % 10 != 0) | (F.col("cur_part") != 2))
    sent = sent.withColumn("md5_checksum", F.when(
        F.col("doc_id") % 10 == 1, F.reverse("md5_checksum")).otherwise(F.col("md5_checksum")))
    times = F.when(F.col("doc_id") % 3 == 0, 2).otherwise(1)
    again = sent.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return again.withColumn("msg_id", F.col("msg_id") + F.col("_copy") * 10**12).drop("_copy")


@query
def file_chunks(spark, sf_dir):
    return ch.cut(_document_files(spark, sf_dir), "content", "file", PART).select(
        "sync_id", "file", "total_parts", "cur_part", "md5_checksum",
        F.octet_length("data").alias("n_bytes"))


@query
def file_chunks_zero_based(spark, sf_dir):
    return ch.cut(_document_files(spark, sf_dir), "content", "file", PART, base=0,
                  header_style="batch").select("file", "total_batch", "cur_batch", "md5_checksum")


@query
def chunk_checksum(spark, sf_dir):
    return ch.checksum_ok(_document_chunks(spark, sf_dir)).select(
        "msg_id", "sync_id", "cur_part", "ok")


@query
def file_reassemble(spark, sf_dir):
    whole = ch.reassemble(_document_chunks(spark, sf_dir), PART)
    return whole.select("sync_id", "file", "segment", "n_parts",
                        F.octet_length("data").cast("long").alias("n_bytes"),
                        F.md5("data").alias("data_md5"))


@query
def file_incomplete(spark, sf_dir):
    return ch.incomplete(_document_chunks(spark, sf_dir)).select(
        "sync_id", "file", "total_parts", "n_parts")


@query
def file_missing_parts(spark, sf_dir):
    return ch.missing_parts(_document_chunks(spark, sf_dir)).select(
        "sync_id", "file", "cur_part")


@query
def file_append_by_name(spark, sf_dir):
    named = ch.cut(_document_files(spark, sf_dir), "content", "file", PART,
                   header_style="named")
    arrived = named.withColumn("msg_id", F.col("doc_id") * 1000 + F.col("_seq"))
    return ch.append_by_name(arrived, "msg_id", "file", span=1000).select(
        "file", "segment", "n_parts", F.md5("data").alias("data_md5"))


# ---- both sides ----------------------------------------------------------------------------

N_LANES = 4
ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderday", T.StringType())])


def _sent(spark, messages: DataFrame) -> DataFrame:
    """Messages through a topic: packed and written once, read by every consumer."""
    path = scratch(spark, "topic")
    topics.publish(messages, path)
    return topics.read_topic(spark, path)


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderday"))


@query
def sync_append(spark, sf_dir):
    """Orders to a table that already holds older rows, cleared once for the batch."""
    orders = _orders(spark, sf_dir)
    header = headers.append_header(
        "tmp.orders_all", batch_id="run-1", clear_table="tmp.orders_local",
        source_platform="jd", target_platform="tb")
    sent = sync.send(orders, F.col("o_orderkey") % N_LANES, F.col("o_orderkey"), header,
                     "orders_topic", F.lit("2024-01-01 00:00:00"), N_LANES,
                     task_id="orders_sync", source_table="orders")
    older = orders.withColumn("o_orderstatus", F.lit("OLD")).withColumn(
        "target", F.lit("tmp.orders_all"))
    checked = sync.receive(_sent(spark, sent), ORDER_SCHEMA)
    return sync.apply_append(checked, ORDER_SCHEMA, older,
                             {"tmp.orders_local": "tmp.orders_all"})


@query
def sync_upsert(spark, sf_dir):
    """Orders into a table keyed by customer, which holds a placeholder row for each."""
    orders = _orders(spark, sf_dir)
    header = headers.keyed_header(
        "impala::tmp.last_order", batch_id="run-1", range_partition="0<=VALUES<1000")
    # one lane per customer, so that the later of two rows of a customer is defined
    sent = sync.send(orders, F.col("o_custkey") % N_LANES, F.col("o_orderkey"), header,
                     "orders_topic", F.lit("2024-01-01 00:00:00"), N_LANES)
    placeholders = table(spark, sf_dir, "customer").select(
        F.lit("tmp.last_order").alias("target"), F.lit(-1).cast("long").alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"), F.lit("-").alias("o_orderstatus"),
        F.lit(0.0).alias("o_totalprice"), F.lit("").alias("o_orderday"))
    registry = table(spark, sf_dir, "customer").select(
        F.lit("tmp.last_order").alias("target_table"), F.lit(1000).cast("long").alias("lower"),
        F.lit(10**12).cast("long").alias("upper")).distinct()
    checked = sync.receive(_sent(spark, sent), ORDER_SCHEMA, ["tmp.last_order"])
    return sync.apply_keyed(checked, ORDER_SCHEMA, ["o_custkey"], placeholders, registry,
                            "o_custkey")


@query
def sync_files(spark, sf_dir):
    """Text files read in parts, sent as chunks, put together and loaded as lines, whatever the
    size of the segments that a file is put together in."""
    listed = files.list_files(spark, _text_files(spark, sf_dir), ".txt")
    parts = files.file_parts(listed, 64 * 1024)
    name = tables.fresh_name("files")
    sent = sync.send_files(parts, name, F.create_map(
        F.lit("bucket"), _bucket("file").cast("string")))
    whole = sync.load_files(stored(sent, "chunks"), 64 * 1024, segment_bytes=256 * 1024)
    tables.create_target(spark, name, "line STRING, bucket STRING", scratch(spark, name),
                         ["bucket"])
    landed.load_rows(spark, whole, format="text")
    return spark.table(name).select(F.md5("line").alias("line_md5"), "bucket")


@query
def sync_file_rows(spark, sf_dir):
    """Orders exported to parquet files by status, sent as chunks and loaded into partitions that
    hold older rows: two are replaced, the third is added to."""
    path, name = scratch(spark, "export"), tables.fresh_name("loaded_files")
    orders = _orders(spark, sf_dir)
    orders.write.option("maxRecordsPerFile", 4000).partitionBy("o_orderstatus").parquet(path)
    tables.create_target(spark, name, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE,"
                         " o_orderday STRING, o_orderstatus STRING", scratch(spark, name),
                         ["o_orderstatus"])
    tables.append_by_name(orders.where("o_orderkey % 100 = 0").withColumn(
        "o_orderday", F.lit("older")), name)
    parts = files.file_parts(files.list_files(spark, path, ".parquet"), 32 * 1024)
    status = F.regexp_extract("file", "o_orderstatus=([A-Z])/", 1)
    sent = stored(sync.send_files(parts, name, F.create_map(F.lit("o_orderstatus"), status))
                  .withColumn("is_overwrite", status != "P"), "chunks")
    landed.load_rows(spark, sync.load_files(sent, 32 * 1024, segment_bytes=64 * 1024))
    return spark.table(name)


@query
def stream_files(spark, sf_dir):
    """Documents sent as files in two waves, with a stop between them: every file is reported once
    all its parts are here. Each ninth file lacks its last part."""
    path, out = scratch(spark, "chunks"), scratch(spark, "files")
    parts = ch.cut(_document_files(spark, sf_dir), "content", "file", PART)
    parts = parts.where("doc_id % 9 <> 0 or cur_part < total_parts")
    sink = sinks.FileSink(spark, f"{out}/store", PART)
    for wave in ("cur_part % 3 = 1", "cur_part % 3 <> 1"):
        sent = sync.send_files(parts.where(wave), "tmp.texts", F.create_map(
            F.lit("day"), F.lit("1")), transfer="first")
        topics.publish(sent, path, schema=CHUNK)
        receiver.start_files(spark.readStream.schema(CHUNK).parquet(path), sink, f"{out}/chunks",
                             once=True).awaitTermination()
        transfers.start_transfers(spark, sink, f"{out}/transfers", once=True).awaitTermination()
    times = sink.events().where("event = 'complete'").groupBy("sync_id").agg(
        F.count(F.lit(1)).alias("n_reports"))
    return sink.read_reported().join(times, "sync_id").select(
        "file", "n_parts", "n_reports", F.md5("data").alias("data_md5"))


@query
def stream_until_end(spark, sf_dir):
    """A subscription of three waves of messages whose lanes end in different ones."""
    path, out = scratch(spark, "topic"), scratch(spark, "until-end")
    header = headers.append_header("tmp.all", batch_id="run-1")
    topic = stored(fx.messages(spark, sf_dir).select(
        "lane", "msg_id", F.lit("all").alias("topic"),
        F.col("publish_time").cast("timestamp").alias("publish_time"), header.alias("properties"),
        F.when(F.col("msg_id") % 997 == 996, pack.END_SIGN).otherwise(F.col("data")).alias("data")),
        "messages")
    waves = F.when(F.col("msg_id") < 1500, 0).when(F.col("msg_id") < 3000, 1).otherwise(2)
    sink = sinks.AppendSink(spark, f"{out}/rows", K)
    for wave in range(3):
        topics.publish(topic.where(waves == wave), path, own_ids=True)
        receiver.start(topics.stream_topic(spark, path), K, [sink], f"{out}/cursor", once=True,
                       until_end=True).awaitTermination()
    return sink.read().select("msg_id", "row_pos", "k")


@query
def sync_files_twice(spark, sf_dir):
    """Every document as a file, then a shorter version of each third again on the same topic, of
    which every ninth lacks its last part: the latest complete transfer of each file."""
    path, docs = scratch(spark, "chunks"), _document_files(spark, sf_dir)
    shorter = docs.where("doc_id % 3 = 0").withColumn("content", F.substring(
        "content", F.lit(1), F.expr("octet_length(content) div 2")))
    for transfer, rows in (("first", docs), ("second", shorter)):
        parts = ch.cut(rows, "content", "file", PART)
        if transfer == "second":
            parts = parts.where("doc_id % 9 <> 0 or cur_part < total_parts")
        sent = sync.send_files(parts, "tmp.texts", F.create_map(F.lit("day"), F.lit("1")),
                               transfer=transfer)
        topics.publish(sent, path, schema=CHUNK)
    whole = ch.reassemble(spark.read.schema(CHUNK).parquet(path), PART)
    return whole.select("file", "n_parts", F.md5("data").alias("data_md5"))


@query
def sync_bounded(spark, sf_dir):
    """A consumer that reads up to the end mark and inserts in groups of 500 rows."""
    marked = fx.messages(spark, sf_dir).withColumn("data", F.when(
        F.col("msg_id") % 997 == 996, pack.END_SIGN).otherwise(F.col("data")))
    bounded = topics.until_end(marked.select("lane", "msg_id", "data"))
    rows = sync.bounded_load(bounded, K, 500)
    return rows.where("dirty_fields is null").select("lane", "msg_id", "insert_no", "row_pos", "k")


def _daily(orders: DataFrame, batch: str) -> DataFrame:
    header = headers.append_header("tmp.orders", batch_id=batch, clear_table="tmp.orders")
    return sync.send(orders, F.col("o_orderkey") % N_LANES, F.col("o_orderkey"), header,
                     "orders_topic", F.lit("2024-01-01 00:00:00"), N_LANES, span=2000)


@query
def sync_append_two_runs(spark, sf_dir):
    """A second, smaller run on the same topic replaces the first."""
    orders, path = _orders(spark, sf_dir), scratch(spark, "topic")
    topics.publish(_daily(orders, "run-1"), path)
    topics.publish(_daily(orders.where("o_orderstatus = 'F'"), "run-2"), path)
    checked = sync.receive(topics.read_topic(spark, path), ORDER_SCHEMA)
    return sync.apply_append(checked, ORDER_SCHEMA)


@query
def sync_upsert_two_runs(spark, sf_dir):
    """The later run wins for every key that both hold."""
    orders, path = _orders(spark, sf_dir), scratch(spark, "topic")
    header = headers.keyed_header("impala::tmp.by_order", batch_id="run")
    for rows in (orders.withColumn("o_orderstatus", F.lit("OLD")),
                 orders.where("o_orderkey % 3 = 0")):
        topics.publish(sync.send(
            rows, F.col("o_orderkey") % N_LANES, F.col("o_orderkey"), header, "orders_topic",
            F.lit("2024-01-01 00:00:00"), N_LANES, span=2000), path)
    checked = sync.receive(topics.read_topic(spark, path), ORDER_SCHEMA, ["tmp.by_order"])
    nothing = orders.select(F.lit("tmp.by_order").alias("target"), *ORDER_SCHEMA.names).limit(0)
    return sync.apply_keyed(checked, ORDER_SCHEMA, ["o_orderkey"], nothing)


@query
def sync_upsert_partial(spark, sf_dir):
    """Records of three runs carry some columns each; the others keep what is stored."""
    orders, path = _orders(spark, sf_dir), scratch(spark, "topic")
    header = headers.keyed_header("impala::tmp.last_order", batch_id="run")
    for columns, rows in ((["o_orderkey", "o_custkey", "o_orderstatus"], "o_orderkey % 2 = 0"),
                          (["o_custkey", "o_totalprice"], "o_orderkey % 2 = 1"),
                          (["o_custkey", "o_orderstatus"], "o_orderkey % 5 = 0")):
        # orders of a customer share a lane, so that the last one is defined
        numbered = orders.where(rows).select(
            *columns, F.struct((F.col("o_custkey") % N_LANES).alias("lane"),
                               F.col("o_orderkey").alias("ord")).alias("_at"))
        topics.publish(sync.send(
            numbered, F.col("_at")["lane"], F.col("_at")["ord"], header, "orders_topic",
            F.lit("2024-01-01 00:00:00"), N_LANES), path)
    placeholders = table(spark, sf_dir, "customer").select(
        F.lit("tmp.last_order").alias("target"), F.lit(-1).cast("long").alias("o_orderkey"),
        F.col("c_custkey").alias("o_custkey"), F.lit("-").alias("o_orderstatus"),
        F.lit(0.0).alias("o_totalprice"), F.lit("").alias("o_orderday"))
    checked = sync.receive(topics.read_topic(spark, path), ORDER_SCHEMA, ["tmp.last_order"],
                           partial=True)
    return sync.apply_keyed(checked, ORDER_SCHEMA, ["o_custkey"], placeholders, partial=True)


@query
def sync_oversize(spark, sf_dir):
    """Documents through messages of 4 KiB: what is too large for one is in the audit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    header = headers.append_header("tmp.docs", batch_id="run-1")
    sent = sync.send(docs, F.col("doc_id") % N_LANES, F.col("doc_id"), header, "docs_topic",
                     F.lit("2024-01-01 00:00:00"), N_LANES, limit=4096, strict=False)
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("text", T.StringType())])
    arrived = sync.apply_append(sync.receive(_sent(spark, sent), schema), schema)
    large = sync.rejected(docs, "docs_topic", "tmp.docs", 4096)
    kept = F.from_json("payload", schema)
    both = arrived.select("doc_id", "text").unionByName(
        large.select(kept["doc_id"].alias("doc_id"), kept["text"].alias("text")))
    return both.select("doc_id", F.md5("text").alias("text_md5"))


@query
def clear_by_literal(spark, sf_dir):
    """Partitions cleared by the literals that users write, of one and of two columns."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("msg_id"), F.lit("t").alias("clear_table"), "event_type",
        (F.col("user_id") % 3).alias("part"), F.expr("event_id div 400").cast("string")
        .alias("batch_id"), "value")
    out = None
    for name, literal, columns in (
            ("one", literals.partition_literal(F.col("event_type"), quoted=(True,)),
             ["event_type"]),
            ("two", literals.partition_literal(F.col("part"), F.col("event_type"),
                                               quoted=(False, True)), ["part", "event_type"])):
        rows = events.withColumn("partition", literal)
        last = clear.last_clears(clear.run_starts(rows, span=500))
        left = clear.surviving(rows, last, "clear_table", columns).select(
            F.lit(name).alias("keyed_by"), "msg_id", "event_type", "part")
        out = left if out is None else out.unionByName(left)
    return out


@query
def pack_messages_blocks(spark, sf_dir):
    """Packing over many blocks of each lane gives the messages of one block."""
    return pack.pack_messages(fx.rows(spark, sf_dir), limit=LIMIT, span=700).select(
        "lane", "msg", "first_order", "n_rows", "n_bytes", _joined("rows").alias("rows_md5"))


@query
def pack_messages_sparse(spark, sf_dir):
    """Packing by an order whose values lie far apart and not in the order of the table."""
    rows = fx.rows(spark, sf_dir).withColumn("ord", F.expr("ord * 2654435761L % 4294967291L"))
    return pack.pack_messages(rows, limit=LIMIT, span=blocks.Ranked(700)).select(
        "lane", "msg", "first_order", "n_rows", "n_bytes", _joined("rows").alias("rows_md5"))


@query
def clear_events_blocks(spark, sf_dir):
    """Clears over many blocks of message ids."""
    return _clear_events(spark, sf_dir, span=300)


def _many_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Three tables of different columns."""
    customers = table(spark, sf_dir, "customer")
    return {"tmp.orders": _orders(spark, sf_dir),
            "tmp.customers": customers.select("c_custkey", "c_name", "c_acctbal"),
            "tmp.events": table(spark, sf_dir, "events").select(
                "event_id", "event_type", F.to_date("ts").alias("day"), "value")}


@query
def sync_many_tables(spark, sf_dir):
    """Orders, customers and events on one topic, and a table that nobody takes: one receiver
    loads each into its own target. Customers are keyed, and come twice."""
    rows = _many_tables(spark, sf_dir)
    path, out = scratch(spark, "topic"), scratch(spark, "many")
    keys = {"tmp.orders": "o_orderkey", "tmp.customers": "c_custkey", "tmp.events": "event_id",
            "tmp.stray": "c_custkey"}
    older = rows["tmp.customers"].withColumn("c_name", F.lit("OLD"))
    for target, df in (("tmp.customers", older), *rows.items(), ("tmp.stray", older)):
        header = (headers.keyed_header(f"impala::{target}", batch_id="run-1")
                  if keys[target] == "c_custkey" else
                  headers.append_header(target, batch_id="run-1", clear_table=target))
        topics.publish(sync.send(df, F.col(keys[target]) % N_LANES, F.col(keys[target]), header,
                                 "all", F.lit("2024-01-01 00:00:00"), N_LANES), path)
    targets = {
        name: (sinks.KeyedSink(spark, f"{out}/{name}", df.schema, [keys[name]])
               if name == "tmp.customers" else sinks.AppendSink(spark, f"{out}/{name}", df.schema))
        for name, df in rows.items()}
    sink = sinks.CatalogSink(spark, f"{out}/audit", targets)
    receiver.start_many(topics.stream_topic(spark, path), sink, f"{out}/cursor",
                        once=True).awaitTermination()
    shown = [sink.audited().groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("audit").alias("target"), F.lit(0).cast("long").alias("id"),
        F.col("reason").alias("content")).distinct()]
    for name, target in targets.items():
        fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("-")) for f in target.schema
                  if not isinstance(f.dataType, T.DoubleType)]
        numbers = [F.round(F.col(f.name) * 100).cast("long").cast("string") for f in target.schema
                   if isinstance(f.dataType, T.DoubleType)]
        shown.append(target.read().select("target", F.col(keys[name]).alias("id"),
                                          F.concat_ws("|", *fields, *numbers).alias("content")))
    result = shown[0]
    for df in shown[1:]:
        result = result.unionByName(df)
    return result


@query
def stream_compact_clears(spark, sf_dir):
    """Batches that clear their table, received in three parts that are mixed in the order of
    ids, with all epochs folded and deleted after each part."""
    path, out = scratch(spark, "topic"), scratch(spark, "compacted")
    msgs = fx.clears(spark, sf_dir)
    # batches come back: a run of each third batch id interrupts its neighbours
    batch = F.when(F.col("msg_id") % 1000 < 300, "again").otherwise(F.col("batch_id"))
    header = headers.header_map({
        "db_type": headers.APPEND_TYPE, "target_table": F.col("clear_table"),
        "clear_table": F.col("clear_table"), "partition": "", "batch_id": batch})
    topic = stored(msgs.select(
        F.lit(0).cast("long").alias("lane"), "msg_id", F.lit("clears").alias("topic"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("publish_time"),
        header.alias("properties"),
        F.concat(F.lit('[{"part":"'), "part", F.lit('"}]')).alias("data")), "messages")
    schema = T.StructType([T.StructField("part", T.StringType())])
    sink = sinks.AppendSink(spark, f"{out}/rows", schema)
    for part in range(3):
        topics.publish(topic.where((F.col("msg_id") + F.lit(part)) % 3 == 0), path, own_ids=True)
        receiver.start(topics.stream_topic(spark, path), schema, [sink], f"{out}/cursor",
                       once=True).awaitTermination()
        sink.compact()
        sink.vacuum()
    return sink.read().select("target", "msg_id", "part")
