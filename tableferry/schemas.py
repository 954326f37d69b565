"""Table schemas shared by producers, consumers and sinks."""

from pyspark.sql import types as T

TOPIC = T.StructType([
    T.StructField("lane", T.LongType()),
    T.StructField("msg_id", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("data", T.StringType()),
])

AUDIT = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("msg_id", T.LongType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("payload", T.StringType()),
])

CHUNK = T.StructType([
    T.StructField("msg_id", T.LongType()),
    T.StructField("sync_id", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("total_parts", T.IntegerType()),
    T.StructField("cur_part", T.IntegerType()),
    T.StructField("md5_checksum", T.StringType()),
    T.StructField("is_overwrite", T.BooleanType()),
    T.StructField("table", T.StringType()),
    T.StructField("partition", T.MapType(T.StringType(), T.StringType())),
    T.StructField("transfer", T.StringType()),
    T.StructField("data", T.BinaryType()),
])

#: What is reported of file transfers.
EVENTS = T.StructType([
    T.StructField("sync_id", T.StringType()), T.StructField("transfer", T.StringType()),
    T.StructField("file", T.StringType()), T.StructField("event", T.StringType()),
    T.StructField("n_parts", T.IntegerType()), T.StructField("total_parts", T.IntegerType()),
    T.StructField("last_msg", T.LongType()),
])

RANGES = T.StructType([
    T.StructField("target_table", T.StringType()),
    T.StructField("lower", T.LongType()),
    T.StructField("upper", T.LongType()),
])
