"""Codec, headers, literals."""

import datetime
import decimal
import json
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from tableferry.functions import codec, headers, literals
from tableferry.operators.route import typed


def test_rows_survive_the_wire(spark):
    schema = T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("s", T.StringType()),
        T.StructField("d", T.DoubleType()), T.StructField("m", T.DecimalType(12, 3)),
        T.StructField("t", T.TimestampType()), T.StructField("day", T.DateType()),
        T.StructField("b", T.BinaryType()), T.StructField("f", T.BooleanType()),
        T.StructField("l", T.ArrayType(T.LongType()))])
    rows = [
        (1, 'quote " and é\n', 1e-7, decimal.Decimal("12.345"),
         datetime.datetime(2024, 1, 2, 3, 4, 5, 678901), datetime.date(2024, 2, 29), b"\x00\xff",
         True, [1, None, 3]),
        (None,) * 9,
        (-5, "", 1.5e300, decimal.Decimal("-0.001"), datetime.datetime(1999, 12, 31),
         datetime.date(1900, 1, 1), b"", False, [])]
    df = spark.createDataFrame(rows, schema)
    enc = codec.encode_rows(df).agg(F.collect_list("enc").alias("rows")).select(
        F.lit(1).alias("msg_id"), codec.json_array(F.col("rows")).alias("data"))
    back = typed(codec.decode_rows(enc, schema.names), schema)
    assert back.where("dirty_fields is not null").count() == 0
    assert sorted(map(str, back.select(*schema.names).collect())) == sorted(map(str, df.collect()))


def test_text_that_is_no_binary_is_dirty(spark):
    df = spark.createDataFrame([("!!!",), ("AP8=",)], "b string")
    got = typed(df, T.StructType([T.StructField("b", T.BinaryType())])).collect()
    assert [(r.b and bytes(r.b), r.dirty_fields) for r in got] == [(None, "b"), (b"\x00\xff", None)]


def test_null_fields_are_kept_in_the_text(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(codec.encode_rows(df).first().enc) == {"a": 1, "b": None}


def test_unreadable_payloads_decode_to_null(spark):
    texts = ['[{"k": 1}', "", "nonsense", '[{"k": 1},{"k"', None, "[]", '[{"k": "x"}]', "[{}]"]
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    got = [r[0] for r in df.select(codec.parsed(F.col("data"), ["k"]).alias("r")).collect()]
    assert got[:5] == [None] * 5
    assert got[5] == [] and got[6][0].k == "x" and got[7][0].k is None


def test_append_header_defaults(spark):
    df = spark.range(3).select(headers.append_header("t", partition=None, task_id=0).alias("h"))
    maps = [r.h for r in df.collect()]
    assert set(maps[0]) == set(headers.APPEND_FIELDS) | {"db_type"}
    assert maps[0]["db_type"] == "clickhouse" and maps[0]["task_id"] == maps[0]["partition"] == ""
    assert len({m["batch_id"] for m in maps}) == 1
    uuid.UUID(maps[0]["batch_id"])


def test_keyed_header_options_become_entries(spark):
    h = spark.range(1).select(
        headers.keyed_header("t", batch_id="b", db_type="other", note=F.col("id")).alias("h")
    ).first().h
    assert h["db_type"] == "other" and h["note"] == "0" and h["write_mode"] == "upsert"
    assert "kwargs" not in h


def test_enriched_sets_rows_and_fills_only_empty_entries(spark):
    base = headers.header_map({"task_id": "mine", "source_table": None, "rows": "9"})
    h = spark.range(1).select(headers.enriched(base, "x", "src", F.lit(4)).alias("h")).first().h
    assert h == {"task_id": "mine", "source_table": "src", "rows": "4"}


def test_partition_literals(spark):
    texts = ["(2021,7,13)", "(2021,'Tom','Andersen')", "'jd'", "20210804", "(2021,'a,b')"]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r[0] for r in df.select(literals.partition_values(F.col("p"))).collect()]
    assert got == [["2021", "7", "13"], ["2021", "Tom", "Andersen"], ["jd"], ["20210804"],
                   ["2021", "a,b"]]


def test_partition_clause_quotes_text_and_reserved_words(spark):
    clause = literals.partition_clause({
        "date": (F.lit(20240101), False), "no": (F.lit(7), False), "day": (F.lit("1"), True)})
    assert spark.range(1).select(clause).first()[0] == (
        "partition(`date`=20240101,`no`=7,day='1')")


def test_only_the_exact_prefix_is_stripped(spark):
    names = ["impala::impala_sales.a", "impala::map.b", "lima.c", "impala:d", "x.impala::e"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(literals.normalise_target(F.col("n"))).collect()]
    assert got == ["impala_sales.a", "map.b", "lima.c", "impala:d", "x.impala::e"]


def test_range_bounds(spark):
    specs = ["20210804<=VALUES<20210805", "3 < VALUES <= 9", "VALUES < 5", "7 <= values",
             "VALUE = 4", "garbage", "", None]
    df = spark.createDataFrame([(s,) for s in specs], "s string")
    lower, upper = literals.range_bounds(F.col("s"))
    got = [tuple(r) for r in df.select(lower, upper).collect()]
    assert got == [(20210804, 20210805), (4, 10), (-2**63, 5), (7, 2**63 - 1), (4, 5),
                   (None, None), (None, None), (None, None)]


NESTED = T.StructType([
    T.StructField("at", T.TimestampType()), T.StructField("cost", T.DecimalType(10, 4)),
    T.StructField("raw", T.BinaryType()),
    T.StructField("days", T.MapType(T.DateType(), T.ArrayType(T.IntegerType()))),
    T.StructField("inner", T.StructType([T.StructField("n", T.IntegerType()),
                                         T.StructField("s", T.StringType())]))])


def test_nested_values_round_trip_in_any_zone(spark):
    row = ("2024-11-03 05:30:00.123456+00:00", "12.3400", b"\x00\xff")
    df = spark.createDataFrame([(*row, 1), (*row, None)], "at string, cost string, raw binary,"
                               " n int").select(F.col("n").alias("id"), F.struct(
        F.col("at").cast("timestamp").alias("at"), F.col("cost").cast("decimal(10,4)").alias("cost"),
        "raw", F.create_map(F.lit("2024-02-29").cast("date"), F.array(F.lit(1), F.col("n")))
        .alias("days"), F.when(F.col("n").isNotNull(), F.struct("n", F.lit('q"x').alias("s")))
        .alias("inner")).alias("f"))
    sent = [r.enc for r in codec.encode_rows(df).select("enc").collect()]
    want = [r.f for r in df.select(F.to_json("f").alias("f")).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = codec.decode_rows(spark.createDataFrame([(f"[{','.join(sent)}]",)], "data string"),
                                  ["f"])
        read = texts.select("row_pos", codec.from_wire(F.col("f"), NESTED).alias("f")).cache()
        assert read.where("f is null").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.f for r in read.orderBy("row_pos").select(F.to_json("f").alias("f")).collect()] == want


@pytest.mark.parametrize("text", [
    '{"inner": {"n": "x"}}', '{"inner": 5}', '{"days": {"2024-13-01": [1]}}',
    '{"days": {"2024-01-01": ["a"]}}', '{"cost": "abc"}', '5', '{"at":', '[]'])
def test_a_misfit_at_any_depth_does_not_fit(spark, text):
    df = spark.createDataFrame([(text,)], "f string")
    assert df.select(codec.from_wire(F.col("f"), NESTED).alias("f")).first().f is None
