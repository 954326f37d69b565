"""Sources, targets, topics."""

import pytest
from pyspark.sql import functions as F

from tableferry.operators import mapper
from tableferry.session import scratch
from tableferry.sources import tables, topics


def fresh(spark, ddl, parts=()):
    name = tables.fresh_name("t")
    tables.create_target(spark, name, ddl, scratch(spark, name), parts)
    return name


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_source_needs_a_statement_or_a_table(spark):
    spark.range(3).createOrReplaceTempView("src_t")
    assert tables.source(spark, src_table="src_t").count() == 3
    assert tables.source(spark, "select * from src_t where id < :n", args={"n": 2}).count() == 2
    with pytest.raises(ValueError):
        tables.source(spark)


def test_templates():
    p = tables.day_params("2021-08-31")
    assert tables.rendered("{{ds_nodash}}<=VALUES<{{ next_ds_nodash }}", p) == (
        "20210831<=VALUES<20210901")
    with pytest.raises(KeyError):
        tables.rendered("{{other}}", p)


def test_jdbc_options():
    o = tables.jdbc_options("jdbc:x", sql="select 1")
    assert o == {"url": "jdbc:x", "fetchsize": "100000", "query": "select 1"}
    o = tables.jdbc_options("jdbc:x", sql="select 1", split_column="id", bounds=(0, 9), splits=3)
    assert "query" not in o and o["dbtable"] == "(select 1) src" and o["numPartitions"] == "3"
    for bad in ({"url": "u"}, {"url": "u", "dbtable": "t", "split_column": "id"}):
        with pytest.raises(ValueError):
            tables.jdbc_options(**bad)


def test_append_by_position_and_by_name(spark):
    name = fresh(spark, "a INT, b STRING")
    tables.append_by_position(spark.createDataFrame([(1, "x")], "b int, a string"), name)
    tables.append_by_name(spark.createDataFrame([("y", 2)], "b string, a int"), name)
    tables.append_by_name(spark.createDataFrame([(3,)], "a int"), name)
    assert rows(spark, name) == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(ValueError):
        tables.append_by_name(spark.createDataFrame([(3,)], "other int"), name)


def test_partition_load_overwrites_or_adds(spark):
    name = fresh(spark, "n INT, day STRING", ["day"])
    one = spark.createDataFrame([(1,)], "n int")
    for day in ("007", "it's"):
        tables.load_partition(one, name, {"day": day})
        tables.load_partition(one, name, {"day": day})
        tables.load_partition(one, name, {"day": day}, is_overwrite=False)
    assert rows(spark, name) == [(1, "it's")] * 2 + [(1, "007")] * 2


def test_reload_of_a_partition_leaves_the_others(spark):
    name = fresh(spark, "n INT, day INT", ["day"])
    tables.append_by_name(spark.createDataFrame([(1, 1), (2, 2)], "n int, day int"), name)
    batch = spark.createDataFrame([(3, 1), (4, 2)], "n int, day int")
    tables.reload_partition(batch, name, {"day": 1})
    assert rows(spark, name) == [(2, 2), (3, 1), (4, 2)]
    tables.drop_partition(spark, name, {"day": 1})
    tables.append_by_name(spark.createDataFrame([(5, 1)], "n int, day int"), name)
    assert rows(spark, name) == [(2, 2), (4, 2), (5, 1)]
    tables.truncate_reload(spark.createDataFrame([(9, 9)], "n int, day int"), name)
    assert rows(spark, name) == [(9, 9)]


def test_clone_keeps_columns_and_partitioning(spark):
    first = fresh(spark, "n INT, day INT", ["day"])
    tables.append_by_name(spark.createDataFrame([(1, 1)], "n int, day int"), first)
    second = tables.fresh_name("t")
    tables.clone_schema(spark, second, first, scratch(spark, second))
    assert spark.table(second).count() == 0
    assert spark.table(second).schema == spark.table(first).schema
    assert [c.name for c in spark.catalog.listColumns(second) if c.isPartition] == ["day"]


def test_layout_is_partitioned_and_sorted(spark, tmp_path):
    df = spark.range(200).selectExpr("id % 3 as p", "cast(199 - id as string) as shop", "id as n")
    tables.write_layout(df, f"{tmp_path}/t", ["p"], ["shop"])
    got = spark.read.parquet(f"{tmp_path}/t").select("p", "shop", F.input_file_name().alias("f"),
                                                     F.monotonically_increasing_id().alias("i"))
    seen = {}
    for r in got.orderBy("i").collect():
        seen.setdefault(r.f, []).append((r.p, r.shop))
    assert sum(map(len, seen.values())) == 200
    assert all(v == sorted(v) and len({p for p, _ in v}) == 1 for v in seen.values())


def test_export_bounds_the_rows_per_file(spark, tmp_path):
    tables.export_parquet(spark.range(0, 1000, 1, 2), f"{tmp_path}/e", 150)
    got = spark.read.parquet(f"{tmp_path}/e").groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in got) == 1000 and max(r[1] for r in got) <= 150


def test_catalog(spark):
    spark.range(4).createOrReplaceTempView("four")
    assert "default" in tables.databases(spark) and "four" in tables.tables_of(spark)
    assert [tuple(r) for r in tables.row_counts(spark, ["four"]).collect()] == [("four", 4)]
    assert [r.id for r in tables.first_rows(spark.range(9), ["id"], 2).collect()] == [0, 1]


def test_mappers(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "n long, s string")
    out = mapper.map_records(df, lambda r: {"m": r["n"] * 2, "t": r["s"]}, "m long, t string")
    assert sorted(map(tuple, out.collect())) == [(2, None), (4, "b")]
    assert mapper.map_rows(df, lambda d: d.drop("s")).columns == ["n"]


def test_subscription_lists_must_agree():
    got = topics.subscriptions("u1;u2;", "t1; t2", "s1;s2")
    assert [(s.url, s.topic, s.name) for s in got] == [("u1", "t1", "s1"), ("u2", "t2", "s2")]
    for bad in (("u", "t1;t2", "s1;s2"), ("", "t", "s"), ("u;;v", "a;b;c", "a;b;c")):
        with pytest.raises(ValueError):
            topics.subscriptions(*bad)


def test_reading_ends_at_the_first_end_mark_of_each_lane(spark):
    df = spark.createDataFrame(
        [(0, 1, "a"), (0, 2, "END_SIGN"), (0, 3, "b"), (0, 4, "END_SIGN"), (1, 9, "c"),
         (None, 5, "d")], "lane long, msg_id long, data string")
    assert sorted(r.data for r in topics.until_end(df).collect()) == ["a", "c", "d"]
