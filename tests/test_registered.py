"""Every registered query against its SQL, and what no plan may contain."""

import contextlib
import io

import pytest
from oracle import ORACLE, QUERIES, actual, connection, difference, expected

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(actual(spark, sf_dir, name), expected(con, name)) is None


@pytest.mark.parametrize("name", ["audit_counts", "range_partition_assign", "partition_reload",
                                  "file_reassemble", "pack_messages", "sync_append"])
def test_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_payload_is_shuffled_once_by_packing(spark, sf_dir):
    assert plan_of(QUERIES["pack_messages"](spark, sf_dir)).count("Exchange hashpartitioning") == 1


def test_scan_reads_only_the_columns_in_use(spark, sf_dir):
    plan = plan_of(QUERIES["pack_messages"](spark, sf_dir))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "o_totalprice" not in schema and "o_orderdate" not in schema


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns


@pytest.mark.parametrize("name", ["wal_rows", "sync_append"])
def test_payload_is_parsed_once(spark, sf_dir, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, sf_dir).explain("formatted")
    assert text.getvalue().count("from_json") <= 1, text.getvalue()
