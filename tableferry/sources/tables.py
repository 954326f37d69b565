"""Source queries and target tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableferry.session import scratch
from tableferry.sources.files import list_files

# Fixed value: rows per fetch of the source.
FETCH_ROWS = 100_000
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> None:
    """Make the tables of a directory visible to SQL."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def source(spark: SparkSession, sql: str | None = None, src_table: str | None = None,
           args: dict | None = None) -> DataFrame:
    """The rows to send: any statement, or all of a table."""
    if not sql and not src_table:
        raise ValueError("give a statement or a table")
    if not sql:
        return spark.table(src_table)
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def rendered(template: str, params: dict) -> str:
    """``{{name}}`` in a header value replaced by a run-time parameter."""
    def value(match):
        name = match.group(1)
        if name not in params:
            raise KeyError(f"no parameter {name!r}")
        return str(params[name])
    return re.sub(r"\{\{\s*(\w+)\s*\}\}", value, template)


def day_params(ds: str) -> dict:
    """Parameters of a daily run: its date and the next, without dashes."""
    import datetime
    day = datetime.date.fromisoformat(ds)
    nxt = day + datetime.timedelta(days=1)
    return {"ds": ds, "ds_nodash": f"{day:%Y%m%d}", "next_ds": nxt.isoformat(),
            "next_ds_nodash": f"{nxt:%Y%m%d}"}


def jdbc_options(url: str, sql: str | None = None, dbtable: str | None = None,
                 fetch_rows: int = FETCH_ROWS, split_column: str | None = None,
                 bounds: tuple | None = None, splits: int | None = None) -> dict:
    """Options of an external source: blocks of ``fetch_rows`` rows, and parallel reads over
    ranges of ``split_column`` where one is given."""
    if not sql and not dbtable:
        raise ValueError("give a statement or a table")
    opts = {"url": url, "fetchsize": str(fetch_rows)}
    if split_column:
        if bounds is None or not splits:
            raise ValueError("a split column needs bounds and a number of splits")
        opts |= {"partitionColumn": split_column, "lowerBound": str(bounds[0]),
                 "upperBound": str(bounds[1]), "numPartitions": str(splits),
                 "dbtable": f"({sql}) src" if sql else dbtable}
    else:
        opts["query" if sql else "dbtable"] = sql or dbtable
    return opts


def jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def named_records(df: DataFrame, out: str = "record") -> DataFrame:
    """Every row as one named record."""
    return df.select(F.struct("*").alias(out))


def described(df: DataFrame) -> DataFrame:
    """Column names and types of a result, with the number of values in each column."""
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in df.columns])
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"),
                 F.lit(t).alias("data_type"), F.col(f"`{n}`").alias("n_values"))
        for i, (n, t) in enumerate(df.dtypes)])
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def tables_of(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Rows of each table; only file footers or one column are read."""
    out = None
    for name in names:
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by key; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


# ---- targets -------------------------------------------------------------------------------

def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def create_target(spark: SparkSession, name: str, ddl: str, location: str,
                  partitioned_by: Sequence[str] = ()) -> None:
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{part} LOCATION '{location}'")


def clone_schema(spark: SparkSession, new: str, old: str, location: str) -> None:
    """A new empty table with the columns and partitioning of another."""
    spark.sql(f"CREATE TABLE {new} LIKE {old} LOCATION '{location}'")


def append_by_position(df: DataFrame, target: str) -> None:
    df.write.insertInto(target)


def append_by_name(df: DataFrame, target: str) -> None:
    """Columns the rows lack become null; columns the target lacks are an error."""
    spark = df.sparkSession
    extra = {c.lower() for c in df.columns} - {c.lower() for c in spark.table(target).columns}
    if extra:
        raise ValueError(f"{target} has no columns {sorted(extra)}")
    view = fresh_name("by_name")
    aligned(df, target).createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {target} BY NAME SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def sql_literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def partition_spec(partition: dict) -> str:
    return "PARTITION (" + ", ".join(f"`{k}`={sql_literal(v)}"
                                     for k, v in partition.items()) + ")"


def add_partition(spark: SparkSession, target: str, partition: dict) -> None:
    spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {partition_spec(partition)}")


def aligned(df: DataFrame, target: str, without: Sequence[str] = ()) -> DataFrame:
    """The columns of the target in its order, null where ``df`` lacks one."""
    have = {c.lower() for c in df.columns}
    fields = [f for f in df.sparkSession.table(target).schema.fields if f.name not in without]
    return df.select(*[
        F.col(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in fields])


def overwrite_partition(df: DataFrame, target: str, partition: dict) -> None:
    """Replace the content of one partition by ``df`` in a single step."""
    view = fresh_name("part")
    aligned(df, target, tuple(partition)).createOrReplaceTempView(view)
    df.sparkSession.sql(
        f"INSERT OVERWRITE {target} {partition_spec(partition)} SELECT * FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def drop_partition(spark: SparkSession, target: str, partition: dict) -> None:
    """Remove a partition and its rows; dropping alone leaves the files of an external table,
    and they would be back with the next row written there."""
    nothing = spark.createDataFrame([], spark.table(target).schema)
    overwrite_partition(nothing, target, partition)
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {partition_spec(partition)}")


def load_partition(df: DataFrame, target: str, partition: dict,
                   is_overwrite: bool = True) -> None:
    """Put rows (without the partition columns) into one partition, which is added first."""
    spark = df.sparkSession
    add_partition(spark, target, partition)
    view = fresh_name("load")
    df.createOrReplaceTempView(view)
    verb = "OVERWRITE" if is_overwrite else "INTO"
    spark.sql(f"INSERT {verb} {target} {partition_spec(partition)} SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def put_partitions(df: DataFrame, target: str, is_overwrite: bool = True) -> None:
    """Put rows, in the order of the target's columns, into the partitions that they name, in one
    load: with ``is_overwrite`` these are replaced, and others stay as they are."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    try:
        spark.conf.set(mode, "dynamic")  # an option of the writer is not passed on to a table
        df.write.insertInto(target, overwrite=is_overwrite)
    finally:
        spark.conf.set(mode, before)


def reload_partition(df: DataFrame, target: str, partition: dict) -> None:
    """Clear one partition and put in ``df`` (partition columns included).

    Clear and load of that partition are one overwrite. Rows of ``df`` in other partitions are
    added to what those hold, which a dynamic overwrite of ``df`` would replace instead.
    """
    inside = F.lit(True)
    for name, value in partition.items():
        inside = inside & F.col(name).eqNullSafe(F.lit(value))
    overwrite_partition(df.where(inside), target, partition)
    append_by_name(df.where(~inside), target)


def truncate_reload(df: DataFrame, target: str) -> None:
    """Replace all rows of a table, whatever partitions ``df`` covers."""
    (aligned(df, target).write.option("partitionOverwriteMode", "static")
     .insertInto(target, overwrite=True))


def write_layout(df: DataFrame, path: str, partition_by: Sequence[str],
                 sort_by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned, sorted files. Rebalancing brings the rows of a partition together and
    splits one that is too large for a task, which plain repartitioning would not."""
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, *[c for c in sort_by if c not in partition_by])
        .write.mode(mode).partitionBy(*partition_by).parquet(path)
    )


def export_parquet(df: DataFrame, path: str, rows_per_file: int) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


# Fixed value: size of an exported file in bytes.
EXPORT_BYTES = 100 * 1024 * 1024


def export_sized(df: DataFrame, path: str, file_bytes: int = EXPORT_BYTES,
                 one_in: int = 64) -> int:
    """Write files of about ``file_bytes`` each and return how many were planned.

    What a row takes on disk is measured first: one row in ``one_in`` (all of a table that has
    few) is written to the shared folder in a single run of the same writer. All rows are then
    dealt evenly over as many files as that gives.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_at", F.monotonically_increasing_id())
    rows = df.count()
    step = one_in if rows >= 1000 * one_in else 1
    trial = scratch(spark, "export-trial")
    sample = keyed.where(F.col("_at") % step == 0).drop("_at")
    # in one file, as pages and dictionaries of many small ones would take more for a row
    sample.coalesce(1).write.parquet(trial)
    written = list_files(spark, trial).agg(F.sum("length")).first()[0] or 0
    n_files = max(1, round(written * step / file_bytes))
    df.repartition(n_files).write.parquet(path)
    return n_files
