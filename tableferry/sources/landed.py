"""Finished files put back as files, and their rows loaded into tables.

Tasks write each file under a name of their own and rename it when it is whole, so a lost or
repeated attempt leaves no half file behind a final name. The files of one table and partition are
in one folder, which Spark's own readers load.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from hashlib import md5
from itertools import groupby
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableferry.session import scratch, stored
from tableferry.sources import tables

_FOLDER, _PARTITION = "_landed_folder", "_landed_partition"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

LANDED = ("table string, partition map<string,string>, is_overwrite boolean, folder string,"
          " file string, n_bytes long")


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write_files(whole: DataFrame, root: str) -> DataFrame:
    """Write the segments of :func:`tableferry.plans.sync.load_files` as files below ``root`` and
    list them, one row for each.

    A task writes a file segment by segment, so its memory is bounded by a segment, and files are
    spread over tasks. A file's name is its ``sync_id`` with the ending of its path.
    """
    folder = F.concat_ws("/", F.lit(root.rstrip("/")), F.md5(F.encode(F.concat_ws(
        "\x1f", "table", F.to_json(F.array_sort(F.map_entries("partition"))),
        F.col("is_overwrite").cast("string")), "UTF-8")))
    parts = (whole.select("table", "partition", "is_overwrite", folder.alias("folder"), "file",
                          "sync_id", "segment", "data")
             .repartition("sync_id").sortWithinPartitions("sync_id", "segment"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, done = None, None, []

        def close() -> None:
            out["stream"].close()
            out["fs"].move(out["temp"], out["name"])
            done.append({**{k: now[k] for k in ("table", "partition", "is_overwrite", "folder",
                                                "file")}, "n_bytes": out["bytes"]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if now is None or row["sync_id"] != now["sync_id"]:
                    if now is not None:
                        close()
                    now = row
                    fs, place = _file_system(row["folder"])
                    fs.create_dir(place, recursive=True)
                    last = row["file"].rsplit("/", 1)[-1]
                    name = row["sync_id"] + (quote("." + last.rsplit(".", 1)[1]) if "." in last else "")
                    # readers pass over names that begin with a dot
                    temp = f"{place}/.{name}-{uuid4().hex}"
                    out = {"fs": fs, "temp": temp, "name": f"{place}/{name}", "bytes": 0,
                           "stream": fs.open_output_stream(temp)}
                out["stream"].write(row["data"] or b"")
                out["bytes"] += len(row["data"] or b"")
        if now is not None:
            close()
        schema = pa.schema([("table", pa.string()), ("partition", pa.map_(pa.string(), pa.string())),
                            ("is_overwrite", pa.bool_()), ("folder", pa.string()),
                            ("file", pa.string()), ("n_bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist(done, schema)

    return parts.mapInArrow(write, LANDED)


def _layouts(loads: DataFrame) -> DataFrame:
    """``loads`` with a column ``layout``: loads of one layout have parquet files of one schema, which
    is that of the first file of a folder, as Spark's reader takes it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts = []
            for folder in batch.column("folder").to_pylist():
                fs, place = _file_system(folder)
                found = sorted(e.path for e in fs.get_file_info(pafs.FileSelector(place))
                               if not e.base_name.startswith((".", "_")))
                file = pq.ParquetFile(fs.open_input_file(found[0]))
                spark_schema = (file.metadata.metadata or {}).get(_SPARK_SCHEMA, b"")
                layouts.append(md5(repr(file.schema).split("\n", 1)[-1].encode()
                                   + spark_schema).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("folder"), pa.array(layouts, pa.string())], ["folder", "layout"])

    named = loads.select("folder").repartition("folder").mapInArrow(
        read, "folder string, layout string")
    return loads.join(named, "folder")


def load_rows(spark: SparkSession, whole: DataFrame, targets: Mapping[str, str] | None = None,
              format: str = "parquet", root: str | None = None) -> DataFrame:
    """Load the rows of finished files into the partition that their headers name: it is replaced
    by the files that ask for that, then the others are added. Returns the files.

    ``targets`` maps names of tables in headers to tables here. Columns are matched by name.
    Parquet and text files of a table take one load for each mode, whatever the number of
    partitions, and a partition is replaced in the commit of that load. Files of other formats,
    whose columns Spark finds in their rows, are loaded partition by partition, as are partitions
    whose files hold no row.
    """
    files = write_files(whole, root or scratch(spark, "landed"))
    path = scratch(spark, "landed-list")
    files.write.parquet(path)
    listed = spark.read.schema(files.schema).parquet(path)
    # one row for each partition of a table that these files load
    loads = listed.groupBy("folder").agg(
        F.first("table").alias("table"), F.first("partition").alias("partition"),
        F.first("is_overwrite").alias("is_overwrite"))
    loads = stored(_layouts(loads) if format == "parquet"
                   else loads.withColumn("layout", F.lit("")), "loads")

    def inside(target: str, partition: Sequence[str]) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in spark.table(target).schema.fields
                if f.name not in partition}

    def found(folders: Sequence[str], columns: dict[str, T.DataType], *more: Column) -> DataFrame:
        reader = spark.read.format(format)
        if format == "text":
            (name,) = columns
            return reader.option("lineSep", "\n").load(list(folders)).select(
                F.col("value").alias(name), *more)
        return reader.load(list(folders)).select(
            *[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()], *more)

    rows = sorted(loads.collect(), key=lambda r: (
        r.table, not r.is_overwrite, r.layout, sorted(r.partition.items())))
    for (table, adds), these in groupby(rows, lambda r: (r.table, not r.is_overwrite)):
        target, these = (targets or {}).get(table, table), list(these)
        one_by_one = these
        if format in ("parquet", "text"):
            keys = list(these[0].partition)
            for r in these:
                if set(r.partition) != set(keys) or any(v in (None, "") for v in r.partition.values()):
                    raise ValueError(f"{r.partition} is no partition of {target}")
            columns, types = inside(target, keys), inside(target, ())
            parts = [found([r.folder for r in group], columns,
                           F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1).alias(_FOLDER))
                     for group in (list(g) for _, g in groupby(these, lambda r: r.layout))]
            union = reduce(DataFrame.unionByName, parts)
            named = loads.select(F.element_at(F.split("folder", "/"), -1).alias(_FOLDER),
                                 F.col("partition").alias(_PARTITION))
            filled = {r[0] for r in union.select(_FOLDER).distinct().collect()}
            one_by_one = [r for r in these if r.folder.rsplit("/", 1)[-1] not in filled]
            values = [F.col(_PARTITION)[k].cast(types[k]).alias(k) for k in types if k in keys]
            tables.put_partitions(
                union.join(named, _FOLDER).select(*columns, *values), target, not adds)
        for r in one_by_one:
            empty = found([r.folder], inside(target, list(r.partition)))
            tables.load_partition(empty, target, dict(r.partition), not adds)
    return listed
