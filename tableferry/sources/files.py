"""Files of a directory, read part by part."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tableferry.operators.chunks import PART_BYTES, plan_parts


def _opened(path: str):
    """A file that can be read from any offset, on whatever file system it lies."""
    if path.startswith("file:"):
        return open("/" + path[len("file:"):].lstrip("/"), "rb")
    fs, name = pafs.FileSystem.from_uri(quote(path, safe=":/?=%"))
    return fs.open_input_file(name)


def _listing(suffix: str, recursive: bool):
    """Entries below folders, one batch for each folder given: files, and where the listing is not
    recursive also folders, whose length is -1."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                local = path.startswith("file:") or "://" not in path
                if local:
                    fs, top = pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    fs, top = pafs.FileSystem.from_uri(quote(path, safe=":/?=%"))
                head = "file:" if local else path[:len(path) - len(top.lstrip("/"))].rstrip("/")
                found = [(f"{head}/{e.path.lstrip('/')}",
                          e.size if e.type == pafs.FileType.File else -1)
                         for e in fs.get_file_info(pafs.FileSelector(top, recursive=recursive))
                         if "/_temporary/" not in f"{e.path}/"
                         and (e.path.endswith(suffix) if e.type == pafs.FileType.File
                              else not recursive)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.string()),
                     pa.array([n for _, n in found], pa.int64())], ["path", "length"])
    return task


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet",
               recursive: bool = True) -> DataFrame:
    """Path and size of the files with a suffix, empty ones and those that other readers take for
    hidden too; only folders that a running job writes to (``_temporary``) are passed over. The
    folders of the first level are listed in tasks of their own."""
    columns = "path string, length long"
    top = spark.createDataFrame([(path,)], "path string").mapInArrow(_listing(suffix, False), columns)
    files = top.where("length >= 0")
    if not recursive:
        return files
    below = (top.where("length < 0").select("path").repartition("path")
             .mapInArrow(_listing(suffix, True), columns))
    return files.unionByName(below)


def file_parts(files: DataFrame, part_bytes: int = PART_BYTES,
               tasks: int | None = None) -> DataFrame:
    """Chunks of listed files, with number, total and checksum.

    Parts are spread over tasks and each task seeks to its own, so one large file is read by
    many tasks and never held whole, whatever its size.
    """
    plan = plan_parts(files, "length", part_bytes).select(
        "path", "length", "total_parts",
        F.explode(F.sequence(F.lit(1), F.col("total_parts"))).alias("cur_part"))
    cols = [F.col("path"), F.col("cur_part")]
    spread = plan.repartition(tasks, *cols) if tasks else plan.repartition(*cols)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as f:
                    f.seek((row["cur_part"] - 1) * part_bytes)
                    data = f.read(part_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]]), pa.array([row["total_parts"]], pa.int32()),
                     pa.array([row["cur_part"]], pa.int32()), pa.array([data], pa.binary())],
                    ["file", "total_parts", "cur_part", "data"])

    chunks = spread.mapInArrow(
        read, "file string, total_parts int, cur_part int, data binary")
    return (chunks.withColumn("md5_checksum", F.md5("data"))
            .withColumn("sync_id", F.md5(F.encode("file", "UTF-8"))))
