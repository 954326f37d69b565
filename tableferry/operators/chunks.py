"""Files as checksummed chunks: cutting, checking, putting back together.

A file is never required to fit in one row or one task. Chunks travel as rows; a finished file
is a sequence of segments of bounded size, and a file below the bound is a single segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tableferry.operators.blocks import block_of
from tableferry.session import stored

# Part sizes in bytes of the numbered and of the unnumbered file messages.
PART_BYTES = 1024 * 1024
UNNUMBERED_PART_BYTES = 4 * 1024 * 1024
SEGMENT_BYTES = 64 * 1024 * 1024


def plan_parts(files: DataFrame, length: str = "length",
               part_bytes: int = PART_BYTES) -> DataFrame:
    """Number of parts of each file; an empty file has one empty part."""
    return files.withColumn("total_parts", F.greatest(
        F.ceil(F.col(length) / part_bytes), F.lit(1)).cast("int"))


def cut(files: DataFrame, content: str, path: str, part_bytes: int = PART_BYTES, base: int = 1,
        header_style: str = "numbered") -> DataFrame:
    """Binary ``content`` to chunk rows, parts numbered from ``base``.

    ``header_style`` ``numbered`` identifies a file by ``sync_id``, the md5 of its path.
    ``batch`` names the counters ``cur_batch`` and ``total_batch`` and carries only the path.
    ``named`` carries the last component of the path and no numbers, so order is up to the log.
    """
    keep = [c for c in files.columns if c not in (content, path)]
    planned = plan_parts(files.withColumn("_len", F.octet_length(content)), "_len", part_bytes)
    # sliced before they are exploded: rows that each carry the whole content would take the square
    # of a file's size
    slices = F.transform(F.sequence(F.lit(0), F.col("total_parts") - 1), lambda i: F.substring(
        F.col(content), i * part_bytes + 1, F.lit(part_bytes)))
    parts = planned.select(*keep, F.col(path).alias("file"), "total_parts",
                           F.posexplode(slices).alias("_i", "data"))
    chunks = parts.select(*keep, "file", "total_parts",
                          (F.col("_i") + base).cast("int").alias("cur_part"), "data")
    if header_style == "named":
        return chunks.select(*keep, F.element_at(F.split("file", "/"), -1).alias("file"),
                             F.col("cur_part").alias("_seq"), "data")
    chunks = chunks.withColumn("md5_checksum", F.md5("data"))
    if header_style == "batch":
        return (chunks.withColumnRenamed("cur_part", "cur_batch")
                .withColumnRenamed("total_parts", "total_batch"))
    if header_style != "numbered":
        raise ValueError(f"unknown header style {header_style!r}")
    return chunks.withColumn("sync_id", F.md5(F.encode("file", "UTF-8")))


def checksum_ok(chunks: DataFrame) -> DataFrame:
    """Whether the payload of each chunk is what its header says."""
    return chunks.withColumn("ok", F.md5("data") == F.col("md5_checksum"))


def _identified(chunks: DataFrame) -> DataFrame:
    """Chunks with the ``transfer`` that they belong to, empty where the header has none. Parts of
    a file that is sent again never mix with those of its older version."""
    given = F.col("transfer") if "transfer" in chunks.columns else F.lit(None).cast("string")
    return chunks.withColumn("transfer", F.coalesce(given, F.lit("")))


def _part_headers(chunks: DataFrame, order: str, verified: bool = False) -> DataFrame:
    """Per part its last intact delivery (null if there is none) and what it says. Payload that is
    ``verified`` is not read."""
    seen = (_identified(chunks).withColumn("ok", F.lit(True)) if verified
            else checksum_ok(_identified(chunks))).select(
        "sync_id", "transfer", "file", "cur_part", "total_parts",
        F.when(F.col("ok"), F.col(order)).alias("_good"))
    return seen.groupBy("sync_id", "transfer", "file", "cur_part").agg(
        F.max("_good").alias(order), F.max("total_parts").alias("total_parts"))


def progress(chunks: DataFrame, order: str = "msg_id", verified: bool = False) -> DataFrame:
    """Intact parts seen and parts expected per transfer of a file. The payload is read for its
    checksum, unless that is ``verified``, but only headers are shuffled."""
    return _part_headers(chunks, order, verified).groupBy("sync_id", "transfer", "file").agg(
        F.max("total_parts").alias("total_parts"),
        F.count(order).cast("int").alias("n_parts"))


def incomplete(chunks: DataFrame, order: str = "msg_id", verified: bool = False) -> DataFrame:
    """Files that still wait for parts."""
    return progress(chunks, order, verified).where("n_parts < total_parts")


def missing_parts(chunks: DataFrame, base: int = 1, order: str = "msg_id") -> DataFrame:
    """The parts those files wait for, one row each."""
    wanted = incomplete(chunks, order).select("sync_id", "transfer", "file", F.explode(F.sequence(
        F.lit(base), F.col("total_parts") + (base - 1))).alias("cur_part"))
    have = _part_headers(chunks, order).where(F.col(order).isNotNull())
    return wanted.join(have, ["sync_id", "transfer", "cur_part"], "left_anti")


def complete_parts(chunks: DataFrame, order: str = "msg_id", verified: bool = False) -> DataFrame:
    """Intact chunks of the files of which all parts are here: of the transfers of a file, the
    latest that is complete; of repeated deliveries of a part, the last.

    Which ones these are is settled on headers and stored. The chunks are then only filtered
    by that list, so copies and unfinished files are gone before any payload is shuffled,
    where the list is small enough for a broadcast. Chunks that are ``verified`` are not hashed.
    """
    heads = _part_headers(chunks, order, verified).where(F.col(order).isNotNull())
    sent = heads.groupBy("sync_id", "transfer").agg(
        F.count(F.lit(1)).alias("_have"), F.max("total_parts").alias("_want"),
        F.max(order).alias("_last"))
    done = sent.where("_have >= _want").groupBy("sync_id").agg(
        F.max_by("transfer", "_last").alias("transfer"))
    wanted = stored(heads.join(done, ["sync_id", "transfer"], "left_semi")
                    .select("sync_id", "transfer", "cur_part", order), "parts")
    intact = _identified(chunks)
    if not verified:
        intact = checksum_ok(intact).where("ok").drop("ok")
    kept = intact.join(
        wanted, ["sync_id", "transfer", "cur_part", order], "left_semi")
    return kept.select(*chunks.columns)


def segments(parts: DataFrame, part_bytes: int = PART_BYTES,
             segment_bytes: int = SEGMENT_BYTES, base: int = 1,
             keep: Sequence[str] = ("file", "total_parts")) -> DataFrame:
    """Join parts to segments of at most ``segment_bytes``: no row grows with its file.

    One shuffle brings a segment together; a message that was read twice counts once.
    """
    per = max(segment_bytes // part_bytes, 1)
    cell = F.expr(f"cast((cur_part - {base}) div {per} as int)")
    return (
        parts.withColumn("segment", cell).repartition("sync_id", "segment")
        .groupBy("sync_id", "segment", "cur_part")
        .agg(*[F.first(c).alias(c) for c in (*keep, "data")])
        .groupBy("sync_id", "segment")
        .agg(*[F.first(c).alias(c) for c in keep],
             F.count(F.lit(1)).alias("n_parts"),
             F.expr("listagg(data, X'') within group (order by cur_part)").alias("data"))
    )


def reassemble(chunks: DataFrame, part_bytes: int = PART_BYTES,
               segment_bytes: int = SEGMENT_BYTES, order: str = "msg_id",
               base: int = 1) -> DataFrame:
    """Complete files as segments, in order of ``segment``."""
    return segments(complete_parts(chunks, order), part_bytes, segment_bytes, base)


def append_by_name(chunks: DataFrame, order: str = "msg_id", by: str = "file",
                   span: int = 16) -> DataFrame:
    """Unnumbered chunks appended to their file in order of arrival.

    A segment is what arrived for the file within ``span`` consecutive message ids, so it
    holds at most that many chunks; a file is its segments in order of ``segment``.
    """
    return (
        chunks.groupBy(by, block_of(order, span).alias("segment"))
        .agg(F.count(F.lit(1)).alias("n_parts"),
             F.expr(f"listagg(data, X'') within group (order by `{order}`)").alias("data"))
    )
