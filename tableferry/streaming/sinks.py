"""Targets that a stream writes to.

A target is a log of epochs. Each micro-batch writes only its own rows, under its subscription's
cursor and its epoch id, so a retried epoch replaces itself, subscriptions do not touch each
other's rows, and the cost of a batch does not grow with the table. Clears
and upserts take effect when the table is read, and :meth:`compact` folds old epochs into a
base so that readers do not pay for them again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableferry.functions.codec import FIELDS
from tableferry.functions.headers import APPEND_TYPE, KEYED_TYPE
from tableferry.operators.chunks import PART_BYTES, checksum_ok, incomplete, segments
from tableferry.operators.clear import (KEYS, as_runs, last_clears_of_runs, open_runs,
                                        surviving)
from tableferry.operators.ranges import (add_ranges, assign_ranges, requested_ranges,
                                         unread_ranges)
from tableferry.operators.route import (BAD_MSG, DIRTY, WAL, audit, for_target, good_rows,
                                        typed)
from tableferry.operators.upsert import cell_values, cells, last_wins, merged_cells
from tableferry.plans.sync import LOADED, load_files, with_aliases
from tableferry.schemas import AUDIT, CHUNK, EVENTS, RANGES
from tableferry.session import stored

HEAD = T.StructType([
    T.StructField("clear_table", T.StringType()), T.StructField("partition", T.StringType()),
    T.StructField("batch_id", T.StringType()), T.StructField("msg_id", T.LongType())])
RUNS = T.StructType([*HEAD.fields[:3], T.StructField("first", T.LongType()),
                     T.StructField("last", T.LongType())])
#: Chunks as a log stores them, with the folders that it puts them in.
EPOCH_CHUNK = T.StructType([*CHUNK.fields, T.StructField("_cursor", T.StringType()),
                            T.StructField("_epoch", T.LongType())])
NOTE = T.StructType([T.StructField("version", T.LongType()),
                     T.StructField("cursor", T.StringType()), T.StructField("upto", T.LongType())])


#: The cursor of rows that are written by hand and not by a subscription.
BY_HAND = "by-hand"
Upto = dict[str, int]


class Sink(Protocol):
    def write(self, checked: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        """Store what a micro-batch of checked messages holds for this sink."""


class EpochLog:
    """Folders ``name/_cursor=C/_epoch=N`` below a path, and a list of the epochs that are
    finished. Every subscription counts its own epochs, so several may write to one log."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def put(self, name: str, df: DataFrame, epoch_id: int, cursor: str = BY_HAND,
            by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").partitionBy(*by).parquet(
            f"{self.path}/{name}/_cursor={cursor}/_epoch={epoch_id}")

    def get(self, name: str, schema: T.StructType, upto: Upto,
            above: Upto | None = None) -> DataFrame:
        """The epochs of each cursor after ``above`` up to ``upto``; the folder names prune the
        read."""
        wanted = F.lit(False)
        some = False
        for cursor, last in upto.items():
            first = (above or {}).get(cursor, -1)
            if last > first:
                some = True
                wanted = wanted | ((F.col("_cursor") == cursor) & (F.col("_epoch") > first)
                                   & (F.col("_epoch") <= last))
        if not some:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("_cursor", T.StringType()),
                             T.StructField("_epoch", T.LongType())])
        # a table that no epoch has written yet, or of which a base holds all, has no folder
        there = self._noted(name, full)
        return (self.spark.createDataFrame([], schema) if there is None
                else there.where(wanted).select(*schema.names))

    def commit(self, epoch_id: int, cursor: str = BY_HAND) -> None:
        """Everything of this epoch is written. Subscriptions write their notes to folders of
        their own, as two jobs cannot append to one at the same time."""
        self.put("commits", self.spark.range(1).coalesce(1), epoch_id, cursor)

    def finished(self) -> Upto:
        """The last finished epoch of each cursor. Epochs of a cursor come one after the other,
        so all before it are finished as well. Those that a base holds may have no note left."""
        out = self._included(self._version())
        noted = self._noted("commits", "id long, _cursor string, _epoch long")
        if noted is not None:
            for r in noted.groupBy(F.col("_cursor").alias("cursor")).agg(
                    F.max("_epoch").alias("upto")).collect():
                out[r.cursor] = max(r.upto, out.get(r.cursor, -1))
        return out

    def put_base(self, df: DataFrame, upto: Upto, **more: DataFrame) -> None:
        """A new base that holds the epochs up to ``upto``, with further tables beside its rows.
        It counts once its note is written, which is one file; a lost attempt leaves folders that
        nobody reads."""
        version = self._version() + 1
        for name, table in {"base": df, **{f"base-{n}": t for n, t in more.items()}}.items():
            table.write.mode("overwrite").parquet(f"{self.path}/{name}/version={version}")
        notes = self.spark.createDataFrame([(version, c, n) for c, n in upto.items()], NOTE)
        notes.coalesce(1).write.mode("append").parquet(f"{self.path}/bases")

    def base(self, schema: T.StructType, name: str = "base") -> tuple[DataFrame, Upto]:
        """The newest base, or a table beside it (``base-...``), and the last epoch of each cursor
        that it includes."""
        version = self._version()
        if version < 0:
            return self.spark.createDataFrame([], schema), {}
        return (self.spark.read.schema(schema).parquet(f"{self.path}/{name}/version={version}"),
                self._included(version))

    def _included(self, version: int) -> Upto:
        if version < 0:
            return {}
        return {r.cursor: r.upto for r in self._noted("bases", NOTE).where(
            F.col("version") == version).collect()}

    def vacuum(self, keep: Sequence[str] = ()) -> None:
        """Delete what the newest base holds: its epochs, their notes and older bases. Tables
        named in ``keep`` stay whole. A reader that began before the last compaction needs these
        files, so leave time between :meth:`put_base` and this."""
        version = self._version()
        included = self._included(version)
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

        def below(path, prefix: str):
            if fs.exists(path):
                for status in fs.listStatus(path):
                    name = status.getPath().getName()
                    if name.startswith(prefix):
                        yield name.removeprefix(prefix), status.getPath()

        for name, table in list(below(top, "")):
            if name in keep:
                continue
            if name.startswith("base"):
                for number, folder in below(table, "version="):
                    if int(number) < version:
                        fs.delete(folder, True)
            for cursor, epochs in below(table, "_cursor="):
                for number, folder in below(epochs, "_epoch="):
                    if int(number) <= included.get(cursor, -1):
                        fs.delete(folder, True)

    def _version(self) -> int:
        noted = self._noted("bases", NOTE)
        last = None if noted is None else noted.agg(F.max("version")).first()[0]
        return -1 if last is None else last

    def _noted(self, name: str, schema: str | T.StructType) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None


def _row_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("target", T.StringType()), T.StructField("topic", T.StringType()),
        T.StructField("msg_id", T.LongType()), T.StructField("row_pos", T.IntegerType()),
        *schema.fields])


#: Order of rows. Where several topics feed one target, their ids must be comparable.
ORDER = ("msg_id", "row_pos", "topic")
ORIGIN = ("target", "topic", "msg_id")


class AppendSink:
    """Append target, cleared once per batch. ``partition`` names the columns that partition
    clears compare, ``aliases`` the targets of tables that headers clear by another name."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 partition: str | Sequence[str] | None = None,
                 aliases: dict[str, str] | None = None):
        self.log, self.schema, self.partition = EpochLog(spark, path), schema, partition
        self.aliases, self.row_schema = aliases, _row_schema(schema)

    def write(self, checked: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        mine = checked.where(F.col("route") == APPEND_TYPE)
        rows = typed(good_rows(mine, self.schema.names, ORIGIN), self.schema)
        self.log.put("rows", rows.where("dirty_fields is null")
                     .select(*self.row_schema.names), epoch_id, cursor)
        # a message clears even if its payload is bad
        self.log.put("heads", with_aliases(mine, self.aliases)
                     .where("clear_table <> '' and batch_id <> ''").select(*HEAD.names),
                     epoch_id, cursor)
        self.log.commit(epoch_id, cursor)

    def _runs(self, upto: Upto) -> DataFrame:
        """Runs of batches: those that the base has kept, and the headers of later epochs."""
        base, included = self.log.base(RUNS, "base-runs")
        return base.unionByName(as_runs(self.log.get("heads", HEAD, upto, included)))

    def _at(self, upto: Upto, runs: DataFrame) -> DataFrame:
        base, included = self.log.base(self.row_schema)
        rows = base.unionByName(self.log.get("rows", self.row_schema, upto, included))
        return surviving(rows, last_clears_of_runs(runs, KEYS), "target", self.partition)

    def read(self) -> DataFrame:
        upto = self.log.finished()
        return self._at(upto, self._runs(upto))

    def compact(self) -> None:
        """Fold all finished epochs into a new base. Of the headers it keeps the runs that later
        messages can still matter to, so what a reader pays does not grow with the epochs, and
        messages that arrive late are judged as exactly as before."""
        upto = self.log.finished()
        if upto != self.log.base(self.row_schema)[1]:
            runs = stored(open_runs(self._runs(upto)), "runs")
            self.log.put_base(self._at(upto, runs), upto, runs=runs)

    def vacuum(self) -> None:
        """Delete what the newest base has folded; see :meth:`EpochLog.vacuum`."""
        self.log.vacuum()


class KeyedSink:
    """Keyed target, last write wins.

    With ``range_key``, rows must lie in a range of their target: one of ``ranges`` or one
    that a message header asked for up to then. Others are kept apart, in ``uncovered``.
    With ``partial``, as in :func:`tableferry.plans.sync.receive`, a record sets only the columns
    that it carries; the log then holds a cell with its place for each column.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 keys: Sequence[str], range_key: str | None = None,
                 ranges: DataFrame | None = None, partial: bool = False):
        self.log, self.schema, self.keys = EpochLog(spark, path), schema, ["target", *keys]
        self.range_key, self.ranges, self.partial = range_key, ranges, partial
        self.row_schema = self.log_schema = _row_schema(schema)
        if partial:
            at = [self.row_schema[c] for c in ORDER]
            self.log_schema = T.StructType([
                *[self.row_schema[c] for c in self.keys],
                *[T.StructField(f.name, T.StructType([*at, T.StructField("value", f.dataType)]))
                  for f in schema.fields if f.name not in self.keys]])

    def registry(self, upto: Upto) -> DataFrame:
        asked = self.log.get("ranges", RANGES, upto).distinct()
        return asked if self.ranges is None else add_ranges(self.ranges, asked)

    def _reduced(self, rows: DataFrame) -> DataFrame:
        return (merged_cells(rows, self.keys, ORDER) if self.partial
                else last_wins(rows, self.keys, ORDER))

    def write(self, checked: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        mine = checked.where(F.col("route") == KEYED_TYPE)
        extra = [FIELDS] if self.partial else []
        rows = typed(good_rows(mine, [*self.schema.names, *extra], ORIGIN), self.schema)
        rows = rows.where("dirty_fields is null").select(*self.row_schema.names, *extra)
        if self.range_key:
            self.log.put("ranges", requested_ranges(mine), epoch_id, cursor)
            registry = self.registry({**self.log.finished(), cursor: epoch_id})
            placed = assign_ranges(rows, self.range_key, registry, "target")
            self.log.put("uncovered", placed.where("lower is null")
                         .select(*self.row_schema.names), epoch_id, cursor)
            rows = placed.where("lower is not null").drop("lower", "upper")
        if self.partial:
            rest = [c for c in self.schema.names if c not in self.keys]
            rows = cells(rows, self.keys, rest, ORDER, FIELDS)
        self.log.put("rows", self._reduced(rows), epoch_id, cursor)
        self.log.commit(epoch_id, cursor)

    def _at(self, upto: Upto) -> DataFrame:
        base, included = self.log.base(self.log_schema)
        return self._reduced(base.unionByName(
            self.log.get("rows", self.log_schema, upto, included)))

    def read(self) -> DataFrame:
        rows = self._at(self.log.finished())
        return cell_values(rows, self.keys) if self.partial else rows

    def uncovered(self) -> DataFrame:
        return self.log.get("uncovered", self.row_schema, self.log.finished())

    def compact(self) -> None:
        upto = self.log.finished()
        if upto != self.log.base(self.log_schema)[1]:
            self.log.put_base(self._at(upto), upto)


def bad_entries(checked: DataFrame) -> DataFrame:
    """Audit entries of bad messages, and of range requests that are none."""
    bad = audit(BAD_MSG, checked.where("reason is not null"), F.col("reason"), F.col("data"))
    if "range_partition" not in checked.columns:
        return bad
    asked = unread_ranges(checked.where(F.col("route") == KEYED_TYPE))
    return bad.unionByName(audit(BAD_MSG, asked, F.lit("bad_range"), F.col("asked")))


def row_entries(checked: DataFrame, schema: T.StructType, wal: bool) -> DataFrame:
    """Audit entries of dirty rows, and with ``wal`` of every decoded row."""
    texts = good_rows(checked, schema.names, ["topic", "msg_id", "target_table"])
    shown = F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})
    rows = typed(texts.withColumn("_text", shown), schema).where("dirty_fields is not null")
    out = audit(DIRTY, rows, F.concat(F.lit("type_mismatch:"), F.col("dirty_fields")),
                F.col("_text"))
    return audit(WAL, texts, F.lit("decoded"), shown).unionByName(out) if wal else out


class AuditSink:
    """Bad messages, dirty rows and the write-ahead copy, in one table by channel."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, wal: bool = True):
        self.log, self.schema, self.wal = EpochLog(spark, path), schema, wal

    def write(self, checked: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        out = bad_entries(checked).unionByName(row_entries(checked, self.schema, self.wal))
        self.log.put("audit", out.select(*AUDIT.names), epoch_id, cursor, ["channel"])
        self.log.commit(epoch_id, cursor)

    def read(self) -> DataFrame:
        return self.log.get("audit", AUDIT, self.log.finished())


class CatalogSink:
    """The targets of a topic that many tables share, each a sink with a schema of its own.

    Takes the messages of :func:`tableferry.plans.sync.receive_many`. The audit, of all targets
    together, is written first. Only targets that a micro-batch has messages for are written.
    """

    def __init__(self, spark: SparkSession, path: str, targets: Mapping[str, AppendSink | KeyedSink],
                 wal: bool = False):
        self.targets, self.wal = dict(targets), wal
        self.log = EpochLog(spark, path)

    def write(self, checked: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        # at most one row for each target of the catalog
        present = sorted(r.target for r in checked.where(
            F.col("target").isin(list(self.targets))).select("target").distinct().collect())
        mine = {name: for_target(checked, name, self.targets[name].schema.names,
                                 getattr(self.targets[name], "partial", False)) for name in present}
        entries = bad_entries(checked)
        for name, messages in mine.items():
            entries = entries.unionByName(row_entries(messages, self.targets[name].schema, self.wal))
        self.log.put("audit", entries.select(*AUDIT.names), epoch_id, cursor, ["channel"])
        self.log.commit(epoch_id, cursor)
        for name, messages in mine.items():
            self.targets[name].write(messages, epoch_id, cursor)

    def audited(self) -> DataFrame:
        return self.log.get("audit", AUDIT, self.log.finished())


class FileSink:
    """Chunk messages of files, kept until all parts of a file are here. Chunks whose content is
    not what their header says are kept apart, in ``bad``."""

    def __init__(self, spark: SparkSession, path: str, part_bytes: int = PART_BYTES):
        self.log, self.part_bytes = EpochLog(spark, path), part_bytes
        self.noted = EpochLog(spark, f"{path}-transfers")

    def write(self, chunks: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        checked = checksum_ok(chunks.select(*CHUNK.names))
        ok = F.coalesce(F.col("ok"), F.lit(False))
        self.log.put("chunks", checked.where(ok).select(*CHUNK.names), epoch_id, cursor)
        named = checked.where(~ok).select(
            "msg_id", F.col("table").alias("target_table"), F.to_json(F.struct(
                "sync_id", "transfer", "file", "cur_part", "total_parts")).alias("chunk"))
        self.log.put("bad", audit(BAD_MSG, named, F.lit("checksum"), F.col("chunk")), epoch_id,
                     cursor)
        self.log.commit(epoch_id, cursor)

    def note(self, events: DataFrame, epoch_id: int, cursor: str = BY_HAND) -> None:
        """Store what :mod:`tableferry.streaming.transfers` reports."""
        self.noted.put("events", events, epoch_id, cursor)
        self.noted.commit(epoch_id, cursor)

    def events(self) -> DataFrame:
        """Reported transfers, complete and stalled ones."""
        return self.noted.get("events", EVENTS, self.noted.finished())

    def _chunks(self) -> DataFrame:
        return self.log.get("chunks", CHUNK, self.log.finished())

    def read(self) -> DataFrame:
        """Finished files as segments."""
        return load_files(self._chunks(), self.part_bytes, verified=True)

    def read_reported(self) -> DataFrame:
        """As :meth:`read` for the files that are reported as complete: the latest transfer of
        each. Only their chunks are read on; nothing is counted or checked again."""
        done = self.events().where("event = 'complete'").groupBy("sync_id").agg(
            F.max_by("transfer", "last_msg").alias("transfer"))
        mine = self._chunks().withColumn("transfer", F.coalesce("transfer", F.lit("")))
        kept = mine.join(stored(done, "transfers"), ["sync_id", "transfer"], "left_semi")
        return segments(kept.select(*CHUNK.names), self.part_bytes, keep=LOADED)

    def bad(self) -> DataFrame:
        """Audit entries of the chunks that arrived broken."""
        return self.log.get("bad", AUDIT, self.log.finished())

    def pending(self) -> DataFrame:
        """Files that still wait for parts."""
        return incomplete(self._chunks(), verified=True)
