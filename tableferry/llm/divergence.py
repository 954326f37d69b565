"""How far the sources of a language diverge: joint tables of term counts by one-hot products.

A term's probability in a group depends on the group and the term's count there, its level, only.
So what two groups need of each other is the joint table of their levels: in how many terms
the one has level a and the other level b. With a matrix that has a row for each term, a column
for each (group, level) and a one where the term has that level in that group, all joint tables
of a language are the product of its transpose with itself. The matrix is cut into blocks of terms
of like frequency, which have few levels between them, each block into pieces with few columns,
and the products of the pieces, exact in whole numbers, add up. Pricing a joint table is then a
sum over its cells.

Defined results: null text, language and source count as empty. A group without terms has level 0
in every kept term; a language without kept terms has pairs of value 0 and no terms. Rows are
documents: a repeated row counts again. Texts are counted whole, long ones in parts. Only the three
named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tableferry.llm.common import sliced
from tableferry.session import stored

#: Terms that a task counts before it gives them on, and bytes of a text counted at a time.
ENTRIES, PART_BYTES = 300_000, 4 << 20
#: A block of terms holds about this many counts, and its matrix of counts this many cells.
BLOCK_COUNTS, BLOCK_CELLS = 1 << 16, 1 << 21
#: Columns of one product; a block with more levels is cut into fewer terms.
COLUMNS = 1024

# A term is a run of ASCII letters and characters beyond ASCII; A-Z are lowered.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
                    for b in range(256))

SCALE, SMOOTHING, MIN_DOCS, TOP = 1_000_000_000, 1, 3, 200


def _parts(data: bytes, size: int = PART_BYTES) -> Iterator[bytes]:
    """Pieces of a text that end between terms."""
    start = 0
    while len(data) - start > size:
        end = data.rfind(b" ", start, start + size)
        end = end if end > start else data.find(b" ", start + size)
        if end < 0:
            break
        yield data[start:end]
        start = end
    yield data[start:]


def counted(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents, counted ahead in each task;
    what belongs together still has to be added up."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).cast("string").alias(c)
                          for c in ("lang", "source", "text")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, in_docs, size = defaultdict(Counter), defaultdict(Counter), 0
        for batch in sliced(batches, "text"):
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text").cast(pa.binary()).to_pylist()):
                seen, mine = set(), counts[group]
                size -= len(mine)
                for part in _parts(text.translate(_TERM_BYTES)):
                    terms = part.split()
                    mine.update(terms)
                    seen.update(terms)
                in_docs[group].update(seen)
                size += len(mine)
            if size > ENTRIES:
                yield from rows(counts, in_docs)
                counts, in_docs, size = defaultdict(Counter), defaultdict(Counter), 0
        yield from rows(counts, in_docs)

    def rows(counts, in_docs) -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            if terms:
                known = in_docs[lang, source]
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(lang, len(terms)), pa.repeat(source, len(terms)),
                    pa.array(list(terms), pa.binary()).cast(pa.string()),
                    pa.array(list(terms.values()), pa.int64()),
                    pa.array([known[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    return texts.mapInArrow(task, "lang string, source string, term string, n long, docs long")


def groups_of(docs: DataFrame) -> DataFrame:
    """The (lang, source) groups that occur, with terms or without."""
    return docs.select(F.coalesce("lang", F.lit("")).cast("string").alias("lang"),
                       F.coalesce("source", F.lit("")).cast("string").alias("source")).distinct()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, source, term, n, total)`` of the terms in at least ``min_docs`` documents of their
    language; ``total`` is the count in the language."""
    added = counted(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # one row per source and term is left, so a term has as many rows as it has sources
    of_term = Window.partitionBy("lang", "term")
    return (added.withColumn("total", F.sum("n").over(of_term))
            .withColumn("docs", F.sum("docs").over(of_term))
            .where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total"))


def _level_class(total: Column) -> Column:
    """Terms of like frequency: floor of the binary logarithm."""
    return F.length(F.bin(total)).cast("int")


def joint_counts(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, level, other, other_level, n_terms)`` with ``source`` before ``other``.

    These are the joint tables of each block; the tables of a language are their sums. Every pair
    of sources has a row, with 0 terms where the language keeps none.
    """
    of_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    sizes = kept.groupBy("lang", _level_class(F.col("total")).alias("class")).agg(
        F.count(F.lit(1)).alias("counts"), F.count_distinct("term").alias("terms"))
    blocks = of_lang.join(sizes, "lang", "left").select(
        "lang", F.coalesce("class", F.lit(0)).alias("class"), F.greatest(
            F.lit(1), F.ceil(F.col("counts") / BLOCK_COUNTS),
            F.ceil(F.col("terms") * F.col("n_sources") / BLOCK_CELLS)).cast("int").alias("blocks"))
    blocks = stored(blocks, "blocks")
    placed = kept.withColumn("class", _level_class(F.col("total"))).join(
        blocks, ["lang", "class"]).select(
            "lang", "class", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
            "source", "term", "n")
    # each block knows all sources of its language
    named = blocks.select("lang", "class", F.explode(F.sequence(
        F.lit(0), F.col("blocks") - 1)).alias("block")).join(groups, "lang").select(
            "lang", "class", "block", "source", F.lit(None).cast("string").alias("term"),
            F.lit(0).cast("long").alias("n"))
    return placed.unionByName(named).groupBy("lang", "class", "block").applyInArrow(
        _block, "lang string, source string, level long, other string, other_level long,"
                " n_terms long")


def _block(table: pa.Table) -> pa.Table:
    lang, source, term = (table.column(c).combine_chunks() for c in ("lang", "source", "term"))
    names = sorted(pc.unique(source).to_pylist(), key=str.encode)
    of = pc.index_in(source, pa.array(names, source.type)).to_numpy()
    real = pc.is_valid(term).to_numpy(zero_copy_only=False)
    row = term.filter(pa.array(real)).dictionary_encode().indices.to_numpy()
    levels = np.zeros((int(row.max()) + 1 if len(row) else 0, len(names)), np.int64)
    levels[row, of[real]] = table.column("n").to_numpy()[real]
    a, level, b, other, n = (np.concatenate(c) for c in zip(*joint_tables(levels)))
    text = pa.array(names, pa.string())
    return pa.table([pa.repeat(lang[0], len(a)).cast(pa.string()), text.take(pa.array(a)),
                     pa.array(level), text.take(pa.array(b)), pa.array(other), pa.array(n)],
                    names=["lang", "source", "level", "other", "other_level", "n_terms"])


def joint_tables(levels: np.ndarray, columns: int = COLUMNS) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells ``(group, level, other group, level, terms)`` of the joint tables of a matrix of
    levels, terms by groups; group before other group. Cells may come in parts."""
    n_rows, n_groups = levels.shape
    if not n_rows:
        a, b = np.triu_indices(n_groups, 1)
        zero = np.zeros(len(a), np.int64)
        yield a, zero, b, zero, zero
        return
    todo = [levels[np.lexsort((levels.sum(1), levels.max(1)))]]
    while todo:
        piece = todo.pop()
        code, value, group = _columns(piece)
        if len(value) > columns and len(piece) > 1:
            todo += [piece[:len(piece) // 2], piece[len(piece) // 2:]]
            continue
        for i in range(0, len(value), columns):
            left = _one_hot(code, i, columns)
            for j in range(i, len(value), columns):
                # sums of ones, exact in single precision below 2^24 rows
                product = left.T @ (left if i == j else _one_hot(code, j, columns))
                at, to = np.nonzero(product)
                before = group[i + at] < group[j + to]
                at, to = at[before], to[before]
                yield (group[i + at], value[i + at], group[j + to], value[j + to],
                       product[at, to].astype(np.int64))


def _columns(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The column of each cell of a matrix of levels, and the level and group of each column."""
    code = np.empty(levels.shape, np.int64)
    values, groups, first = [], [], 0
    for g in range(levels.shape[1]):
        known, code[:, g] = np.unique(levels[:, g], return_inverse=True)
        code[:, g] += first
        first += len(known)
        values.append(known)
        groups.append(np.full(len(known), g))
    return code, np.concatenate(values), np.concatenate(groups)


def _one_hot(code: np.ndarray, first: int, columns: int) -> np.ndarray:
    """Columns ``first`` and after of the indicator matrix."""
    out = np.zeros((len(code), columns), np.float32)
    row, at = np.nonzero((code >= first) & (code < first + columns))
    out[row, code[row, at] - first] = 1
    return out


def _p(count: Column, n: Column, v: Column, scale: int, smoothing: int) -> Column:
    """1 + floor(scale * (count + smoothing) / (n + smoothing * v)), null without kept terms."""
    wide = "decimal(20,0)"
    over = F.nullif(n + smoothing * v, F.lit(0)).cast(wide)
    return 1 + F.call_function("div", F.lit(scale).cast("decimal(10,0)")
                               * (count + smoothing).cast(wide), over)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, scale: int = SCALE,
          smoothing: int = SMOOTHING, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` has the divergence of each source
    from each other of its language, part ``term`` the ``top`` terms that a source has more of
    than its language.

    Values are exact: no probability is above ``scale`` + 1, and those of a group add up to no
    more than ``scale`` plus its terms, so sums stay below 2^63 for languages of up to two
    billion terms.
    """
    groups = stored(groups_of(docs), "groups")
    kept = stored(kept_counts(docs, min_docs), "kept")
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("n_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    stats = stored(
        groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c)
                                for c in ("n_group", "n_lang", "v")]), "sums")

    def p(count: str, n: str) -> Column:
        return _p(F.col(count), F.col(n), F.col("v"), scale, smoothing)

    joint = (joint_counts(kept, groups)
             .join(stats.select("lang", "source", "n_group", "v"), ["lang", "source"])
             .join(stats.select("lang", F.col("source").alias("other"),
                                F.col("n_group").alias("n_other")), ["lang", "other"])
             .select("lang", "source", "other", "n_terms", p("level", "n_group").alias("p"),
                     p("other_level", "n_other").alias("q")))
    pairs = joint.groupBy("lang", "source", "other").agg(
        F.sum(F.col("n_terms") * _f(F.col("p"), F.col("q"))).alias("there"),
        F.sum(F.col("n_terms") * _f(F.col("q"), F.col("p"))).alias("back"))
    pairs = pairs.select("lang", F.explode(F.array(
        F.struct("source", F.col("other").alias("item"), F.col("there").alias("value")),
        F.struct(F.col("other").alias("source"), F.col("source").alias("item"),
                 F.col("back").alias("value")))).alias("one")).select(
        "lang", "one.source", F.lit("pair").alias("part"), "one.item",
        F.coalesce("one.value", F.lit(0)).alias("value"))

    terms = (kept.join(stats, ["lang", "source"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     p("n", "n_group").alias("p"), p("total", "n_lang").alias("q"))
             .where("p > q").select("lang", "source", "part", "item",
                                    _f(F.col("p"), F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
