"""Fill-in-the-middle: texts cut into prefix, middle and suffix at line borders and put in a
new order, and back.

Each Arrow batch is one chain of array operations: texts are split into lists of lines, the
lists are flattened with the index of their text, each line gets its ordinal in its text, a role
by its ordinal, and the lines of a role are put into lists again and joined. Only the four
draws of a document are made row by row, from the hash of its id.

Defined results: a null text counts as empty, and an empty text, or one that holds a mark, keeps
its order (form ``plain``). A null id draws as the empty text. Equal rows give equal results,
rows do not see each other, and a text of any length is handled whole: batches are cut at
:data:`tableferry.llm.common.SLICE_BYTES` and a longer text is a batch of its own. Other columns
are kept; one named like a new column (in any case) is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from tableferry.llm.common import sliced

# The marks in front of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

MADE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])


def draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers below 2^32 for each id."""
    digests = (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16]
               for i in ids)
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def lines(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lines of all texts with their ends, the text that each belongs to, and its ordinal
    there. What follows the last line end is a line only if it is not empty."""
    parts = pc.split_pattern(text, "\n")
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy()
    sizes = pc.list_value_length(parts).to_numpy()
    ordinal = np.arange(len(flat)) - (np.cumsum(sizes) - sizes)[parent]
    last = ordinal == sizes[parent] - 1
    units = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), "", "\n"), "")
    real = ~last | (pc.binary_length(flat).to_numpy() > 0)
    return units.filter(pa.array(real)), parent[real], ordinal[real]


def joined(units: pa.Array, parent: np.ndarray, mine: np.ndarray, rows: int) -> pa.Array:
    """The units of one role put together, one value for each text."""
    ends = np.cumsum(np.bincount(parent[mine], minlength=rows))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                     units.filter(pa.array(mine)))
    return pc.binary_join(lists, "")


def transformed(text: pa.Array, ids: list, seed: int, rate: int, spm_rate: int) -> list[pa.Array]:
    """The columns of ``MADE`` for one batch."""
    text = _rows(pc.fill_null(text, ""), np.arange(len(text)))
    h = draws(ids, seed)
    units, parent, ordinal = lines(text)
    n = np.bincount(parent, minlength=len(text))
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    role = (ordinal >= cuts[parent, 0]).astype(int) + (ordinal >= cuts[parent, 1])
    prefix, middle, suffix = (joined(units, parent, role == r, len(text)) for r in range(3))
    plain = pa.array((n == 0) | (h[:, 2] % 100 >= rate))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(text, mark))
    spm = pa.array(h[:, 3] % 100 < spm_rate)
    ordered = pc.if_else(
        spm, pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
        pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))
    nothing = pa.scalar(None, pa.int64())
    return [pa.array(n, pa.int64()), pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
            *[pc.if_else(plain, nothing, pc.utf8_length(p).cast(pa.int64()))
              for p in (prefix, middle)],
            pc.if_else(plain, text, ordered)]


def _others(df: DataFrame, new: list[str]) -> list[str]:
    lower = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in lower]


def fill_in_middle(df: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 7,
                   rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``df`` with ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` percent of the documents are put in a new order, of these ``spm_rate`` percent with
    the suffix in front (``spm``), the others with the prefix in front (``psm``).
    """
    kept = _others(df, MADE.names)
    schema = T.StructType([df.schema[c] for c in kept] + MADE.fields)
    names, types = schema.names, [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            made = transformed(batch.column(text), batch.column(doc_id).to_pylist(), seed, rate,
                               spm_rate)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [a.cast(t) for a, t in zip(made, types)],
                names=names)

    return df.mapInArrow(task, schema)


def _rows(value: pa.Array, rows: np.ndarray) -> pa.Array:
    """These rows, in memory of their own: array functions that make nulls of rows of a slice
    were seen to give wrong ones."""
    return value.take(pa.array(rows, pa.int64()))


def rebuilt(output: pa.Array, form: pa.Array) -> pa.Array:
    """Texts from outputs and forms. A mark has no part that both begins and ends it, so its
    first occurrence is the one that was put there."""
    forms = np.array(form.to_pylist(), object)
    forms[~pc.is_valid(output).to_numpy(zero_copy_only=False)] = None
    plain = np.flatnonzero(forms == "plain")
    texts, places = [_rows(output, plain)], [plain]
    for name, order in (("psm", (PREFIX, SUFFIX, MIDDLE)), ("spm", (SUFFIX, PREFIX, MIDDLE))):
        place = np.flatnonzero(forms == name)
        pieces = [_rows(output, place)]
        for mark in order:
            cut = pc.split_pattern(pieces[-1], mark, max_splits=1)
            there = pc.equal(pc.list_value_length(cut), 2)
            cut, place = cut.filter(there), place[there.to_numpy(zero_copy_only=False)]
            pieces = [p.filter(there) for p in pieces[:-1]] + [pc.list_element(cut, i) for i in (0, 1)]
        _, first, second, middle = pieces
        prefix, suffix = (first, second) if name == "psm" else (second, first)
        texts.append(pc.binary_join_element_wise(prefix, middle, suffix, ""))
        places.append(place)
    at = np.full(len(output), -1)
    at[np.concatenate(places)] = np.arange(sum(map(len, places)))
    return pa.concat_arrays(texts).take(pa.array(at, mask=at < 0))


def restored(df: DataFrame, output: str = "output", form: str = "form",
             out: str = "restored") -> DataFrame:
    """``df`` with the exact text that each output was made of. Null where the output or form is
    null, the form unknown, or a mark of the form missing."""
    kept = _others(df, [out])
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.StringType())])
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, output):
            text = rebuilt(batch.column(output), batch.column(form))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [text.cast(pa.string())], names=names)

    return df.mapInArrow(task, schema)
