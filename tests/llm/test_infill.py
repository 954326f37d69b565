"""Fill-in-the-middle against a row-by-row version, and round trips."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from tableferry.llm import infill

SCHEMA = "doc_id long, text string, Output string, n int, restored string"


def plain(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


NASTY = ["", None, "\n", "\n\n", "a", "a\n", "a\nb", "\na\n\nb\n", "x <P> y\nz", "<S", "<\n<S\n<M", "ä\n👩‍👩‍👧\r\n한\x85국 어\n",
         "long line " * 3000 + "\n" + "more\n" * 9000, "a\nb\nc\nd\ne\n", "a\nb\nc\nd\ne\n"]


def rows(seed, n):
    rng = random.Random(seed)
    return [(rng.randint(-5, 10**12), "".join(rng.choice("ab<PSM>\n é") for _ in range(rng.randint(0, 60))))
            for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"seed": 1, "rate": 60, "spm_rate": 20}, {"rate": 0}])
def test_output_is_that_of_the_rows_and_comes_back(spark, options):
    data = [(i, t) for i, t in enumerate(NASTY)] + [(None, "a\nb\nc\n"), (3, "\n\n")] + rows(1, 400)
    docs = spark.createDataFrame([(i, t, "old", 9, "old") for i, t in data], SCHEMA)
    got = infill.restored(infill.fill_in_middle(docs, **options)).collect()
    assert len(got) == len(data)
    for r, (doc_id, text) in zip(sorted(got, key=str), sorted(
            ((i, t) for i, t in data), key=lambda d: str((d[0], d[1])))):
        assert r.restored == (r.text or "")
    want = sorted(map(str, ((i, t, *plain(i, t, **options)) for i, t in data)))
    assert want == sorted(str((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output))
                          for r in got)


def test_slices_of_batches_give_the_same():
    """Nulls made in slices were once wrong."""
    data = rows(2, 500)
    whole = pa.array([t for _, t in data])
    ids = [i for i, _ in data]
    for first in (0, 3, 9):
        part = whole.slice(first, 300)
        n, form, _, _, output = infill.transformed(part, ids[first:first + 300], 7, 100, 50)
        assert output.to_pylist() == [plain(i, t)[4] for i, t in data[first:first + 300]]
        assert infill.rebuilt(output.slice(5), form.slice(5)).to_pylist() == part.slice(5).to_pylist()


def test_what_cannot_be_rebuilt_is_null():
    output = pa.array(["<P>a<S>b<M>c", None, "<P>a<S>b", "x", "t", "<S>b<P>a<M>c", "<P>a"])
    form = pa.array(["psm", "psm", "psm", "odd", "plain", "spm", None])
    assert infill.rebuilt(output, form).to_pylist() == ["acb", None, None, None, "t", "acb", None]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    df = infill.restored(infill.fill_in_middle(empty))
    assert df.collect() == [] and df.columns == ["doc_id", "text", "n", "form", "prefix_chars",
                                                 "middle_chars", "output", "restored"]
