"""Quality by compression with two dictionaries.

One zstandard dictionary is built from good labelled text and one from bad. A text is compressed
with each, piece by piece so that the dictionaries matter in long texts too; the difference of the
two sizes, divided by the size without a dictionary and by the raw size, is calibrated by a
logistic curve into the probability of label 1.

Labels are learned from at most SAMPLE_ROWS rows, none held out. A dictionary is trained on at most
DICT_PIECES pieces of a label: where texts have more, every row gives its share of them, spaced
evenly over its text. Defined results: null counts as
empty; the empty text has differences of 0 and gets the score of the curve there; with one label
only, or none, the score is the rate of label 1 with add-half smoothing; every text is compressed
to its end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tableferry.llm.common import extended, labelled_sample, logistic

SAMPLE_ROWS = 6_000
DICT_BYTES = 32 << 10
DICT_PIECES = 40_000  # of one label that a dictionary is trained on
PIECE = 2048
LEVEL = 3


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[at:at + PIECE] for at in range(0, len(data), PIECE)]


def training_pieces(sample: list[tuple[str, int]], label: int,
                    limit: int = DICT_PIECES) -> list[bytes]:
    """At most ``limit`` pieces of the texts with a label. Where there are more, the longest texts
    give up pieces first, so that all rows take part, and each gives them from all its parts."""
    cut = [pieces(t) for t, l in sample if l == label]
    sizes = np.array([len(c) for c in cut], np.int64)
    if sizes.sum() <= limit:
        return [p for c in cut for p in c]
    low, high = 0, int(sizes.max())  # the most that every row may give
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if np.minimum(sizes, middle).sum() <= limit else (low, middle)
    take = np.minimum(sizes, low)
    longer = np.flatnonzero(sizes > low)
    rest = limit - int(take.sum())  # less than one for each longer row
    take[longer[np.arange(rest) * len(longer) // max(1, rest)]] += 1
    return [c[i * len(c) // n] for c, n in zip(cut, take.tolist()) for i in range(n)]


class Sizes:
    """Compressed-size features of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as zs
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False,
                   "write_dict_id": False}
        self.plain = zs.ZstdCompressor(**options)
        self.with_dict = []
        for content in (good, bad):
            data = zs.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            options["dict_data"] = data
            self.with_dict.append(zs.ZstdCompressor(**options))
            options.pop("dict_data")

    def features(self, text: str) -> tuple[float, ...]:
        cut = pieces(text)
        raw = sum(map(len, cut))
        if not raw:
            return 0.0, 0.0, 0.0
        plain = sum(len(self.plain.compress(p)) for p in cut)
        good, bad = (sum(len(c.compress(p)) for p in cut) for c in self.with_dict)
        return (good - bad) / plain, (good - bad) / raw, plain / raw


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; raw content where there is too little to train on."""
    import zstandard as zs
    if not samples:
        return b" " * 16
    try:
        return zs.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:
        return b" ".join(samples)[-DICT_BYTES:].ljust(16)


class QualityModel:
    """The two dictionaries and the calibration, as plain values that travel to tasks."""

    def __init__(self, sample: list[tuple[str, int]], dict_pieces: int = DICT_PIECES):
        # the curve is fitted on the fold that the dictionaries have not seen, for both halves
        by_label = sorted(sample, key=lambda x: x[1])
        halves = [by_label[0::2], by_label[1::2]]
        rows, y = [], []
        for train, test in (halves, halves[::-1]):
            sizes = Sizes(*(dictionary(training_pieces(train, want, dict_pieces))
                            for want in (1, 0)))
            rows += [sizes.features(t) for t, _ in test]
            y += [l for _, l in test]
        x = np.array(rows, float).reshape(-1, 3)
        self.spread = x.std(axis=0) + 1e-9 if len(x) else np.ones(3)
        self.weights = logistic(self._scaled(x), np.array(y, float))
        self.good, self.bad = (dictionary(training_pieces(sample, want, dict_pieces))
                               for want in (1, 0))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return x / self.spread

    def scores(self, features: list[tuple[float, ...]]) -> np.ndarray:
        x = self._scaled(np.array(features, float).reshape(-1, 3))
        z = x @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality",
           rows: int = SAMPLE_ROWS, dict_pieces: int = DICT_PIECES) -> QualityModel:
    return QualityModel(labelled_sample(docs, labels, label, rows), dict_pieces)


def scored(docs: DataFrame, model: QualityModel, column: str = "text",
           out: str = "score") -> DataFrame:
    """Add the calibrated score of each text."""

    def make():
        sizes = Sizes(model.good, model.bad)

        def work(values):
            got = model.scores([sizes.features(v) for v in values]) if values else []
            return [pa.array(got, pa.float64())]

        return work

    return extended(docs, [T.StructField(out, T.DoubleType())], make, column)
