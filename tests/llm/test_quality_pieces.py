"""Pieces that the quality dictionaries are trained on."""

from tableferry.llm import quality


def test_all_rows_and_parts_give_pieces():
    texts = [(f"{i:04d}" * (quality.PIECE // 4) * (1 + 9 * (i % 3)), i % 2) for i in range(60)]
    for limit in (7, 30, 100, 5000):
        for label in (0, 1):
            got = quality.training_pieces(texts, label, limit)
            total = sum(len(quality.pieces(t)) for t, l in texts if l == label)
            assert len(got) == min(limit, total)
            rows = {p[:4] for p in got}
            assert len(rows) == min(limit, 30)
    long = "".join(f"{i:04d}" * (quality.PIECE // 4) for i in range(100))
    got = [int(p[:4]) for p in quality.training_pieces([(long, 1)], 1, 10)]
    assert got == list(range(0, 100, 10))


def test_late_rows_reach_the_dictionaries(monkeypatch):
    given = []
    monkeypatch.setattr(quality, "dictionary", lambda samples: given.append(samples) or b" " * 16)
    long = [("early text of one kind " * 1_800_000, 1)] * 2  # over 40,000 pieces
    quality.QualityModel(long + [("late text", 1), ("another", 0)])
    good = given[-2]
    assert len(good) == 40_000 and b"late text" in good
