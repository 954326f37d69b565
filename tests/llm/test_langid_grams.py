"""Languages whose n-grams are rare next to those of a large script."""

import random

import numpy as np

from tableferry.llm import langid


def test_grams_of_a_rare_language_are_kept():
    rng = random.Random(3)
    large = [" ".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(4))
                      for _ in range(1000)) for _ in range(25)]
    sample = [(f"{t} word", "zh") for t in large] * 2 + [("qovim zethul wagny", "xx"),
                                                         ("house garden", "en")]
    model = langid.LanguageModel(sample)
    words = ["qovim", "zethul", "wagny"]
    assert np.isin(langid.gram_keys(words)[0], model.keys).all()
    assert len(model.keys) > 60_000
    scores = model.scorer()(words)
    assert (scores.argmax(axis=1) == model.langs.index("xx")).all()
