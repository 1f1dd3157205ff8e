"""The character model of corpora with many scripts."""

from __future__ import annotations

import math

import numpy as np

from turnstile.llm import toxicity


def test_rare_trigrams_of_many_are_kept(spark):
    rng = np.random.default_rng(2)
    words = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 5000, 12)) for _ in range(20_000)]
    docs = [(" ".join(words[i : i + 500] * 2),) for i in range(0, len(words), 500)] + [("𐐨hund",)]
    model = toxicity.character_model(spark.createDataFrame(docs, "text string"))  # more than 240,000 trigrams
    assert math.isclose(model.cost("un", "d"), -math.log(0.5))
    assert math.isclose(model.cost("𐐨h", "u"), -math.log(0.5))
    assert toxicity.restore("h.u.n.d", model) == "hund"
