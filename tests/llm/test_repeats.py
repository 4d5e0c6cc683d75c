"""Units and runs without their places are those with them."""

import random

import numpy as np

from finfilings.llm import repeats, sentences


def test_units_and_runs_without_places_are_the_same():
    r = random.Random(4)
    words = ["Alpha", "beta", "GAMMA.", "Ünï", "x!", "y?\n", "\n", " ", "delta", "\ud800", "end...", ""]
    for _ in range(300):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 120)))
        units = sentences.sentences(text)
        plain = sentences.contents(text)
        assert [u[:2] for u in plain] == [u[:2] for u in units]
        hashes, cuts = repeats.runs(units, 3, 18)
        alone, none = repeats.runs(plain, 3, 18, False)
        assert none is None and np.array_equal(hashes, alone) and len(cuts) == len(hashes)
        assert all(0 <= a < b <= len(text) for a, b in cuts)
