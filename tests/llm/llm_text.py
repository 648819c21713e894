"""Random prose for the tests of this folder."""

from __future__ import annotations

import random


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["the", "an", "er", "in", "ou", "st", "re"]) for _ in range(r.randint(1, 3)))
                    for _ in range(words))
