"""Invented prose for the tests."""

import random

WORDS = "amber birch cedar delta ember fjord grove heath islet jetty knoll ledge marsh north ocean pines quarry ridge shore tower".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))
