"""Words and column names for the tests of this folder."""

import random

WORDS = "the of and river stone light garden window market winter letter music forest harbour bridge story engine signal copper".split()

#: Columns that operators use inside or return: inputs may have them too.
CLASHING = ["id", "rid", "score", "kept", "fp", "name", "n", "t1", "key", "item", "__id", "spans", "n_bytes"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(words))
