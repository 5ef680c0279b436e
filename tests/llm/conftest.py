"""Small tables with the awkward cases that every operator has to define."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, embedding string, a long, spans string"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds ``documents`` from (doc_id, text) or (doc_id, text, lang); other columns clash with inner names."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None, "x", 1, "y") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words))


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here at all now"), (5, "é " * 30_000)]
