"""Small documents with the awkward cases every operator must define."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, items string, row string, kept string, score string"

WORDS = "red green blue amber violet teal stone river cloud forest lamp chair paper ink quiet loud swift slow early late".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(400)}" for _ in range(n))


def rows(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    """Rows with columns whose names clash with those of the operators."""
    return [(i, t, "en", "s", None, "a", "b", "c", "d", "e") for i, t in texts]


def frame(spark, texts: list[tuple[int | None, str | None]]):
    return spark.createDataFrame(rows(texts), SCHEMA)


AWKWARD: list[tuple[int | None, str | None]] = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "ONE"),
    (5, "?!\n\n--"),
    (6, "Größe ñandú 漢字 123"),
    (7, "same words here again and again"),
    (7, "same words here again and again"),
    (7, "another text under the same id"),
    (None, "no id at all but some words"),
    (None, None),
]


def collected(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
