"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward_rows(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in every column, empty and
    very long texts, repeated rows and ids, copies."""
    rng = random.Random(seed)
    base = prose(rng, 80)
    rows = [
        (1, base, "en", "a", len(base)),
        (1, base, "en", "a", len(base)),  # a repeated row
        (2, base, None, "b", None),  # a copy
        (2, prose(rng, 30), "en", None, 1),  # a repeated id, other text
        (3, None, "en", "a", 0),
        (4, "", "fr", "a", 0),
        (5, " \t\n\x0b ", "fr", "b", 5),
        (6, "Word", "fr", "b", 4),
        (None, prose(rng, 40), "en", "a", 7),
        (None, None, None, None, None),
        (7, "x" * 30_000, "de", "b", 30_000),
        (8, prose(rng, 20_000), "de", "c", 1),
        (9, "日本語 ü 🤔 \U0001f600 ﬁ", "de", "c", 9),
        (-5, "1 2 3 4 !!", "de", "c", 10),
    ]
    rows += [(100 + i, prose(rng, rng.randrange(1, 120)), rng.choice(["en", "de"]), rng.choice("abc"), 0) for i in range(30)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra: bool = True):
    """The table, with extra columns whose names internal steps also use."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    if extra:
        for name in ("score", "fp", "key", "size", "src", "block", "word", "n", "th", "dk", "x"):
            df = df.selectExpr("*", f"'z' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
