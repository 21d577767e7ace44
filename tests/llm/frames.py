"""Small tables for the tests of the text operators."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
# Null, empty, white space only, punctuation only, ties, repeated rows, a null id, one id twice.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "?!. ,"), (5, "one two three"), (5, "one two three"), (6, "one  two\tthree"),
    (7, "one two three"), (None, "one two three"), (None, "nobody's text"), (8, "first text"), (8, "second text"), (9, "Ünïcödé ß text ß 文字"),
]


def docs(spark, rows):
    """documents with columns that clash with names the operators use."""
    return spark.createDataFrame(
        [(i, t, "en", "src", "x", 1.5, "n", "k") for i, t in rows],
        "doc_id bigint, text string, lang string, source string, name string, score double, node string, key string")


def sentence(rng: random.Random, n: int) -> list[str]:
    return [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
