"""Awkward rows that every operator must take: nulls, blanks, long texts, repeats, and columns with clashing names."""

from __future__ import annotations

import random

WORDS = "the of and a net total growth license apache mit cc by gnu general public é ñandú über 中文 don't 3.14 idiot".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, digest string, kept boolean, node long, size long, part int, rank long, label string"


def text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", ",", ".", "\n"]) for _ in range(n))


def rows() -> list[tuple]:
    long = text(1, 30_000)
    base = text(2, 200)
    near = base.replace("net", "gross", 1)
    texts = [
        (0, "", "a"), (1, None, "a"), (2, " \t\n", "b"), (3, "one", None), (4, "one two three four", "b"), (5, base, "a"), (6, base, "b"), (7, near, "a"), (8, "x  " + base, None),
        (9, base.replace(" ", "\n"), "a"), (10, long, "a"), (11, long + " end", "b"), (12, "MIT  License, Apache License! cc-by gnu general public license", "c"), (13, "🙂 <|endoftext|> \x00 ́ ﬁ", "c"),
        (14, "a" * 5000, "a"), (15, text(3, 50), "a"), (15, text(3, 50), "a"), (None, "no id", "b"), (None, None, None), (16, text(4, 80), "z"), (17, "one", "a"),
    ]
    return [(i, t, "en", s, None, 7, "clash", None, 1, 2, 3, 4, "l") for i, t, s in texts]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
