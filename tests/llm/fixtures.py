"""Small made-up tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, 7))) for _ in range(words))


def edited(text: str, seed: int, share: float) -> str:
    draw = random.Random(seed)
    return " ".join(prose(seed * 1000 + i, 1) if draw.random() < share else w for i, w in enumerate(text.split(" ")))


def rows() -> list[tuple]:
    texts = [prose(i, 5 + 7 * i) for i in range(30)]
    texts += [edited(prose(900, 200), i, 0.02 + 0.01 * (i % 6)) for i in range(40)]  # a group of near copies
    texts += [prose(901, 120)] * 12  # exact copies
    texts += ["", None, "   ", "!?", "one", "one two", "One TWO", "zwei Wörter über", "x" * 500, prose(902, 20_000)]
    return [(i * 3 + 1, t, "en", "s", len(t) if t else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


def odd_table(spark):
    """Null ids, repeated rows, and columns whose names clash with those of the operators."""
    from pyspark.sql import functions as F

    base = spark.createDataFrame(
        [(None, "null id here and more", "en", "s", 3), (5, None, None, None, None), (5, None, None, None, None), (7, "a b", "en", "s", 3)]
        + [(8, prose(3, 40), "en", "s", 9)] * 2,
        DOCS,
    )
    return base.withColumns({c: F.lit(1) for c in ("node", "kept", "text_", "leader", "part", "shard", "pii", "_lang_pred", "block", "ids", "score")})


def empty(spark):
    return spark.createDataFrame([], DOCS)
