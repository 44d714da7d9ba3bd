"""Small tables with the awkward cases: nulls, empty texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, cls long, row long, part string"


def documents(spark, texts, first=0):
    """One row per text, with extra columns whose names the operators use inside."""
    rows = [(first + i, text, "en", "s", len(text or ""), 1, 2, "x") for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    texts = [None, "", " ", "\n\t ", "one", "a b c d", "x  y \n z", "word " * 3000, "é漢字😀 \u00a0 ok", "same text", "same text"]
    docs = documents(spark, texts)
    repeated = docs.filter("doc_id = 9")
    unknown = spark.createDataFrame([(None, "no id here", None, None, None, None, None, None)], DOCS)
    return docs.union(repeated).union(unknown)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(n)]
