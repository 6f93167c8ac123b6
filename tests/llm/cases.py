"""Rows that operators must take as they come."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} and{i % 13}," for i in range(60_000))

ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\r ", "en", "a", 5),
    (4, LONG, "en", "a", len(LONG)),
    (5, "Ünï cödé — ﬁ 日本語 🙂 é ΑΣ İ'll <|endoftext|> 12#!", "de", None, 40),
    (6, "the same text twice, the same text twice.\nthe same line\nthe same line", "en", "b", 70),
    (6, "the same text twice, the same text twice.\nthe same line\nthe same line", "en", "b", 70),
    (7, "the same text twice, the same text twice.\nthe same line\nthe same line", "fr", "b", 70),
    (None, "nobody's row", "en", "b", 12),
    (None, None, None, None, None),
]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def crowded(df, *names):
    """The same rows with extra columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("mine") for name in names})
