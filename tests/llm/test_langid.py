from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from farekit.llm import langid, queries
from tests.llm.cases import ODD, crowded, docs


def phrases(text, sample):
    """Greedy longest stretches of ``text`` that occur in ``sample``; a stranger is a phrase of its own."""
    count, at = 0, 0
    while at < len(text):
        length = 0
        while at + length < len(text) and text[at : at + length + 1] in sample:
            length += 1
        at, count = at + max(length, 1), count + 1
    return count


def test_table_parses_like_brute_force():
    dice = random.Random(2)
    for letters in ("ab", "abcd"):
        sample = "".join(dice.choice(letters) for _ in range(60))
        table = langid.phrase_table([np.array([ord(c) for c in sample], dtype=np.uint32)])
        for _ in range(60):
            text = "".join(dice.choice(letters + "z") for _ in range(dice.randrange(1, 40)))
            piece = np.zeros((1, langid.PIECE), dtype=np.uint32)
            piece[0, : len(text)] = [ord(c) for c in text]
            # The sample ends with a space, as every sampled text does.
            assert langid.phrases(piece, table)[0] == phrases(text, sample + " ")


def test_rare_letters_parse_like_brute_force(monkeypatch):
    """Most letters without a column."""
    monkeypatch.setattr(langid, "COLUMNS", 3)
    dice = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(40)] + ["\U00031350"]
    for _ in range(8):
        sample = "".join(dice.choices(letters[: dice.choice((2, 3, 5, 41))], k=90))
        table = langid.phrase_table([np.array([ord(c) for c in sample], dtype=np.uint32)])
        texts = ["".join(dice.choices([*letters, "z", "\U00031360"], k=dice.randrange(1, 60))) for _ in range(30)]
        texts += [sample[i : i + 30] + sample[:i] for i in range(0, 60, 9)]
        pieces = np.zeros((len(texts), langid.PIECE), dtype=np.uint32)
        for row, text in zip(pieces, texts, strict=True):
            row[: len(text)] = [ord(c) for c in text]
        assert langid.phrases(pieces, table).tolist() == [phrases(t, sample + " ") for t in texts]


def test_a_script_of_two_thousand_letters(spark):
    """Two languages with the same letters and other words."""
    dice = random.Random(8)
    alphabet = [chr(0x4E00 + i) for i in range(1999)] + ["\U00030000"]
    words = {lang: ["".join(dice.choices(alphabet, k=2)) for _ in range(1500)] for lang in ("first", "second")}
    rows = [(i, "".join(dice.choices(words[lang], k=120)), lang, "a", 1) for i, lang in enumerate(["first", "second"] * 150)]
    given = docs(spark, rows)
    found = langid.with_language(given, given.where("doc_id < 200").select("text", "lang")).where("doc_id >= 200").collect()
    assert len(found) == 100 and all(r.lang_pred == r.lang for r in found)


def test_held_out_accuracy(spark, data_dir):
    path = data_dir.replace("sf0.001", "sf0.01")
    found = queries.QUERIES["op3_language"](spark, path).where("held_out")
    right = found.join(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert found.where("score < 0 OR score > 1").count() == 0


def test_odd_rows(spark):
    labelled = docs(spark).select("text", "lang")
    rows = langid.with_language(crowded(docs(spark), "score", "lang_pred", "__lang"), labelled).collect()
    assert len(rows) == len(ODD)
    assert all((r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text)) for r in rows)
    assert langid.with_language(docs(spark, []), labelled).count() == 0
    untaught = langid.with_language(docs(spark), docs(spark, []).select("text", "lang")).select("lang_pred", "score")
    assert untaught.distinct().collect() == [("und", 0.0)]
