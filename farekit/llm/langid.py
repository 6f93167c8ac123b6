"""Language by cross-parsing: the language whose text needs the fewest phrases to spell a document."""

from __future__ import annotations

import sys
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farekit.session import stage

# The sample that the automata are built from: this many characters of normalised text in all, at most so many of one
# language, from at most so many rows of it.
SAMPLE_CHARS = 240_000
LANGUAGE_CHARS = 60_000
LANGUAGE_ROWS = 256
PARTS = 16
# Characters of one language with a column in its table; the ways by rarer ones are found by search.
COLUMNS = 63
# A phrase ends at every so many characters, so that texts of any length are parsed in equal pieces side by side.
PIECE = 512
PIECES_AT_ONCE = 4096
UNDECIDED = "und"

_SPACE = 32


def _letters() -> np.ndarray:
    """Code point to lower-case letter, all else a space; as far as there are letters, and one more."""
    letters = [c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]
    table = np.full(letters[-1] + 2, _SPACE, dtype=np.uint32)
    for c in letters:
        lower = chr(c).lower()
        table[c] = ord(lower) if len(lower) == 1 else c
    return table


def normalised(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Lower-case letters of a text, every run of other characters one space, as code points."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
    mapped = letters[np.minimum(codes, len(letters) - 1)]
    blank = mapped == _SPACE
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    return mapped[keep]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    longest, link = [0], [-1]
    last = 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if longest[at] + 1 == longest[target]:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                longest.append(longest[at] + 1)
                link.append(link[target])
                link[target] = link[state] = copy
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
        last = state
    return moves


def phrase_table(texts: list[np.ndarray]) -> dict:
    """A language's automaton as one array, and as sorted keys for the letters that have no column in it.

    Entry (state, character) is twice the start of the next state's row, plus 1
    if a phrase begins with the character: from the start state, and wherever
    the automaton has no way on, the character begins the next phrase. Most
    states have a way on by one or two characters, so a script of thousands of
    letters gets columns for the commonest ones only; a way by another letter
    has a key, state times letters plus letter. A character that the sample
    lacks is a phrase of its own.
    """
    joined = np.concatenate([part for t in texts for part in (t, [_SPACE])]) if texts else np.array([_SPACE])
    letters = [c for c, _ in sorted(Counter(joined.tolist()).items(), key=lambda x: (-x[1], x[0]))]
    columns = min(COLUMNS, len(letters))
    other, pad, width = columns, columns + 1, columns + 2
    number = {c: i for i, c in enumerate(letters)}
    moves = suffix_automaton([number[c] for c in joined.tolist()])
    table = np.zeros((len(moves), width), dtype=np.int32)
    table[:, :columns] = [2 * width * moves[0][c] + 1 for c in range(columns)]
    keys, ways = [], []
    for state, edges in enumerate(moves):
        for letter, to in edges.items():
            if letter >= columns:
                keys.append(state * len(letters) + letter)
                ways.append(2 * width * to + (state == 0))
            elif state:
                table[state, letter] = 2 * width * to
    table[:, other] = 1
    order = np.argsort(np.array(keys, dtype=np.int64))
    # Columns first, then absent and missing, then the letters without a column.
    codes = np.full(max(letters) + 2, other, dtype=np.int32)
    codes[letters[:columns]] = np.arange(columns)
    codes[letters[columns:]] = np.arange(columns, len(letters)) + 2
    codes[0] = pad
    return {
        "table": table.ravel(), "codes": codes, "width": width, "letters": len(letters),
        "keys": np.array(keys, dtype=np.int64)[order], "ways": np.array(ways, dtype=np.int32)[order],
    }


def _searched(state: np.ndarray, letter: np.ndarray, language: dict) -> np.ndarray:
    """Entries of letters without a column: the way on from the state, else from the start state."""
    keys, ways = language["keys"], language["ways"]
    wanted = state // language["width"] * np.int64(language["letters"]) + letter
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    # From the start state there is a way by every letter, and it begins a phrase.
    return np.where(keys[at] == wanted, ways[at], ways[np.searchsorted(keys, letter)])


def phrases(pieces: np.ndarray, language: dict) -> np.ndarray:
    """How many phrases each row of characters needs; rows end in zeros where a piece is shorter."""
    table, width = language["table"], language["width"]
    codes = np.ascontiguousarray(language["codes"][np.minimum(pieces, len(language["codes"]) - 1)].T)
    searched = (codes >= width).any(axis=1) if len(language["keys"]) else np.zeros(len(codes), dtype=bool)
    state = np.zeros(len(pieces), dtype=np.int32)
    count = np.zeros(len(pieces), dtype=np.int32)
    for column, some in zip(codes, searched.tolist(), strict=True):
        if some:
            rare = np.flatnonzero(column >= width)
            found = table.take(state + np.minimum(column, width - 1))
            found[rare] = _searched(state[rare], column[rare] - 2, language)
        else:
            found = table.take(state + column)
        count += found & 1
        state = found >> 1
    return count


def decide(texts: list[str | None], model: dict) -> list[tuple[str, float]]:
    """Language and margin of each text: 1 minus the fewest phrases over the second fewest."""
    names, tables = model["names"], model["tables"]
    bodies = [normalised(t, model["letters"]) for t in texts]
    totals = np.zeros((len(texts), len(names)), dtype=np.int64)
    pieces = np.array([-(-len(b) // PIECE) for b in bodies], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), pieces)
    # All pieces in one row of equal pieces; zeros fill each text's last one.
    padded = np.zeros(int(pieces.sum()) * PIECE, dtype=np.uint32)
    for body, end, n in zip(bodies, np.cumsum(pieces).tolist(), pieces.tolist(), strict=True):
        padded[(end - n) * PIECE : (end - n) * PIECE + len(body)] = body
    padded = padded.reshape(-1, PIECE)
    for start in range(0, len(padded), PIECES_AT_ONCE):
        part = padded[start : start + PIECES_AT_ONCE]
        for k, table in enumerate(tables):
            totals[:, k] += np.bincount(owner[start : start + PIECES_AT_ONCE], phrases(part, table), len(texts)).astype(np.int64)
    out = []
    for body, counts in zip(bodies, totals, strict=True):
        if not names or not (body != _SPACE).any():
            out.append((UNDECIDED, 0.0))
            continue
        order = np.argsort(counts, kind="stable")
        second = counts[order[1]] if len(names) > 1 else len(body)
        out.append((names[order[0]], float(1 - counts[order[0]] / max(second, 1)) if second else 0.0))
    return out


def learn(labelled: DataFrame) -> dict:
    """Automata of the languages of labelled rows (text, lang).

    From each language come up to LANGUAGE_ROWS rows by a hash of the text,
    texts of over 10,000 characters last, and of them so many characters that
    the budgets hold: SAMPLE_CHARS shared evenly, so 1,200 characters each for
    200 languages; raise it for many. That bounds the model whatever the size
    of the table: about 2 states a character, and 65 numbers a state.
    Null languages and rows without text teach nothing.
    """
    rows = labelled.where("lang is not null and text is not null").select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("h")
    )
    # The choice is made without the texts; the few chosen ones are fetched by their hashes.
    thin = rows.select("lang", "h", (F.length("text") > 10_000).alias("long")).distinct()
    # First by parts of a language, so that no task sees more of a frequent one than parts x LANGUAGE_ROWS.
    part = Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("long", "h")
    order = Window.partitionBy("lang").orderBy("long", "h")
    first = thin.withColumn("n", F.row_number().over(part)).where(F.col("n") <= LANGUAGE_ROWS)
    chosen = first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= LANGUAGE_ROWS)
    chosen = stage(chosen.select(F.col("lang").alias("__lang"), F.col("h").alias("__h"), "n"), "language-sample")
    texts = rows.join(F.broadcast(chosen), (F.col("lang") == F.col("__lang")) & (F.col("h") == F.col("__h")))
    sampled = (
        texts.groupBy("lang", "n").agg(F.min(F.substring("text", 1, LANGUAGE_CHARS)).alias("text"))
        .withColumn("before", F.coalesce(F.sum(F.length("text")).over(
            Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .where(F.col("before") < LANGUAGE_CHARS)
        .select("lang", "n", "text").collect()
    )
    letters = _letters()
    names = sorted({row["lang"] for row in sampled})
    budget = min(LANGUAGE_CHARS, SAMPLE_CHARS // max(len(names), 1))
    tables = []
    for name in names:
        texts, left = [], budget
        for row in sorted((r for r in sampled if r["lang"] == name), key=lambda r: r["n"]):
            body = normalised(row["text"], letters)[:left]
            texts.append(body)
            left -= len(body)
        tables.append(phrase_table(texts))
    return {"letters": letters, "names": names, "tables": tables}


def _decide_all(shared: Broadcast[dict]):
    @F.pandas_udf("lang_pred string, score double")
    def of_texts(texts: pd.Series) -> pd.DataFrame:
        out = []
        for start in range(0, len(texts), 1024):
            out += decide(list(texts[start : start + 1024]), shared.value)
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return of_texts


def with_language(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), replacing such columns.

    Each text's letters are parsed into the longest stretches that occur in a
    language's sample, for each language; the one with the fewest phrases wins,
    of equal ones the first by name. Whole texts are parsed, of any length and
    in scripts of any number of letters; repeated rows fare alike. Null texts and
    texts without a letter are ``und`` with score 0, as is every text if nothing
    was learnt. The broadcast model is bounded by the sample's parameters.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(labelled))
    found = docs.drop("lang_pred", "score").withColumn("__found", _decide_all(model)("text"))
    return found.withColumns({"lang_pred": F.col("__found.lang_pred"), "score": F.col("__found.score")}).drop("__found")
