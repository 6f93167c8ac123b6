"""Find benchmark items in documents: q-gram counts in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.session import stage

# Characters of a q-gram, and edits allowed per character of an item.
Q = 8
EDITS = 0.08
# Items shorter than this after normalisation are looked for as they are, as whole words.
SHORTEST = 24
# Indexes of the benchmark that are with the executors at the same time.
TOGETHER = 4
# Normalised characters of the benchmark that one broadcast index holds, and of documents searched at a time.
INDEX_CHARS = 1_000_000
STREAM_CHARS = 1_000_000

_BASE = 0x9E3779B97F4A7C15
_FILTER_BITS = 22
_GAP = np.uint32(0)
_SPACE = np.uint32(32)


def _letters() -> np.ndarray:
    """Code point to normalised code point: letters and digits in lower case, all else a space."""
    table = np.full(0x30000, _SPACE, dtype=np.uint32)
    for c in range(len(table)):
        if not 0xD800 <= c < 0xE000:
            lower = chr(c).lower()
            if chr(c).isalnum():
                table[c] = ord(lower) if len(lower) == 1 else c
    return table


def normalised(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Lower-case letters and digits of a text, every run of other characters one space, as code points."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
    mapped = letters[np.minimum(codes, len(letters) - 1)]
    blank = mapped == _SPACE
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    return mapped[keep]


def _stripped(codes: np.ndarray) -> np.ndarray:
    if len(codes) and codes[0] == _SPACE:
        codes = codes[1:]
    return codes[:-1] if len(codes) and codes[-1] == _SPACE else codes


def _short_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of so many characters from each position, for sizes below Q."""
    n = max(len(codes) - size + 1, 0)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        h = h * np.uint64(_BASE) + codes[i : i + n]
    return h


def _whole_words(stream: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether stretches of a stream begin and end where words do, or texts."""
    edge = lambda at: (at < 0) | (at >= len(stream)) | np.isin(stream[np.clip(at, 0, len(stream) - 1)], (_SPACE, _GAP))
    return edge(begin - 1) & edge(end)


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the Q characters from each position; Q is a power of two, so log Q passes do."""
    h, width, base = codes.astype(np.uint64), 1, _BASE
    while width < Q:
        if len(h) <= width:
            return np.empty(0, dtype=np.uint64)
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), width * 2
    return h ^ (h >> np.uint64(29))


def build_index(items: list[tuple[int, str]], letters: np.ndarray, edits: float) -> dict:
    """Q-grams of the items with their places, as plain arrays."""
    ids, codes = [], []
    short: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for item_id, text in items:
        body = _stripped(normalised(text, letters))
        if len(body) >= Q:
            ids.append(item_id)
            codes.append(body)
        elif len(body):
            short.setdefault(len(body), []).append((int(_short_hashes(body, len(body))[0]), item_id, body))
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    budget = np.where(lengths < SHORTEST, 0, np.minimum((lengths * edits).astype(np.int64), (lengths - Q) // Q))
    grams = [_gram_hashes(c) for c in codes]
    hashes = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(codes)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    keys, first = np.unique(hashes[order], return_index=True)
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return {
        "letters": letters, "short": short, "ids": ids, "codes": codes, "lengths": lengths, "budget": budget,
        # Each edit destroys Q q-grams at most, so a region within the budget shares at least this many.
        "shared": lengths - Q + 1 - Q * budget,
        "keys": keys, "first": np.append(first, len(order)), "owner": owner[order], "place": place[order], "seen": seen,
    }


def align(item: np.ndarray, region: np.ndarray, budget: int) -> int | None:
    """Fewest edits that turn the item into some part of the region, if within the budget.

    Only cells on diagonals the region leaves room for are filled: a part may
    start anywhere, so the band is as wide as region and item differ, plus the
    budget on both sides.
    """
    low, high = -budget, len(region) - len(item) + budget
    width = high - low + 1
    if width <= 0:
        return None
    far = len(item) + len(region)
    shift = np.arange(width)
    # Row i holds the cells (i, i + low + k); row 0 starts at no cost wherever the part starts.
    column = low + shift
    row = np.where((column >= 0) & (column <= len(region)), 0, far)
    padded = np.concatenate([np.full(budget + 1, 2**31, dtype=np.int64), region, np.full(width + budget + 1, 2**31)])
    for i in range(1, len(item) + 1):
        column = i + low + shift
        start = i + low - 1 + budget + 1
        cost = row + (padded[start : start + width] != item[i - 1])
        cost[:-1] = np.minimum(cost[:-1], row[1:] + 1)
        # Insertions run along the row: the best earlier cell plus the distance from it.
        cost = np.minimum.accumulate(cost - shift) + shift
        row = np.where((column >= 0) & (column <= len(region)), cost, far)
        if row.min() > budget:
            return None
    return int(row.min()) if row.min() <= budget else None


def _candidates(stream: np.ndarray, bounds: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, band) of every diagonal band that shares enough q-grams with an item.

    Bands are two budgets wide and start one budget apart, so that a region
    within the budget lies whole in one of them; a shared q-gram counts in both
    bands of its diagonal.
    """
    none = (np.empty(0, np.int64),) * 3
    hashes = _gram_hashes(stream)
    at = np.flatnonzero(index["seen"][(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    key = np.searchsorted(index["keys"], hashes[at])
    key = np.minimum(key, len(index["keys"]) - 1)
    match = index["keys"][key] == hashes[at]
    at, key = at[match], key[match]
    times = index["first"][key + 1] - index["first"][key]
    if not len(at):
        return none
    posting = np.repeat(index["first"][key] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
    at = np.repeat(at, times)
    item = index["owner"][posting]
    step = np.maximum(index["budget"][item], 1)
    diagonal = at - index["place"][posting] + int(index["lengths"].max())
    band = diagonal // step
    document = np.searchsorted(bounds, at, side="right") - 1
    # One number per (document, item, band): documents x items x bands of a stream stay far below 2^63.
    bands = int(band.max()) + 2
    code = (document * len(index["ids"]) + item) * bands + band
    both = np.sort(np.concatenate([code, code - (band > 0)]))
    starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    counts = np.diff(np.append(starts, len(both)))
    found = both[starts]
    item = found // bands % len(index["ids"])
    enough = counts >= index["shared"][item]
    found, item = found[enough], item[enough]
    return found // bands // len(index["ids"]), item, found % bands


def _pieces(texts: pd.Series, index: dict) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts for one stream at a time; a long text comes in overlapping pieces."""
    overlap = int(index["lengths"].max(initial=0) + 2 * index["budget"].max(initial=0)) + Q + 1
    rows, codes, size = [], [], 0
    for row, text in enumerate(texts):
        body = normalised(text, index["letters"])
        for start in range(0, max(len(body) - overlap, 1), STREAM_CHARS):
            rows.append(row)
            codes.append(body[start : start + STREAM_CHARS + overlap])
            size += len(codes[-1])
            if size >= STREAM_CHARS:
                yield rows, codes
                rows, codes, size = [], [], 0
    if rows:
        yield rows, codes


def _short_matches(stream: np.ndarray, bounds: np.ndarray, index: dict) -> Iterator[tuple[int, int | None]]:
    """(document, item id) of every item of fewer than Q characters that stands in a document as whole words."""
    for size, items in index["short"].items():
        hashes = _short_hashes(stream, size)
        wanted = np.unique(np.array([h for h, _, _ in items], dtype=np.uint64))
        at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes)
        at = at[_whole_words(stream, at, at + size)]
        for h, item_id, body in items:
            mine = at[hashes[at] == np.uint64(h)]
            mine = mine[(stream[mine[:, None] + np.arange(size)] == body).all(axis=1)]
            for document in np.unique(np.searchsorted(bounds, mine, side="right") - 1).tolist():
                yield document, item_id


def matches(texts: pd.Series, index: dict) -> list[dict[int | None, int]]:
    """For each text, the items it holds and the fewest edits of each."""
    out: list[dict[int | None, int]] = [{} for _ in range(len(texts))]
    if not index["ids"] and not index["short"]:
        return out
    longest = int(index["lengths"].max(initial=0))
    gap = np.full(Q, _GAP)
    for rows, codes in _pieces(texts, index):
        stream = np.concatenate([part for c in codes for part in (c, gap)])
        bounds = np.concatenate([[0], np.cumsum([len(c) + Q for c in codes])])
        for document, item_id in _short_matches(stream, bounds, index):
            out[rows[document]][item_id] = 0
        if not index["ids"]:
            continue
        for document, item, band in zip(*_candidates(stream, bounds, index), strict=True):
            item_id, budget = index["ids"][item], int(index["budget"][item])
            known = out[rows[document]].get(item_id)
            if known == 0:
                continue
            step, wanted = max(budget, 1), index["codes"][item]
            start = int(band) * step - longest
            begin, end = int(bounds[document]), int(bounds[document + 1]) - Q
            low = max(begin, start - budget)
            region = stream[low : min(end, start + 2 * step + len(wanted) + budget)]
            if len(wanted) < SHORTEST:
                at = low + np.flatnonzero([(region[i : i + len(wanted)] == wanted).all() for i in range(len(region) - len(wanted) + 1)])
                edits = 0 if _whole_words(stream, at, at + len(wanted)).any() else None
            else:
                edits = align(wanted, region, budget)
            if edits is not None:
                out[rows[document]][item_id] = edits if known is None else min(known, edits)
    return out


def _indexes(benchmark: DataFrame, edits: float) -> Iterator[dict]:
    """Indexes of INDEX_CHARS characters in the mean, each built from one block of the benchmark."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // INDEX_CHARS)
    letters = _letters()
    for block in range(blocks):
        # By id and text, so that many items of one id or none make no block larger than others.
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield build_index([tuple(row) for row in mine.collect()], letters, edits)


_KIND = "array<struct<item_id: bigint, edits: int>>"


def _search(shared: Broadcast[dict]):
    """What was found so far with what one block adds; of an item that several blocks have, the fewest edits."""

    @F.pandas_udf(_KIND)
    def search(before: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for known, found in zip(before, matches(texts, shared.value), strict=True):
            for m in known:
                found[m["item_id"]] = min(m["edits"], found.get(m["item_id"], m["edits"]))
            order = sorted(found.items(), key=lambda x: (x[0] is not None, x))
            out.append([{"item_id": i, "edits": e} for i, e in order])
        return pd.Series(out, dtype="object")

    return search


def _searched(docs: DataFrame, benchmark: DataFrame, edits: float, name: str) -> DataFrame:
    """Documents with the items found by all blocks; TOGETHER blocks a pass, the rows written in between."""
    out, sent = docs.withColumn(name, F.array().cast(_KIND)), []
    for index in _indexes(benchmark, edits):
        if len(sent) == TOGETHER:
            out = stage(out, "matches")
            for block in sent:
                block.destroy()
            sent = []
        sent.append(docs.sparkSession.sparkContext.broadcast(index))
        out = out.withColumn(name, _search(sent[-1])(name, "text"))
    return out


def with_matches(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """Add ``matches``: array of (item_id, edits) for the benchmark items that the document's text contains.

    Texts are compared by their letters and digits in lower case, every run of
    other characters being one space. An item is contained if some part of the
    text is within ``edits`` x its length of edits (at most one in Q characters)
    of the whole item. Items of fewer than SHORTEST characters must stand there
    as they are, as whole words. Whole texts of any length are searched; null
    and empty texts contain nothing, and repeated rows the same. Null items and
    items without a letter or digit are not looked for; items without an id are
    reported under null; equal items are all reported, and of several items with
    one id the fewest edits. An empty benchmark finds nothing. An existing column
    ``matches`` is replaced.

    The benchmark is the query set: it goes to the executors in blocks of
    bounded size, TOGETHER of them at a time, and every block is searched in all
    documents where they lie.
    """
    return _searched(docs, benchmark, edits, "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, edits) for every benchmark item in every document."""
    return with_matches(docs.select("doc_id", "text"), benchmark, edits).select("doc_id", F.inline("matches"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The documents without those that contain a benchmark item; columns as given."""
    clean = _searched(docs, benchmark, edits, "__matches").where(F.size("__matches") == 0)
    return clean.drop("__matches")
