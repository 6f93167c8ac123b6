"""Repeated passages: maximal repeat groups from enhanced suffix arrays, sharded by the anchors of the passages.

A suffix array of a whole corpus has no shard that can be sorted alone, but its
stretches that hold repeats of ``length`` bytes or more do. Every window of
``length`` bytes has an anchor: the leftmost of its short stretches with the
smallest hash. Equal windows have equal anchors, wherever they stand, so all
suffixes that begin with equal windows are found under one anchor. Windows in a
row with the same anchor are a run; a run with the bytes its windows cover is a
unit of about 60 bytes, and a shard sorts the suffixes of its units.

1. Texts are packed into blocks, cut into runs, and written, bucketed by block:
   what buckets answer goes to the blocks, which stay where they are.
2. Blocks tell each bucket of anchors which it has; buckets answer which of them
   stand in several documents. Nothing else is looked at again.
3. Blocks send the units of those anchors, equal units once. An anchor with very
   many different units is split: each of its windows goes by its own hash.
4. Each shard builds the suffix array of its units with the common prefixes of
   neighbours, scans them with a stack into the tree of common-prefix intervals,
   and keeps the intervals whose occurrences are preceded by different bytes:
   the maximal repeats, each with all of its occurrences. The smallest document
   of a group's occurrences is the first of every window that the group covers.
5. Blocks hear the first document of each window of their units.

Nothing has to be looked up by position, and a task holds a block or a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.llm.spans import SpanHasher, distinct
from farekit.session import stage, stage_bucketed

LENGTH = 50
# Bytes of an anchor. Shorter ones are fewer but stand in more places by chance.
ANCHOR = 28
# Text in a block, and windows that are cut into runs at a time.
BLOCK_BYTES = 4_000_000
AT_ONCE = 1_000_000
# Different units under one anchor, summed over blocks, from which its windows go their own ways.
HOT = 1 << 14
# Suffixes that are sorted at a time, whole anchors only.
SORTED = 300_000
# The id that stands for null: later than any document.
LAST = (1 << 63) - 1

_BLOCK = "block long, ids binary, nulls binary, sizes binary, texts binary, runs binary"
_ASKED = "bucket int, block long, hashes binary, counts binary"
_TOLD = "block long, kind int, bucket int, sizes binary, values binary"
_UNITS = "bucket int, block long, keys binary, sizes binary, texts binary, lows binary"
_MEMBERS = "group long, length int, doc_id long, begin long"
_OUT = "doc_id long, n_bytes long, begins array<long>, ends array<long>, kept binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}

ANCHORS, FIRSTS, GROUPS = 0, 1, 2
ALONE, SHARED, SPLIT = 0, 1, 2


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def _rows(rows: list[dict], fields: str) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_schema(fields))


def _pack(array: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.astype(kind).tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _pack_leading(hashes: np.ndarray) -> bytes:
    """The leading 40 bits of ascending hashes, as differences byte by byte: about half of the 8 bytes of each."""
    leading = hashes >> np.uint64(24)
    steps = np.diff(leading, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return _pack(np.ascontiguousarray(steps[:, :5].T), "u1")


def _unpack_leading(raw: bytes) -> np.ndarray:
    planes = _unpack(raw, "u1").reshape(5, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :5] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every stretch, one after the other."""
    sizes = sizes.astype(np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


# --- texts to runs -----------------------------------------------------------------------------------------------


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values in a row."""
    span = 1
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[: len(h) - (width - span)], h[width - span :]) if span < width else h


def runs(data: np.ndarray, sizes: np.ndarray, length: int, anchor: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts in a row, cut into runs with one anchor: windows in the run, and place of the anchor from its begin."""
    width = length - anchor + 1
    ends = np.cumsum(sizes)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    whole = sizes >= length
    np.add.at(inside, (ends - sizes)[whole], 1)
    np.add.at(inside, (ends - length + 1)[whole], -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    lengths, offsets = [], []
    reached, anchored = -1, -1
    for begin in range(0, max(len(data) - length + 1, 0), AT_ONCE):
        valid = inside[begin : min(begin + AT_ONCE, len(data) - length + 1)]
        if not valid.any():
            continue
        n = len(valid)
        h = hasher.windows(data[begin : begin + n + length - 1], anchor)
        least = _smallest(h, width)
        entered = np.zeros(n, dtype=bool)
        entered[1:] = h[width : n + width - 1] < least[:-1]
        new = entered.copy()
        new[1:] |= (h[: n - 1] == least[:-1]) | ~valid[:-1]
        new[0] = True
        new &= valid
        at = np.flatnonzero(new)
        # A smaller one that comes in is the anchor; else the leftmost of the smallest is looked for.
        offset = np.full(len(at), width - 1)
        search = np.flatnonzero(~entered[at] | (at == 0) | ~valid[at - 1])
        offset[search] = h[at[search, None] + np.arange(width)].argmin(axis=1)
        # Windows outside a text end a run.
        edge = np.flatnonzero(np.concatenate([new | ~valid, [True]]))
        following = edge[np.searchsorted(edge, at, side="right")]
        length_of = following - at
        # The run that reached the end of the windows before goes on, if its anchor does.
        if reached == begin and at[0] == 0 and anchored == begin + offset[0]:
            lengths[-1][-1] += length_of[0]
            at, offset, length_of = at[1:], offset[1:], length_of[1:]
        if len(at):
            anchored = begin + int(at[-1] + offset[-1])
            lengths.append(length_of)
            offsets.append(offset)
        reached = begin + n if valid[-1] and inside[min(begin + n, len(inside) - 1)] else -1
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(lengths), np.concatenate(offsets)) if lengths else (none, none)


def _packed(length: int, anchor: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, done = SpanHasher(), 0
        task = TaskContext.get().partitionId()
        ids: list = []
        bodies: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            body = b"".join(bodies)
            sizes = np.array([len(b) for b in bodies], dtype=np.int64)
            lengths, offsets = runs(np.frombuffer(body, np.uint8), sizes, length, anchor, hasher)
            row = {
                "block": (task << 32) + done,
                "ids": np.array([LAST if i is None else i for i in ids], dtype="<i8").tobytes(),
                "nulls": np.array([i is None for i in ids]).tobytes(),
                "sizes": sizes.astype("<i8").tobytes(),
                "texts": zstandard.ZstdCompressor(level=1).compress(body),
                "runs": _pack(np.concatenate([lengths, offsets]), "<u2"),
            }
            return pa.RecordBatch.from_pylist([row], schema=_schema(_BLOCK))

        for batch in batches:
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                bodies.append(batch.column(1)[i].as_py() or b"")
                size += len(bodies[-1])
                # Also many empty texts make a block.
                if size + 100 * len(ids) >= block_bytes:
                    yield block()
                    ids, bodies, size, done = [], [], 0, done + 1
        if ids:
            yield block()

    return run


@dataclass(frozen=True)
class _Shape:
    """What all steps of a run agree on."""

    length: int
    anchor: int
    buckets: int
    hot: int

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)

    def by_bucket(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The places of ascending hashes by bucket; within a bucket they ascend too."""
        q = self.bucket(hashes)
        order = np.argsort(q, kind="stable")
        found, starts = np.unique(q[order], return_index=True)
        ends = np.append(starts, len(order))[1:]
        for b, begin, end in zip(found.tolist(), starts, ends, strict=True):
            yield b, order[begin:end]


class _Block:
    """The texts of a block, its runs, and its different units by anchor."""

    def __init__(self, row: dict, shape: _Shape) -> None:
        self.name, self.shape, self.hasher = row["block"], shape, SpanHasher()
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.nulls = np.frombuffer(row["nulls"], "?")
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8)
        packed = _unpack(row["runs"], "<u2").astype(np.int64)
        self.lengths, offsets = packed[: len(packed) // 2], packed[len(packed) // 2 :]
        # Windows are numbered without those that would cross the end of a text.
        self.windows = np.maximum(self.sizes - shape.length + 1, 0)
        self.ordinals = np.cumsum(self.lengths) - self.lengths
        upto = np.cumsum(self.windows)
        self.document = np.searchsorted(upto, self.ordinals, side="right")
        begins = np.cumsum(self.sizes) - self.sizes
        self.starts = self.ordinals + (begins - (upto - self.windows))[self.document]
        self.spans = self.lengths + shape.length - 1
        at = self.starts + offsets
        both = np.concatenate([at, self.starts]), np.concatenate([at + shape.anchor, self.starts + self.spans])
        anchors, whole = np.split(self.hasher.hashes(self.data, *both), 2)
        # Equal units share their anchor; units are ordered by anchor.
        _, first, which = distinct(whole)
        order = np.argsort(anchors[first], kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.unit, self.which = first[order], place[which]
        self.key = anchors[self.unit]
        self.low = np.full(len(self.unit), LAST)
        np.minimum.at(self.low, self.which, self.ids[self.document])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different anchors, how many different units each has, and whether it stands in several documents."""
        new = np.ones(len(self.key), dtype=bool)
        new[1:] = self.key[1:] != self.key[:-1]
        begin = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        least, most = np.full(len(begin), len(self.sizes)), np.full(len(begin), -1)
        np.minimum.at(least, number[self.which], self.document)
        np.maximum.at(most, number[self.which], self.document)
        return self.key[begin], np.diff(np.append(begin, len(self.key))), least != most

    def codes(self, told: list[dict]) -> np.ndarray:
        """For each unit whether its anchor stands alone, is shared, or is split by window."""
        keys, counts, _ = self.anchors()
        answer = np.zeros(len(keys), dtype=np.uint8)
        rows = {r["bucket"]: r for r in told if r["kind"] == ANCHORS}
        for b, at in self.shape.by_bucket(keys):
            answer[at] = _unpack(rows[b]["values"], "u1")
        return np.repeat(answer, counts)

    def requests(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By bucket: key, begin, size and first document of each unit sent, and the places of its windows' answers.

        The last is the number of the unit's first window among those of all
        different units of the block.
        """
        starts, lengths = self.starts[self.unit], self.lengths[self.unit]
        base = np.cumsum(lengths) - lengths
        whole, split = np.flatnonzero(codes == SHARED), np.flatnonzero(codes == SPLIT)
        at = _ranges(starts[split], lengths[split])
        keys = np.concatenate([self.key[whole], self.hasher.hashes(self.data, at, at + self.shape.length)])
        begin = np.concatenate([starts[whole], at])
        size = np.concatenate([self.spans[self.unit][whole], np.full(len(at), self.shape.length)])
        low = np.concatenate([self.low[whole], np.repeat(self.low[split], lengths[split])])
        answer = np.concatenate([base[whole], _ranges(base[split], lengths[split])])
        order = np.argsort(keys, kind="stable")
        for b, mine in self.shape.by_bucket(keys[order]):
            yield b, *(x[order][mine] for x in (keys, begin, size, low, answer))


# --- anchors -----------------------------------------------------------------------------------------------------


def _asked(shape: _Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.slice(i, 1).to_pylist()[0], shape)
                keys, counts, several = block.anchors()
                rows = [
                    {
                        "bucket": b, "block": block.name, "hashes": _pack_leading(keys[at]),
                        "counts": _pack(np.minimum(counts[at], 1 << 30) * 2 + several[at], "<u4"),
                    }
                    for b, at in shape.by_bucket(keys)
                ]
                yield from _rows(rows, _ASKED).to_batches()

    return run


def _answered(shape: _Shape):
    """Which anchors of each block stand in several documents, and which have too many units for one shard.

    Anchors are told apart by 40 bits and the bucket. Two that agree in those
    share an answer in all blocks, at worst that units are sent or split for nothing;
    the units themselves go by all 64 bits.
    """

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        hashes = [_unpack_leading(r["hashes"]) for r in rows]
        packed = np.concatenate([_unpack(r["counts"], "<u4") for r in rows]).astype(np.int64)
        _, first, which = distinct(np.concatenate(hashes))
        blocks = np.bincount(which, minlength=len(first))
        units = np.bincount(which, packed >> 1, len(first))
        several = np.bincount(which, packed & 1, len(first)) > 0
        code = np.where((blocks > 1) | several, np.where(units >= shape.hot, SPLIT, SHARED), ALONE)[which]
        done, out = 0, []
        for row, h in zip(rows, hashes, strict=True):
            codes = _pack(code[done : done + len(h)], "u1")
            out.append({"block": row["block"], "kind": ANCHORS, "bucket": row["bucket"], "sizes": b"", "values": codes})
            done += len(h)
        return _rows(out, _TOLD)

    return run


def _sent(shape: _Shape):
    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in blocks.to_pylist():
            block = _Block(row, shape)
            for b, keys, begin, size, low, _ in block.requests(block.codes(told.to_pylist())):
                text = block.data[_ranges(begin, size)]
                out.append(
                    {
                        "bucket": b, "block": block.name, "keys": keys.tobytes(), "sizes": _pack(size, "<u2"),
                        "texts": _pack(text, "u1"), "lows": _pack(low, "<i8"),
                    }
                )
        return _rows(out, _UNITS)

    return run


# --- suffix arrays -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SuffixArray:
    """The suffixes of at least ``length`` bytes of many units, ordered by anchor and bytes.

    ``prefix[i]`` is the common prefix of suffixes i - 1 and i where it has
    ``length`` bytes or more, else 0.
    """

    unit: np.ndarray
    offset: np.ndarray
    prefix: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, groups: np.ndarray, length: int) -> SuffixArray:
        n = sizes - length + 1
        unit = np.repeat(np.arange(len(sizes)), n)
        offset = _ranges(np.zeros(len(sizes), dtype=np.int64), n)
        left = sizes[unit] - offset
        at = begins[unit] + offset
        # Eight bytes at every place as one number; beyond the end of a unit the bytes are zero.
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        word = np.zeros(len(data) + 1, dtype=np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | padded[i : i + len(data) + 1]
        columns = []
        for j in range(-(-int(left.max(initial=0)) // 8)):
            rest = np.clip(left - 8 * j, 0, 8).astype(np.uint64) * np.uint64(8)
            value = word[np.minimum(at + 8 * j, len(data))]
            gone = np.uint64(64) - rest
            columns.append(np.where(rest == 0, np.uint64(0), value >> (gone & np.uint64(63)) << (gone & np.uint64(63))))
        order = np.lexsort((left, *columns[::-1], groups[unit]))
        unit, offset, left = unit[order], offset[order], left[order]
        same = groups[unit[1:]] == groups[unit[:-1]]
        common = np.zeros(max(len(unit) - 1, 0), dtype=np.int64)
        for j, column in enumerate(columns):
            differs = column[order][1:] ^ column[order][:-1]
            reached = same & (common == 8 * j)
            # Leading bytes that agree: zero bytes from the top.
            equal = sum((differs >> np.uint64(64 - 8 * (i + 1)) == 0).astype(np.int64) for i in range(8))
            common[reached] += equal[reached]
        common = np.minimum(common, np.minimum(left[1:], left[:-1]))
        return cls(unit, offset, np.concatenate([[0], np.where(common >= length, common, 0)]) if len(unit) else common)

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tree of common-prefix intervals as (prefix, first, last), children before parents; by a scan with a stack.

        Only neighbours with a common prefix are looked at, so the scan is as
        long as what repeats.
        """
        found: list[tuple[int, int, int]] = []
        at = np.flatnonzero(self.prefix)
        stack: list[tuple[int, int]] = []
        before = -2
        for i, common in zip(at.tolist(), self.prefix[at].tolist(), strict=True):
            if i != before + 1:
                found += [(depth, first, before) for depth, first in reversed(stack)]
                stack = []
            first = i - 1
            while stack and stack[-1][0] > common:
                depth, first = stack.pop()
                found.append((depth, first, i - 1))
            if not stack or stack[-1][0] < common:
                stack.append((common, first))
            before = i
        found += [(depth, first, before) for depth, first in reversed(stack)]
        tree = np.array(found, dtype=np.int64).reshape(-1, 3)
        return tree[:, 0], tree[:, 1], tree[:, 2]

    def maximal(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals whose occurrences cannot all be extended to the left by the same byte.

        The begin of a unit counts as a byte of its own: what stands before it
        belongs to the run before. Every interval is as long as it can be to
        the right, so these are the maximal repeats, and the suffixes from
        first to last are all their occurrences.
        """
        depth, first, last = self.intervals()
        if not len(depth):
            return depth, first, last
        before = np.where(self.offset > 0, data[np.maximum(begins[self.unit] + self.offset - 1, 0)].astype(np.int64), 256)
        ends = np.stack([first, last + 1], axis=1).ravel()
        before = np.append(before, 256)
        least, most = np.minimum.reduceat(before, ends)[::2], np.maximum.reduceat(before, ends)[::2]
        diverse = (least != most) | (most == 256)
        return depth[diverse], first[diverse], last[diverse]


def first_documents(
    data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, groups: np.ndarray, lows: np.ndarray, length: int
) -> np.ndarray:
    """The smallest document in which each window of each unit occurs; units of one group at least must be together."""
    n = sizes - length + 1
    base = np.cumsum(n) - n
    result = np.repeat(lows, n)
    suffixes = SuffixArray.of(data, begins, sizes, groups, length)
    depth, first, last = suffixes.maximal(data, begins)
    if len(depth):
        ends = np.stack([first, last + 1], axis=1).ravel()
        least = np.minimum.reduceat(np.append(lows[suffixes.unit], LAST), ends)[::2]
        # All occurrences of every group, and all windows of every occurrence.
        group = np.repeat(np.arange(len(depth)), last - first + 1)
        member = _ranges(first, last - first + 1)
        later = lows[suffixes.unit[member]] > least[group]
        group, member = group[later], member[later]
        windows = depth[group] - length + 1
        at = _ranges(base[suffixes.unit[member]] + suffixes.offset[member], windows)
        np.minimum.at(result, at, np.repeat(least[group], windows))
    return result


class _Bucket:
    """The different units of a bucket, whatever block they came from."""

    def __init__(self, sent: pa.Table, length: int) -> None:
        self.rows = sorted(sent.to_pylist(), key=lambda r: r["block"])
        keys = np.concatenate([np.frombuffer(r["keys"], "<u8") for r in self.rows])
        self.sent = [_unpack(r["sizes"], "<u2").astype(np.int64) for r in self.rows]
        size = np.concatenate(self.sent)
        low = np.concatenate([_unpack(r["lows"], "<i8") for r in self.rows])
        body = b"".join(zstandard.ZstdDecompressor().decompress(r["texts"]) for r in self.rows)
        bounds = np.concatenate([[0], np.cumsum(size)])
        texts = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(body)])
        self.which = texts.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, unit = np.unique(self.which, return_index=True)
        self.lows = np.full(len(unit), LAST)
        np.minimum.at(self.lows, self.which, low)
        self.data, self.begins, self.sizes, self.group = np.frombuffer(body, np.uint8), bounds[unit], size[unit], keys[unit]
        self.windows = self.sizes - length + 1

    def shards(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Units of some anchors with several units each, their bytes in a row, and where each begins in those.

        Anchors of one unit need no array: the unit is the repeat, and its rows are the occurrences.
        """
        order = np.argsort(self.group, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], self.group[order][1:] != self.group[order][:-1]]))
        members = np.diff(np.append(edge, len(order)))
        for some in _slices(edge, members, self.windows[order], at_once):
            mine = order[some]
            ends = np.cumsum(self.sizes[mine])
            yield mine, self.data[_ranges(self.begins[mine], self.sizes[mine])], ends - self.sizes[mine]


def _judged(shape: _Shape, at_once: int):
    """The first documents of the windows of all units of a bucket."""

    def run(sent: pa.Table) -> pa.Table:
        bucket = _Bucket(sent, shape.length)
        rows, sizes, which, n = bucket.rows, bucket.sent, bucket.which, bucket.windows
        base = np.cumsum(n) - n
        result = np.repeat(bucket.lows, n)
        for mine, data, begins in bucket.shards(at_once):
            found = first_documents(data, begins, bucket.sizes[mine], bucket.group[mine], bucket.lows[mine], shape.length)
            result[_ranges(base[mine], n[mine])] = found
        # As stretches of windows with the same first document, unit by unit as they were sent.
        new = np.ones(len(result), dtype=bool)
        new[1:] = result[1:] != result[:-1]
        new[base] = True
        head = np.flatnonzero(new)
        stretch = np.diff(np.append(head, len(result)))
        begin_of = np.searchsorted(head, base)
        count_of = np.diff(np.append(begin_of, len(head)))
        done, out = 0, []
        for row, s in zip(rows, sizes, strict=True):
            mine = which[done : done + len(s)]
            done += len(s)
            at = _ranges(begin_of[mine], count_of[mine])
            out.append(
                {
                    "block": row["block"], "kind": FIRSTS, "bucket": row["bucket"], "sizes": _pack(stretch[at], "<u2"),
                    "values": _pack(result[head[at]], "<i8"),
                }
            )
        return _rows(out, _TOLD)

    return run


def _grouped(shape: _Shape, at_once: int):
    """The maximal repeats of all units of a bucket: to each block, which of its units hold which of them, and where."""

    def run(sent: pa.Table) -> pa.Table:
        bucket, hasher = _Bucket(sent, shape.length), SpanHasher()
        # A unit is a repeat of its own copies; the arrays give those that it shares with other units.
        unit, offset, depth = [np.arange(len(bucket.sizes))], [np.zeros(len(bucket.sizes), dtype=np.int64)], [bucket.sizes]
        for mine, data, begins in bucket.shards(at_once):
            suffixes = SuffixArray.of(data, begins, bucket.sizes[mine], bucket.group[mine], shape.length)
            length, first, last = suffixes.maximal(data, begins)
            member = _ranges(first, last - first + 1)
            unit.append(mine[suffixes.unit[member]])
            offset.append(suffixes.offset[member])
            depth.append(np.repeat(length, last - first + 1))
        unit, offset, depth = (np.concatenate(x) for x in (unit, offset, depth))
        # A unit that is a prefix of another one is found by itself and in the array.
        unit, offset, depth = np.unique(np.stack([unit, offset, depth]), axis=1)
        at = bucket.begins[unit] + offset
        name = hasher.hashes(bucket.data, at, at + depth)
        begin = np.searchsorted(unit, np.arange(len(bucket.sizes) + 1))
        done, out = 0, []
        for row, s in zip(bucket.rows, bucket.sent, strict=True):
            mine = bucket.which[done : done + len(s)]
            done += len(s)
            count = begin[mine + 1] - begin[mine]
            of = _ranges(begin[mine], count)
            request = np.repeat(np.arange(len(s)), count)
            out.append(
                {
                    "block": row["block"], "kind": GROUPS, "bucket": row["bucket"],
                    "sizes": _pack(np.concatenate([request, offset[of], depth[of]]), "<u4"), "values": _pack(name[of], "<u8"),
                }
            )
        return _rows(out, _TOLD)

    return run


def _slices(edge: np.ndarray, members: np.ndarray, n: np.ndarray, at_once: int) -> Iterator[np.ndarray]:
    """Places of the units whose anchor has several, some anchors at a time and each anchor whole."""
    several = np.flatnonzero(members > 1)
    if not len(several):
        return
    suffixes = np.add.reduceat(n, edge)[several]
    turn = (np.cumsum(suffixes) - suffixes) // at_once
    for k in np.unique(turn).tolist():
        mine = several[turn == k]
        yield _ranges(edge[mine], members[mine])


# --- documents ---------------------------------------------------------------------------------------------------


def _cut(shape: _Shape):
    """Each document of a block with its removed spans and what is left."""

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        tables, told_rows = [], told.to_pylist()
        for row in blocks.to_pylist():
            block = _Block(row, shape)
            firsts = {r["bucket"]: r for r in told_rows if r["kind"] == FIRSTS}
            lengths = block.lengths[block.unit]
            base = np.cumsum(lengths) - lengths
            first = np.full(int(lengths.sum()), LAST)
            for b, _, _, size, _, answer in block.requests(block.codes(told_rows)):
                found = np.repeat(_unpack(firsts[b]["values"], "<i8"), _unpack(firsts[b]["sizes"], "<u2"))
                first[_ranges(answer, size - shape.length + 1)] = found
            # From the different units to all windows of the block, in order.
            first = first[_ranges(base[block.which], block.lengths)]
            mine = np.repeat(block.ids, block.windows)
            begins = np.cumsum(block.sizes) - block.sizes
            ordinal = np.flatnonzero(first < mine)
            document = np.searchsorted(np.cumsum(block.windows), ordinal, side="right")
            at = ordinal + (begins - (np.cumsum(block.windows) - block.windows))[document]
            depth = np.zeros(len(block.data) + 1, dtype=np.int64)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + shape.length, -1)
            gone = np.cumsum(depth[:-1]) > 0
            edge = np.diff(gone.astype(np.int8), prepend=0)
            edge[begins[block.sizes > 0]] = gone[begins[block.sizes > 0]]
            head = np.flatnonzero(edge == 1)
            stop = np.zeros(len(gone) + 1, dtype=bool)
            stop[:-1] = edge != 0
            stop[-1] = True
            stop[np.cumsum(block.sizes)] = True
            stops = np.flatnonzero(stop)
            tail = stops[np.searchsorted(stops, head, side="right")]
            upto = np.searchsorted(head, np.append(begins, len(gone)))
            out = []
            for d, (begin, size) in enumerate(zip(begins.tolist(), block.sizes.tolist(), strict=True)):
                spans = slice(upto[d], upto[d + 1])
                body = block.data[begin : begin + size]
                out.append(
                    {
                        "doc_id": None if block.nulls[d] else int(block.ids[d]), "n_bytes": size,
                        "begins": (head[spans] - begin).tolist(), "ends": (tail[spans] - begin).tolist(),
                        "kept": body[~gone[begin : begin + size]].tobytes(),
                    }
                )
            tables.append(_rows(out, _OUT))
        return pa.concat_tables(tables) if tables else _rows([], _OUT)

    return run


def _placed(shape: _Shape):
    """Where the occurrences of every group stand in the documents of a block."""

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        tables, told_rows = [], told.to_pylist()
        for row in blocks.to_pylist():
            block = _Block(row, shape)
            members = {r["bucket"]: r for r in told_rows if r["kind"] == GROUPS}
            # All runs of a unit, one after the other.
            order = np.argsort(block.which, kind="stable")
            begin = np.searchsorted(block.which[order], np.arange(len(block.unit) + 1))
            lengths = block.lengths[block.unit]
            base = np.cumsum(lengths) - lengths
            text_begin = np.cumsum(block.sizes) - block.sizes
            for b, _, _, _, _, answer in block.requests(block.codes(told_rows)):
                request, offset, depth = np.split(_unpack(members[b]["sizes"], "<u4").astype(np.int64), 3)
                name = _unpack(members[b]["values"], "<u8").view("<i8")
                # A request is a unit, or one window of it.
                unit = np.searchsorted(base, answer[request], side="right") - 1
                inner = answer[request] - base[unit] + offset
                count = begin[unit + 1] - begin[unit]
                run_of = order[_ranges(begin[unit], count)]
                document = block.document[run_of]
                place = block.starts[run_of] + np.repeat(inner, count) - text_begin[document]
                arrays = [
                    pa.array(np.repeat(name, count), pa.int64()), pa.array(np.repeat(depth, count).astype(np.int32)),
                    pa.array(block.ids[document], mask=block.nulls[document]), pa.array(place, pa.int64()),
                ]
                tables.append(pa.Table.from_arrays(arrays, schema=_schema(_MEMBERS)))
        return pa.concat_tables(tables) if tables else _rows([], _MEMBERS)

    return run


def _prepared(
    docs: DataFrame, length: int, anchor: int | None, hot: int, block_bytes: int
) -> tuple[_Shape, DataFrame, DataFrame, DataFrame]:
    """Blocks of texts, which of their anchors are shared, and the units of those by bucket."""
    spark = docs.sparkSession
    anchor = anchor or max(1, round(length * ANCHOR / LENGTH))
    shape = _Shape(length, anchor, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), hot)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("body"))
    blocks = stage_bucketed(narrow.mapInArrow(_packed(length, anchor, block_bytes), _BLOCK), "blocks", "block")
    asked = blocks.mapInArrow(_asked(shape), _ASKED)
    told = stage(asked.groupBy("bucket").applyInArrow(_answered(shape), _TOLD), "anchors")
    units = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_sent(shape), _UNITS)
    return shape, blocks, told, units


def repeat_groups(
    docs: DataFrame, length: int = LENGTH, *, anchor: int | None = None, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
    sorted_at_once: int = SORTED,
) -> DataFrame:
    """(group, length, doc_id, begin): every maximal repeat of ``length`` bytes or more with all of its occurrences.

    ``group`` is a hash of the repeated bytes, ``begin`` counts bytes. Repeats
    are maximal within the stretch around one anchor, so a longer passage comes
    as several overlapping groups whose occurrences run side by side, and under
    an anchor that is split each window is a group. Only groups that stand in
    several documents are given. Odd rows fare as in ``without_repeats``; null
    ids count as one document.
    """
    shape, blocks, told, units = _prepared(docs, length, anchor, hot, block_bytes)
    groups = stage(units.groupBy("bucket").applyInArrow(_grouped(shape, sorted_at_once), _TOLD), "groups")
    answers = told.union(groups)
    members = stage(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_placed(shape), _MEMBERS), "members")
    # Null counts as the last id, as everywhere here.
    document = F.coalesce("doc_id", F.lit(LAST))
    several = members.groupBy(F.col("group").alias("__group")).agg(F.min(document).alias("low"), F.max(document).alias("high"))
    several = stage(several.where("low < high").select("__group"), "several")
    return members.join(several, F.col("group") == F.col("__group")).drop("__group")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, *, anchor: int | None = None, hot: int = HOT, block_bytes: int = BLOCK_BYTES,
    sorted_at_once: int = SORTED,
) -> DataFrame:
    """(doc_id, n_bytes, begins, ends, kept) of every row: its repeated spans in bytes, and the bytes outside of them.

    A byte goes if a string of ``length`` bytes that covers it starts in a
    document with a smaller doc_id too; strings are compared as UTF-8 bytes and
    never span documents, and what is removed elsewhere does not matter. Spans
    are maximal, so two of them never touch. ``kept`` may end inside of a
    character. The first document of a text keeps it; rows with equal ids do
    not take from each other, so repeated rows are all kept or all cut alike. A
    null doc_id (and the largest long) is later than all others. Null texts are
    empty; texts shorter than ``length`` stay whole. A text of any length is
    read whole. An empty table gives no row. Extra columns are ignored,
    whatever their names.

    The number of buckets is ``spark.sql.shuffle.partitions``; a bucket holds
    its share of 9 bytes for every 12 bytes of text.
    """
    shape, blocks, told, units = _prepared(docs, length, anchor, hot, block_bytes)
    firsts = stage(units.groupBy("bucket").applyInArrow(_judged(shape, sorted_at_once), _TOLD), "firsts")
    answers = told.union(firsts)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(shape), _OUT)
