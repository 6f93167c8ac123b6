"""Token ids in Re-Pair compressed shards: a grammar per shard, decodable from any position."""

from __future__ import annotations

import os
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farekit.llm.spans import SpanHasher, distinct
from farekit.session import stage

END_ID = 2
# Ids of one shard in the mean: what one task compresses and one reader opens.
SHARD_IDS = 1_000_000
# Ranges of documents at most; a range of more ids is cut into shards where it is sorted, so that the exchange between
# tasks and ranges does not grow with the square of the table.
RANGES = 4096
# A pair that occurs less often in a shard is no rule. A rule costs two symbols and, mostly, a byte for its length; each
# occurrence saves one symbol.
FEWEST = 3
_TABLE_BITS = 18
# Runs of letters a task remembers; the store starts anew when it is full.
REMEMBERED = 1_000_000
# Bytes of text that are encoded at a time.
ENCODED_BYTES = 2_000_000

_FORMAT = (
    "part int, piece int, doc_ids binary, has_id binary, lengths binary, n_ids long, first_rule int, "
    "rule_left binary, rule_right binary, rule_length binary, body binary"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in _FORMAT.split(", "))])


# --- one shard ---------------------------------------------------------------------------------------------------


def symbol_bits(first_rule: int) -> int:
    """Width of a symbol: 16 bits if the vocabulary leaves room for rules in them, else 32."""
    return 16 if first_rule <= 60_000 else 32


def _frequent(codes: np.ndarray, none: int, least: int) -> np.ndarray:
    """Pairs that occur at least so often, most frequent first."""
    ordered = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(starts, len(ordered)))
    keep = np.flatnonzero((counts >= least) & (ordered[starts] != none))
    return ordered[starts[keep[np.argsort(-counts[keep], kind="stable")]]]


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over one shard: (left, right) of the rules, and the sequence that is left.

    ``ends`` are the positions behind each document; no pair spans two
    documents. Frequent pairs are replaced in rounds: all pairs of at least a
    given count at once, overlapping ones from the left, the count falling from
    a thousandth of the shard to FEWEST. Rule k stands for symbol first_rule + k
    and uses earlier symbols only. The rules end where symbols do, or when no
    pair is left that pays.
    """
    bits = symbol_bits(first_rule)
    kind = np.uint32 if bits == 16 else np.uint64
    none = (1 << 2 * bits) - 1
    room = (1 << bits) - 1 - first_rule
    body = ids.astype(kind)
    last = np.zeros(len(body), dtype=bool)
    last[ends - 1] = True
    table = np.zeros(1 << _TABLE_BITS, dtype=np.int64)
    lefts, rights, made = [], [], 0
    least = max(FEWEST, len(body) // 1000)
    while len(body) > 1 and made < room:
        codes = (body[:-1] << kind(bits)) | body[1:]
        codes[last[:-1]] = none
        chosen = _frequent(codes, none, least)[: room - made]
        if not len(chosen):
            if least == FEWEST:
                break
            least = max(FEWEST, least // 8)
            continue
        # Each pair's slot names its rule; of pairs that meet in a slot the most frequent goes first, the rest next round.
        table[_slots(chosen)[::-1]] = np.arange(len(chosen))[::-1]
        rule = table[_slots(codes)]
        rule[rule >= len(chosen)] = 0
        at = np.flatnonzero(chosen[rule] == codes)
        # In a run of overlapping occurrences every other one is replaced.
        order = np.arange(len(at))
        run_start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, order, 0))
        at = at[(order - run_start) % 2 == 0]
        used = np.flatnonzero(np.bincount(rule[at], minlength=len(chosen)))
        name = np.zeros(len(chosen), dtype=np.int64)
        name[used] = np.arange(len(used))
        lefts.append(chosen[used] >> kind(bits))
        rights.append(chosen[used] & kind((1 << bits) - 1))
        body[at] = (first_rule + made + name[rule[at]]).astype(kind)
        last[at] = last[at + 1]
        keep = np.ones(len(body), dtype=bool)
        keep[at + 1] = False
        body, last = body[keep], last[keep]
        made += len(used)
        least = max(FEWEST, least // 8)
    narrow = f"<u{bits // 8}"
    empty = np.empty(0, dtype=narrow)
    return (
        np.concatenate(lefts).astype(narrow) if lefts else empty,
        np.concatenate(rights).astype(narrow) if rights else empty,
        body.astype(narrow),
    )


def _slots(codes: np.ndarray) -> np.ndarray:
    return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _narrow(lengths: np.ndarray) -> bytes:
    """Lengths in the fewest bytes that hold the largest; the number of rules tells how many that are."""
    largest = int(lengths.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if largest < 1 << 8 * w)
    return lengths.astype(f"<u{width}").tobytes()


def _wide(raw: bytes, rules: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{len(raw) // rules}").astype(np.int64) if rules else np.empty(0, dtype=np.int64)


def rule_lengths(left: np.ndarray, right: np.ndarray, first_rule: int) -> np.ndarray:
    """How many ids each rule stands for."""
    lengths: list[int] = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        lengths.append(
            (lengths[a - first_rule] if a >= first_rule else 1) + (lengths[b - first_rule] if b >= first_rule else 1)
        )
    return np.array(lengths, dtype=np.int64)


def expand(body: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that a piece of the sequence stands for, as signed 32-bit."""
    texts: list[list[int]] = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        texts.append(
            (texts[a - first_rule] if a >= first_rule else [a]) + (texts[b - first_rule] if b >= first_rule else [b])
        )
    # All single ids, then the expansion of each rule: every symbol is a stretch of this table.
    flat = np.array([i for text in texts for i in text], dtype=np.int32)
    table = np.concatenate([np.arange(first_rule, dtype=np.int32), flat])
    starts = first_rule + np.cumsum(lengths) - lengths
    symbols = body.astype(np.int64)
    ruled = symbols >= first_rule
    size, start = np.ones(len(symbols), dtype=np.int64), symbols.copy()
    size[ruled], start[ruled] = lengths[symbols[ruled] - first_rule], starts[symbols[ruled] - first_rule]
    behind = np.cumsum(size)
    return table[np.repeat(start - behind + size, size) + np.arange(behind[-1] if len(behind) else 0)]


def decode(shard: dict, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids start..stop of a shard; only the symbols that cover them are expanded."""
    first = shard["first_rule"]
    narrow = f"<u{symbol_bits(first) // 8}"
    left, right, body = (np.frombuffer(shard[n], dtype=narrow) for n in ("rule_left", "rule_right", "body"))
    lengths = _wide(shard["rule_length"], len(left))
    stop = shard["n_ids"] if stop is None else min(stop, shard["n_ids"])
    if stop <= start:
        return np.empty(0, dtype=np.int32)
    sizes = np.ones(len(body), dtype=np.int64)
    ruled = body >= first
    sizes[ruled] = lengths[body[ruled].astype(np.int64) - first]
    upto = np.cumsum(sizes)
    begin, end = np.searchsorted(upto, start, side="right"), np.searchsorted(upto, stop, side="left") + 1
    ids = expand(body[begin:end], left, right, lengths, first)
    offset = start - int(upto[begin] - sizes[begin])
    return ids[offset : offset + stop - start]


# --- tokenizing and writing --------------------------------------------------------------------------------------


# Classes of bytes: white space, letters (with all of UTF-8 beyond ASCII), digits, symbols.
_SPACE, _LETTER, _DIGIT, _SYMBOL = range(4)


def _classes() -> np.ndarray:
    table = np.full(256, _SYMBOL, dtype=np.uint8)
    table[128:] = _LETTER
    for b in range(128):
        if chr(b).isalpha():
            table[b] = _LETTER
        elif chr(b).isdigit():
            table[b] = _DIGIT
    table[[9, 10, 11, 12, 13, 32]] = _SPACE
    return table


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Encoder:
    """Ids of many texts at once; every distinct run of letters or symbols is encoded once, by the library's model.

    For a tokenizer that composes, lower-cases, and cuts into letters, single
    digits and symbols, such runs never influence each other. What doesn't fit
    (an apostrophe that may start a contraction, names of special tokens,
    characters outside plain letters beyond ASCII) is found when a run is first
    seen; the whole stretch between white space around it then goes through the
    library's own pipeline. At most REMEMBERED runs are kept.
    """

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.hasher, self.classes, self.byte_letters = SpanHasher(), _classes(), _byte_letters()
        self.lower = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        # Known runs by hash, each a stretch of the flat ids; an odd run has the length -1.
        self.keys = np.empty(0, dtype=np.uint64)
        self.starts, self.sizes = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.int32)

    def _run_ids(self, raw: bytes) -> list[int] | None:
        text = raw.decode("utf-8", "replace")
        if text.isascii():
            if "'" in text or "<|" in text:
                return None
            if text.isprintable():  # printable ASCII stands for itself
                return [t.id for t in self.tokenizer.model.tokenize(text)]
        else:
            lowered = text.lower()
            plain = text.isalpha() and lowered.isalpha() and "\u03a3" not in text
            if not plain or not unicodedata.is_normalized("NFC", text):
                return None
            raw = lowered.encode()
        return [t.id for t in self.tokenizer.model.tokenize("".join(map(self.byte_letters.__getitem__, raw)))]

    def _learn(self, keys: np.ndarray, raws: list[bytes]) -> None:
        ids, sizes = [], []
        for raw in raws:
            found = self._run_ids(raw)
            sizes.append(-1 if found is None else len(found))
            ids += found or []
        sizes = np.array(sizes, dtype=np.int64)
        starts = len(self.flat) + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        self.flat = np.concatenate([self.flat, np.array(ids, dtype=np.int32)])
        # Both lists of keys are in order, so the new ones are let in where they belong.
        at = np.searchsorted(self.keys, keys)
        self.keys, self.starts, self.sizes = (
            np.insert(known, at, new) for known, new in ((self.keys, keys), (self.starts, starts), (self.sizes, sizes))
        )

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys stand among the known ones; -1 if nowhere."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        kinds = self.classes[data]
        cut = np.empty(len(data), dtype=bool)
        cut[0] = True
        cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        begins = np.flatnonzero(cut)
        ends = np.append(begins[1:], len(data))
        solid = kinds[begins] != _SPACE
        # The stretch between white space that each run belongs to.
        stretch = np.cumsum(~solid)[solid]
        begins, ends = begins[solid], ends[solid]
        lowered = self.lower[data]
        keys, first, which = distinct(self.hasher.hashes(lowered, begins, ends))
        if len(self.keys) > REMEMBERED:
            self.forget()
        new = np.flatnonzero(self._places(keys) < 0)
        if len(new):
            # ASCII letters are lower-cased for the hash; a run beyond ASCII is lower-cased as a whole when it is learnt.
            raw = lowered.tobytes()
            spans = zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self._learn(keys[new], [raw[a:b] for a, b in spans])
        place = self._places(keys)[which]
        sizes, starts, flat = self.sizes[place], self.starts[place], self.flat
        odd = np.unique(stretch[sizes < 0])
        if len(odd):
            low, high = np.searchsorted(stretch, odd), np.searchsorted(stretch, odd, side="right")
            raw = data.tobytes()
            spans = zip(begins[low].tolist(), ends[high - 1].tolist(), strict=True)
            wholes = [raw[a:b].decode("utf-8", "replace") for a, b in spans]
            found = [e.ids for e in self.tokenizer.encode_batch(wholes, add_special_tokens=False)]
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                sizes[a:b] = 0
            sizes[low] = lengths = np.array([len(f) for f in found], dtype=np.int64)
            starts[low] = len(flat) + np.cumsum(lengths) - lengths
            flat = np.concatenate([flat, np.array([i for f in found for i in f], dtype=np.int32)])
        behind = np.cumsum(sizes)
        total = int(behind[-1]) if len(behind) else 0
        ids = flat[np.repeat(starts - behind + sizes, sizes) + np.arange(total)]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        upto = np.append(0, behind)[np.searchsorted(begins, text_ends)]
        return ids, np.diff(upto, prepend=0)


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with ``end_id`` behind each text."""
    return np.insert(ids, np.cumsum(counts), end_id)


def _encoder(tokenizer_json: str) -> Encoder:
    """The encoder of this worker process: one, whatever the number of its tasks, with the runs it remembers.

    Functions reach the workers by value, so a task has no module of this package to keep things in.
    """
    kept = sys.modules.setdefault("_farekit_kept", types.ModuleType("_farekit_kept"))
    name = f"encoder_{zlib.crc32(tokenizer_json.encode())}_{len(tokenizer_json)}"
    if not hasattr(kept, name):
        kept.__dict__.clear()
        setattr(kept, name, Encoder(tokenizer_json))
    return getattr(kept, name)


def _encode(tokenizer_json: str, end_id: int, kind: str):
    """Batches of (doc_id, body) to (doc_id, n_ids, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(tokenizer_json)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                texts, size, first = [], 0, start
                while start < batch.num_rows and size < ENCODED_BYTES:
                    texts.append(batch.column(1)[start].as_py() or b"")
                    size, start = size + len(texts[-1]) + 1, start + 1
                ids, counts = encoder.encode(texts)
                ids, counts = _with_ends(ids, counts, end_id).astype(kind), counts + 1
                raw, stops = ids.tobytes(), (np.cumsum(counts) * ids.itemsize).tolist()
                out = [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, start - first), pa.array(counts), pa.array(out, pa.binary())],
                    names=["doc_id", "n_ids", "ids"],
                )

    return run


def _shard_of(doc_ids: list, pieces: list[bytes], part: int, piece: int, first_rule: int) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(pieces), dtype=f"<u{symbol_bits(first_rule) // 8}")
    lengths = np.array([len(p) // ids.itemsize for p in pieces], dtype="<i8")
    left, right, body = compress(ids, np.cumsum(lengths), first_rule)
    shard = {
        "part": part,
        "piece": piece,
        "doc_ids": np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        "has_id": np.array([d is not None for d in doc_ids], dtype="u1").tobytes(),
        "lengths": lengths.tobytes(),
        "n_ids": len(ids),
        "first_rule": first_rule,
        "rule_left": left.tobytes(),
        "rule_right": right.tobytes(),
        "rule_length": _narrow(rule_lengths(left, right, first_rule)),
        "body": body.tobytes(),
    }
    return pa.RecordBatch.from_pylist([shard], schema=_ARROW)


def _compress_parts(first_rule: int):
    """Each sorted partition to its shard; a partition of far more ids than the mean is cut, in order, into pieces."""

    width = symbol_bits(first_rule) // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, found, size, part, piece = [], [], 0, 0, 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids")), strict=True)
            for doc_id, part, ids in rows:
                doc_ids.append(doc_id)
                found.append(ids)
                size += len(ids) // width
                if size >= 2 * SHARD_IDS:
                    yield _shard_of(doc_ids, found, part, piece, first_rule)
                    doc_ids, found, size, piece = [], [], 0, piece + 1
        if doc_ids:
            yield _shard_of(doc_ids, found, part, piece, first_rule)

    return run


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write compressed shards in ascending doc_id order.

    Null texts are empty, null ids come first, equal ids are ordered by a hash
    of their ids; an empty table gives no shard. Encoding happens where the
    texts lie. Only ids move: they are ranged by doc_id into parts of about
    SHARD_IDS ids, or into RANGES larger ones that are cut into shards of twice
    as many at most; each part is sorted and compressed by its own task. Texts
    of any length are encoded whole, and extra columns are ignored. The
    tokenizer file is read here and sent along, so executors need no copy.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer_json = file.read()
    first_rule = max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body"))
    kind = f"<u{symbol_bits(first_rule) // 8}"
    encoded = stage(narrow.mapInArrow(_encode(tokenizer_json, end_id, kind), "doc_id long, n_ids long, ids binary"), "encoded")
    total = encoded.agg(F.sum("n_ids")).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids").asc()]
    parts = (
        encoded.repartitionByRange(min(max(1, -(-total // SHARD_IDS)), RANGES), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", F.spark_partition_id().alias("part"), "ids")
    )
    parts.mapInArrow(_compress_parts(first_rule), _FORMAT).write.parquet(path)


# --- reading -----------------------------------------------------------------------------------------------------


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            ids = decode(shard).astype("<u4")
            lengths = np.frombuffer(shard["lengths"], dtype="<i8")
            stops = np.cumsum(lengths)
            doc_ids = pa.array(np.frombuffer(shard["doc_ids"], "<i8"), mask=np.frombuffer(shard["has_id"], "u1") == 0)
            crc = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(stops.tolist(), lengths.tolist(), strict=True)]
            same = np.ones(len(lengths), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids, pa.array(same * shard["part"]), pa.array(same * shard["piece"]), pa.array(stops - lengths),
                    pa.array(lengths), pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "part", "piece", "offset", "n_tokens", "ids_crc32"],
            )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before. Shards are added up in two
    steps, by thousands of parts and then within them, so that no task sees all.
    """
    shards = spark.read.schema(_FORMAT).parquet(path)
    thousand = F.floor(F.col("part") / 1000)
    sums = shards.select("part", "piece", "n_ids", thousand.alias("thousand"))
    coarse = sums.groupBy("thousand").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(F.col("thousand").alias("__thousand"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("thousand").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(coarse, F.col("thousand") == F.col("__thousand"))
        .select(F.col("part").alias("__part"), F.col("piece").alias("__piece"), (F.col("base") + F.col("inner")).alias("shard_start"))
    )
    starts = stage(starts, "shard-starts")
    schema = "doc_id long, part int, piece int, offset long, n_tokens long, ids_crc32 long"
    docs = shards.mapInArrow(_documents, schema)
    return docs.join(starts, (F.col("part") == F.col("__part")) & (F.col("piece") == F.col("__piece"))).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
