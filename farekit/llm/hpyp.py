"""Hierarchical Pitman-Yor bigram model: fitted, sampled and applied in cells of word pairs.

Every text is its words and an end token; the first word's context is the end
token, so each token is a context exactly once. Each context has a restaurant
whose customers are the tokens that followed it. All of these share one parent,
the restaurant of single words, whose base is uniform over the known words and
one slot for an unknown one.

Nothing global is ever in one place. A pair of words (u, w) belongs to the cell
of the slice of u and the slice of w, so a frequent context spreads over all
cells of its row and a frequent word over all of its column. Texts are reduced
to their distinct pairs block by block before anything moves, and the pairs
bring along which documents of the block they occur in: cells give back sums by
document, never probabilities to be looked up. What cells must know of a word
(its count, its tables, its probability in the parent restaurant) comes from
the word's bucket, which hears from the cells of the word's row and column
only. Cells see the pairs again in each round through the same shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farekit.llm.spans import SpanHasher, distinct

# Discount and strength of the contexts' restaurants and of their parent.
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
# Rounds of messages between cells and words; sweeps of each round, of which the first half is not averaged.
ROUNDS = 2
SWEEPS = 4
# Customers of a dish up to which the law of its tables is tabled; below, terms of such laws that are held at a time.
TABLED = 1024
# Tables, by customers to the power of the discount, up to which the law of more customers comes from an expansion.
EXPANDED = 2.5
TERMS = 4_000_000
# Text that is reduced to pairs at a time, and text hashed at a time.
BLOCK_BYTES = 15_000_000
HASHED_BYTES = 1_000_000
SEED = 7

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# No hash of a word is likely to be this number; it stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)

_REQUEST = "cell int, block long, kind int, heads binary, pairs binary, small binary"
_MESSAGE = "q int, cell int, side int, keys binary, counts binary, tables binary, seats binary"
_REPLY = "cell int, q int, side int, a binary, b binary, n double, v double, m double, k double"
_PARTIAL = "block long, kind int, docs binary, base binary, known binary, score binary, tokens double, types double"
_SCORED = (
    "doc_id long, in_training boolean, n_tokens long, n_known long, base_sum double, score double, tokens double, types double"
)
_KINDS = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(),
}

CONTEXT, WORD, OWN, TOTAL = range(4)


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in fields.split(", "))])


def _table(rows: list[dict], fields: str) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_schema(fields))


def _pack(*arrays: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers that are mostly small, or few different ones."""
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([a.astype(kind) for a in arrays]).tobytes())


def _unpack(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


# --- texts to pairs ----------------------------------------------------------------------------------------------


def tokens(bodies: list[bytes], hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts in a row, end tokens included, and how many each text has."""
    data = _LOWER[np.frombuffer(b"\n".join(bodies) + b"\n", dtype=np.uint8)]
    solid = ~_BLANK[data]
    edges = np.diff(solid.astype(np.int8), prepend=0)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    words = hasher.hashes(data, begins, ends)
    text_ends = np.cumsum([len(b) + 1 for b in bodies])
    upto = np.searchsorted(begins, text_ends)
    return np.insert(words, upto, END), np.diff(upto, prepend=0) + 1


def bucket(keys: np.ndarray, side: int) -> np.ndarray:
    """The word's bucket out of side x side; modulo ``side`` it is the word's row and column of cells."""
    return ((keys >> np.uint64(20)) % np.uint64(side * side)).astype(np.int64)


def _block_rows(stream: np.ndarray, sizes: np.ndarray, training: np.ndarray, side: int) -> Iterator[tuple[int, dict]]:
    """The pairs of one block by cell: each context with its words, training counts and documents."""
    words, _, place = distinct(stream)
    document = np.repeat(np.arange(len(sizes)), sizes)
    # Context, word and document as one number where that fits; the order is the same either way.
    code = np.concatenate([[np.searchsorted(words, END)], place[:-1]])
    code *= len(words)
    code += place
    if len(words) ** 2 * len(sizes) < 2**63:
        code *= len(sizes)
        code += document
        code.sort()
        code, document = np.divmod(code, len(sizes))
    else:
        order = np.argsort(code, kind="stable")
        code, document = code[order], document[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = code[1:] != code[:-1]
    new_document = new.copy()
    new_document[1:] |= document[1:] != document[:-1]
    # One entry per pair and document, one per pair.
    entry = np.flatnonzero(new_document)
    times = np.diff(np.append(entry, len(code)))
    entry_document = document[entry]
    first = np.flatnonzero(new[entry])
    taught = np.add.reduceat(np.where(training[entry_document], times, 0), first)
    documents = np.diff(np.append(first, len(entry)))
    pair = code[entry[first]]
    context, word = pair // len(words), pair % len(words)
    slices = bucket(words, side) % side
    cell = slices[context] * side + slices[word]
    by_cell = np.argsort(cell.astype(np.uint16) if side < 256 else cell, kind="stable")
    bounds = np.searchsorted(cell[by_cell], np.arange(side * side + 1))
    for c in range(side * side):
        mine = by_cell[bounds[c] : bounds[c + 1]]
        if not len(mine):
            continue
        u = context[mine]
        head = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        runs = np.diff(np.append(head, len(mine)))
        n = documents[mine]
        at = np.repeat(first[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield c, {
            "heads": words[u[head]].tobytes(),
            "pairs": words[word[mine]].tobytes(),
            "small": _pack(runs, taught[mine], n, entry_document[at], times[at]),
        }


def _requests(side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, blocks = SpanHasher(), 0
        task = TaskContext.get().partitionId()

        def block() -> Iterator[pa.RecordBatch]:
            name = (task << 32) + blocks
            stream, sizes, training = np.concatenate(streams), np.concatenate(counts), np.array(taught)
            for cell, row in _block_rows(stream, sizes, training, side):
                yield pa.RecordBatch.from_pylist([{"cell": cell, "block": name, "kind": 0, **row}], schema=_schema(_REQUEST))
            info = {
                "heads": np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
                "pairs": sizes.astype("<i8").tobytes(),
                "small": _pack(np.array([i is not None for i in ids]), training),
            }
            yield pa.RecordBatch.from_pylist(
                [{"cell": hash(name) % (side * side), "block": name, "kind": 1, **info}], schema=_schema(_REQUEST)
            )

        streams, counts, ids, taught, size = [], [], [], [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                bodies, hashed = [], 0
                while start < batch.num_rows and hashed < HASHED_BYTES:
                    bodies.append(batch.column(1)[start].as_py() or b"")
                    ids.append(batch.column(0)[start].as_py())
                    taught.append(bool(batch.column(2)[start].as_py()))
                    hashed, start = hashed + len(bodies[-1]) + 1, start + 1
                stream, sizes = tokens(bodies, hasher)
                streams.append(stream)
                counts.append(sizes)
                size += hashed
                if size >= BLOCK_BYTES:
                    yield from block()
                    blocks += 1
                    streams, counts, ids, taught, size = [], [], [], [], 0
        if ids:
            yield from block()

    return run


# --- seating -----------------------------------------------------------------------------------------------------


def _log_partitions(most: int, discount: float) -> np.ndarray:
    """Entry (c, t): the log of the summed weights of all seatings of c customers at t tables.

    A table with k customers weighs (1 - discount)(2 - discount)...(k - 1 - discount). One more customer sits
    down at a new table, or at one of t old ones, which weigh c - discount x t in all.
    """
    table = np.full((most + 1, most + 1), -np.inf)
    table[1, 1] = 0.0
    for c in range(1, most):
        table[c + 1, 1 : c + 1] = table[c, 1 : c + 1] + np.log(c - discount * np.arange(1, c + 1))
        table[c + 1, 2 : c + 2] = np.logaddexp(table[c + 1, 2 : c + 2], table[c, 1 : c + 1])
    return table


def _log_many(customers: int, t: np.ndarray, discount: float) -> np.ndarray:
    """The same for many customers, but for a term of c alone: log of 1 / t! [x^c] (1 - (1 - x)^discount)^t / discount^t.

    For few tables the coefficient is the sum over the binomial expansion, whose terms fall like c^-discount; for more
    it is that of the saddle point of its generating function, whose error falls with t and hardly differs between
    neighbours.
    """
    c = np.full(len(t), float(customers))
    ratio = c / t
    # The saddle point solves x g'(x) / g(x) = c / t for g = 1 - (1 - x)^discount; v = 1 - x is found on a log scale.
    low, high = np.full(len(c), -700.0), np.full(len(c), -1e-12)
    for _ in range(60):
        middle = (low + high) / 2
        v = np.exp(middle)
        above = discount * (1 - v) * np.exp(middle * (discount - 1)) > -ratio * np.expm1(middle * discount)
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    v = np.exp(low)
    g = -np.expm1(low * discount)
    spread = c * np.maximum(1 + (1 - discount) * (1 - v) / v - ratio, 1e-12)
    log_x = np.log1p(-v)
    gamma = np.array([math.lgamma(x + 1) for x in range(int(t.max()) + 1)]) if len(t) else np.zeros(1)
    coefficient = t * np.log(g) - c * log_x - 0.5 * np.log(2 * np.pi * spread)
    few = np.flatnonzero(t <= EXPANDED * c**discount)
    if len(few):
        n = float(customers)
        binomial, total = np.zeros(len(few)), np.zeros(len(few))
        for j in range(1, min(int(t[few].max()), 120) + 1):
            with np.errstate(divide="ignore"):
                binomial += np.log(np.maximum(t[few] - j + 1, 0)) - math.log(j)
            if abs(discount * j - round(discount * j)) > 1e-9:
                scale = math.lgamma(n - discount * j) - math.lgamma(n - discount)
                total += (-1) ** j * np.exp(binomial + scale) / math.gamma(-discount * j)
        coefficient[few] = np.log(np.maximum(total, 1e-300)) + math.lgamma(n - discount) - math.lgamma(n + 1)
    return coefficient - t * math.log(discount) - gamma[t]


def _middle(c: np.ndarray, fresh: np.ndarray, discount: float) -> np.ndarray:
    """About the mean number of tables: that of the tilted law whose mean number of customers is c."""
    low, high = np.full(len(c), -700.0), np.full(len(c), -1e-12)
    for _ in range(60):
        middle = (low + high) / 2
        above = fresh * (-np.expm1(middle)) * np.exp(middle * (discount - 1)) > c
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return np.clip(fresh / discount * -np.expm1(low * discount), 1, c)


def _draw(logs: np.ndarray, first: np.ndarray, rng: np.random.Generator, sweeps: int) -> np.ndarray:
    """Independent draws of first + place by rows of log weights; one column a sweep."""
    weights = np.exp(logs - logs.max(axis=1, keepdims=True))
    upto = np.cumsum(weights, axis=1)
    chance = rng.random((len(logs), sweeps)) * upto[:, -1:]
    return first[:, None] + (upto[:, None, :] <= chance[:, :, None]).sum(axis=2)


def seat(
    customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator, sweeps: int = SWEEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each dish: the mean over the later half of the sweeps, and the last state.

    ``fresh`` is the weight of a new table: (strength + discount x tables of the
    restaurant) x probability of the dish in the parent. A table with k
    customers weighs k - discount. No customer means no table, one customer one.

    A sweep reseats all customers of a dish at once, given everything else: a
    Gibbs step that draws the number of its tables from its law, fresh^t times
    the weight of all seatings at t tables. Up to TABLED customers the law is
    tabled; beyond, its terms come from an expansion or the saddle point, and
    only those within ten standard deviations of the middle are looked at. The cost of a draw
    does not grow with the number of customers.
    """
    tables = (customers > 0).astype(np.float64)
    last = (customers > 0).astype(np.int64)
    many = np.flatnonzero(customers > 1)
    if not len(many):
        return tables, last
    many = many[np.argsort(customers[many], kind="stable")]
    c, w = customers[many].astype(np.int64), np.maximum(fresh[many], 1e-300)
    drawn = np.empty((len(many), sweeps), dtype=np.int64)
    small = int(np.searchsorted(c, TABLED, side="right"))
    partitions = _log_partitions(int(c[small - 1]), discount) if small else np.zeros((1, 1))
    begin = 0
    while begin < small:
        # Dishes with equal numbers of customers side by side, a bounded number of terms at a time.
        n = int(c[begin])
        end = min(int(np.searchsorted(c, n, side="right")), begin + max(1, TERMS // (n * sweeps)))
        logs = partitions[n, 1 : n + 1] + np.arange(1, n + 1) * np.log(w[begin:end, None])
        drawn[begin:end] = _draw(logs, np.ones(end - begin, dtype=np.int64), rng, sweeps)
        begin = end
    middle = _middle(c[small:].astype(np.float64), w[small:], discount)
    reach = (10 * np.sqrt(middle) + 10).astype(np.int64)
    least = np.maximum(middle.astype(np.int64) - reach, 1)
    most = np.minimum(middle.astype(np.int64) + reach, c[small:] - 1)
    for i, (a, b) in enumerate(zip(least, most, strict=True)):
        t = np.arange(a, b + 1)
        logs = _log_many(int(c[small + i]), t, discount) + t * np.log(w[small + i])
        drawn[small + i] = _draw(logs[None], np.array([a]), rng, sweeps)[0]
    tables[many] = drawn[:, sweeps // 2 :].mean(axis=1)
    last[many] = drawn[:, -1]
    return tables, last


# --- cells -------------------------------------------------------------------------------------------------------


class _Cell:
    """The merged pairs of a cell, and where the requests' pairs stand among them."""

    def __init__(self, requests: pa.Table, side: int) -> None:
        rows = sorted(requests.to_pylist(), key=lambda r: (r["kind"], r["block"]))
        self.infos = [r for r in rows if r["kind"] == 1]
        self.parts = []
        contexts, words, taught = [], [], []
        for row in rows:
            if row["kind"]:
                continue
            heads, pairs = np.frombuffer(row["heads"], "<u8"), np.frombuffer(row["pairs"], "<u8")
            small, n, p = _unpack(row["small"]), len(heads), len(pairs)
            contexts.append(np.repeat(heads, small[:n]))
            words.append(pairs)
            taught.append(small[n : n + p])
            documents = small[n + p : n + 2 * p]
            rest = small[n + 2 * p :]
            self.parts.append((row["block"], documents, rest[: len(rest) // 2], rest[len(rest) // 2 :]))
        none = np.empty(0, dtype=np.uint64)
        u, w = (np.concatenate(x) if x else none for x in (contexts, words))
        # One number for a pair; both words are random 64-bit numbers already.
        key = (u * np.uint64(0x9E3779B97F4A7C15)) ^ (w * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
        _, first, self.which = distinct(key)
        self.count = np.bincount(self.which, np.concatenate(taught) if taught else None, len(first)).astype(np.int64)
        self.contexts, _, self.context = distinct(u[first])
        self.words, _, self.word = distinct(w[first])
        self.side = side

    def _by_bucket(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        q = bucket(keys, self.side)
        order = np.argsort(q, kind="stable")
        found, starts = np.unique(q[order], return_index=True)
        for k, a, b in zip(found.tolist(), starts, np.append(starts[1:], len(order)), strict=True):
            yield k, order[a:b]

    def messages(self, cell: int, tables: np.ndarray, seats: np.ndarray) -> pa.Table:
        """To the words' buckets: counts and tables of contexts, tables of words; to the cell's later self: the tables."""
        rows = []
        counts = np.bincount(self.context, self.count, len(self.contexts))
        own = np.bincount(self.context, tables, len(self.contexts))
        for q, at in self._by_bucket(self.contexts):
            rows.append(
                {
                    "q": q, "cell": cell, "side": CONTEXT, "keys": self.contexts[at].tobytes(),
                    "counts": _pack(counts[at], kind="<u8"), "tables": _pack(own[at], kind="<f4"), "seats": b"",
                }
            )
        mean = np.bincount(self.word, tables, len(self.words))
        now = np.bincount(self.word, seats, len(self.words))
        for q, at in self._by_bucket(self.words):
            rows.append(
                {
                    "q": q, "cell": cell, "side": WORD, "keys": self.words[at].tobytes(), "counts": b"",
                    "tables": _pack(mean[at], kind="<f4"), "seats": _pack(now[at], kind="<u8"),
                }
            )
        many = _pack(tables[self.count > 1], kind="<f4")
        rows.append({"q": cell, "cell": cell, "side": OWN, "keys": b"", "counts": b"", "tables": many, "seats": b""})
        return _table(rows, _MESSAGE)

    def hear(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict]:
        """Count and tables of each context, the parent's number of each word, the cell's own tables, the totals."""
        count, tables = np.zeros(len(self.contexts)), np.zeros(len(self.contexts))
        parent = np.zeros(len(self.words))
        own = (self.count > 0).astype(np.float64)
        totals: dict = {}
        rows = {(r["side"], r["q"]): r for r in replies.to_pylist()}
        for q, at in self._by_bucket(self.contexts):
            count[at] = _unpack(rows[CONTEXT, q]["a"], "<u8")
            tables[at] = _unpack(rows[CONTEXT, q]["b"], "<f4")
        for q, at in self._by_bucket(self.words):
            parent[at] = _unpack(rows[WORD, q]["a"], "<f4")
        for (side, _), row in rows.items():
            totals = row["totals"]
            if side == OWN:
                own[self.count > 1] = _unpack(row["a"], "<f4")
        return count, tables, parent, own, totals


def _first_messages(side: int):
    def run(requests: pa.Table) -> pa.Table:
        cell = requests.column("cell")[0].as_py()
        pairs = _Cell(requests, side)
        one = (pairs.count > 0).astype(np.int64)
        return pairs.messages(cell, one.astype(np.float64), one)

    return run


def _next_messages(side: int, turn: int, sweeps: int):
    def run(requests: pa.Table, replies: pa.Table) -> pa.Table:
        cell = requests.column("cell")[0].as_py()
        pairs = _Cell(requests, side)
        _, tables, parent, _, totals = pairs.hear(replies)
        fresh = (STRENGTH + DISCOUNT * tables[pairs.context]) * _single(parent, totals)[pairs.word]
        rng = np.random.default_rng([SEED, turn, cell])
        return pairs.messages(cell, *seat(pairs.count, fresh, DISCOUNT, rng, sweeps))

    return run


def _single(parent: np.ndarray, totals: dict) -> np.ndarray:
    """Probabilities in the parent restaurant, from numerators of words and the sums over all buckets."""
    rest = (ROOT_STRENGTH + ROOT_DISCOUNT * totals.get("k", 0)) / (totals.get("v", 0) + 1)
    return (parent + rest) / (ROOT_STRENGTH + totals.get("m", 0))


def _sums(side: int):
    """Scores of the documents by block: each pair's probability times how often a document has it."""

    def run(requests: pa.Table, replies: pa.Table) -> pa.Table:
        pairs = _Cell(requests, side)
        count, tables, parent, own, totals = pairs.hear(replies)
        single = _single(parent, totals)
        known, every = count[pairs.context], tables[pairs.context]
        seated = pairs.count - DISCOUNT * own + (STRENGTH + DISCOUNT * every) * single[pairs.word]
        score = np.log10(seated / (STRENGTH + known))
        base = np.log10(known + 1)
        rows, done = [], 0
        sums = {"tokens": totals.get("n"), "types": totals.get("v")}
        for block, documents, document, times in pairs.parts:
            mine = np.repeat(pairs.which[done : done + len(documents)], documents)
            done += len(documents)
            size = int(document.max()) + 1 if len(document) else 0
            at = np.flatnonzero(np.bincount(document, minlength=size))
            rows.append(
                {
                    "block": block, "kind": 0, "docs": _pack(np.diff(at, prepend=0)),
                    "base": np.bincount(document, base[mine] * times, size)[at].astype("<f8").tobytes(),
                    "known": _pack(np.bincount(document, (known[mine] > 0) * times, size)[at]),
                    "score": np.bincount(document, score[mine] * times, size)[at].astype("<f4").tobytes(), **sums,
                }
            )
        for row in pairs.infos:
            info = {"block": row["block"], "kind": 1, "docs": row["heads"], "base": row["pairs"], "known": row["small"]}
            rows.append({**info, "score": b"", **sums})
        return _table(rows, _PARTIAL)

    return run


def _documents(partials: pa.Table) -> pa.Table:
    """The sums of a block's cells, by document."""
    rows = partials.to_pylist()
    info = next(r for r in rows if r["kind"] == 1)
    ids, sizes = np.frombuffer(info["docs"], "<i8"), np.frombuffer(info["base"], "<i8")
    flags = _unpack(info["known"])
    base, known, score = np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids))
    # A cell that has only the names of documents hears of no sums; every document has a pair in some cell.
    sums = next((r for r in rows if r["tokens"] is not None), {"tokens": 0.0, "types": 0.0})
    for row in sorted((r for r in rows if r["kind"] == 0), key=lambda r: (len(r["docs"]), r["docs"], r["score"])):
        at = np.cumsum(_unpack(row["docs"]).astype(np.int64))
        base[at] += np.frombuffer(row["base"], "<f8")
        known[at] += _unpack(row["known"])
        score[at] += np.frombuffer(row["score"], "<f4")
    arrays = [
        pa.array(ids, mask=flags[: len(ids)] == 0), pa.array(flags[len(ids) :] == 1), pa.array(sizes), pa.array(known),
        pa.array(base), pa.array(score), pa.array(np.full(len(ids), sums["tokens"])), pa.array(np.full(len(ids), sums["types"])),
    ]
    return pa.Table.from_arrays(arrays, schema=_schema(_SCORED))


# --- words -------------------------------------------------------------------------------------------------------


def _known(messages: pa.Table) -> pa.Table:
    """How many different training tokens a bucket has. Each is a context, and each has a seat in the parent restaurant."""
    rows = [r for r in messages.select(["side", "keys", "counts"]).to_pylist() if r["side"] == CONTEXT]
    found = [np.frombuffer(r["keys"], "<u8")[_unpack(r["counts"], "<u8") > 0] for r in rows]
    return pa.table({"v": pa.array([float(len(np.unique(np.concatenate(found)))) if found else 0.0])})


def _word_replies(turn: int, sweeps: int):
    """One bucket of words: their counts, their tables as contexts, and their seats in the parent restaurant.

    Messages bring along the number of known words of all buckets, which is
    also the number of tables in the parent restaurant before the first
    reseating. Replies carry numerators only; the sums over all buckets follow.
    """

    def run(messages: pa.Table) -> pa.Table:
        rows = sorted(messages.to_pylist(), key=lambda r: (r["side"], r["cell"]))
        q = rows[0]["q"]
        keys = [np.frombuffer(r["keys"], "<u8") for r in rows]
        words, _, place = distinct(np.concatenate(keys))
        spots = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        count, tables, mean = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words))
        seats = np.zeros(len(words), dtype=np.int64)
        for row, at in zip(rows, spots, strict=True):
            if row["side"] == CONTEXT:
                count[at] += _unpack(row["counts"], "<u8")
                tables[at] += _unpack(row["tables"], "<f4")
            elif row["side"] == WORD:
                mean[at] += _unpack(row["tables"], "<f4")
                seats[at] += _unpack(row["seats"], "<u8").astype(np.int64)
        known = float((count > 0).sum())
        every = rows[0]["known"]
        rng = np.random.default_rng([SEED, turn, q, 1])
        fresh = np.full(len(words), (ROOT_STRENGTH + ROOT_DISCOUNT * every) / (every + 1))
        above, _ = seat(seats, fresh, ROOT_DISCOUNT, rng, sweeps)
        parent = mean - ROOT_DISCOUNT * above
        n, m, k = float(count.sum()), float(mean.sum()), float(above.sum())
        out = []
        empty = {"n": 0.0, "v": 0.0, "m": 0.0, "k": 0.0}
        for row, at in zip(rows, spots, strict=True):
            reply = {"cell": row["cell"], "q": q, "side": row["side"], **empty}
            if row["side"] == CONTEXT:
                reply |= {"a": _pack(count[at], kind="<u8"), "b": _pack(tables[at], kind="<f4")}
            elif row["side"] == WORD:
                reply |= {"a": _pack(parent[at], kind="<f4"), "b": b""}
            else:
                reply |= {"a": row["tables"], "b": b""}
            out.append(reply)
        out.append({"cell": -1, "q": q, "side": TOTAL, "a": b"", "b": b"", "n": n, "v": known, "m": m, "k": k})
        return _table(out, _REPLY)

    return run


# --- the model ---------------------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, in_training: Column, *, rounds: int = ROUNDS, sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, in_training, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Tokens are the words of the text with A-Z lowered and one end. The model is
    fitted to the rows for which ``in_training`` holds and scores all of them.
    ``score`` is the log10 probability of the whole text, from table counts
    averaged over the kept sweeps of the last round; perplexity is per token.
    ``base_score`` is that of the single words with one added to every count.
    ``n_known`` counts the tokens that occur in the training rows.

    Null and empty texts are one end token. A null ``in_training`` is false;
    null and repeated ids are kept as they are. Without training rows all words
    are unknown and the one slot for them has probability 1. The side of the
    square of cells is the root of ``spark.sql.shuffle.partitions``: set that so
    that a partition fits a task, as for any shuffle. Sampling is seeded by cell
    and word bucket, so a repeated task repeats its result.
    """
    spark = docs.sparkSession
    side = max(1, math.ceil(math.sqrt(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("body"),
        F.coalesce(in_training, F.lit(False)).alias("in_training"),
    )
    requests = narrow.mapInArrow(_requests(side), _REQUEST)
    by_cell = requests.groupBy("cell")
    # Dealt by bucket before the known words are attached, so that counting them and seating read one shuffle.
    messages = by_cell.applyInArrow(_first_messages(side), _MESSAGE).repartition("q")
    known = messages.groupBy("q").applyInArrow(_known, "v double").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("v")).scalar()
    sums = F.struct(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in "nvmk"])
    for turn in range(rounds + 1):
        replies = messages.withColumn("known", known).groupBy("q").applyInArrow(_word_replies(turn, sweeps), _REPLY)
        totals = replies.where(F.col("cell") < 0).agg(sums.alias("totals")).scalar()
        # One subquery a turn: every further mention of the totals would repeat the whole plan so far.
        told = replies.where(F.col("cell") >= 0).drop(*"nvmk").withColumn("totals", totals)
        if turn < rounds:
            cells = by_cell.cogroup(told.groupBy("cell"))
            messages = cells.applyInArrow(_next_messages(side, turn, sweeps), _MESSAGE).repartition("q")
    partials = by_cell.cogroup(told.groupBy("cell")).applyInArrow(_sums(side), _PARTIAL)
    scored = partials.groupBy("block").applyInArrow(_documents, _SCORED)
    return scored.select(
        "doc_id", "in_training", "n_tokens", "n_known", F.col("tokens").cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * F.log10(F.col("tokens") + F.col("types") + 1)).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
