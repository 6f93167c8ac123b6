"""Boosted trees and forests of pyspark.ml, fitted on binned rows.

``GBTRegressor`` and ``RandomForestRegressor`` visit every slot of the assembled
vector for every row, level and tree. Most slots are one-hot: of a block of them
a row has one. Here a row is one code per column, the label's index or the bin
of the number, and each column adds to one cell of the histogram of the row's
node. A one-hot slot's left side is the node less the slot, so the candidates
for a split, their gains and their order are those of the library, and the
fitted model is an object of its class.

Columns that depend on each other go by one code for each combination that the
rows have (``Bundles``); their histograms are summed from its histogram. Of two
sibling nodes only the smaller is added up, the other is the rest of their
parent.

What is drawn for a row follows from a hash of the row, so a fit asks nothing of
the order or the parts of its rows.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.session import even_parts, scratch_path, scratch_scope, shared_dir, stage

# Functions for the executors travel by value, so their machines need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of one block, whose codes and labels are one row of the staged table.
BLOCK_ROWS = 131_072
# Rows that the bins of numbers are found from, at least: the library's own number.
BIN_ROWS = 10_000
# Rounds after which what is left of the labels is taken from the labels anew, and trees of a forest that one pass serves.
FRESH_ROUNDS, TREES_TOGETHER = 25, 10
# Nodes whose histograms are one row of a shuffle, each split by one task.
NODES_TOGETHER = 64
# Blocks that a forest adds up at once: its histograms are larger than a block.
BLOCKS_TOGETHER = 2
# Codes of a bundle at most, those of its columns in the blocks that bundles are chosen by, and the number of these.
BUNDLE_CODES, CHOSEN_CODES, CHOICE_BLOCKS = 2048, 1600, 2

_BLOCKS = "part int, seq int, n int, codes binary, labels binary, hashes binary"
# Arrays stay as they came from Python.
_KEPT = StorageLevel.MEMORY_AND_DISK_DESER
# Beyond any code.
_NEVER = np.int32(2**31 - 1)
_EPSILON = float(np.finfo(float).eps)
# Gains that differ by less are equal but for the order of their sums.
_ALIKE = 1e-9
# Products of columns' widths up to which combinations are found by ticking them off.
_TICKED = 2**22


@dataclass(frozen=True)
class Columns:
    """The codes of a row: their number by column, and the splits that they allow, in the order of the vector's slots."""

    widths: np.ndarray
    column: np.ndarray  # of each candidate
    slot: np.ndarray
    threshold: np.ndarray
    low: np.ndarray  # codes from low to high go right
    high: np.ndarray
    slots: int
    kind: type = np.uint8

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)])


@dataclass(frozen=True)
class Bundles:
    """Columns by groups, each with one code: the place of a row's combination of codes among those that occur.

    A group of one column keeps the column's codes.
    """

    groups: list[tuple[int, ...]]
    keys: list[np.ndarray | None]
    widths: np.ndarray
    decoded: list[np.ndarray]  # of each column, its code for each code of its group
    kind: type = np.uint8

    @classmethod
    def of(cls, columns: Columns, groups: list[tuple[int, ...]], keys: list[np.ndarray | None]) -> Bundles:
        decoded = [np.arange(width) for width in columns.widths]
        for group, known in zip(groups, keys, strict=True):
            if known is not None:
                rest = known
                for j in reversed(group):
                    rest, decoded[j] = np.divmod(rest, columns.widths[j])
        widths = np.array([len(decoded[group[0]]) for group in groups])
        return cls(groups, keys, widths, decoded, _kind(widths))

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)])

    def group_of(self, column: int) -> int:
        return next(i for i, group in enumerate(self.groups) if column in group)

    def encode(self, codes: np.ndarray, columns: Columns) -> np.ndarray:
        made = np.empty((len(self.groups), codes.shape[1]), dtype=self.kind)
        for i, (group, known) in enumerate(zip(self.groups, self.keys, strict=True)):
            made[i] = codes[group[0]] if known is None else np.searchsorted(known, _joint(codes, group, columns))
        return made

    def by_column(self, tally: np.ndarray, columns: Columns) -> np.ndarray:
        """Histograms of the columns from those of the bundles; columns that split alike are summed alike."""
        made, starts, own = np.zeros((*tally.shape[:2], columns.starts[-1])), self.starts, columns.starts
        for i, group in enumerate(self.groups):
            part = tally[:, :, starts[i] : starts[i + 1]]
            for j in group:
                order = np.argsort(self.decoded[j], kind="stable")
                seen, first = np.unique(self.decoded[j][order], return_index=True)
                made[:, :, own[j] + seen] = np.add.reduceat(part[:, :, order], first, axis=2)
        return made


def _kind(widths: np.ndarray) -> type:
    return next(k for k in (np.uint8, np.uint16, np.int32) if widths.max() - 1 <= np.iinfo(k).max)


def _joint(codes: np.ndarray, group: tuple[int, ...], columns: Columns) -> np.ndarray:
    key = codes[group[0]].astype(np.int64)
    for j in group[1:]:
        key *= columns.widths[j]
        key += codes[j]
    return key


def choose_groups(codes: np.ndarray, columns: Columns, most: int = CHOSEN_CODES) -> list[tuple[int, ...]]:
    """Join, again and again, the two groups with the fewest combinations in these rows, while there are few."""
    ranked = {}
    for j, row in enumerate(codes):
        known, rank = np.unique(row, return_inverse=True)
        ranked[(j,)] = (rank, len(known))
    joined = lambda a, b: ranked[a][0] * ranked[b][1] + ranked[b][0]

    def combinations(a, b):
        size = ranked[a][1] * ranked[b][1]
        fits = max(ranked[a][1], ranked[b][1]) <= most and np.prod(columns.widths[[*a, *b]].astype(float)) < 2.0**62
        return np.count_nonzero(np.bincount(joined(a, b), minlength=size)) if fits else most + 1

    names = list(ranked)
    pairs = {(a, b): combinations(a, b) for i, a in enumerate(names) for b in names[i + 1 :]}
    while pairs and min(pairs.values()) <= most:
        a, b = min(pairs, key=pairs.get)
        known, rank = np.unique(joined(a, b), return_inverse=True)
        del ranked[a], ranked[b]
        pairs = {pair: n for pair, n in pairs.items() if not {a, b} & set(pair)}
        others = list(ranked)
        ranked[a + b] = (rank, len(known))
        pairs |= {(other, a + b): combinations(other, a + b) for other in others}
    return list(ranked)


def _bundles(blocks: DataFrame, columns: Columns) -> Bundles:
    """Groups chosen by a few blocks, with the combinations of all rows; a group that has too many falls apart."""
    some = blocks.where("seq = 0").orderBy("part").limit(CHOICE_BLOCKS).collect()
    groups = choose_groups(np.concatenate([_codes(row, columns) for row in some], axis=1), columns)
    several = [group for group in groups if len(group) > 1]

    sizes = [float(np.prod(columns.widths[list(group)].astype(float))) for group in several]

    def seen(rows: Iterable) -> Iterator[list[np.ndarray]]:
        ticks = [np.zeros(int(size), dtype=bool) if size <= _TICKED else None for size in sizes]
        found = [np.zeros(0, dtype=np.int64) for _ in several]
        for row in rows:
            codes = _codes(row, columns)
            for i, group in enumerate(several):
                if ticks[i] is not None:
                    ticks[i][_joint(codes, group, columns)] = True
                elif len(found[i]) <= BUNDLE_CODES:
                    found[i] = np.union1d(found[i], _joint(codes, group, columns))
        yield [(keys if tick is None else np.flatnonzero(tick))[: BUNDLE_CODES + 1] for keys, tick in zip(found, ticks, strict=True)]

    parts = blocks.rdd.mapPartitions(seen).collect() if several else []
    keys = {group: np.unique(np.concatenate([part[i] for part in parts])) for i, group in enumerate(several)}
    kept = []
    for group in groups:
        kept += [group] if len(keys.get(group, ())) <= BUNDLE_CODES else [(j,) for j in group]
    return Bundles.of(columns, kept, [keys.get(group) for group in kept])


@dataclass
class Tree:
    """A tree in the making: node 0 is the root, children are neighbours; a leaf is its own child."""

    column: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [_NEVER])
    high: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    stats: list[tuple] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])  # rows, sum and sum of squares
    split: dict[int, tuple[int, float]] = field(default_factory=dict)  # candidate and gain
    open: list[int] = field(default_factory=lambda: [0])  # nodes of the lowest level
    depth: int = 0

    def values(self) -> np.ndarray:
        return np.array([total / n if n else 0.0 for n, total, _ in self.stats])

    def grow(self, columns: Columns, found: np.ndarray, last: bool) -> None:
        """Split the open nodes as found: rows, sum, squares, candidate (or -1), gain and the left side's three."""
        opened = []
        for node, (n, total, squares, best, gain, *left) in zip(self.open, found.tolist(), strict=True):
            self.stats[node] = (n, total, squares)
            best = int(best)
            if best < 0:
                continue
            self.split[node] = (best, gain)
            self.column[node], self.low[node], self.high[node] = (int(v[best]) for v in (columns.column, columns.low, columns.high))
            self.child[node] = len(self.child)
            for side in (tuple(left), (n - left[0], total - left[1], squares - left[2])):
                opened.append(len(self.child))
                self.column.append(0)
                self.low.append(_NEVER)
                self.high.append(0)
                self.child.append(len(self.child))
                self.stats.append(side)
        self.depth += 1
        self.open = [] if last else opened


def _steps(tree: Tree, nodes: Iterable[int], bundles: Bundles, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How rows go on from these nodes: the bundle that each asks, where its row of the table starts, and the target for each code.

    ``targets`` translates children; a node without a split leads to its own translation.
    """
    least = int(bundles.widths.argmin())
    asked, starts, table, at = [], [], [], 0
    for node in nodes:
        if node in tree.split:
            column, child = tree.column[node], tree.child[node]
            code = bundles.decoded[column]
            right = (code >= tree.low[node]) & (code <= tree.high[node])
            asked.append(bundles.group_of(column))
            table.append(targets[child + right])
        else:
            asked.append(least)
            table.append(np.full(bundles.widths[least], targets[node]))
        starts.append(at)
        at += len(table[-1])
    return np.array(asked), np.array(starts), np.concatenate(table)


def _step(steps: tuple, node: np.ndarray, flat: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    asked, starts, table = steps
    place = (asked * n).take(node)
    place += at
    key = starts.take(node)
    key += flat.take(place)
    return table.take(key)


def _walk(steps: tuple, depth: int, codes: np.ndarray) -> np.ndarray:
    """The node of every row of a block."""
    n = codes.shape[1]
    flat, at = codes.ravel(), np.arange(n)
    node = np.zeros(n, dtype=np.intp)
    for _ in range(depth):
        node = _step(steps, node, flat, at, n)
    return node


def _exits(tree: Tree, bundles: Bundles) -> tuple | None:
    """How rows find their leaves all at once: the leaves, left to right, and for each bundle asked a mask for each code.

    A mask has a bit for each leaf that the code leaves open; a row's leaf is
    the lowest bit that all its masks have. ``None`` beyond 64 leaves.
    """
    leaves, under, waiting = [], {}, [(0, False)]
    while waiting:  # leaves under each node, as a range
        node, left = waiting.pop()
        if left:
            under[node] = (under[node], len(leaves))
        elif node in tree.split:
            under[node] = len(leaves)
            waiting += [(node, True), (tree.child[node] + 1, False), (tree.child[node], False)]
        else:
            under[node] = (len(leaves), len(leaves) + 1)
            leaves.append(node)
    if len(leaves) > 64:
        return None
    masks = {}
    for node in tree.split:
        column = tree.column[node]
        group, code = bundles.group_of(column), bundles.decoded[column]
        right = (code >= tree.low[node]) & (code <= tree.high[node])
        first, last = under[tree.child[node]]
        closed = np.uint64(~(((1 << (last - first)) - 1) << first) & (2**64 - 1))
        mask = masks.setdefault(group, np.full(bundles.widths[group], 2**64 - 1, dtype=np.uint64))
        mask[right] &= closed
    return np.array(leaves), sorted(masks.items())


def _leaf_places(exits: tuple, codes: np.ndarray) -> np.ndarray:
    """The place of every row's leaf among the leaves."""
    _, masks = exits
    if not masks:
        return np.zeros(codes.shape[1], dtype=np.int64)
    (group, mask), *others = masks
    open_ = mask.take(codes[group])
    for group, mask in others:
        open_ &= mask.take(codes[group])
    open_ &= -open_
    # The exponent of a power of two.
    return (open_.astype(float).view(np.int64) >> 52) - 1023


def _targets(tree: Tree, bundles: Bundles, targets: np.ndarray):
    """What finds, for the rows of a block, the target of each row's leaf; ``targets`` go by node."""
    exits = _exits(tree, bundles)
    if exits is not None:
        of_leaf = targets[exits[0]]
        return lambda codes: of_leaf.take(_leaf_places(exits, codes))
    steps, depth = _steps(tree, range(len(tree.child)), bundles, np.arange(len(tree.child))), tree.depth
    return lambda codes: targets.take(_walk(steps, depth, codes))


def _salt(*keys: int) -> np.ndarray:
    return np.random.default_rng(keys).integers(0, 2**32, 2, dtype=np.uint32)


def _mixed(hashes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hashes of the rows' hashes and a salt, evenly over 32 bits."""
    mixed = (hashes ^ salt[0]) * (salt[1] | np.uint32(1))
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        mixed ^= mixed >> np.uint32(shift)
        mixed *= np.uint32(factor)
    mixed ^= mixed >> np.uint32(16)
    return mixed


def _poisson(rate: float, mixed: np.ndarray) -> np.ndarray:
    """Poisson draws from even 32-bit hashes, by the inverse of the distribution."""
    term, reached, limits = np.exp(-rate), 0.0, []
    while reached + term < 1 - 2.0**-32 and len(limits) < 1000:
        reached += term
        limits.append(reached)
        term *= rate / len(limits)
    limits = (np.array(limits) * 2**32).astype(np.uint64)
    return np.searchsorted(limits, mixed, side="right").astype(np.uint16)


def _add(tally: np.ndarray, squares: np.ndarray, columns: Columns | Bundles, node: np.ndarray, codes: np.ndarray, y: np.ndarray, w: np.ndarray | None) -> None:
    """Add a block's rows to the histograms.

    ``tally`` is (sums, nodes, codes of all columns): rows and sum, and squares where the level is the last.
    """
    nodes = tally.shape[1]
    wy = y if w is None else w * y
    wyy = wy * y
    squares += np.bincount(node, weights=wyy, minlength=nodes)
    weights = (w, wy, wyy)[: len(tally)]
    starts = columns.starts
    cell, base = np.empty(len(node), dtype=np.int64), node.astype(np.int64)
    for j, width in enumerate(columns.widths):
        np.multiply(base, width, out=cell)
        np.add(cell, codes[j], out=cell)
        for sums, weight in zip(tally, weights, strict=True):
            found = np.bincount(cell, weights=weight, minlength=nodes * width)
            sums[:, starts[j] : starts[j + 1]] += found.reshape(nodes, width)


def best_splits(columns: Columns, tally: np.ndarray, squares: np.ndarray, fewest: int, allowed: np.ndarray | None = None) -> np.ndarray:
    """For each node its rows, sum, squares, best candidate (-1: a leaf), gain, and rows, sum and squares of the left side."""
    starts = columns.starts
    total = tally[:, :, : starts[1]].sum(axis=2)
    left = np.empty((len(tally), tally.shape[1], len(columns.slot)))
    for j in range(len(columns.widths)):
        mine = np.flatnonzero(columns.column == j)
        if not len(mine):
            continue
        sums = tally[:, :, starts[j] : starts[j + 1]]
        if columns.high[mine[0]] == _NEVER:  # a number: left are the codes below
            left[:, :, mine] = np.cumsum(sums, axis=2)[:, :, columns.low[mine] - 1]
        else:
            left[:, :, mine] = total[:, :, None] - sums[:, :, columns.low[mine]]
    n, lefts = total[0][:, None], left[0]
    rights = n - lefts
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left[1] / lefts - (total[1][:, None] - left[1]) / rights
        gain = lefts * rights / (n * n) * apart * apart
        impurity = squares / total[0] - (total[1] / total[0]) ** 2
    good = (lefts >= fewest) & (rights >= fewest)
    if allowed is not None:
        good &= allowed
    gain = np.where(good, gain, -1.0)
    at = np.arange(len(squares))
    # Of equal gains the first, whatever the order in which the rows were added.
    best = (gain >= gain.max(axis=1, keepdims=True) * (1 - _ALIKE)).argmax(axis=1) if len(columns.slot) else np.zeros(len(at), dtype=int)
    found = np.zeros((len(at), 8))
    found[:, 0], found[:, 1], found[:, 2] = total[0], total[1], squares
    found[:, 3] = -1
    if len(columns.slot):
        split = (gain[at, best] > 0) & (np.abs(impurity) >= _EPSILON)
        found[:, 4] = gain[at, best]
        found[split, 3] = best[split]
        found[:, 5 : 5 + len(tally)] = left[:, at, best].T
    return found


def bin_limits(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between sorted values: all of them, or ``bins`` - 1 at about equal numbers of rows, as in the library."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = len(values) / bins
    target, limits, reached = stride, [], np.cumsum(counts)
    for i in range(1, len(distinct)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            limits.append(middles[i - 1])
            target += stride
    return np.array(limits)


def _codes(row, columns: Columns) -> np.ndarray:
    return np.frombuffer(row["codes"], dtype=columns.kind).reshape(len(columns.widths), row["n"])


def _binned(table: DataFrame, columns: Columns, limits: list[np.ndarray], labels: int) -> DataFrame:
    """The table's rows as blocks of codes: label columns first, then numbers, then the label and the row's hash."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, waiting, rows = TaskContext.get().partitionId(), 0, [], 0

        def block(batch: pa.Table) -> pa.RecordBatch:
            values = [c.to_numpy() for c in batch.columns]
            codes = [v.astype(columns.kind) for v in values[:labels]]
            codes += [np.searchsorted(limit, v).astype(columns.kind) for limit, v in zip(limits, values[labels:-2], strict=True)]
            y, hashes = values[-2].astype(float), values[-1].astype(np.uint32)
            made = [[part], [seq], [len(y)], [np.stack(codes).tobytes()], [y.tobytes()], [hashes.tobytes()]]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            names = ("part", "seq", "n", "codes", "labels", "hashes")
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, types, strict=True)], names)

        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                whole = pa.Table.from_batches(waiting)
                for start in range(0, rows - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield block(whole.slice(start, BLOCK_ROWS))
                    seq += 1
                rest = whole.slice(rows // BLOCK_ROWS * BLOCK_ROWS)
                waiting, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield block(pa.Table.from_batches(waiting))

    return table.mapInArrow(blocks, _BLOCKS)


def _unpacked(flat: np.ndarray, sums: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    nodes = len(flat) // (sums * cells + 1)
    return flat[: sums * nodes * cells].reshape(sums, nodes, cells), flat[sums * nodes * cells :]


def _dealt(blocks: DataFrame, parts: int, columns: Columns, bundles: Bundles) -> RDD:
    """(bundles' codes, hashes, label) of each block, in about equal parts: files are read back in parts by size."""

    def bundled(row):
        hashes, labels = np.frombuffer(row["hashes"], dtype=np.uint32), np.frombuffer(row["labels"])
        return bundles.encode(_codes(row, columns), columns), hashes, labels

    return blocks.select("n", "codes", "hashes", "labels").repartition(parts).rdd.map(bundled)


def _boosted(machine: GBTRegressor, blocks: RDD, columns: Columns, bundles: Bundles) -> tuple[list[Tree], list[float]]:
    """Trees on the residuals of those before, a new draw of rows for each; the first one stands for itself."""
    rate, seed, depth = machine.getSubsamplingRate(), machine.getSeed(), machine.getMaxDepth()
    weights = [1.0] + [machine.getStepSize()] * (machine.getMaxIter() - 1)
    cells, width = int(bundles.starts[-1]), int(columns.starts[-1])
    drawn_under = np.uint32(min(int(rate * 2**32), 2**32 - 1))

    def tallies(rows: RDD, turn: int, tree: Tree, added: list[int], sums: int) -> tuple[np.ndarray, np.ndarray]:
        """The histograms of some open nodes."""
        place = np.full(len(tree.child), -1)
        place[added] = np.arange(len(added))
        places, salt = _targets(tree, bundles, place), _salt(seed, turn)

        def tally(blocks: Iterable) -> Iterator[bytes]:
            made, squares = np.zeros((sums, len(added), cells)), np.zeros(len(added))
            for codes, hashes, left in blocks:
                node = places(codes)
                counted = node >= 0
                if rate < 1:
                    counted &= _mixed(hashes, salt) < drawn_under
                mine = np.flatnonzero(counted)
                values = left.take(mine)
                _add(made, squares, bundles, node.take(mine), codes.take(mine, axis=1), 2 * values if turn else values, None)
            yield np.concatenate([bundles.by_column(made, columns).ravel(), squares])

        # A few thousand numbers for each node from each part.
        return _unpacked(sum(rows.mapPartitions(tally).collect()), sums, width)

    def rest(rows: RDD, some: list[tuple[Tree, float]]) -> RDD:
        """What trees leave of the labels."""
        found = [_targets(tree, bundles, weight * tree.values()) for tree, weight in some]

        def less(block: tuple) -> tuple:
            codes, hashes, left = block
            left = left.copy()
            for values in found:
                left -= values(codes)
            return codes, hashes, left

        return rows.map(less)

    trees: list[Tree] = []
    state, before = blocks.persist(_KEPT), None
    try:
        for turn in range(len(weights)):
            tree = Tree()
            trees.append(tree)
            above = None  # histograms of the nodes that were split
            while tree.open and tree.depth < depth:
                last = tree.depth == depth - 1
                if above is None or last:
                    tally, squares = tallies(state, turn, tree, tree.open, 3 if last else 2)
                else:
                    lefts, rights = tree.open[::2], tree.open[1::2]
                    smaller = [a if tree.stats[a][0] <= tree.stats[b][0] else b for a, b in zip(lefts, rights, strict=True)]
                    some, known = tallies(state, turn, tree, smaller, 2)
                    tally, squares = np.empty((2, len(tree.open), width)), np.empty(len(tree.open))
                    taken = np.array([2 * i + (node != left) for i, (node, left) in enumerate(zip(smaller, lefts, strict=True))])
                    tally[:, taken], tally[:, taken ^ 1] = some, above[0] - some
                    squares[taken], squares[taken ^ 1] = known, above[1] - known
                if before is not None:  # the residuals of this round are held now
                    before.unpersist()
                    before = None
                found = best_splits(columns, tally, squares, machine.getMinInstancesPerNode())
                split = np.flatnonzero(found[:, 3] >= 0)
                above = tally[:, split], squares[split]
                tree.grow(columns, found, last)
            if turn + 1 == len(weights):
                break
            before = state
            if (turn + 1) % FRESH_ROUNDS:
                state = rest(state, [(tree, weights[turn])]).persist(_KEPT)
            else:
                # Lineages stay short without a checkpoint: a lost executor costs these rounds at most.
                state = rest(blocks, list(zip(trees, weights))).persist(_KEPT)
    finally:
        state.unpersist()
        if before is not None:
            before.unpersist()
    return trees, weights


def _forest(machine: RandomForestRegressor, blocks: RDD, columns: Columns, bundles: Bundles) -> list[Tree]:
    """Trees on Poisson draws of the rows; each node splits on its own third of the slots."""
    seed, depth, fewest = machine.getSeed(), machine.getMaxDepth(), machine.getMinInstancesPerNode()
    rate, drawn_slots = machine.getSubsamplingRate(), -(-columns.slots // 3)
    trees = {k: Tree() for k in range(machine.getNumTrees())}
    cells, width = int(bundles.starts[-1]), int(columns.starts[-1])
    # A row's place among its tree's open nodes, or this: it is in none.
    nowhere = 2**depth if 2**depth <= np.iinfo(np.uint16).max else np.iinfo(np.int32).max
    kind = np.uint16 if nowhere <= np.iinfo(np.uint16).max else np.int32

    def together(blocks: Iterable) -> Iterator[tuple]:
        waiting = []
        for block in blocks:
            waiting.append(block)
            if len(waiting) == BLOCKS_TOGETHER:
                yield joined(waiting)
                waiting = []
        if waiting:
            yield joined(waiting)

    def joined(several: list[tuple]) -> tuple:
        codes, hashes, y = zip(*several, strict=True)
        return np.concatenate(codes, axis=1), np.concatenate(hashes), np.concatenate(y)

    rows = blocks.mapPartitions(together).persist(_KEPT)
    state = before = None
    try:
        for first in range(0, len(trees), TREES_TOGETHER):
            growing = {k: trees[k] for k in range(first, min(first + TREES_TOGETHER, len(trees)))}

            def drawn(block, numbers=tuple(growing)):
                codes, hashes, y = block
                weights = {k: _poisson(rate, _mixed(hashes, _salt(seed, k))) for k in numbers}
                return codes, y, weights, {k: np.where(w > 0, 0, nowhere).astype(kind) for k, w in weights.items()}

            state = rows.map(drawn).persist(_KEPT)
            for level in range(depth):
                last = level == depth - 1
                named = {k: list(tree.open) for k, tree in growing.items()}
                sums = 3 if last else 2

                def tally(blocks: Iterable, named=named, sums=sums) -> Iterator[tuple]:
                    made = {k: (np.zeros((sums, len(nodes), cells)), np.zeros(len(nodes))) for k, nodes in named.items()}
                    for codes, y, weights, places in blocks:
                        for k in named:
                            mine = np.flatnonzero(places[k] != nowhere)
                            node, w = places[k].take(mine).astype(np.intp), weights[k].take(mine).astype(float)
                            _add(*made[k], bundles, node, codes.take(mine, axis=1), y.take(mine), w)
                    for k, (counts, squares) in made.items():
                        for start in range(0, len(squares), NODES_TOGETHER):
                            chosen = slice(start, start + NODES_TOGETHER)
                            yield (k, start), np.concatenate([bundles.by_column(counts[:, chosen], columns).ravel(), squares[chosen]])

                def splits(item: tuple, named=named, sums=sums) -> tuple:
                    (k, start), flat = item
                    tally, squares = _unpacked(flat, sums, width)
                    allowed = np.zeros((len(squares), columns.slots), dtype=bool)
                    for i, node in enumerate(named[k][start : start + len(squares)]):
                        allowed[i, np.random.default_rng([seed, k, node]).choice(columns.slots, drawn_slots, replace=False)] = True
                    return k, start, best_splits(columns, tally, squares, fewest, allowed[:, columns.slot])

                tallies = state.mapPartitions(tally).reduceByKey(np.add, partitionFunc=lambda at: at[0] + at[1] // NODES_TOGETHER)
                found = tallies.map(splits).collect()
                if before is not None:
                    before.unpersist()
                    before = None
                steps = {}
                for k, tree in growing.items():
                    tree.grow(columns, np.concatenate([f for _, _, f in sorted((f for f in found if f[0] == k), key=lambda f: f[1])]), last)
                    if tree.open:
                        targets = np.full(len(tree.child), nowhere, dtype=kind)
                        targets[tree.open] = np.arange(len(tree.open))
                        steps[k] = _steps(tree, named[k], bundles, targets)
                growing = {k: growing[k] for k in steps}
                if not growing:
                    break

                def onward(block, steps=steps):
                    codes, y, weights, places = block
                    n, flat = len(y), codes.ravel()
                    moved = {}
                    for k, step in steps.items():
                        moved[k] = np.full(n, nowhere, dtype=kind)
                        mine = np.flatnonzero(places[k] != nowhere)
                        moved[k][mine] = _step(step, places[k].take(mine).astype(np.intp), flat, mine, n)
                    return codes, y, {k: weights[k] for k in steps}, moved

                before, state = state, state.map(onward).persist(_KEPT)
            state.unpersist()
    finally:
        for held in (rows, state, before):
            if held is not None:
                held.unpersist()
    return list(trees.values())


_NODES = ("treeID", "id", "prediction", "impurity", "n", "total", "squares", "gain", "left", "right", "slot", "threshold")


def _nodes(number: int, tree: Tree, columns: Columns) -> list[tuple]:
    """A tree's nodes as the library stores them, in preorder, leaves of one prediction joined as it joins them."""
    predictions = tree.values()
    split = dict(tree.split)
    for node in sorted(split, reverse=True):  # children come behind their parents
        left, right = tree.child[node], tree.child[node] + 1
        if left not in split and right not in split and predictions[left] == predictions[right]:
            del split[node]
            predictions[node] = predictions[left]
    made, waiting = [], [(0, None)]
    while waiting:
        node, right_of = waiting.pop()
        n, total, squares = tree.stats[node]
        mean = total / n if n else 0.0
        place = len(made)
        if right_of is not None:
            made[right_of][9] = place
        row = [number, place, float(predictions[node]), squares / n - mean * mean if n else 0.0, n, total, squares, -1.0, -1, -1, -1, None]
        if node in split:
            best, gain = split[node]
            row[7:] = [gain, place + 1, -1, int(columns.slot[best]), float(columns.threshold[best])]
            waiting += [(tree.child[node] + 1, place), (tree.child[node], None)]
        made.append(row)
    return made


def _as_library_model(spark: SparkSession, machine, kind: type, trees: list[Tree], weights: list[float], columns: Columns):
    """The trees as a model of the library, which reads them as it stores its own."""
    path = scratch_path(spark, "trees")
    name = "org.apache.spark.ml.regression."

    def described(model: str, uid: str, **more) -> str:
        known = {"class": name + model, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps({**known, "paramMap": {}, "defaultParamMap": {"impurity": "variance"}, **more})

    whole = described(kind.__name__, machine.uid, numFeatures=columns.slots, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    single = [(k, described("DecisionTreeRegressionModel", f"{machine.uid}_{k}"), float(w)) for k, w in enumerate(weights)]
    spark.createDataFrame(single, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    rows = list(zip(*(row for k, tree in enumerate(trees) for row in _nodes(k, tree, columns)), strict=True))
    flat = spark.createDataFrame(pa.table({column: pa.array(values) for column, values in zip(_NODES, rows, strict=True)}))
    limits = F.when(F.col("threshold").isNull(), F.array().cast("array<double>")).otherwise(F.array("threshold"))
    split = F.struct(F.col("slot").cast("int").alias("featureIndex"), limits.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = F.struct(
        F.col("id").cast("int").alias("id"), "prediction", "impurity", F.array("n", "total", "squares").alias("impurityStats"),
        F.col("n").cast("long").alias("rawCount"), "gain", F.col("left").cast("int").alias("leftChild"),
        F.col("right").cast("int").alias("rightChild"), split.alias("split"),
    )
    flat.select(F.col("treeID").cast("int").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")
    return kind.load(path)


def _whole(machine) -> bool:
    """Whether the estimator is set to what is done here."""
    plain = not machine.isDefined("weightCol") and machine.getMinInfoGain() == 0 and machine.getMinWeightFractionPerNode() == 0
    if isinstance(machine, GBTRegressor):
        known = machine.getLossType() == "squared" and not machine.isDefined("validationIndicatorCol")
        return plain and known and machine.getFeatureSubsetStrategy() in ("auto", "all")
    several = isinstance(machine, RandomForestRegressor) and machine.getNumTrees() > 1
    return plain and several and machine.getBootstrap() and machine.getFeatureSubsetStrategy() in ("auto", "onethird")


def _columns(labels: list[int], limits: list[np.ndarray], scale: np.ndarray) -> Columns:
    """The splits of one-hot blocks of so many labels, and of numbers at their limits; ``scale`` is that of each slot."""
    splits, slot = [], 0
    for j, size in enumerate(labels):
        splits += [(j, slot + k, scale[slot + k] / 2, k, k) for k in range(size)]
        slot += size
    for j, found in enumerate(limits):
        splits += [(len(labels) + j, slot + j, limit, i + 1, _NEVER) for i, limit in enumerate(found)]
    # A label that the model does not know has the code behind the others, and no slot.
    widths = np.array([size + 1 for size in labels] + [len(found) + 1 for found in limits])
    column, slots, threshold, low, high = (np.array(v) for v in zip(*splits, strict=True)) if splits else [np.zeros(0, dtype=int)] * 5
    return Columns(widths, column, slots, threshold, low, high, slot + len(limits), _kind(widths))


def _is_ours(before: list, machine) -> bool:
    """Whether a pipeline is what is done here, in its stages and in how they are set."""
    if [type(s) for s in before] != [StringIndexer, OneHotEncoder, VectorAssembler, StandardScaler] or not _whole(machine):
        return False
    indexer, encoder, assembler, scaler = before
    labels, encoded = list(indexer.getOutputCols()), list(encoder.getOutputCols())
    return (
        indexer.getHandleInvalid() == "keep" and indexer.getStringOrderType() == "frequencyDesc"
        and list(encoder.getInputCols()) == labels and encoder.getDropLast() and encoder.getHandleInvalid() == "error"
        and assembler.getHandleInvalid() == "skip" and assembler.getInputCols()[: len(encoded)] == encoded
        and scaler.getWithStd() and not scaler.getWithMean() and scaler.getInputCol() == assembler.getOutputCol()
    )


def _prepared(before: list, rows: DataFrame, label: Column) -> tuple[list, Column, int] | None:
    """The fitted stages before the trees, which rows they keep, and how many these are.

    One pass counts labels, another describes the numbers; the deviations of the
    slots follow from both, so that no row is assembled for them. ``None`` where
    a column has no label, no row is kept, or a number to learn is bad.
    """
    indexer, encoder, assembler, scaler = before
    names = list(indexer.getInputCols())
    numbers = assembler.getInputCols()[len(names) :]
    kept = F.lit(True)
    for name in numbers:
        kept = kept & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    long = rows.select(kept.alias("_kept"), *[F.col(name).cast("string").alias(name) for name in names])
    long = long.unpivot(["_kept"], names, "_name", "_label").where("_label IS NOT NULL")
    counted = long.groupBy("_name", "_label").agg(F.count("*").alias("n"), F.count_if("_kept").alias("kept"))
    known = {name: [] for name in names}
    for row in counted.collect():  # as many as the model has labels
        # The most frequent first, equal ones as the library's texts compare.
        known[row["_name"]].append((-row["n"], row["_label"].encode("utf-16-be"), row["_label"], row["kept"]))
    bad = label.isNull() | F.isnan(label) | (F.abs(label) == float("inf"))
    moments = [kind(F.col(name).cast("double")) for kind in (F.avg, F.stddev_samp) for name in numbers]
    n, wrong, *moments = rows.where(kept).agg(F.count("*"), F.count_if(bad), *moments).first()
    if not n or wrong or not all(known.values()):
        return None
    ordered = [sorted(known[name]) for name in names]
    gateway = rows.sparkSession.sparkContext._gateway
    texts = gateway.new_array(gateway.jvm.String, len(names), 0)  # ``from_arrays_of_labels`` fills columns of fewer labels with nulls
    for i, found in enumerate(ordered):
        texts[i] = gateway.new_array(gateway.jvm.String, len(found))
        for j, (_, _, text, _) in enumerate(found):
            texts[i][j] = text
    indexed = indexer._copyValues(
        StringIndexerModel._create_from_java_class("org.apache.spark.ml.feature.StringIndexerModel", indexer.uid, texts)
    )
    ones = np.array([count for found in ordered for *_, count in found], dtype=float)
    mean = np.concatenate([ones / n, moments[: len(numbers)]])
    spread = [deviation or 0.0 for deviation in moments[len(numbers) :]]
    spread = np.concatenate([np.sqrt(ones / n * (n - ones) / max(n - 1, 1)), spread])
    scaled = StandardScalerModel._create_from_java_class(
        "org.apache.spark.ml.feature.StandardScalerModel", scaler.uid, DenseVector(spread), DenseVector(mean)
    )
    return [indexed, encoder.fit(indexed.transform(rows)), assembler, scaler._copyValues(scaled)], kept, n


def fit_trees(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """Fit a pipeline that encodes labels, assembles, scales and ends in boosted trees or a forest.

    The trees are those of the library's estimator but for rounding and for
    what it draws at random: the rows of each tree, the slots of a forest's
    nodes, and the rows that bins are found from. Draws follow from the rows
    alone; rows that are equal in all columns are drawn together. The library
    fits itself where the pipeline is set to something else, or the rows are refused.
    """
    *before, machine = pipeline.getStages()
    label = F.col(machine.getLabelCol()).cast("double")
    prepared = _prepared(before, rows, label) if _is_ours(before, machine) else None
    if prepared is None:
        shared_dir(rows.sparkSession)  # a library's fit cuts its lineage there every few rounds
        with even_parts(rows) as dealt:
            return pipeline.fit(dealt)

    stages, kept, n = prepared
    indexer, encoder, assembler, scaler = stages
    labels = [size - 1 for size in encoder.categorySizes]
    with np.errstate(divide="ignore"):
        scale = np.where(scaler.std.toArray() > 0, 1 / scaler.std.toArray(), 0.0)
    numbers = [F.col(c).cast("double") * float(s) for c, s in zip(assembler.getInputCols()[len(labels) :], scale[sum(labels) :], strict=True)]
    numbers = [number.alias(f"number_{i}") for i, number in enumerate(numbers)]
    whole = rows.where(kept)
    bins = min(machine.getMaxBins(), n)
    share = max(bins * bins, BIN_ROWS) / n
    drawn = F.pmod(F.xxhash64(F.lit(machine.getSeed()), *rows.columns), F.lit(2**40)) < int(min(share, 1.0) * 2**40)
    some = whole.where(drawn).select(*numbers).toPandas()
    limits = [bin_limits(some[name].to_numpy(), bins) for name in some]
    columns = _columns(labels, limits, scale)

    spark = rows.sparkSession
    # Blocks are small: more parts than cores would only cost their starts.
    parts = min(spark.sparkContext.defaultParallelism, -(-n // BLOCK_ROWS))
    hashes = F.shiftrightunsigned(F.xxhash64(*rows.columns), 32).alias("hash")
    coded = indexer.transform(whole).select(*[F.col(c).cast("int") for c in encoder.getInputCols()], *numbers, label.alias("y"), hashes)
    with scratch_scope(spark):
        staged = stage(_binned(coded, columns, limits, len(labels)), "blocks", compression="zstd")
        bundles = _bundles(staged, columns)
        blocks = _dealt(staged, parts, columns, bundles)
        if isinstance(machine, GBTRegressor):
            trees, weights = _boosted(machine, blocks, columns, bundles)
            kind = GBTRegressionModel
        else:
            trees, kind = _forest(machine, blocks, columns, bundles), RandomForestRegressionModel
            weights = [1.0] * len(trees)
        fitted = _as_library_model(spark, machine, kind, trees, weights, columns)
    machine._transfer_params_to_java()
    machine._java_obj.copyValues(fitted._java_obj, machine._java_obj.extractParamMap())
    return PipelineModel([*stages, machine._copyValues(fitted)])
