from __future__ import annotations

import random
from itertools import pairwise

import numpy as np
import pytest

from farekit.llm import queries, repeats
from farekit.llm.spans import SpanHasher
from tests import oracle
from tests.llm.cases import ODD, crowded, docs


def brute(rows, length):
    """(doc_id, n_bytes, begins, ends, kept) by a dictionary of all strings."""
    texts = [(repeats.LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first: dict[bytes, int] = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            first[t[p : p + length]] = min(i, first.get(t[p : p + length], i))
    out = []
    for (i, t), r in zip(texts, rows, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        edges = [p for p, (a, b) in enumerate(pairwise([0, *gone, 0])) if a != b]
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((r[0], len(t), tuple(edges[::2]), tuple(edges[1::2]), kept))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == ["doc_id", "n_bytes", "begins", "ends", "kept"]
    return sorted(((r.doc_id, r.n_bytes, tuple(r.begins), tuple(r.ends), bytes(r.kept)) for r in df.collect()), key=str)


def passages(seed, n=60, letters="abcdefgh ", longest=300):
    """Texts put together from a few passages, cut anywhere, with other text between."""
    rng = random.Random(seed)
    some = lambda size: "".join(rng.choices(letters, k=size))
    pool = [some(rng.randrange(5, longest)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts += [p[a : a + rng.randrange(longest)], some(rng.randrange(30))]
        rows.append((rng.randrange(n), "".join(parts), "en", "a", 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_passages(spark, seed):
    rows = passages(seed)
    found = repeats.without_repeats(docs(spark, rows).repartition(4), 20, block_bytes=2000, sorted_at_once=50)
    assert rows_of(found) == brute(rows, 20)


@pytest.mark.parametrize("letters", ["a", "ab", "é🙂"])
def test_equals_brute_force_on_periodic_and_wide_texts(spark, letters):
    rows = passages(7, n=25, letters=letters, longest=90)
    assert rows_of(repeats.without_repeats(docs(spark, rows), 12, block_bytes=1500)) == brute(rows, 12)


@pytest.mark.parametrize("hot", [1, 2, 4])
def test_split_anchors_give_the_same(spark, hot):
    rows = passages(11)
    assert rows_of(repeats.without_repeats(docs(spark, rows).repartition(3), 20, hot=hot, block_bytes=1500)) == brute(rows, 20)


@pytest.mark.parametrize("seed", range(2))
def test_groups_have_all_their_occurrences(spark, seed):
    """Every place where a group's bytes stand, no other; together they cover what is removed."""
    rows = [(i, *r[1:]) for i, r in enumerate(passages(seed, n=40))]
    texts = {r[0]: r[1].encode() for r in rows}
    found = repeats.repeat_groups(docs(spark, rows).repartition(3), 20, block_bytes=2000, sorted_at_once=50).collect()
    by_group = {}
    for r in found:
        by_group.setdefault((r.group, r.length), []).append((r.doc_id, r.begin))
    assert len({g for g, _ in by_group}) == len(by_group) > 20
    covered = {i: bytearray(len(t)) for i, t in texts.items()}
    for (_, length), members in by_group.items():
        doc, begin = members[0]
        text = texts[doc][begin : begin + length]
        wanted = {(i, p) for i, t in texts.items() for p in range(len(t) - length + 1) if t[p : p + length] == text}
        assert len(text) == length >= 20 and len(members) == len(set(members)) and set(members) == wanted
        first = min(d for d, _ in members)
        for doc, begin in members:
            if doc > first:
                covered[doc][begin : begin + length] = b"\1" * length
    for doc_id, _, begins, ends, _ in brute(rows, 20):
        gone = bytearray(len(texts[doc_id]))
        for a, b in zip(begins, ends, strict=True):
            gone[a:b] = b"\1" * (b - a)
        assert gone == covered[doc_id]


def test_groups_of_odd_rows(spark):
    assert repeats.repeat_groups(docs(spark, [])).count() == 0
    found = repeats.repeat_groups(crowded(docs(spark), "group", "length")).collect()
    assert {r.doc_id for r in found} == {6, 7} and len({r.group for r in found}) * 3 == len(found)
    split = repeats.repeat_groups(docs(spark), hot=1).collect()
    assert {r.length for r in split} == {50} and {r.doc_id for r in split} == {6, 7}


def test_odd_rows(spark):
    rows = [*ODD, (3, "x" * 49, "en", "a", 1), (8, "x" * 50, "en", "a", 1), (9, "x" * 51, "en", "a", 1), (-5, "y\0" * 40, "en", "a", 1),
            (10, "y\0" * 40 + "x" * 49, "en", "a", 1), (11, "y\0" * 25 + "x" * 50 + "z", "en", "a", 1)]
    found = repeats.without_repeats(crowded(docs(spark, rows), "block", "bucket", "ids", "kept"))
    assert rows_of(found) == brute(rows, 50)
    assert repeats.without_repeats(docs(spark, [])).count() == 0
    assert rows_of(repeats.without_repeats(docs(spark, [(1, None, None, None, None)]))) == [(1, 0, (), (), b"")]


def test_a_long_text_is_read_whole(spark):
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnop ", k=4_300_000))
    rows = [(5, text, "en", "a", 1), (6, "q" + text[-60:], "en", "a", 1), (7, text[2_000_000:2_000_050] + "r", "en", "a", 1)]
    found = {r.doc_id: r for r in repeats.without_repeats(docs(spark, rows)).collect()}
    assert (found[5].begins, found[6].begins, found[6].ends, found[7].begins, found[7].ends) == ([], [1], [61], [0], [50])
    assert bytes(found[6].kept) == b"q" and bytes(found[7].kept) == b"r" and bytes(found[5].kept) == text.encode()


def test_runs_cover_every_window_and_equal_windows_share_their_anchor(monkeypatch):
    monkeypatch.setattr(repeats, "AT_ONCE", 700)
    texts = [r[1].encode() for r in passages(5, n=40, letters="abc")]
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths, offsets = repeats.runs(data, sizes, 20, 9, SpanHasher())
    monkeypatch.setattr(repeats, "AT_ONCE", 10**9)
    assert all((a == b).all() for a, b in zip((lengths, offsets), repeats.runs(data, sizes, 20, 9, SpanHasher()), strict=True))
    windows = [t[p : p + 20] for t in texts for p in range(len(t) - 19)]
    assert lengths.sum() == len(windows) and lengths.max() <= 12
    run = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(windows)) - (np.cumsum(lengths) - lengths)[run]
    seen = {}
    for window, anchor in zip(windows, (offsets[run] - place).tolist(), strict=True):
        assert 0 <= anchor <= 11 and seen.setdefault(window, anchor) == anchor


def arrays(units, length):
    sizes = np.array([len(u) for u in units])
    data = np.frombuffer(b"".join(units), np.uint8)
    begins = np.cumsum(sizes) - sizes
    return data, begins, repeats.SuffixArray.of(data, begins, sizes, np.zeros(len(units), dtype=np.int64), length)


@pytest.mark.parametrize("seed", range(20))
def test_suffix_array_and_its_maximal_repeats(seed):
    """Suffixes in order, and every group against all substrings: right and left maximal, with all occurrences."""
    rng = random.Random(seed)
    units = [bytes(rng.choices(b"ab\0", k=rng.randrange(6, 22))) for _ in range(rng.randrange(1, 12))]
    data, begins, array = arrays(units, 5)
    suffix = [units[u][o:] for u, o in zip(array.unit, array.offset, strict=True)]
    assert suffix == sorted(suffix) and len(suffix) == sum(len(u) - 4 for u in units)
    for i in range(1, len(suffix)):
        same = next((k for k, (a, b) in enumerate(zip(suffix[i - 1], suffix[i], strict=False)) if a != b), min(map(len, suffix[i - 1 : i + 1])))
        assert array.prefix[i] == (same if same >= 5 else 0)
    found = set()
    for depth, first, last in zip(*array.maximal(data, begins), strict=True):
        members = frozenset(zip(array.unit[first : last + 1].tolist(), array.offset[first : last + 1].tolist(), strict=True))
        found.add((suffix[first][:depth], members))
    expected = set()
    for text in {u[i:j] for u in units for i in range(len(u)) for j in range(i + 5, len(u) + 1)}:
        where = [(k, p) for k, u in enumerate(units) for p in range(len(u) - len(text) + 1) if u[p : p + len(text)] == text]
        if len(where) < 2:
            continue
        after = [units[k][p + len(text) : p + len(text) + 1] for k, p in where]
        before = [units[k][p - 1 : p] if p else None for k, p in where]
        if (len(set(after)) > 1 or b"" in after) and (len(set(before)) > 1 or None in before):
            expected.add((text, frozenset(where)))
    assert found == expected


def test_query_agrees_with_sql_and_brute_force(spark, data_dir):
    df = queries.QUERIES["op13_without_repeats"](spark, data_dir)
    assert oracle.compare(df, oracle.connect(data_dir), queries.ORACLES["op13_without_repeats"]) == []
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert rows_of(repeats.without_repeats(table)) == brute(rows, 50)


def test_blocks_stay_where_they_are(spark):
    """The blocks hold all texts; only what is told about them may be shuffled."""
    found = repeats.without_repeats(docs(spark, passages(0)), 20, block_bytes=2000)
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("AdaptiveSparkPlan") :]
    assert initial.count("Exchange hashpartitioning(block") == 1 and "Bucketed: true" in initial


def test_leading_bits_of_anchors_go_there_and_back():
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 3000, dtype=np.uint64))
    for some in (hashes, hashes[:1], hashes[:0], np.array([0, 1, (1 << 64) - 1], dtype=np.uint64)):
        assert (repeats._unpack_leading(repeats._pack_leading(some)) == some >> np.uint64(24)).all()
    assert len(repeats._pack_leading(hashes)) < 0.6 * hashes.nbytes


def test_anchors_that_agree_in_their_leading_bits_share_the_answer():
    shape = repeats._Shape(50, 28, 1, 4)
    row = lambda block, hashes, counts: {
        "bucket": 0, "block": block, "hashes": repeats._pack_leading(np.array(hashes, np.uint64)),
        "counts": repeats._pack(np.array(counts), "<u4"),
    }
    far = 1 << 60
    told = repeats._answered(shape)(repeats._rows([row(1, [5, far], [2, 2]), row(2, [6, 2 * far], [2, 3])], repeats._ASKED))
    codes = {r["block"]: repeats._unpack(r["values"], "u1").tolist() for r in told.to_pylist()}
    assert codes == {1: [repeats.SHARED, repeats.ALONE], 2: [repeats.SHARED, repeats.SHARED]}
