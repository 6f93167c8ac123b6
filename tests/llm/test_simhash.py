from __future__ import annotations

import random
import re

import xxhash

from farekit.llm import queries, simhash
from farekit.llm.components import components
from tests.llm.cases import LONG, ODD, crowded, docs


def fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash.LOWER))
    if not words:
        return 0
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius, linked=lambda i, j: True):
    """Smallest position reachable, by comparing everything with everything."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and linked(i, j):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def test_fingerprints_follow_their_definition():
    for text in [t for _, t, *_ in ODD if t is not LONG] + ["one", "one two three", "a b c d a b c d a b c d"]:
        assert simhash.simhash(text and text.encode()) % 2**64 == fingerprint(text)
    assert simhash.simhash(LONG.encode()) % 2**64 == fingerprint(LONG)


def test_tree_finds_what_a_scan_finds():
    dice = random.Random(3)
    centres = [dice.getrandbits(64) for _ in range(20)]
    prints = [c ^ sum(1 << dice.randrange(64) for _ in range(dice.randrange(8))) & (2**64 - 1) for c in centres for _ in range(30)]
    tree = simhash.BKTree()
    for p in prints:
        tree.add(p)
    for q in prints[::7] + [0, 2**64 - 1]:
        for radius in (0, 4, 9):
            wanted = [i for i, p in enumerate(prints) if (p ^ q).bit_count() <= radius]
            assert sorted(tree.near(q, radius)) == wanted


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 150)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_in_many_small_trees(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TREE_NODES", 5)
    dice = random.Random(5)
    centres = [dice.getrandbits(63) for _ in range(4)]
    prints = sorted({c ^ sum(1 << dice.randrange(63) for _ in range(dice.randrange(5))) & (2**63 - 1) for c in centres for _ in range(40)})
    nodes = spark.createDataFrame([(p, p) for p in prints], "node long, bits long")
    found = dict(simhash.linked(nodes, 4).collect())
    top = groups(prints, 4)
    assert all(found.get(p, p) == prints[top[i]] for i, p in enumerate(prints))


def test_groups_equal_brute_force(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [fingerprint(r.text) for r in rows]
    top = groups(prints, 4)
    found = {r.doc_id: r for r in queries.QUERIES["op4_simhash_groups"](spark, data_dir).collect()}
    for i, r in enumerate(rows):
        assert found[r.doc_id].fingerprint == f"{prints[i]:016x}" and found[r.doc_id].component_id == rows[top[i]].doc_id


def test_groups_of_odd_rows(spark):
    found = simhash.grouped(crowded(docs(spark), "bits", "component_id"))
    got = [(r.doc_id or -1, r.component_id) for r in found.collect()]
    assert len(got) == 10 and (4, 4) in got and (5, 5) in got
    assert {c for d, c in got if d in (1, 2, 3)} == {1} and {c for d, c in got if d in (6, 7)} == {6}
    assert simhash.grouped(docs(spark, [])).count() == 0


def test_one_of_each_group_stays(spark):
    body = [f"w{i}" for i in range(200)]
    near = body[:100] + ["changed"] + body[101:]
    far = body[:40] + [f"v{i}" for i in range(160)]
    rows = [(i, " ".join(t), "en", "a", 1) for i, t in enumerate((body, near, far, body))] + [(3, " ".join(body), "en", "a", 1)]
    kept = simhash.deduplicated(crowded(docs(spark, rows), "bits", "row"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2] and kept.columns[-2:] == ["bits", "row"]
    odd = simhash.deduplicated(docs(spark)).collect()
    assert sorted((r.doc_id or -1) for r in odd) == [-1, 1, 4, 5, 6]
    assert simhash.deduplicated(docs(spark, [])).count() == 0
    twice = docs(spark, [(1, "x y", "en", "a", 3)] * 5)
    assert simhash.deduplicated(twice).count() == 1


def test_kept_documents_equal_brute_force(spark, data_dir):
    """The smallest document of every component, by comparing all fingerprints with all."""
    docs_ = spark.read.parquet(f"{data_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = docs_.orderBy("doc_id").collect()
    prints = [fingerprint(r.text) for r in rows]
    wanted = {rows[t].doc_id for t in groups(prints, 4)}
    kept = simhash.deduplicated(docs_)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(wanted)
    assert kept.exceptAll(docs_).count() == 0 and len(wanted) < len({r.text for r in rows})
