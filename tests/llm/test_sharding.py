from __future__ import annotations

import math
import zlib

import pytest
from pyspark.sql import functions as F

from farekit.llm import chance, queries, sharding
from tests.llm.cases import crowded, docs


@pytest.mark.parametrize(("total", "marked", "drawn"), [(20, 7, 5), (50, 50, 9), (9, 0, 4), (300, 150, 40)])
def test_draws_follow_the_hypergeometric_law(spark, total, marked, drawn):
    n = 4000
    u = (F.col("id") + 0.5) / n
    draw = chance.hypergeometric(u, F.lit(total), F.lit(marked), F.lit(drawn))
    found = {r.x: r["count"] / n for r in spark.range(n).select(draw.alias("x")).groupBy("x").count().collect()}
    for x in range(drawn + 1):
        exact = math.comb(marked, x) * math.comb(total - marked, drawn - x) / math.comb(total, drawn)
        assert found.get(x, 0.0) == pytest.approx(exact, abs=2 / n)


def test_matrix_has_the_given_sums(spark):
    sizes = [(i, (i * 37) % 211) for i in range(3000) if (i * 37) % 211]
    total = sum(n for _, n in sizes)
    counts = sharding.shard_sizes(total, 8)
    matrix = sharding.communication_matrix(spark.createDataFrame(sizes, "part long, n long"), 4096, counts)
    rows = {r.part: list(r.counts) for r in matrix.collect()}
    assert {p: sum(c) for p, c in rows.items()} == dict(sizes)
    assert [sum(c[s] for c in rows.values()) for s in range(8)] == counts
    assert min(min(c) for c in rows.values()) >= 0


def check(placed, rows, shards):
    found = [tuple(r) for r in placed.groupBy("shard").agg(
        F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).collect()]
    counts = [c for _, c, *_ in found]
    assert sum(counts) == rows and all((low, high, n) == (0, c - 1, c) for _, c, low, high, n in found)
    assert rows < shards or (len(found) == shards and max(counts) - min(counts) <= 1)


def test_exact_sizes_gapless_slots_and_reruns(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir.replace('sf0.001', 'sf0.1')}/documents.parquet")
    placed = sharding.shard(rows)
    check(placed, 10_000, 8)
    again = sharding.shard(rows.repartition(5))
    assert placed.select("doc_id", "shard", "slot").exceptAll(again.select("doc_id", "shard", "slot")).count() == 0
    # A uniform shuffle: neighbours in the input go to the same shard one time in eight.
    shard_of = dict(placed.select("doc_id", "shard").collect())
    together = sum(shard_of[i] == shard_of[i + 1] for i in range(9999)) / 9999
    assert together == pytest.approx(1 / 8, abs=0.02)


def test_odd_rows_copies_and_clashing_names(spark):
    rows = crowded(docs(spark), "shard", "slot", "part")
    placed = sharding.shard(rows, 3)
    check(placed, rows.count(), 3)
    assert placed.where("part = 'mine'").count() == rows.count()
    assert sharding.shard(docs(spark, [])).count() == 0
    many = docs(spark, [(1, "x", "en", "a", 1)] * 900)
    placed = sharding.shard(many, 3)
    check(placed, 900, 3)


def test_query_equals_python_on_the_whole_table(spark, data_dir):
    path = data_dir.replace("sf0.001", "sf0.01")
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = queries.QUERIES["op6_shard"](spark, path)
    assert dict(found.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    }
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert (r.law, r.grown_shard) == ("rows", None) and 0 <= r.shard < 8
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    check(found, len(texts), 8)
    # The digests are placed as the documents themselves would be with the same key.
    again = queries.QUERIES["op6_shard"](spark, path)
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in rows}
