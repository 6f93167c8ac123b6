from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farekit.llm import queries, repair
from farekit.session import scratch_path
from tests.llm.cases import ODD, docs

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def brute(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, repair.END_ID]


@pytest.mark.parametrize("first_rule", [300, 70_000])
def test_any_stretch_can_be_read_back(first_rule):
    dice = random.Random(1)
    phrases = [[dice.randrange(300) for _ in range(dice.randrange(2, 9))] for _ in range(30)]
    ids = np.array([i for _ in range(900) for i in dice.choice(phrases)] + [7] * 501, dtype="<u4")
    ends = np.array([*range(100, len(ids), 100), len(ids)])
    left, right, body = repair.compress(ids.astype(np.int32), ends, first_rule)
    assert len(body) < len(ids) / 2 and len(left)
    lengths = repair.rule_lengths(left, right, first_rule)
    shard = {
        "first_rule": first_rule, "rule_left": left.tobytes(), "rule_right": right.tobytes(), "body": body.tobytes(),
        "rule_length": lengths.astype("<i8").tobytes(), "n_ids": len(ids),
    }
    assert (repair.decode(shard) == ids).all()
    for _ in range(100):
        a, b = sorted(dice.randrange(len(ids) + 1) for _ in range(2))
        assert (repair.decode(shard, a, b) == ids[a:b]).all()
    assert len(repair.decode(shard, 5, 5)) == 0


def test_every_pair_that_pays_becomes_a_rule():
    """No pair is left that occurs often enough, unless symbols have run out; lengths take as few bytes as they can."""
    dice = random.Random(4)
    ids = np.array([i for _ in range(4000) for i in dice.choice([[1, 2, 3], [4, 5], [1, 5, 2, 2], [9] * 7])], dtype=np.int32)
    left, right, body = repair.compress(ids, np.array([len(ids)]), 300)
    pairs = Counter(zip(body[::1].tolist(), body[1:].tolist(), strict=False))
    # Pairs of one symbol overlap themselves; the others cannot.
    assert max(n for (a, b), n in pairs.items() if a != b) < repair.FEWEST
    lengths = repair.rule_lengths(left, right, 300)
    for largest in (255, 256, 70_000, 2**33):
        some = np.append(lengths, largest)
        raw = repair._narrow(some)
        assert (repair._wide(raw, len(some)) == some).all() and len(raw) == len(some) * {255: 1, 256: 2, 70_000: 4, 2**33: 8}[largest]
    assert len(repair._wide(b"", 0)) == 0


def test_few_large_ranges_are_cut_into_shards(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_IDS", 300)
    monkeypatch.setattr(repair, "RANGES", 2)
    rows = [(i, f"some words of text number {i} " * 5, "en", "a", 1) for i in range(200)]
    path = scratch_path(spark, "few-ranges")
    repair.write_tokens(docs(spark, rows), FILE, path)
    shards = spark.read.parquet(path)
    assert shards.select("part").distinct().count() <= 2 and shards.count() > 8
    check({tuple(r) for r in repair.token_index(spark, path).collect()}, [r[:2] for r in rows], tokenizer)


def test_encoder_equals_the_library(tokenizer):
    texts = [t or "" for _, t, *_ in ODD] + [
        "it's don't 'S we'll", "a1b2 33", "x́é é", "Straße ΣΑΣ σας", "tab\tnb sp em", "\x00\x1c\x7f a​b",
        "<|startoftext|>a<|endoftext|>b <| |>", "🙂🙂 日本語テキスト", "﷽ Ǆ ŉ ẞ", "!!!,,,...", "naïve café", "≠ ̸a",
    ]
    encoder = repair.Encoder(tokenizer.to_str())
    for _ in range(2):  # again from what is remembered
        ids, counts = encoder.encode([t.encode() for t in texts])
        for t, piece in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert piece.tolist() == brute(tokenizer, t)[:-1], t[:40]


def test_a_worker_has_one_encoder_at_a_time(tokenizer, monkeypatch):
    monkeypatch.setattr(repair, "Encoder", lambda text: [text])
    first = repair._encoder("one tokenizer")
    assert repair._encoder("one tokenizer") is first
    other = repair._encoder("another one")
    assert other == ["another one"] and repair._encoder("another one") is other
    assert repair._encoder("one tokenizer") is not first


def check(found, rows, tokenizer):
    start = 0
    for doc_id, text in rows:
        ids = np.array(brute(tokenizer, text), dtype="<u4")
        assert (doc_id, start, len(ids), zlib.crc32(ids.tobytes())) in found
        start += len(ids)


def test_files_hold_every_id_in_order(spark, data_dir, tokenizer):
    found = {tuple(r) for r in queries.QUERIES["op7_token_files"](spark, data_dir).collect()}
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert len(found) == len(rows)
    check(found, [tuple(r) for r in rows], tokenizer)


def test_small_shards_and_odd_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_IDS", 500)
    path = scratch_path(spark, "odd-tokens")
    repair.write_tokens(docs(spark).selectExpr("*", "1 AS part", "2 AS ids"), FILE, path)
    assert spark.read.parquet(path).count() > 3
    found = [tuple(r) for r in repair.token_index(spark, path).orderBy("start").collect()]
    assert [f[0] for f in found] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7]
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:], strict=False))
    by_id = {f[0]: f for f in found}
    for doc_id, text, *_ in ODD:
        if doc_id is not None:
            ids = np.array(brute(tokenizer, text), dtype="<u4")
            assert by_id[doc_id][2:] == (len(ids), zlib.crc32(ids.tobytes()))
    path = scratch_path(spark, "no-tokens")
    repair.write_tokens(docs(spark, []), FILE, path)
    assert repair.token_index(spark, path).count() == 0
