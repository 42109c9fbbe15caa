"""Repeated windows against a plain count, and the anchors' own rules."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kardex.llm import exchange, queries, substring

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((key, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS batch", "2 AS k", "3 AS shard")
    return sorted(((r.id, r.n_words, r.n_removed, r.text) for r in substring.remove_repeats(df, **more).collect()), key=str)


def test_query_equals_count(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute(rows, 35)]
    assert sorted(map(tuple, queries.op9_substring(spark, SF).collect()), key=str) == sorted(want, key=str)
    assert any(r[2] for r in want)


@pytest.mark.parametrize("batch", [300, 1 << 20])
def test_small_batches_and_many_shards(spark, batch):
    rng = random.Random(1)
    pool = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(5, 30))) for _ in range(12)]
    rows = [(i, "  ".join(rng.choice(pool) + f"\t{rng.randrange(400)}" for _ in range(rng.randrange(0, 7)))) for i in range(60)]
    rows += [(1, rows[0][1]), (1, rows[0][1]), (None, "é " * 40), (7, None), (8, ""), (9, " \n "), (10, "x y " * 34)]
    for window, period in ((9, 7), (20, 13)):
        assert run(spark, rows, window=window, period=period, batch_bytes=batch, shard_bytes=200) == brute(rows, window)


def test_long_text_and_empty_table(spark):
    rows = [(1, " ".join(str(i) for i in range(60_000)) + " same" * 36), (2, "other " + "same " * 35)]
    assert run(spark, rows) == brute(rows, 35)
    assert run(spark, []) == []


def test_many_equal_rows_are_spread(spark):
    rows = [(1, "the same text again and again " * 10)] * 40_000 + [(2, "other words " * 9), (None, "null id " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    df.write.mode("overwrite").parquet(path := spark.sparkContext.getCheckpointDir() + "/equal-rows")
    table = spark.read.parquet(path)
    batches, _ = exchange.batched(table, "doc_id", "text", 1 << 18, 1 << 20)
    sizes = [r["count"] for r in batches.groupBy("batch").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 4 * sum(sizes) / len(sizes)
    got = substring.remove_repeats(table, batch_bytes=1 << 18, shard_bytes=1 << 20)
    assert sorted(map(str, got.groupBy("id", "n_words", "n_removed").count().collect())) == sorted(map(str, [
        spark.createDataFrame([(1, 60, 60, 40_000)], "id long, n_words long, n_removed long, count long").first(),
        spark.createDataFrame([(2, 18, 0, 1)], "id long, n_words long, n_removed long, count long").first(),
        spark.createDataFrame([(None, 40, 40, 1)], "id long, n_words long, n_removed long, count long").first()]))


def test_windows_equal_in_one_hash_stay(spark, monkeypatch):
    """With a first hash of a single bit only the second tells windows apart."""
    rng = random.Random(2)
    words = substring.Windows(pa.table({"k": pa.array([1, 2]), "id": pa.array([1, 2]), "batch": pa.array([0, 0]), "text": [
        " ".join(rng.choice("abc") for _ in range(40)), " ".join(rng.choice("abc") for _ in range(40))]}), 9, 7)
    words.hashed = np.zeros(len(words.hashed), np.uint64)
    at, _, index, twice, _ = words.candidates(np.arange(0, 60))
    w = [words.words[c] for c in words.codes]
    seen = Counter(tuple(w[i:i + 9]) for i in at)
    assert [bool(t) for t in twice[index]] == [seen[tuple(w[i:i + 9])] > 1 for i in at]


def test_covers():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_rolling_hash_is_of_the_window():
    values = np.random.default_rng(0).integers(0, 5, 400).astype(np.uint64)
    for width in (1, 2, 3, 7, 15, 35):
        got = substring.rolling(values, width)
        assert len(got) == len(values) - width + 1
        by = {}
        for i, h in enumerate(got.tolist()):
            by.setdefault(h, set()).add(tuple(values[i:i + width].tolist()))
        assert all(len(s) == 1 for s in by.values())
        assert len(by) == len({tuple(values[i:i + width].tolist()) for i in range(len(got))})
