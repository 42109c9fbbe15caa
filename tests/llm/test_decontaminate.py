"""Decontamination against a plain scan, and the index's own parts."""

import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq

from kardex.llm import decontaminate, queries
from kardex.llm.fm_index import FMIndex, WaveletTree, suffix_order

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    owners = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            owners.setdefault(tuple(w[i:i + window]), set()).add("null" if item is None else str(item))
    lengths = sorted({len(p) for p in owners})
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := owners.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "text AS spans", "doc_id AS n_words")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id")
    got = decontaminate.with_digest(decontaminate.contamination(d, b, **more)).collect()
    return sorted(((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str)


def test_query_equals_scan(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    want = brute(docs, items)
    assert sorted(map(tuple, queries.op8_decontamination(spark, SF).collect()), key=str) == want
    assert any(r[2] for r in want)


def test_awkward_rows_and_blocks(spark):
    long = " ".join(f"w{i}" for i in range(20))
    items = [(1, long), (2, "Two words"), (2, "two WORDS!"), (3, None), (4, "!!"), (None, "two words more"), (5, "é-É")]
    docs = [(1, "x " + long.upper() + " y"), (1, "x " + long.upper() + " y"), (2, None), (3, ""), (None, "two, words; more"),
            (4, "two wordsx"), (5, "a é É b"), (6, ("w3 w4 " * 40000) + long), (7, "two words two words")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, block_bytes=40) == want
    assert run(spark, [], items) == []
    assert all(r[2] == 0 for r in run(spark, docs, []))


def test_spans_are_cut_from_the_text(spark):
    long = " ".join(f"w{i}" for i in range(13))
    d = spark.createDataFrame([(1, f"Ä, {long.upper()}! end", "a"), (2, None, "b"), (3, "two-words é", "c")],
                              "doc_id long, text string, spans string")
    b = spark.createDataFrame([(1, long), (2, "words")], "item_id long, text string")
    for size in (1 << 20, 3):
        cut = decontaminate.cut_spans(decontaminate.mark(d, b, block_bytes=size))
        assert cut.columns == ["doc_id", "text"]
        assert sorted(map(tuple, cut.collect())) == [(1, "Ä, ! end"), (2, None), (3, "two- é")]


def test_index_finds_all_places():
    rng = random.Random(2)
    for n_symbols in (2, 3, 9):
        text = np.array([rng.randrange(n_symbols) for _ in range(700)] + [0])
        suffixes = suffix_order(text)
        unique = [(0, i) if s == 0 else (1, s) for i, s in enumerate(text.tolist())]
        assert suffixes.tolist() == sorted(range(len(text)), key=lambda i: unique[i:])
        index = FMIndex(text, n_symbols, sample=8)
        for length in (1, 2, 5):
            phrases = {tuple(text[i:i + length].tolist()) for i in range(300)}
            phrases = np.array([p for p in phrases if 0 not in p] + [(1,) * length])
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                want = [i for i in range(len(text) - length + 1) if (text[i:i + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 11, 1000)
    tree = WaveletTree(text, 11)
    for c in range(11):
        at = rng.integers(0, 1001, 50)
        got = tree.descend(np.full(50, c), at) - tree.descend(np.full(50, c), np.zeros(50, np.int64))
        assert got.tolist() == [int((text[:i] == c).sum()) for i in at]
