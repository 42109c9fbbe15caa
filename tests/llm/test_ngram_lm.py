"""The n-gram model against plain dictionaries, and the sequences' own parts."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kardex.llm import ngram_lm, queries
from kardex.llm.elias_fano import EliasFano, Trie, pack, unpack

SF = "/root/testdata/sf0.001"


def model(rows, trained, d=0.75):
    """(n_tokens, n_known, N, base, score) of each row."""
    tokens = [(t or "").encode().lower().split() + [b"\n"] for _, t in rows]
    uni, pairs, size = Counter(), Counter(), Counter()
    for (key, _), t in zip(rows, tokens):
        if trained(key):
            uni.update(t)
            for a, b in zip([None, *t], t):
                pairs[a, b] += 1
                size[a] += 1
    followers = Counter(a for a, _ in pairs)
    n, v = sum(uni.values()), len(uni)
    once, twice = (sum(c == k for c in uni.values()) for k in (1, 2))
    cut = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    for t in tokens:
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for a, b in zip([None, *t], t):
            p = ((uni[b] - cut) / n if uni[b] else cut * v / n) if n else 1.0
            if size[a]:
                p = max(0, pairs[a, b] - d) / size[a] + d * followers[a] / size[a] * p
            score += math.log10(p)
        yield len(t), sum(uni[w] > 0 for w in t), n, base, score


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = {k: w for (k, _), w in zip(rows, model(rows, lambda k: zlib.crc32(str(k).encode()) % 7 != 2))}
    got = queries.op5_ngram_lm(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=0.01)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_awkward_rows_hot_contexts_and_shards(spark):
    rows = [(i, "the " * (i % 9) + f"cat {i % 5} the end{i}") for i in range(80)]
    rows += [(1, None), (1, None), (None, ""), (7, "THE Cat"), (90, "unknown words only"), (91, "the " * 50_000 + "é É")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS batch", "true AS train", "2 AS id")
    got = ngram_lm.score(df, F.col("id") < 70, batch_bytes=400, shard_bytes=60_000).collect()
    want = list(model(rows, lambda k: k is not None and k < 70))
    key = lambda r: (str(r[0]), *(round(x, 6) for x in r[1:4]))
    a = sorted(((r.id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=key)
    b = sorted(((k, w[0], w[1], w[3], w[4]) for (k, _), w in zip(rows, want)), key=key)
    for x, y in zip(a, b, strict=True):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3]) and x[4] == pytest.approx(y[4], rel=0.01)


@pytest.mark.parametrize("shard_bytes", [8 << 20, 4])
def test_after_each_context_probabilities_sum_to_one(spark, shard_bytes):
    learned = ["a b a c", "a b b d", "c a b", "d d a", "b"]
    uni = Counter(w for t in learned for w in [*t.split(), ""])
    n, v, once, twice = sum(uni.values()), len(uni), *(sum(c == k for c in uni.values()) for k in (1, 2))
    cut = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    single = {w: math.log10((c - cut) / n) for w, c in uni.items()}
    single["u"] = math.log10(cut * v / n)
    known = sorted(set(uni) - {""})
    texts = ["", "u", *known, *(f"u {w}" for w in known), *(f"u {w} u" for w in known), *(f"u {c} {w}" for c in known for w in known)]
    rows = [(-1 - i, t) for i, t in enumerate(learned)] + list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {texts[r.id]: r.score for r in ngram_lm.score(df, F.col("id") < 0, batch_bytes=60, shard_bytes=shard_bytes).collect()
           if r.id >= 0}
    # Differences of scores give each probability: an unknown word forgets what was before.
    start = {"": got[""], "u": got["u"] - single[""]}
    end = {w: got[f"u {w}"] - start["u"] - single[w] for w in known}
    start |= {w: got[w] - end[w] for w in known}
    assert sum(10 ** x for x in start.values()) == pytest.approx(1, rel=0.05)
    for c in known:
        after = [end[c], got[f"u {c} u"] - start["u"] - single[c] - single[""]]
        after += [got[f"u {c} {w}"] - start["u"] - single[c] - end[w] for w in known]
        assert sum(10 ** x for x in after) == pytest.approx(1, rel=0.05)


def test_nothing_to_learn_and_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = ngram_lm.score(df, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    assert ngram_lm.score(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 5), (999, 1 << 62), (3000, 100), (20_000, 1 << 40)])
def test_elias_fano(n, universe):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, universe, n))
    packed = EliasFano.of(unpack(pack(EliasFano.build(values, universe).parts())))
    assert (packed.get(np.arange(n)) == values).all()
    asked = np.concatenate([draw.integers(0, universe, 300), values[:300]])
    none = np.zeros(len(asked), np.int64)
    place, equal = packed.successor(none, none + n, asked)
    assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_trie():
    draw = np.random.default_rng(1)
    ids = 300
    keys = np.unique(draw.integers(0, ids * ids, 20_000))
    context, word = keys // ids, keys % ids
    log_p, log_rest = draw.normal(size=len(keys)), draw.normal(size=len(np.unique(context)))
    trie = Trie.load(Trie.build(context, word, log_p, log_rest, ids).dump())
    pair, rest = trie.look_up(context, word)
    assert np.abs(trie.bins[pair] - log_p).max() < 0.04 and (rest > 0).all()
    a, b = draw.integers(0, ids, 9000), draw.integers(0, ids, 9000)
    assert ((trie.look_up(a, b)[0] > 0) == np.isin(a * ids + b, keys)).all()
