"""Embedding links: recall against all pairs, and rare inputs."""

import math

import numpy as np
import pytest

from kardex.llm import crosspolytope
from kardex.llm.crosspolytope import hadamard


def brute(rows, limit=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, comp = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= limit:
                    links[i] += 1
                    links[j] += 1
                    comp[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return [(k, n, low.get(root(i))) for i, ((k, _), n) in enumerate(zip(rows, links))]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS label", "2 AS n", "3 AS bucket", "4 AS key")
    return [(r.id, r.n_links, r.component) for r in crosspolytope.near_duplicates(df, **more).collect()]


def cluster(draw, centre, n, cosine):
    out = []
    for _ in range(n):
        noise = draw.normal(size=len(centre))
        noise -= noise @ centre / (centre @ centre) * centre
        noise *= np.linalg.norm(centre) / np.linalg.norm(noise)
        out.append((cosine * centre + math.sqrt(1 - cosine ** 2) * noise) * draw.uniform(0.5, 2))
    return out


def test_awkward_rows(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [math.nan, 1.0, 1.0, 1.0]),
            (6, [math.inf, 0.0, 0.0, 0.0]), (9, v), (7, v), (7, v), (8, [2 * x for x in v]), (None, v), (None, None),
            (10, v + [0.0]), (11, [-x for x in v]), (12, [1.0]), (13, [2.0])]
    assert sorted(run(spark, rows), key=str) == sorted(brute(rows), key=str)
    assert run(spark, []) == []


def test_recall_at_the_limit_and_crowds(spark):
    draw = np.random.default_rng(7)
    vectors = [draw.normal(size=64) for _ in range(900)]
    for _ in range(150):
        vectors += cluster(draw, draw.normal(size=64), 1, 1.0) * 1
        centre = vectors[-1]
        vectors += cluster(draw, centre, 1, 0.905)
    vectors += cluster(draw, draw.normal(size=64), 300, 0.985)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]
    want = brute(rows)
    for more in ({}, {"hashes": 2, "tile": 50}):
        got = {k: (n, c) for k, n, c in run(spark, rows, **more)}
        assert all(got[k][0] <= n for k, n, _ in want)
        total = sum(n for _, n, _ in want)
        border = [(k, n) for k, n, _ in want[900:1200]]
        assert sum(got[k][0] for k, _ in border) >= 0.9 * sum(n for _, n in border)
        assert sum(n for n, _ in got.values()) >= 0.99 * total
        crowd = [got[k][1] for k, _, _ in want[1200:]]
        assert len(set(crowd)) == 1


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


@pytest.mark.parametrize("hashes", [1, 2, 3, 4])
@pytest.mark.parametrize("dim", [64, 256, 768])
def test_recall_does_not_fall_with_more_hashes(dim, hashes):
    """Pairs at cosine 0.9 that share a bucket, with the tables of each number of hashes."""
    rng = np.random.default_rng([dim, hashes])
    a = rng.normal(size=(200, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    hasher = crosspolytope.CrossPolytope(dim, crosspolytope.tables_for(hashes), hashes, 4, 17)
    found = [bool(set(x) & set(y)) for x, y in zip(hasher.buckets(a).tolist(), hasher.buckets(b).tolist())]
    print(dim, hashes, np.mean(found))
    assert np.mean(found) >= 0.9
