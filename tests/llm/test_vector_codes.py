import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kardex.llm import vector_codes
from kardex.llm.vector_codes import Bounds, squared, whole_root


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every distance in every round; ``rows``: (id, label, vector)."""
    kept = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    x = np.array([r[2] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    assign = lambda: np.stack([squared(x[:, p], books[p]).argmin(1) for p in range(parts)], 1)
    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[codes[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    codes = assign()
    error = sum(squared(x[:, p], books[p]).min(1) for p in range(parts))
    sums = {}
    for (_, lab, _), e in zip(kept, error.tolist()):
        sums[lab] = sums.get(lab, 0) + e
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return [(r[0], "".join(f"{c:02x}" for c in codes[i]), int(error[i]), sums[r[1]], digest) for i, r in enumerate(kept)]


SCHEMA = "vec_id long, label int, embedding array<float>"


def both(spark, rows, **more):
    df = spark.createDataFrame([(i, lab, v) for i, lab, v in rows], SCHEMA)
    df = df.select("*", F.lit(1).alias("code"), F.lit(2).alias("id"), F.lit(3).alias("near"))
    got = sorted(map(str, map(tuple, vector_codes.encode(df, **more).collect())))
    exact = [(i, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    return got, sorted(map(str, plain(exact, **{k: v for k, v in more.items() if k != "share"})))


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 0.2, (9, 64))
    rows = [(int(i), int(i) % 5 if i % 7 else None, (centres[rng.integers(9)] + rng.normal(0, 0.08, 64)).tolist())
            for i in rng.permutation(900)]
    rows += [(1000, 1, None), (1001, None, [float("nan")] * 64), (1002, 2, [0.0] * 64), (1003, 2, [None] + [0.1] * 63),
             (1004, 0, [float("inf")] * 64), (5, 1, [0.25] * 64), (5, 1, [0.25] * 64), (None, 3, [0.5] * 64), (None, 3, [0.5] * 64)]
    rows += [(2000 + i, 3, [0.125] * 64) for i in range(500)]
    got, want = both(spark, rows)
    assert got == want
    got, want = both(spark, rows, share=1.0)
    assert got == want


def test_ties_grid(spark):
    rng = np.random.default_rng(2)
    rows = [(i, None, (rng.integers(-2, 3, 16) / 4096).tolist()) for i in range(400)]
    got, want = both(spark, rows)
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    got, want = both(spark, [(i, 1, [0.1 * i] * 8) for i in range(n)])
    assert got == want


def test_other_lengths_and_large_values(spark):
    rows = [(1, 1, [0.5] * 8), (2, 1, [0.5] * 16), (3, 1, [0.5] * 7), (4, 1, [])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.id for r in vector_codes.encode(df).collect()] == [1]
    with pytest.raises(ValueError, match="too large"):
        vector_codes.encode(spark.createDataFrame([(1, 1, [1e30] * 8)], SCHEMA))


def test_bounds_hold_and_save_distances():
    rng = np.random.default_rng(3)
    x = rng.integers(-4000, 4000, (500, 8))
    book = rng.integers(-4000, 4000, (16, 8))
    bounds = Bounds.fresh(x, book, 4)
    depths = []
    for turn in range(6):
        new = book + rng.integers(-400 >> turn, (400 >> turn) + 1, book.shape)
        bounds.move(whole_root(((new - book) ** 2).sum(1), up=True))
        depths.append(bounds.settle(x, new))
        book = new
        square = squared(x, book)
        assert (bounds.near[:, 0] == square.argmin(1)).all()
        assert (bounds.upper.astype(float) ** 2 >= square.min(1)).all()
        rest = np.ones(square.shape, bool)
        np.put_along_axis(rest, bounds.near, False, 1)
        assert (np.where(rest, square, 1 << 60).min(1) >= np.sign(bounds.outer) * bounds.outer ** 2).all()
        there = np.take_along_axis(square, bounds.near[:, 1:], 1)
        assert (there >= np.sign(bounds.lower) * bounds.lower ** 2).all() and (np.diff(bounds.lower) >= 0).all()
        if turn == 3:
            bounds.shrink(2)
    assert (depths[-1] == 0).mean() > 0.5
