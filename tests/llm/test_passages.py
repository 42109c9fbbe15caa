import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kardex.llm import passages, queries
from kardex.llm.passages import FIGURES, PASSAGE, Model, encode, passages_of, slices

SF = "/root/testdata/sf0.1"


def test_query_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    got = queries.op12_quality(spark, SF).collect()
    assert len(got) == pq.read_table(f"{SF}/documents.parquet", columns=["doc_id"]).num_rows
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    low = [p for y, p in held if y == 0]
    high = [p for y, p in held if y == 1]
    assert np.mean(high) > 0.97 and np.mean(low) < 0.05


def some_model(seed=0):
    rng = np.random.default_rng(seed)
    model = Model.start(rng.normal(0, 1, (50, FIGURES)), 6, 4, seed)
    model.weights["judge0"] += 0.3
    return model


def direct(model, text):
    """The plain formula: all passages at once."""
    words = (text or b"").split()
    figures = np.concatenate([encode([words[i:i + PASSAGE]]) for i in range(0, max(1, len(words)), PASSAGE)])
    _, h, _, _, a = model.passages(figures)
    e = np.exp(a - a.max())
    return 1 / (1 + np.exp(-((e / e.sum()) @ h @ model.weights["judge"] + model.weights["judge0"][0])))


def test_running_softmax_and_slices_equal_the_plain_formula():
    rng = np.random.default_rng(4)
    words = [b"the", b"OF!!", b"and***", b"a|b", b"\xc3\xa9t\xc3\xa9", b"12.5", b"x" * 700, b"|"]
    rows = [b" ".join(words[i] for i in rng.integers(0, len(words), n)) for n in (1, 5, 47, 48, 49, 96, 500, 6000)]
    rows += [None, b"", b" \n\t ", b"w" * 50_000, b"a\x0bb\x0cc"]
    model = some_model()
    want = [direct(model, r) for r in rows]
    for size in (1, 100, 5000, 1 << 20):
        assert model.probability(rows, size) == pytest.approx(want, rel=1e-5)


def test_passages_hold_all_words():
    text = b" ".join(str(i).encode() for i in range(1000))
    for size in (1, 7, 333, 10 ** 6):
        found = list(passages_of(text, size))
        assert [w for p in found for w in p] == text.split() and {len(p) for p in found[:-1]} == {PASSAGE}


def test_figures_do_not_depend_on_neighbours():
    rows = [b"one two two!! THREE ***", b"1 2 3 x y z " * 30, b""]
    together = np.concatenate([f for _, f in slices(rows)])
    alone = np.concatenate([f for r in rows for _, f in slices([r])])
    assert np.allclose(together, alone)


def test_gradients():
    rng = np.random.default_rng(5)
    model = some_model(1)
    sizes = np.array([1, 4, 2, 7])
    figures, y, weight = rng.normal(0, 1, (14, FIGURES)), np.array([0, 1, 1, 0.0]), np.array([1.0, 2, 1, 0.5])
    starts = np.cumsum(sizes) - sizes

    def loss():
        _, h, _, _, a = model.passages(figures)
        total = 0
        for s, n, t, w in zip(starts, sizes, y, weight):
            e = np.exp(a[s:s + n])
            p = passages._sigmoid((e / e.sum()) @ h[s:s + n] @ model.weights["judge"] + model.weights["judge0"])[0]
            total -= w * np.log(p if t else 1 - p)
        return total / weight.sum()

    for name, g in model.gradients(figures, starts, y, weight).items():
        flat, g = model.weights[name].reshape(-1), g.reshape(-1)
        for i in rng.integers(0, len(flat), 5):
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss()
            flat[i] = keep - 1e-5
            assert g[i] == pytest.approx((up - loss()) / 2e-5, abs=1e-6), name
            flat[i] = keep


def test_awkward_rows(spark):
    good, bad = "The end of it is, and a day goes on there. ", "BUY!! NOW!! BUY!! *** ### "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5) + str(i)) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, good), (None, None), (3, good), (103, bad * 20_000), (103, bad * 20_000)]
    labels = [(i, i % 2) for i in range(60)] + [(5, 0), (None, 1), (61, None), (999, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS y", "3 AS score")
    marks = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "1 AS text")
    model = passages.fit(docs, marks)
    got = passages.score(docs, model, slice_bytes=2000).collect()
    assert sorted(str(r.id) for r in got) == sorted(str(k) for k, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    told = {r.id: r.score for r in got if r.id is not None}
    assert all((told[i] >= 0.5) == (i % 2 == 1) for i in range(62, 80)) and told[103] < 0.5
    none = marks.where("doc_id < 0")
    assert {r.score for r in passages.score(docs, passages.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in passages.score(docs, passages.fit(docs, marks.where("quality = 1"))).collect()} == {1.0}
    assert passages.score(docs.where("doc_id < 0"), passages.fit(docs.where("doc_id < 0"), marks)).count() == 0
