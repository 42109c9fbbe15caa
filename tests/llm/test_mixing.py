"""Mixing: targets, schedule and what each document gives."""

from collections import Counter

import pyarrow.parquet as pq
import pytest

from kardex.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def water_fill(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while len(full) < len(names):
        level = (share * sum(sizes.values()) - sum(most * sizes[s] for s in full)) / sum(
            weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * level > most * sizes[s]}
        target = {s: most * sizes[s] if s in full | over else weight[s] * level for s in names}
        if not over:
            return target
        full |= over
    return target


def judge(rows, source_of, size_of):
    sizes, taken, targets = Counter(), Counter(), {}
    for r in rows:
        s = source_of(r)
        sizes[s] += r.size
        taken[s] += r.taken
        targets[s] = (r.source_size, r.target)
        assert r.size == size_of(r) and 0 <= r.taken <= 2 * r.size
    want = water_fill(sizes)
    for s in sizes:
        assert targets[s][0] == sizes[s] and targets[s][1] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1


def test_query(spark):
    docs = {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = queries.op7_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    judge(rows, lambda r: docs[r.doc_id]["source"], lambda r: len(docs[r.doc_id]["text"].encode().split()))
    assert sorted(map(tuple, queries.op7_mixing(spark, SF).collect())) == sorted(map(tuple, rows))


def test_awkward_rows_and_schedule(spark):
    rows = [(i, "w " * (i % 50), f"s{i % 4}") for i in range(300)] + [(i, "a\tb c d", None) for i in range(9)]
    rows += [(None, "x y", "é"), (None, "x y", "é"), (3, None, "s1"), (4, "", "empty"), (5, "long " * 70_000, "Z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS bin", "2 AS size", "3 AS begin", "'q' AS h")
    mixed, pieces = mixing.mix(df, block=64, rows_per_bin=40)
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes = Counter((i, s, len((t or "").encode().split())) for i, t, s in rows)
    assert Counter((r.id, r.source, r.size) for r in got) == sizes
    judge(got, lambda r: r.source, lambda r: r.size)
    parts = pieces.collect()
    assert sum(p.end - p.start for p in parts) == sum(r.taken for r in got)
    slots = {}
    for p in parts:
        slots.setdefault(p.slot, set()).add((p.source, p.block))
    assert all(len(s) == 1 for s in slots.values()) and sorted(slots) == list(range(len(slots)))
    order = [next(iter(slots[n])) for n in sorted(slots)]
    for source in {s for s, _ in order}:
        assert [b for s, b in order if s == source] == list(range(sum(s == source for s, _ in order)))
    # Low discrepancy: any prefix holds nearly each source's share.
    share = Counter(s for s, _ in order)
    seen = Counter()
    for n, (s, _) in enumerate(order, 1):
        seen[s] += 1
        assert all(abs(seen[x] - share[x] * n / len(order)) < 8 for x in share)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df)[0].count() == 0 and mixing.mix(df)[1].count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(df)[0].collect()] == [(0.0, 0), (0.0, 0)]
