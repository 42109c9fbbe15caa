import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kardex.llm import importance
from kardex.llm.importance import Append, Scanner

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, target, buckets=10_000, percent=5, least=20):
    bucket = lambda f: zlib.crc32(f) % buckets
    s, t = [0] * buckets, [0] * buckets
    for side, some in ((s, [x for _, x in rows]), (t, target)):
        for x in some:
            for f in runs(x)[1]:
                side[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for key, x in rows:
        n, found = runs(x)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(may[:len(may) * percent // 100]):
        r[5] = place + 1
    return sorted(map(str, out))


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "Of", "café", "naïve", "x1", "don't", "ÉTÉ", "日本", "a-b", "under_score", "end.", "z" * 30]
    return [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("slice_bytes", [60, 1 << 20])
def test_equals_plain_version(spark, slice_bytes):
    rows = list(enumerate(texts(300)))
    rows += [(1000, None), (1001, ""), (1002, " .,;\x00\x7f "), (1003, "w" * 2000 + " the Of " + "w" * 2000 + "é"),
             (1004, "the of " * 20_000), (None, "the café " * 30), (None, "the café " * 30), (5, "the café " * 30), (None, None)]
    rows += [(7, "Of x1 " * 40)] * 50
    target = ["the café x1 of the", None, "", "w" * 2000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("id"), F.lit(2).alias("rank"), F.lit(3).alias("weight"))
    wanted = spark.createDataFrame([(x, 1) for x in target], "text string, rank int")
    got = importance.resample(docs, wanted, slice_bytes=slice_bytes)
    assert got.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(str(list(r)) for r in got.collect()) == plain(rows, target)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(i, t) for i, t in enumerate(texts(60, 3))], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    got = importance.resample(some, none).collect()
    assert sorted(str(list(r)) for r in got) == plain([(i, t) for i, t in enumerate(texts(60, 3))], [])


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900), st.binary(max_size=1500))
def test_appending_maps(a, b):
    append = Append()
    got = append.apply(append.table(len(b)), np.array([zlib.crc32(a)], np.uint32))[0] ^ np.uint32(zlib.crc32(b))
    assert int(got) == zlib.crc32(a + b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=80)), max_size=6), st.integers(1, 40))
def test_scanner_finds_every_run(rows, slice_bytes):
    got = np.zeros((len(rows), 10_001), np.int64)
    for row, found in Scanner(10_000, slice_bytes).slices([None if x is None else x.encode() for x in rows]):
        for bucket in found:
            np.add.at(got, (row, bucket), 1)
    got = got[:, :10_000]
    want = np.zeros_like(got)
    for i, x in enumerate(rows):
        for f in runs(x)[1]:
            want[i, zlib.crc32(f) % 10_000] += 1
    assert (got == want).all()
