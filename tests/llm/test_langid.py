"""Language identification: sums over segmentations, learning, rare inputs."""

import itertools
import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from kardex.llm import langid, queries

SF = "/root/testdata/sf0.01"


def brute(word, pieces, column):
    """Sum over all cuts of the marked word into pieces."""
    marked, total = "▁" + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
        parts, at = [], 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(marked[at:i])
                at = i
        p = 1.0
        for part in parts:
            p *= column[pieces.get(part, 0)] if len(part) == 1 or part in pieces else 0.0
        total += p
    return math.log(total)


def test_forward_sums_all_segmentations():
    pieces = {"▁": 1, "▁a": 2, "a": 3, "b": 4, "ab": 5, "▁ab": 6, "bab": 7}
    table = np.random.default_rng(0).dirichlet(np.ones(8), size=2).T
    model = langid.Model(["x", "y"], langid.Pieces(pieces), table)
    words = ["a", "ab", "abab", "bé", "babab"]
    for word, got in zip(words, model.word_scores(words)):
        assert got == pytest.approx([brute(word, pieces, table[:, k]) for k in (0, 1)])


def plain(word, pieces, table):
    """Natural logs of the sums over segmentations, place by place."""
    marked = "▁" + word
    longest = max(map(len, pieces))
    logs = np.full((len(marked) + 1, table.shape[1]), -np.inf)
    logs[0] = 0
    for j in range(1, len(marked) + 1):
        for i in range(max(0, j - longest), j):
            part = marked[i:j]
            if len(part) == 1 or part in pieces:
                logs[j] = np.logaddexp(logs[j], logs[i] + np.log(table[pieces.get(part, 0)]))
    return logs[-1]


@pytest.mark.parametrize("length", [1, 15, 16, 17, 31, 500, 3000])
def test_long_words(length):
    pieces = {"▁": 1, "▁a": 2, "a": 3, "b": 4, "ab": 5, "▁ab": 6, "bab": 7, "abbaabba": 8}
    table = np.random.default_rng(1).dirichlet(np.ones(9), size=3).T * 1e-6
    model = langid.Model(["x", "y", "z"], langid.Pieces(pieces), table)
    rng = np.random.default_rng(length)
    words = ["".join(rng.choice(list("aabbé"), length)) for _ in range(3)]
    for word, got in zip(words, model.word_scores(words)):
        assert got == pytest.approx(plain(word, pieces, table), rel=1e-9)


def test_query_equals_plain_sums(spark):
    """Predictions and scores of whole texts, words summed one by one."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    pieces, known = langid.load_pieces(), {}
    got = {r.doc_id: r for r in queries.op2_langid(spark, sf).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        words = langid.words_of(r.text)
        for w in set(words) - known.keys():
            known[w] = plain(w, pieces, model.table)
        total = sum((known[w] for w in words), np.zeros(len(model.langs)))
        best = int(total.argmax())
        assert got[r.doc_id].lang_pred == (model.langs[best] if words else "und")
        assert got[r.doc_id].score == pytest.approx(1 / np.exp(total - total[best]).sum() if words else 0)


def test_expected_counts_sum_to_the_pieces_used():
    pieces = {"▁": 1, "a": 2, "aa": 3}
    table = np.full((4, 1), 0.25)
    out = np.zeros((4, 1))
    langid.Lattice(["aa"], langid.Pieces(pieces)).expected(table, np.array([[2.0]]), out)
    # Cuts of "▁aa": ▁|a|a with weight 1/64 and ▁|aa with weight 1/16.
    short, long = 1 / 64, 1 / 16
    assert out[:, 0] == pytest.approx([0, 2, 2 * 2 * short / (short + long), 2 * long / (short + long)])


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = queries.op2_langid(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark):
    train = [(i, f"the cat sat {i}" if i % 2 else f"le chat dort {i}", "en" if i % 2 else "fr") for i in range(20)]
    train += [(None, "the mat", "en"), (50, None, "en"), (51, "who knows", None), (52, "", "fr")]
    schema = "doc_id long, text string, lang string"
    model = langid.fit(spark.createDataFrame(train, schema))
    assert model.langs == ["en", "fr"]
    docs = [(1, None, "fr"), (2, "", "x"), (3, "12 !?", None), (4, "the cat", "fr"), (4, "the cat", "fr"),
            (None, "LE CHAT", "en"), (5, "a" * 200_000, "en"), (6, "le chat " * 100_000, None)]
    df = spark.createDataFrame(docs, schema).selectExpr("*", "'z' AS score", "1 AS Lang_Pred")
    got = sorted(((r.doc_id, r.lang_pred) for r in langid.identify(df, model).collect()), key=str)
    want = {1: "und", 2: "und", 3: "und", 4: "en", None: "fr", 6: "fr"}
    assert [g for g in got if g[0] != 5] == sorted(((d[0], want[d[0]]) for d in docs if d[0] != 5), key=str)
    assert langid.identify(df, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.fit(spark.createDataFrame([], schema))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
