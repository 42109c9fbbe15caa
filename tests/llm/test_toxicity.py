"""Toxicity: automata against plain edit distance, context, held-out score."""

import random

import pyarrow.parquet as pq

from kardex.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_trie_finds_the_closest_term():
    rng = random.Random(3)
    terms = ["ab", "abc", "abcd", "bcda", "aabbccdd", "abcdabcd", "dcba"]
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(0, 12))) for _ in range(3000)] + terms + ["x" * 200]
    best, distance = toxicity.Trie(terms).match(words)
    for word, b, d in zip(words, best.tolist(), distance.tolist()):
        near = [edits(word, t) for t in terms if edits(word, t) <= toxicity.reach(t)]
        assert (b == -1) == (not near)
        if near:
            assert d == min(near) == edits(word, terms[b])


def test_stems_match_beginnings_exactly():
    best, distance = toxicity.Trie(["abcd*", "zzzz", "abc"]).match(["abcd", "abcdefgh", "abxd", "xabcd", "zzzy", "abc"])
    assert best.tolist() == [0, 0, -1, -1, 1, 2] and distance.tolist() == [0, 0, 99, 99, 1, 0]


def test_words_of_any_length():
    long = "abcdefghij" * 9
    trie = toxicity.Trie(["abcd*", long, "zz"])
    words = ["abcd" + "x" * 500, "y" * 500, "b" + long, "b" + long[:-1], "b" + long[:-3] + "b", "zz" + "y" * 70, "x" * 62]
    best, distance = toxicity.Trie([long, "zz"]).match([long, "b" + long, long[:-2], "b" + long + "cc", "x" * 88])
    assert best.tolist() == [0, 0, 0, -1, -1] and distance.tolist()[:3] == [0, 1, 2]
    best, distance = trie.match(words)
    assert best.tolist() == [0, -1, 1, 1, -1, -1, -1] and distance.tolist()[:4] == [0, 99, 1, 2]


def test_terms_beside_signs_are_words():
    assert toxicity.words_of("Scum,loser you-idiot end.Next \"quoted\" don't a_b (x)") == [
        "scum", "loser", "you", "idiot", "end", "next", '"quoted"', "don't", "a", "b", "(x)"]
    model = toxicity.Model(["moron"], frozenset(), [-3.0, 6.0, 0.5, 0.0, 0.5])
    got = model.probability(model.scorer()(["well,moron,you", "you-moron", "so.moron!you", "x" * 80 + "/moron you"])).tolist()
    assert min(got) > 0.7


def test_query_equals_plain_scores(spark):
    """The query against terms looked up one by one by edit distance."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet").where(f"NOT ({held_out})"))
    want = {}
    for r in docs.collect():
        words, hits = toxicity.words_of(r.text), []
        for at, w in enumerate(words):
            plain = w.strip(toxicity._STRIP)
            near = [(0 if plain.startswith(t[:-1]) else 99) if t[-1] == "*" else edits(plain, t) if abs(len(plain) - len(t)) < 3
                    and edits(plain, t) <= toxicity.reach(t) else 99 for t in model.terms]
            d = min(near, default=99)
            if d == 0 or d < 99 and plain not in model.common:
                hits.append((at, {0: 1.0, 1: 0.9, 2: 0.8}[d]))
        features = toxicity.window_scores(words, hits) if hits else [0.0] * 4
        want[r.doc_id] = model.probability(__import__("numpy").array([features]))[0]
    got = {r.doc_id: r.score for r in queries.op10_toxicity(spark, sf).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_quotation_counts_less_than_abuse():
    model = toxicity.Model(["moron"], frozenset(), [-3.0, 6.0, 0.5, 0.0, 0.5])
    texts = ["you are a moron", "what a m0ron he is", 'she wrote "moron" on it', "they said the word moron",
             "nothing here", None, "", "MORON!!"]
    abuse, typo, quoted, said, clean, null, empty, loud = model.probability(model.scorer()(texts)).tolist()
    assert min(abuse, typo, loud) > 0.7 > max(quoted, said) > clean == null == empty


def test_held_out_score(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = queries.op10_toxicity(spark, SF).collect()
    held = [(r, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    hits = [t for r, t in held if r.predicted]
    assert sum(hits) / len(hits) > 0.9 and sum(hits) / sum(t for _, t in held) > 0.75


def test_awkward_rows(spark):
    schema = "doc_id long, text string, toxic int"
    docs = [(i, f"you absolute moron {i} of {i * 7}" if i % 3 == 0 else f"kind words {i}", None) for i in range(60)]
    docs += [(None, "moron", 1), (100, None, 0), (101, "", 1), (101, "", 1), (102, "moron " + "fine " * 100_000, 0)]
    df = spark.createDataFrame(docs, schema).selectExpr("*", "1 AS score", "2 AS id", "3 AS n")
    labels = [(i, "x", int(i % 3 == 0)) for i in range(60)] + [(None, "x", 1), (5, "x", None), (7, "x", 0), (7, "x", 0)]
    marks = spark.createDataFrame(labels, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, marks)
    assert any("moron".startswith(t.removesuffix("*")) for t in model.terms)
    got = {r.id: r.score for r in toxicity.score(df, model).collect()}
    assert got[0] > 0.7 > got[1] and got[100] == got[101] and toxicity.score(df, model).count() == len(docs)
    assert toxicity.score(df.limit(0), model).count() == 0
    none = toxicity.fit(df, marks.limit(0))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.5}
