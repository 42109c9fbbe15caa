"""The pipeline against a plain version of its stages."""

import pyarrow.parquet as pq
from test_decontaminate import WORD, brute as contaminated
from test_mixing import judge, water_fill
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from kardex.llm import langid, pii
from kardex.llm.queries import PII_KEY

SF = "/root/testdata/sf0.001"


def strip_hits(text, items):
    """Cuts every run of words that a 13-word phrase covers."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    spans, words = [m.span() for m in WORD.finditer(low)], WORD.findall(low)
    phrases = set()
    for _, item in items:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in item or ""))
        phrases |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    hit = set()
    for n in {len(p) for p in phrases}:
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in phrases:
                hit |= set(range(i, i + n))
    out, at, i = [], 0, 0
    while i < len(words):
        if i in hit:
            out.append(text[at:spans[i][0]])
            while i + 1 in hit:
                i += 1
            at = spans[i][1]
        i += 1
    return "".join(out) + text[at:]


def test_pipeline_equals_plain_version(spark, tmp_path):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    source = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(source)
    known = []
    for d in docs:
        words = langid.words_of(d["text"])
        if words:
            total = model.word_scores(words).sum(axis=0)
            if 1 / sum(2.718281828459045 ** min(0, x - total.max()) for x in total) >= 0.5:
                known.append(d)
    groups = brute_components([(d["doc_id"], brute_fingerprint(d["text"])) for d in known])
    single = [d for d, g in zip(known, groups) if d["doc_id"] == g]
    dirty = {r[0] for r in contaminated([(d["doc_id"], d["text"]) for d in single], items) if r[5]}
    clean = [d | {"text": strip_hits(d["text"], items)} for d in single if d["doc_id"] not in dirty]
    replace = pii.replacer(__import__("hashlib").sha256(PII_KEY.encode()).digest())
    want = {d["doc_id"]: d | {"text": replace(d["text"])[0]} for d in clean}
    step = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, step, SF).write.parquet(f"{tmp_path}/{name}")
        step = spark.read.parquet(f"{tmp_path}/{name}")
        assert step.columns == source.columns
    assert {r.doc_id: r.asDict() for r in step.collect()} == want and len(known) > len(single) > len(clean)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    judge(rows, lambda r: want[r.doc_id]["source"], lambda r: len(want[r.doc_id]["text"].encode().split()))
    assert water_fill({"a": 10})["a"] == 15.0


def test_stages_on_awkward_documents(spark, tmp_path):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (2, "12 34", None, None, 5, 1)]
    rows += [(i, f"the cat sat on the mat number {'x' * (i % 5 + 1)}", "en", "s", 3, 1) for i in range(3, 12)]
    rows += [(12, "le chat dort ici ce soir", "fr", None, 3, 1), (None, "le chat dort ici ce soir", "fr", "t", 3, 1)] * 2
    rows += [(13, "le chat " * 60_000, "fr", "é", 9, 1)]
    step = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for run, data in enumerate((step, step.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{name}-{run}"
            stage(spark, data, SF).write.parquet(path)
            data = spark.read.parquet(path)
        got = data.collect()
        assert all(r.taken <= 2 * r.size for r in got)
    ids = [r.doc_id for r in spark.read.parquet(f"{tmp_path}/near_duplicates-0").collect()]
    assert sorted(ids) == sorted(set(ids)) and 12 in ids and 13 in ids and 1 not in ids
