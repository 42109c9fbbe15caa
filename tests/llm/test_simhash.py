"""SimHash near-duplicates against brute force over all pairs."""

import random

import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from kardex.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) > len(shingles):
            out |= 1 << bit
    return out


def brute_components(rows, bits=2):
    """rows: (id, fingerprint) -> component by row position."""
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                comp[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return [low.get(root(i)) for i in range(len(rows))]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component long")
    return sorted(((r.id, r.fp & (1 << 64) - 1, r.component) for r in simhash.near_duplicates(df, **more).collect()),
                  key=str)


def test_query_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    rows = [(d["doc_id"], brute_fingerprint(d["text"])) for d in docs]
    want = sorted((k, f"{v:016x}", c) for (k, v), c in zip(rows, brute_components(rows)))
    assert sorted(map(tuple, queries.op4_simhash(spark, SF).collect())) == want


def test_awkward_rows(spark):
    rows = [(3, None, "x", 1), (None, "", "x", 1), (5, " \t\r\n", None, 2), (7, "One", "", 3), (7, "oNE", "", 3),
            (9, "é É ß " * 30000, "", 1), (None, "lone words here now", None, None)]
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted(((k, v, c) for (k, v), c in zip(fps, brute_components(fps))), key=str)
    assert run(spark, rows) == want
    assert run(spark, []) == []


def test_links_of_crowded_and_sparse_buckets(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(40)}
    for base in list(values)[:6]:
        near = base
        for _ in range(30):
            near = (base if rng.random() < 0.7 else near) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            values.add(near)
    values = sorted(values)
    rows = [(i, v) for i, v in enumerate(values)]
    want = brute_components(rows)
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in rows]
    df = spark.createDataFrame(signed, "id long, fp long").select("fp")
    from kardex.llm.components import connected_components
    for crowd in (2, 64):
        nodes = {r.node & (1 << 64) - 1: r.component for r in
                 connected_components(simhash.links(df, crowd=crowd)).collect()}
        groups = {}
        for (_, v), c in zip(rows, want):
            groups.setdefault(nodes.get(v, ("alone", v)), set()).add(c)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_chain_budgets_keep_every_near_pair():
    rng = random.Random(3)
    for m in (3, 5, 7, 9):
        ring = simhash.chains(2, m)
        for _ in range(300):
            diff = (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            assert any(all((diff & mask & (1 << 64) - 1).bit_count() <= b for mask, b in chain) for chain in ring)
