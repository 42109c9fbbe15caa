"""Reports without SQL, against plain Python."""

import re

import pyarrow.parquet as pq

from kardex.operators.lookups import CODE_PATTERN, FALSE_POSITIVES
from kardex.plans import catalog
from kardex.sources import readers as R

SF = "/root/testdata/sf0.01"


def test_text_codes(spark):
    texts = {f"d{r['doc_id']}": None if r["text"] is None else f"Reel_M10{r['doc_id']}_{r['text']} XFF20{r['doc_id']}T, T01" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    texts |= {f"p{r['page_id']}": r["url"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    pattern = re.compile(CODE_PATTERN.replace(r"\d", "[0-9]"))
    want = {k: None if v is None else "|".join(c for c in dict.fromkeys(pattern.findall(v)) if c not in FALSE_POSITIVES)
            for k, v in texts.items()}
    got = {r.id: r.inventory_numbers for r in catalog.queries()["text_codes"](spark, SF).collect()}
    assert got == want and any(want.values())


def test_nested_xml_is_read_by_many_tasks(spark, monkeypatch, tmp_path):
    sf, n = str(tmp_path), 12_000
    spark.range(n // 3).selectExpr("id AS o_orderkey").write.parquet(f"{sf}/orders.parquet")
    spark.range(n).selectExpr("id % 4000 AS l_orderkey", "id % 50 AS l_partkey", "CAST(id % 7 AS INT) AS l_linenumber").write.parquet(f"{sf}/lineitem.parquet")
    rows, items = {}, {}
    for i in range(n // 3):
        rows.setdefault("M0" if i % 3 == 1 else f"M{i % 7001}", []).append(i)
    for i in range(n):
        items.setdefault("M0" if i % 4000 % 3 == 0 else f"M{i % 50}", []).append(i % 4000 * 10 + i % 7)
    want = {(k, len(rows[k]), sum(rows[k]), len(v), sum(v), max(len(v), len(rows[k])) > 1000) for k, v in items.items() if k in rows}
    found, read = [], R.read_xml_rows
    monkeypatch.setattr(R, "read_xml_rows", lambda *a, **k: found.append(read(*a, **k)) or found[-1])
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got = catalog.queries()["nested_xml_file"](spark, sf).collect()
        tasks = found[0].rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert set(map(tuple, got)) == want and any(w[-1] for w in want)
    assert tasks >= 3 * len(found[0].inputFiles())
