"""The queries of the training-data operators: thin wrappers that apply an
operator with its production parameters to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kardex.llm import (crosspolytope, decontaminate, importance, langid, mixing, ngram_lm, passages, pii,
                        simhash, substring, toxicity, vector_codes, warc)
from kardex.llm.common import crc_mod, read


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = warc.archive(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return warc.read_archives(spans, with_data=False).where("last").select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: Key of the registered query; a real run passes its own secret.
PII_KEY = "kardex-test-key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read(spark, sf_dir, "documents", "doc_id", "text"), PII_KEY)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_lm.score(read(spark, sf_dir, "documents", "doc_id", "text"), crc_mod(F.col("id"), 7) != 2)
    return found.select(F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 7) == 2).alias("held_out"), "n_tokens",
                        "n_known", "train_tokens", "base_score", "score")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crosspolytope.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents", "doc_id", "text"),
                                        read(spark, sf_dir, "benchmark"))
    return decontaminate.with_digest(found).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP8_SQL = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
             FROM documents),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS s
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, least(len(ws), 1)) + 1)) AS i FROM b)),
dw AS (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT rid, i, dw.n, item_id FROM dw JOIN iw ON iw.s = dw.s AND iw.n = dw.n),
c AS (SELECT rid, count(DISTINCT p) AS hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
f AS (SELECT rid, count(*) AS items, string_agg(k, ',' ORDER BY k) AS ids
      FROM (SELECT DISTINCT rid, coalesce(CAST(item_id AS VARCHAR), 'null') AS k FROM h) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(hit, 0) AS n_hit, coalesce(items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit, 0) > 0 AND 20 * coalesce(hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN f USING (rid)
"""


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
           FROM documents),
win AS (SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS s
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM rep),
words AS (SELECT rid, p, ws[p] AS x FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.encode(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain rounds: the distance to every entry, then the means."""
    steps = [f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS MATERIALIZED (SELECT rid, (i - 1) // w AS p, (i - 1) % w AS d, xs[i] AS v
  FROM (SELECT rid, xs, len(xs) // {parts} AS w, unnest(range(1, len(xs) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, d, v AS c FROM comp WHERE rid <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT rid, p, min(s * {entries} + e) % {entries} AS e, min(s * {entries} + e) // {entries} AS s
  FROM (SELECT rid, p, e, CAST(sum((v - c) * (v - c)) AS BIGINT) AS s FROM comp JOIN book{r} USING (p, d) GROUP BY rid, p, e)
  GROUP BY rid, p)""")
        if r < rounds:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (SELECT p, e, d, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{r} LEFT JOIN (SELECT p, e, d, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
                          FROM near{r} JOIN comp USING (rid, p) GROUP BY p, e, d) USING (p, e, d))""")
    steps.append(f"""
coded AS (SELECT rid, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(s) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, d)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)""")
    return ",".join(steps)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = passages.fit(docs, read(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out))
    return passages.score(docs, model).select(
        F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
       lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t),
words AS (SELECT 's' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
          UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
w AS MATERIALIZED (SELECT side, rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM words),
f AS MATERIALIZED (SELECT side, rid, array_to_string(ws[i:i + n - 1], ' ') AS f FROM
  (SELECT side, rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS n))),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
b AS MATERIALIZED (SELECT f, xor(list_reduce([4294967295] || list_transform(range(1, len(h), 2),
       lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1),
       lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, crc),
n AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM f JOIN b USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM n) + 10000 AS DOUBLE))
  / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM n) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM n),
d AS (SELECT rid, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
      FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE side = 's' GROUP BY rid),
z AS (SELECT doc_id, len(ws) AS n, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8)
  AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM w LEFT JOIN d USING (rid) WHERE side = 's'),
r AS (SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM z)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) * 5 // 100 FROM z WHERE n >= 20) THEN place END AS rank FROM r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_langid": op2_langid,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_ngram_lm": op5_ngram_lm,
    "op6_embeddings": op6_embeddings,
    "op7_mixing": op7_mixing,
    "op8_decontamination": op8_decontamination,
    "op9_substring": op9_substring,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_quality": op12_quality,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op6_embeddings": OP6_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_substring": OP9_SQL,
    "op11_vector_codes": _op11_sql(),
    "op13_importance": OP13_SQL,
}
