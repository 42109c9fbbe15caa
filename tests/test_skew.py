"""Skew: one key (the blank key) holds a third of all rows.  Results must be
whole and equal to a brute-force DuckDB computation on the same input."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kardex.functions.text import holdings_key
from kardex.operators import keys as K
from kardex.operators import matching as M

SF = "/root/testdata/sf0.01"

HOLDINGS = f"""SELECT CAST(o_custkey AS VARCHAR) AS mms_id, CAST(o_orderkey AS VARCHAR) AS holding_id,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'M ' || CAST(o_orderkey % 5000 AS VARCHAR) END AS call_number,
  o_orderkey AS row_ordinal FROM read_parquet('{SF}/orders.parquet')"""
INVENTORY = f"""SELECT o_orderkey AS inventory_id,
  CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE 'm' || CAST(o_orderkey % 7000 AS VARCHAR) END AS inventory_no,
  'T' AS title, o_orderkey AS row_ordinal FROM read_parquet('{SF}/orders.parquet')"""
DIGITAL = f"""SELECT event_id AS pk,
  CASE WHEN event_id % 3 = 2 THEN '' ELSE 'M' || CAST(event_id % 6000 AS VARCHAR) END AS inventory_number,
  event_id AS row_ordinal FROM read_parquet('{SF}/events.parquet')"""


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW holdings AS {HOLDINGS}")
    c.execute(f"CREATE VIEW inventory AS {INVENTORY}")
    c.execute(f"CREATE VIEW digital AS {DIGITAL}")
    return c


def _spark(spark, con, name):
    return spark.createDataFrame(con.execute(f"SELECT * FROM {name}").df())


def test_skewed_classes(spark, con):
    h, i = _spark(spark, con, "holdings"), _spark(spark, con, "inventory")
    ids = M.source_ids(h, i)
    counts = M.source_counts(ids)
    vals = spark.createDataFrame([("",), ("M7",), ("M3",), ("M1|",)], "value string")
    got = sorted((r.section, r.inventory_number, r.holdings_count, r.inventory_count)
                 for r in M.classify_single_values(vals, counts).collect())
    exp = con.execute("""
      WITH c AS (SELECT k, count(*) FILTER (WHERE s = 'h') AS h, count(*) FILTER (WHERE s = 'i') AS f FROM (
          SELECT upper(replace(call_number, ' ', '')) AS k, 'h' AS s FROM holdings
          UNION ALL SELECT upper(replace(inventory_no, chr(160), '')), 'i' FROM inventory) GROUP BY k)
      SELECT v, coalesce(h, 0), coalesce(f, 0) FROM (VALUES (''), ('M7'), ('M3')) t(v) LEFT JOIN c ON c.k = t.v""").fetchall()
    assert {(r[1], r[2], r[3]) for r in got} == set(exp)
    # the long report keeps every id of the hot blank key
    long = M.attach_ids(M.classify_single_values(vals, counts), ids)
    blank = long.filter(F.col("inventory_number") == "").count()
    assert blank == con.execute("SELECT count(*) FROM holdings WHERE call_number = ''").fetchone()[0] + \
        con.execute("SELECT count(*) FROM inventory WHERE inventory_no = ''").fetchone()[0]


def test_skewed_duplicates_and_keep_first(spark, con):
    h = _spark(spark, con, "holdings")
    dup = K.duplicate_rows(h, "call_number", "row_ordinal", hashed=False)
    exp = con.execute("""SELECT count(*) FROM (SELECT *, count(*) OVER (PARTITION BY call_number) AS c
                         FROM holdings) WHERE c > 1""").fetchone()[0]
    assert dup.count() == exp
    first = K.keep_first(h, "call_number", "row_ordinal")
    exp = con.execute("SELECT call_number, min(row_ordinal) FROM holdings GROUP BY 1").fetchall()
    assert sorted((r.call_number, r.row_ordinal) for r in first.collect()) == sorted(exp)


def test_skewed_perfect_matches_and_summary(spark, con):
    h, i, d = (_spark(spark, con, n) for n in ("holdings", "inventory", "digital"))
    got = M.perfect_matches(h, d, i, sort=False).count()
    exp = con.execute("""
      SELECT count(*) FROM
        (SELECT upper(replace(call_number, ' ', '')) k FROM holdings GROUP BY 1 HAVING count(*) = 1) a
        JOIN (SELECT upper(replace(inventory_no, chr(160), '')) k FROM inventory GROUP BY 1 HAVING count(*) = 1) b USING (k)
        JOIN (SELECT inventory_number k FROM digital GROUP BY 1 HAVING count(*) = 1) c USING (k)""").fetchone()[0]
    assert got == exp
    s = K.key_summary(h, holdings_key("call_number")).first()
    assert s.empty == con.execute("SELECT count(*) FROM holdings WHERE call_number = ''").fetchone()[0]
    assert s.total == con.execute("SELECT count(*) FROM holdings").fetchone()[0]


# --- the hot key's partition is split -------------------------------------------------

SPLIT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in SPLIT_CONF}
    for k, v in SPLIT_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _is_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, n=60_000):
    return spark.range(0, n, 1, 4).selectExpr(
        "CAST(id AS STRING) AS id", "CASE WHEN id % 3 = 0 THEN '' ELSE 'M' || CAST(id % 20011 AS STRING) END AS key",
        "md5(CAST(id AS STRING)) AS pad", "id AS ordinal")


def _operators(hot):
    from kardex.operators import lookups as LK
    reduced = hot.select("key", "id", "ordinal")
    ids = hot.select("key", F.lit("holdings").alias("source"), "id")
    classes = M.classify_single_values(hot.select(F.col("key").alias("value")).distinct(), M.source_counts(ids))
    rows = hot.select(F.col("id").alias("inventory_id"), F.col("key").alias("inventory_no"), "pad").withColumn(
        "inventory_no", F.when(F.col("inventory_no") == "", "M1").otherwise(F.col("inventory_no")))
    res = rows.select(F.col("inventory_no").alias("Inventory_no"), "pad")
    bib = hot.select("id", F.col("key").alias("inventory_number"), "pad")
    inv = reduced.select(F.col("key").alias("inv_key"), F.col("ordinal").alias("row_ordinal"))
    return {
        "control": lambda: hot.join(reduced.select(F.col("key").alias("k")).distinct().hint("merge"), F.col("key") == F.col("k")),
        "A4 ids_by_key": lambda: K.ids_by_key(hot, "key", "pad"),
        "J2/J3 attach_ids": lambda: M.attach_ids(classes, ids.withColumn("id", F.md5("id"))),
        "J8 match_resources": lambda: LK.match_resources(rows, res)[1],
        "J10 lookup_exactly_one": lambda: LK.lookup_exactly_one(hot, reduced, "key", "key", "t_", ["id"]),
        "J11 assemble_sources": lambda: LK.assemble_sources(bib, inv)[0],
        "J14 unmatched": lambda: M.unmatched(hot, reduced, "key", "key", "none"),
        "W1 duplicate_rows": lambda: K.duplicate_rows(hot, "key", "ordinal", hashed=False),
    }


@pytest.mark.parametrize("name", ["A4 ids_by_key", "J2/J3 attach_ids", "J8 match_resources", "J10 lookup_exactly_one",
                                  "J11 assemble_sources", "J14 unmatched", "W1 duplicate_rows"])
def test_hot_key_is_split(splitting, name):
    assert _is_split(_operators(_hot(splitting))[name]())


def test_control_aggregate_on_the_join_key_blocks_the_split(splitting):
    assert not _is_split(_operators(_hot(splitting))["control"]())


def test_hot_key_of_nested_documents_is_split(splitting, monkeypatch):
    from kardex.operators import lookups as LK
    numbered, number = [], LK.number_within
    monkeypatch.setattr(LK, "number_within", lambda df, *a: numbered.append(df) or number(df, *a))
    hot = _hot(splitting)
    rows = hot.select(F.col("id").alias("inventory_id"), F.when(F.col("key") == "", "M1").otherwise(F.col("key")).alias("inventory_no"))
    res = rows.select(F.col("inventory_no").alias("Inventory_no"), F.md5("inventory_id").alias("pad"))
    parts = LK.nested_parts(rows, res, ["pad"])
    assert [_is_split(df) for df in numbered] == [True, True]
    assert parts.agg(F.sum(F.size("rows")), F.sum(F.size("matched_resources"))).first()[:] == (60_000, 60_000)
