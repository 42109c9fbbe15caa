"""Row filters and text formats over the driver's tables (P1, P3, P8, P10, H31,
and the record formats of S1-S7, K1-K6 as text round trips: the options and
schemas are those of the sources and sinks, no file is written)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.formats import CSV_READ, CSV_WRITE
from kardex.functions.text import title_join
from kardex.operators import lookups as LK
from kardex.operators import validation as V
from kardex.operators.keys import drop_missing_key
from kardex.plans.bindings import cte, load, read_table
from kardex.plans.catalog import register

# ----------------------------------------------------------------- P1 / P3
BETWEEN_SQL = cte("modified_records") + """
SELECT inventory_id, modified_text FROM modified_records
WHERE inventory_id % 13 <> 0 AND modified_day BETWEEN DATE '1995-03-01' AND DATE '1996-02-29'
"""


@register("modified_between", BETWEEN_SQL)
def modified_between(spark, sf_dir):
    df = load(spark, sf_dir, "modified_records")
    return V.modified_between(df, "modified_text", "03/01/1995", "1996-02-29").select("inventory_id", "modified_text")


ROLLING_SQL = cte("modified_records") + """
SELECT inventory_id, modified_day FROM modified_records
WHERE modified_day BETWEEN DATE '1996-12-18' AND DATE '1997-01-01'
"""


@register("rolling_window", ROLLING_SQL)
def rolling_window(spark, sf_dir):
    df = load(spark, sf_dir, "modified_records")
    return V.rolling_window(df, "modified_day", "1997-01-01").select("inventory_id", "modified_day")


# ----------------------------------------------------------------- P8 / P10
KEYED_SQL = cte("hot_holdings") + "SELECT holding_id, call_number FROM hot_holdings WHERE trim(call_number) <> ''"


@register("keyed_holdings", KEYED_SQL)
def keyed_holdings(spark, sf_dir):
    return drop_missing_key(load(spark, sf_dir, "hot_holdings"), "call_number").select("holding_id", "call_number")


BATCH_SQL = cte("digital") + """
SELECT pk, batch_number FROM digital WHERE CAST(batch_number AS VARCHAR) = (SELECT min(CAST(batch_number AS VARCHAR)) FROM digital)
"""


@register("first_batch", BATCH_SQL)
def first_batch(spark, sf_dir):
    d = load(spark, sf_dir, "digital").select("pk", F.col("batch_number").cast("string").alias("batch_number"))
    return LK.batch_records(d, d.agg(F.min("batch_number")).first()[0])


# ----------------------------------------------------------------- H31
TITLES_SQL = """
SELECT p_partkey AS part_id, array_to_string(list_filter([p_name, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END,
       CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) END], lambda x: coalesce(x, '') <> ''), '. ') AS full_title
FROM part
"""


@register("inventory_titles", TITLES_SQL)
def inventory_titles(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("part_id"), title_join(
        F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(""),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size").cast("string"))).alias("full_title"))


# ----------------------------------------------------------------- S1 / S6 / K1 / K2
CELLS = ["production_type", "padded", "quoted", "rest"]
CELLS_SQL = cte("sheet_cells") + "SELECT * FROM sheet_cells"


@register("csv_round_trip", CELLS_SQL)
def csv_round_trip(spark, sf_dir):
    df = load(spark, sf_dir, "sheet_cells")
    schema = ", ".join(f"{c} string" for c in CELLS)
    line = F.to_csv(F.struct(*CELLS), CSV_WRITE)
    return df.select("part_id", F.from_csv(line, schema, CSV_READ).alias("c")).select("part_id", "c.*")


# ----------------------------------------------------------------- S2-S4 / K3
ASSETS_SQL = """
SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) AS uuid, text AS title, source FROM documents
"""


@register("asset_documents", ASSETS_SQL)
def asset_documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("uuid"), F.col("text").alias("title"), "source")
    schema = T.StructType([T.StructField("media", T.StructType([T.StructField("assets", T.ArrayType(d.schema))]))])
    text = F.to_json(F.struct(F.struct(F.array(F.struct(*d.columns)).alias("assets")).alias("media")))
    return d.select(F.from_json(text, schema).alias("j")).select(F.explode("j.media.assets").alias("a")).select("a.*")


# ----------------------------------------------------------------- S7 / K5 / K6
XML_SQL = """
SELECT p_partkey AS part_id, p_name AS title, p_brand AS brand FROM part
"""


@register("xml_rows", XML_SQL)
def xml_rows(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"))
    row = {"rowTag": "MediaResource"}
    return p.select(F.from_xml(F.to_xml(F.struct(*p.columns), row), p.schema, row).alias("x")).select("x.*")
