"""Sources and sinks (S1-S11, K1-K8) over files: each report writes the
driver's rows to the shared folder in the layout of an export, and reads them
through the library's own readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.formats import CSV_READ, CSV_WRITE
from kardex.operators import files as FL
from kardex.operators import lookups as LK
from kardex.plans.bindings import cte, load, read_table
from kardex.plans.catalog import register
from kardex.plans.q_bibs import FEATURES_SQL, bibs_of, feature_report
from kardex.plans.q_files import NESTED_SQL, nested_totals
from kardex.session import cut_lineage, staging_dir
from kardex.sinks import writers as W
from kardex.sources import readers as R

CELLS = ["part_id", "production_type", "padded", "quoted", "rest"]
CELLS_SQL = cte("sheet_cells") + "SELECT CAST(part_id AS VARCHAR) AS part_id, production_type, padded, quoted, rest FROM sheet_cells"


def _cells(spark, sf_dir) -> DataFrame:
    cells = load(spark, sf_dir, "sheet_cells")
    return cells.select(F.col("part_id").cast("string").alias("part_id"), *CELLS[1:])


@register("report_csv_file", CELLS_SQL)
def report_csv_file(spark, sf_dir):
    """Carriage returns, quotes and outer blanks in cells."""
    path = staging_dir(spark, "report")
    W.write_report_csv(_cells(spark, sf_dir).withColumn("extra", F.lit(1)), path, CELLS)
    return R.read_holdings(spark, path)


@register("exported_holdings_file", cte("holdings") + """
SELECT mms_id, holding_id, call_number FROM holdings""")
def exported_holdings_file(spark, sf_dir):
    """An export with a byte order mark and CR LF line ends."""
    path = staging_dir(spark, "holdings")
    h = load(spark, sf_dir, "holdings").select("mms_id", "holding_id", "call_number")
    (h.toDF("﻿MMS Id", "Holding Id", "Permanent Call Number").write.options(**dict(CSV_WRITE, lineSep="\r\n"))
     .option("header", True).csv(path))
    return R.read_holdings(spark, path, ["mms_id", "holding_id", "call_number"])


@register("tsv_report_file", cte("sheet_cells") + """
SELECT CAST(part_id AS VARCHAR) AS part_id, 'x, ' || coalesce(padded, '') AS names, quoted FROM sheet_cells""")
def tsv_report_file(spark, sf_dir):
    """K2: arrays joined, read again as tab-separated text."""
    path = staging_dir(spark, "tsv")
    W.write_tsv(_cells(spark, sf_dir).select("part_id", F.array(F.lit("x"), "padded").alias("names"), "quoted"), path)
    return spark.read.options(**CSV_READ).option("header", True).option("sep", "\t").csv(path)


@register("headerless_types_file", cte("sheet_cells") + """
SELECT CAST(part_id AS VARCHAR) AS inventory_no, production_type FROM sheet_cells""")
def headerless_types_file(spark, sf_dir):
    """S6."""
    path = staging_dir(spark, "types")
    _cells(spark, sf_dir).select("part_id", "production_type").write.options(**CSV_WRITE).csv(path)
    return R.read_headerless_csv(spark, path, ["inventory_no", "production_type"])


@register("sheet_tabs", cte("sheet_cells") + "".join(
    f"{'UNION ALL ' if i else ''}SELECT '{f}' AS tab, CAST(part_id AS VARCHAR) AS part_id, padded, rest FROM sheet_cells "
    for i, f in enumerate(("csv", "parquet"))))
def sheet_tabs(spark, sf_dir):
    """A tab as CSV and one as Parquet."""
    path = staging_dir(spark, "tabs")
    cells = _cells(spark, sf_dir).select("part_id", "padded", "rest")
    W.write_report_csv(cells, f"{path}/csv")
    cells.write.parquet(f"{path}/parquet")
    tabs = [R.read_sheet(spark, f"{path}/{f}", f).select(F.lit(f).alias("tab"), "part_id", "padded", "rest") for f in ("csv", "parquet")]
    return tabs[0].unionByName(tabs[1])


# ----------------------------------------------------------------- S2-S5
def write_arrays(records: DataFrame, path: str) -> str:
    """One JSON array of the records per partition, a line feed behind each;
    returns what stands between two records."""
    rows = cut_lineage(records.select(F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("json")))
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("id", F.monotonically_increasing_id())
    ends = rows.groupBy("part").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    lines = rows.join(F.broadcast(ends), "part").select(F.concat(
        F.when(F.col("id") == F.col("first"), "[").otherwise(""), "json",
        F.when(F.col("id") == F.col("last"), "]").otherwise(", ")).alias("value"))
    lines.write.text(path)
    return "}, \n{"


@register("array_records_file", "SELECT doc_id, text, lang, source FROM documents")
def array_records_file(spark, sf_dir):
    """Whole texts in JSON arrays that are cut between records."""
    path = staging_dir(spark, "records")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return R.read_records_json(spark, path, d.schema, between=write_arrays(d, path))


@register("fixture_records_file", cte("digital") + "SELECT inventory_number, batch_number, pk FROM digital")
def fixture_records_file(spark, sf_dir):
    """S3: ``{model, pk, fields}`` records in JSON arrays, the schema inferred."""
    path = staging_dir(spark, "fixture")
    d = load(spark, sf_dir, "digital").select(F.lit("digital").alias("model"), "pk", F.struct(
        "inventory_number", "batch_number").alias("fields"))
    found = R.read_fixture_json(spark, path, between=write_arrays(d, path))
    return found.select("inventory_number", "batch_number", "pk")


@register("asset_documents_file", """
SELECT 'd' || CAST(doc_id AS VARCHAR) AS uuid, text AS title, source, ceil((SELECT count(*) FROM documents) / 40) AS documents
FROM documents""")
def asset_documents_file(spark, sf_dir):
    """Documents of forty assets, as many as it takes."""
    path = staging_dir(spark, "assets")
    d = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("uuid"), F.col("text").alias("title"), "source")
    W.write_asset_docs(d, path, per_document=40)
    documents = F.lit(float(spark.read.text(path).count())).alias("documents")
    schema = T.StructType([T.StructField("media", T.StructType([T.StructField("assets", T.ArrayType(d.schema))]))])
    return R.read_assets(spark, path, schema).select("uuid", "title", "source", documents)


@register("url_list_file", """
SELECT CASE WHEN url LIKE '%.html' THEN 'html' ELSE 'other' END AS kind, count(*) AS paths,
       count(DISTINCT trim(url)) AS different FROM pages GROUP BY 1""")
def url_list_file(spark, sf_dir):
    """S5 over the pages' addresses."""
    path = staging_dir(spark, "paths")
    read_table(spark, sf_dir, "pages").select(F.concat(F.lit("  "), "url", F.lit("\t")).alias("value")).write.text(path)
    kind = F.when(F.endswith("path", F.lit(".html")), "html").otherwise("other").alias("kind")
    return R.read_path_lists(spark, path).groupBy(kind).agg(
        F.count(F.lit(1)).alias("paths"), F.count_distinct("path").alias("different"))


# ----------------------------------------------------------------- XML
@register("xml_rows_file", """
SELECT CAST(p_partkey AS VARCHAR) AS inventory_id, p_name AS title,
       CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand || ' & <Co>' END AS brand FROM part""")
def xml_rows_file(spark, sf_dir):
    """Marks that XML escapes; nulls become empty elements."""
    path = staging_dir(spark, "xml")
    p = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("inventory_id"), F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 3 != 0, F.concat("p_brand", F.lit(" & <Co>"))).alias("brand"))
    W.write_xml_rows(p, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in p.columns])
    back = R.read_xml_rows(spark, path, "MediaResource", schema, cut=True)
    return back.select("inventory_id", "title", F.coalesce("brand", F.lit("")).alias("brand"))


@register("marcxml_features", FEATURES_SQL)
def marcxml_features(spark, sf_dir):
    """The features of bibs that went through MARCXML files."""
    path = staging_dir(spark, "marc")
    bibs = bibs_of(spark, sf_dir)
    (bibs.select("leader", "controlfield", "datafield").write.format("xml").option("rootTag", "collection")
     .option("rowTag", "record").save(path))
    from kardex.functions.marc import bib_id
    mentions = bibs.select(F.col("bib_id").alias("__id"), "mentions")
    return feature_report(R.read_marc(spark, path).withColumn("bib_id", bib_id()).join(
        mentions, F.col("bib_id") == F.col("__id")).drop("__id"))


@register("language_codes_file", cte("language_codes") + """
SELECT code, arg_max(name, row_ordinal) AS name FROM language_codes GROUP BY code""")
def language_codes_file(spark, sf_dir):
    """Names as text and as elements with an attribute; later codes win."""
    path = staging_dir(spark, "codes")
    rows = load(spark, sf_dir, "language_codes").orderBy("row_ordinal").coalesce(1)
    name = F.struct(F.when(F.col("row_ordinal") % 2 == 0, "yes").alias("_authorized"), F.col("name").alias("_VALUE"))
    (rows.select("code", name.alias("name")).write.format("xml").option("rootTag", "codelist")
     .option("rowTag", "language").save(path))
    return R.read_language_codes(spark, path)


@register("nested_xml_file", NESTED_SQL)
def nested_xml_file(spark, sf_dir):
    """K6: the totals of nested documents that were written and read."""
    path = staging_dir(spark, "nested")
    rows = load(spark, sf_dir, "hot_inventory")
    res = load(spark, sf_dir, "hot_resources").withColumnRenamed("inventory_number", "Inventory_no")
    parts = LK.nested_parts(rows, res, ["pk", "line"])
    W.write_nested_xml(parts, path)
    return nested_totals(R.read_xml_rows(spark, path, "ROW", parts.schema, cut=True))


@register("xml_to_json_files", """
SELECT p_partkey % 50 = 7 OR p_partkey % 50 = 9 AS malformed, p_partkey AS id,
       CASE WHEN p_partkey % 50 = 7 OR p_partkey % 50 = 9 THEN NULL ELSE p_name END AS title FROM part""")
def xml_to_json_files(spark, sf_dir):
    """K7: records with a word where a number must be, and records without end
    tags, are malformed; the good ones of the same files stay good."""
    path = staging_dir(spark, "xml-in")
    key = F.col("p_partkey")
    read_table(spark, sf_dir, "part").select(F.concat(
        F.lit("<row n='"), key, F.lit("'><id>"), F.when(key % 50 == 7, "none").otherwise(key.cast("string")),
        F.lit("</id><title> "), "p_name", F.when(key % 50 == 9, "").otherwise(" </title></row>")).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("_n", T.LongType()), T.StructField("id", T.LongType()), T.StructField("title", T.StringType())])
    bad = W.xml_to_json(spark, path, f"{path}-json", "row", schema)
    good = spark.read.schema(schema).json(f"{path}-json/malformed=false")
    number = F.regexp_extract("_corrupt_record", "^<row n='([0-9]+)'", 1).cast("long")
    return good.select(F.lit(False).alias("malformed"), "id", "title").unionByName(
        bad.select(F.lit(True).alias("malformed"), number.alias("id"), F.lit(None).cast("string").alias("title")))


# ----------------------------------------------------------------- K4 / K8 / S11
@register("sectioned_report_files", """
SELECT 'S' || CAST(p_size % 4 AS VARCHAR) AS section, CAST(p_partkey AS VARCHAR) AS part_id FROM part WHERE p_size % 4 <> 2""")
def sectioned_report_files(spark, sf_dir):
    """K4: the sections after a second run that has one section less."""
    path = staging_dir(spark, "sections")
    p = read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), (F.col("p_size") % 4).cast("string")).alias("section"), F.col("p_partkey").cast("string").alias("part_id"))
    W.write_sectioned_report(p, path)
    W.write_sectioned_report(p.where("section <> 'S2'"), path)
    return spark.read.options(**CSV_READ).option("header", True).csv(path).select("section", "part_id")


@register("written_if_valid", cte("batch_assets") + """
SELECT 'with_problems' AS run, 0 AS written, count(*) AS problems FROM (
  SELECT uuid FROM batch_assets WHERE match_asset IS NOT NULL AND match_asset <> '' AND match_asset NOT IN (SELECT uuid FROM batch_assets))
UNION ALL SELECT 'valid', (SELECT count(*) FROM batch_assets), 0""")
def written_if_valid(spark, sf_dir):
    """K8: assets with link problems are not written, valid ones are."""
    path = staging_dir(spark, "valid")
    a = load(spark, sf_dir, "batch_assets")
    linked = a.where("match_asset <> ''").select("uuid", "match_asset")
    problems = linked.join(a.select(F.col("uuid").alias("match_asset")), "match_asset", "left_anti")
    found = W.write_if_valid(a, problems, f"{path}/first")
    assert found is not None and W.write_if_valid(a, problems.limit(0), f"{path}/second") is None
    written = spark.read.schema(a.schema).json(f"{path}/second").agg(F.count(F.lit(1)).alias("written"))
    return found.agg(F.count(F.lit(1)).alias("problems")).select(
        F.lit("with_problems").alias("run"), F.lit(0).cast("long").alias("written"), "problems").unionByName(
        written.select(F.lit("valid").alias("run"), "written", F.lit(0).cast("long").alias("problems")))


# ----------------------------------------------------------------- H4, P7 over real texts
@register("text_codes")
def text_codes(spark, sf_dir):
    """H4 over whole documents, with a code put before and behind the text, and
    over addresses."""
    key = F.col("doc_id").cast("string")
    d = read_table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), key).alias("id"), F.concat(
        F.lit("Reel_M10"), key, F.lit("_"), "text", F.lit(" XFF20"), key, F.lit("T, T01")).alias("text"))
    p = read_table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id")).alias("id"), F.col("url").alias("text"))
    return d.unionByName(p).select("id", LK.extract_codes("text").alias("inventory_numbers"))


MEDIA_SQL = r"""
WITH p AS (SELECT regexp_extract(regexp_replace(trim(url), '/+$', ''), '([^/]*)$', 1) AS filename FROM pages)
SELECT filename FROM p WHERE regexp_matches(filename, '^.+\.[^.]+$', 's') AND NOT lower(filename) LIKE '%.json'
"""


@register("media_addresses", MEDIA_SQL)
def media_addresses(spark, sf_dir):
    """The media files among the pages' addresses."""
    files = FL.media_file_names(read_table(spark, sf_dir, "pages").select(F.col("url").alias("path")))
    return files
