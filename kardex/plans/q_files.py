"""Reports over file lists, asset batches and code extraction (H4, H5, P7,
G1, G2, J5, J8-J11, J14, J15, A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kardex.functions.text import holdings_key, inventory_key
from kardex.operators import files as FL
from kardex.operators import lookups as LK
from kardex.operators.changes import compact_call_number
from kardex.plans.bindings import _prefix, cte, load
from kardex.plans.catalog import register

# ----------------------------------------------------------------- H4
_K = "(row_index + 10)"
_KS = f"CAST({_K} AS VARCHAR)"
CODES_SQL = cte("legacy_paths") + f"""
SELECT row_index, legacy_path,
  CASE row_index % 6
    WHEN 0 THEN {_prefix(_K)} || {_KS}
    WHEN 1 THEN {_prefix(_K)} || {_KS} || 'T'
    WHEN 2 THEN 'T' || {_KS}
    WHEN 3 THEN {_prefix(_K)} || {_KS} || 'M|XFF' || CAST({_K} + 1 AS VARCHAR) || 'M'
    WHEN 4 THEN ''
    ELSE 'M' || {_KS} END AS inventory_numbers
FROM legacy_paths
"""


@register("extracted_codes", CODES_SQL)
def extracted_codes(spark, sf_dir):
    df = load(spark, sf_dir, "legacy_paths")
    return df.select("row_index", "legacy_path", LK.extract_codes("legacy_path").alias("inventory_numbers"))


# ----------------------------------------------------------------- H5
COMPACT_SQL = cte("holdings") + """
SELECT holding_id, call_number,
  CASE WHEN length(call_number) >= 2 AND substr(call_number, length(call_number) - 1, 1) = ' '
        AND right(call_number, 1) IN ('T', 'M', 'R') AND strpos(call_number, '-') = 0
        AND strpos(lower(call_number), 'and') = 0
       THEN left(call_number, length(call_number) - 2) || right(call_number, 1)
       ELSE call_number END AS new_call_number
FROM holdings
"""


@register("compacted_call_numbers", COMPACT_SQL)
def compacted_call_numbers(spark, sf_dir):
    h = load(spark, sf_dir, "holdings")
    return h.select("holding_id", "call_number", compact_call_number("call_number").alias("new_call_number"))


# ----------------------------------------------------------------- G1 / G2
MISMATCH_SQL = cte("file_lists", "asset_files") + """
, f AS (SELECT DISTINCT CASE page_id % 5 WHEN 0 THEN 'f' || CAST(page_id % 97 AS VARCHAR) || '.mov'
                                         WHEN 1 THEN 'f' || CAST(page_id % 97 AS VARCHAR) || '.MP4' END AS filename
        FROM file_lists WHERE page_id % 7 <> 6 AND page_id % 5 IN (0, 1))
, m AS (SELECT DISTINCT CASE WHEN file_name = '' THEN 'NO FILE NAME (' || uuid || ')' ELSE file_name END AS filename
        FROM asset_files)
SELECT 'file_lists_not_metadata' AS section, filename FROM (SELECT filename FROM f EXCEPT SELECT filename FROM m)
UNION ALL
SELECT 'metadata_not_file_lists' AS section, filename FROM (SELECT filename FROM m EXCEPT SELECT filename FROM f)
"""


@register("filename_mismatches", MISMATCH_SQL)
def filename_mismatches(spark, sf_dir):
    files = FL.media_file_names(load(spark, sf_dir, "file_lists"))
    meta = FL.metadata_file_names(load(spark, sf_dir, "asset_files"))
    return FL.filename_mismatches(files, meta)


# ----------------------------------------------------------------- J9 / A6
LINKS_SQL = cte("batch_assets") + """
, t AS (SELECT uuid, arg_max(split_part(inventory_numbers_text, '|', 1), row_ordinal) AS inv,
               arg_max(record_type, row_ordinal) AS rt
        FROM batch_assets WHERE coalesce(uuid, '') <> '' GROUP BY uuid)
, s AS (SELECT a.uuid, a.record_type, a.match_asset, split_part(a.inventory_numbers_text, '|', 1) AS inv,
               t.uuid AS t_uuid, t.inv AS t_inv, t.rt AS t_rt
        FROM batch_assets a LEFT JOIN t ON t.uuid = a.match_asset WHERE coalesce(a.match_asset, '') <> '')
SELECT uuid, CASE WHEN t_uuid IS NULL THEN 'Match asset ' || match_asset || ' for record ' || uuid || ' not found in batch.'
  ELSE 'Inventory numbers do not match for match_asset relationship: ' || record_type || ' ' || uuid || ': '''
       || inv || ''', ' || t_rt || ' ' || t_uuid || ': ''' || t_inv || '''' END AS problem
FROM s WHERE t_uuid IS NULL OR inv IS DISTINCT FROM t_inv
"""


def _assets(spark, sf_dir):
    a = load(spark, sf_dir, "batch_assets")
    return a.withColumn("inventory_numbers", F.split("inventory_numbers_text", r"\|")).drop("inventory_numbers_text")


@register("link_problems", LINKS_SQL)
def link_problems(spark, sf_dir):
    return LK.validate_links(_assets(spark, sf_dir))


COUNTS_SQL = cte("batch_assets") + """
SELECT count(*) FILTER (WHERE record_type = 'asset') AS assets,
       count(*) FILTER (WHERE record_type = 'track') AS tracks FROM batch_assets
"""


@register("asset_counts", COUNTS_SQL)
def asset_counts(spark, sf_dir):
    return LK.count_by_type(_assets(spark, sf_dir))


# ----------------------------------------------------------------- J5
_SUFFIX_CTE = """
, idx AS (SELECT upper(replace(call_number, ' ', '')) AS ck, mms_id FROM holdings)
, c AS (SELECT keys.key, s.p, keys.key || s.suf AS cand
        FROM keys CROSS JOIN (VALUES (0, ''), (1, 'T'), (2, 'M'), (3, 'R')) AS s(p, suf))
, hits AS (SELECT c.key, c.p, c.cand, idx.mms_id FROM c JOIN idx ON idx.ck = c.cand)
, best AS (SELECT key, cand AS matched_key, mms_id AS bib_id, p > 0 AS suffixed
           FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY p, mms_id) AS rn FROM hits) WHERE rn = 1)
"""

SUFFIX_SQL = cte("holdings", "inventory") + """
, keys AS (SELECT DISTINCT upper(replace(inventory_no, chr(160), '')) AS key FROM inventory)
""" + _SUFFIX_CTE + "SELECT * FROM best"


def _bib_index(spark, sf_dir):
    h = load(spark, sf_dir, "holdings")
    return h.select(holdings_key("call_number").alias("call_key"), F.col("mms_id").alias("bib_id"))


@register("suffix_matches", SUFFIX_SQL)
def suffix_matches(spark, sf_dir):
    inv = load(spark, sf_dir, "inventory")
    keys = inv.select(inventory_key("inventory_no").alias("key")).distinct()
    return LK.first_suffix_match(keys, _bib_index(spark, sf_dir))


# ----------------------------------------------------------------- J10 / J15
NEW_MEDIA_SQL = cte("holdings", "inventory", "media_items", "media_batch") + """
, b AS (SELECT uuid, nullif(trim(match_asset_uuid), '') AS match_asset FROM media_batch)
, it AS (SELECT item_uuid, count(*) AS n, min(inventory_id_fk) AS fk FROM media_items GROUP BY item_uuid)
, inv AS (SELECT inventory_id, count(*) AS n, min(inventory_no) AS no FROM inventory GROUP BY inventory_id)
, s AS (SELECT b.uuid, b.match_asset, it.n AS itn, inv.n AS invn, inv.inventory_id, inv.no
        FROM b LEFT JOIN it ON it.item_uuid = b.uuid
               LEFT JOIN inv ON inv.inventory_id = CASE WHEN it.n = 1 THEN it.fk END)
, r AS (SELECT uuid, match_asset,
          CASE WHEN itn IS NULL THEN 'item missing' WHEN itn > 1 THEN 'item ambiguous'
               WHEN invn IS NULL THEN 'inventory missing' WHEN invn > 1 THEN 'inventory ambiguous'
               ELSE 'ok' END AS status,
          CASE WHEN invn = 1 THEN inventory_id END AS inv_inventory_id,
          CASE WHEN invn = 1 THEN no END AS inv_inventory_no
        FROM s)
, keys AS (SELECT DISTINCT upper(replace(inv_inventory_no, chr(160), '')) AS key FROM r
           WHERE inv_inventory_no IS NOT NULL)
""" + _SUFFIX_CTE + """
SELECT r.*, best.matched_key, best.bib_id, best.suffixed
FROM r LEFT JOIN best ON best.key = upper(replace(r.inv_inventory_no, chr(160), ''))
"""


@register("new_media_assembly", NEW_MEDIA_SQL)
def new_media_assembly(spark, sf_dir):
    return LK.assemble_new_media(load(spark, sf_dir, "media_batch"), load(spark, sf_dir, "media_items"),
                                 load(spark, sf_dir, "inventory"), _bib_index(spark, sf_dir))


# ----------------------------------------------------------------- J11
BATCH_SQL = cte("holdings", "inventory", "digital") + """
, fi AS (SELECT upper(replace(inventory_no, chr(160), '')) AS k, arg_min(inventory_id, row_ordinal) AS inventory_id,
                arg_min(title, row_ordinal) AS title FROM inventory GROUP BY 1)
, a AS (SELECT d.pk, d.batch_number, d.inventory_number, fi.inventory_id, fi.title
        FROM digital d JOIN fi ON fi.k = d.inventory_number)
, keys AS (SELECT DISTINCT inventory_number AS key FROM a)
""" + _SUFFIX_CTE + """
SELECT a.*, best.bib_id, best.suffixed, best.bib_id IS NULL AS bib_missing
FROM a LEFT JOIN best ON best.key = a.inventory_number
"""


def _batch(spark, sf_dir):
    d = load(spark, sf_dir, "digital").select("pk", "batch_number", "inventory_number")
    inv = load(spark, sf_dir, "inventory").select(inventory_key("inventory_no").alias("inv_key"),
                                                  "inventory_id", "title", "row_ordinal")
    return LK.assemble_sources(d, inv, _bib_index(spark, sf_dir))


@register("batch_assembly", BATCH_SQL)
def batch_assembly(spark, sf_dir):
    a, _ = _batch(spark, sf_dir)
    return a.select("pk", "batch_number", "inventory_number", F.col("inv.inventory_id").alias("inventory_id"),
                    F.col("inv.title").alias("title"), "bib_id", "suffixed", "bib_missing")


BATCH_ERRORS_SQL = cte("inventory", "digital") + """
SELECT d.pk, d.batch_number, d.inventory_number,
       'No inventory record found for inventory number ''' || d.inventory_number || '''' AS error
FROM digital d
WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE upper(replace(i.inventory_no, chr(160), '')) = d.inventory_number)
"""


@register("batch_errors", BATCH_ERRORS_SQL)
def batch_errors(spark, sf_dir):
    return _batch(spark, sf_dir)[1]


# ----------------------------------------------------------------- J8
RESOURCES_SQL = cte("inventory", "digital") + """
SELECT d.inventory_number AS inventory_no, d.pk, d.file_name, k.n AS inventory_rows
FROM digital d JOIN (SELECT inventory_no, count(*) AS n FROM inventory
                     WHERE coalesce(trim(CAST(inventory_id AS VARCHAR)), '') <> ''
                       AND coalesce(trim(inventory_no), '') <> '' GROUP BY inventory_no) k
  ON k.inventory_no = d.inventory_number
"""


@register("resource_matches", RESOURCES_SQL)
def resource_matches(spark, sf_dir):
    rows = load(spark, sf_dir, "inventory").select("inventory_id", "inventory_no")
    res = load(spark, sf_dir, "digital").select(F.col("inventory_number").alias("Inventory_no"), "pk", "file_name")
    _, key_resources = LK.match_resources(rows, res)
    return key_resources.select(F.col("Inventory_no").alias("inventory_no"), "pk", "file_name", "inventory_rows")


ROW_MATCHES_SQL = cte("inventory", "digital") + """
SELECT i.inventory_id, i.inventory_no, r.n AS resources
FROM inventory i JOIN (SELECT inventory_number AS k, count(*) AS n FROM digital GROUP BY 1) r ON r.k = i.inventory_no
WHERE coalesce(trim(CAST(i.inventory_id AS VARCHAR)), '') <> '' AND coalesce(trim(i.inventory_no), '') <> ''
"""


@register("row_matches", ROW_MATCHES_SQL)
def row_matches(spark, sf_dir):
    rows = load(spark, sf_dir, "inventory").select("inventory_id", "inventory_no")
    res = load(spark, sf_dir, "digital").select(F.col("inventory_number").alias("Inventory_no"), "pk")
    return LK.match_resources(rows, res)[0]


HOT_RESOURCES_SQL = cte("hot_inventory", "hot_resources") + """
SELECT r.inventory_number AS inventory_no, r.pk, r.line, k.n AS inventory_rows
FROM hot_resources r JOIN (SELECT inventory_no, count(*) AS n FROM hot_inventory GROUP BY 1) k
  ON k.inventory_no = r.inventory_number
"""


@register("hot_resource_matches", HOT_RESOURCES_SQL)
def hot_resource_matches(spark, sf_dir):
    rows = load(spark, sf_dir, "hot_inventory")
    res = load(spark, sf_dir, "hot_resources").withColumnRenamed("inventory_number", "Inventory_no")
    return LK.match_resources(rows, res)[1].withColumnRenamed("Inventory_no", "inventory_no")


# ----------------------------------------------------------------- J8 nested (K6 input)
NESTED_SQL = cte("hot_inventory", "hot_resources") + """
, i AS (SELECT inventory_no AS k, count(*) AS row_count, sum(inventory_id) AS row_sum FROM hot_inventory GROUP BY 1)
, r AS (SELECT inventory_number AS k, count(*) AS resources, sum(pk * 10 + line) AS resource_sum FROM hot_resources GROUP BY 1)
SELECT k AS inventory_no, row_count, CAST(row_sum AS BIGINT) AS row_sum, resources,
       CAST(resource_sum AS BIGINT) AS resource_sum, resources > 1000 OR row_count > 1000 AS several_parts
FROM i JOIN r USING (k)
"""


@register("nested_resources", NESTED_SQL)
def nested_resources(spark, sf_dir):
    """Totals of the document parts of each number: every row and resource is
    in one part, also of numbers above the part size."""
    rows = load(spark, sf_dir, "hot_inventory")
    res = load(spark, sf_dir, "hot_resources").withColumnRenamed("inventory_number", "Inventory_no")
    return nested_totals(LK.nested_parts(rows, res, ["pk", "line"]))


def nested_totals(parts):
    """Per number: rows and resources of all its parts, and their sums."""
    add = lambda xs, f: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + f(x))
    return parts.groupBy("inventory_no").agg(
        F.sum(F.size("rows")).alias("row_count"), F.sum(add("rows", lambda x: x)).alias("row_sum"),
        F.sum(F.size("matched_resources")).alias("resources"),
        F.sum(add("matched_resources", lambda x: x["pk"] * 10 + x["line"])).alias("resource_sum"),
        (F.count(F.lit(1)) > 1).alias("several_parts"))


# ----------------------------------------------------------------- H6
CALLNO_CHANGES_SQL = cte("holdings") + """
, h AS (SELECT holding_id, call_number, row_ordinal,
               CASE WHEN length(call_number) >= 2 AND substr(call_number, length(call_number) - 1, 1) = ' '
                     AND right(call_number, 1) IN ('T', 'M', 'R') AND strpos(call_number, '-') = 0
                     AND strpos(lower(call_number), 'and') = 0
                    THEN left(call_number, length(call_number) - 2) || right(call_number, 1)
                    ELSE call_number END AS compact
        FROM holdings)
SELECT holding_id,
  CASE WHEN row_ordinal % 11 = 0 OR row_ordinal % 7 = 0 OR row_ordinal % 5 = 0 THEN NULL ELSE call_number END AS old_value,
  CASE WHEN row_ordinal % 11 = 0 OR row_ordinal % 7 = 0 OR row_ordinal % 5 = 0 THEN NULL ELSE compact END AS new_value,
  CASE WHEN row_ordinal % 11 = 0 THEN 'no record' WHEN row_ordinal % 7 = 0 THEN 'no 852'
       WHEN row_ordinal % 5 = 0 THEN 'no $h' WHEN compact = call_number THEN 'unchanged' ELSE 'change' END AS status
FROM h
"""


@register("call_number_changes", CALLNO_CHANGES_SQL)
def call_number_changes(spark, sf_dir):
    from kardex.operators.changes import call_number_changes as plan
    from kardex.plans.marc_fixture import holdings_records
    return plan(holdings_records(load(spark, sf_dir, "holdings")))


# ----------------------------------------------------------------- P4 + J10
def _preview_cols(spark, sf_dir):
    from kardex.operators.keys import preview_fields
    return preview_fields(load(spark, sf_dir, "layout_records")).columns


def _preview_sql() -> str:
    from kardex.operators.keys import PREVIEW_FIELDS
    from kardex.plans.bindings import BINDINGS
    present = [e.rsplit(" AS ", 1)[1].strip('"') for e in BINDINGS["layout_records"][1]]
    cols = [c for c in PREVIEW_FIELDS if c in present]
    q = lambda c: '"' + c + '"'
    sel = ", ".join(f"CASE WHEN n = 1 THEN r.{q(c)} END AS {q('inv_' + c)}" for c in cols)
    return cte("layout_records", "sheet") + f"""
, k AS (SELECT DISTINCT inventory_value AS key FROM sheet
        WHERE inventory_value IS NOT NULL AND strpos(inventory_value, '|') = 0)
, g AS (SELECT inventory_no, count(*) AS n, min(inventory_id) AS mid FROM layout_records GROUP BY inventory_no)
SELECT k.key, CASE WHEN g.n IS NULL THEN 'missing' WHEN g.n > 1 THEN 'ambiguous' ELSE 'ok' END AS inv_status, {sel}
FROM k LEFT JOIN g ON g.inventory_no = k.key
LEFT JOIN layout_records r ON g.n = 1 AND r.inventory_id = g.mid
"""


@register("inventory_preview", _preview_sql())
def inventory_preview(spark, sf_dir):
    """J10 + P4: per single spreadsheet number, exactly-one inventory lookup
    and the preview fields present in the inventory table."""
    keys = (load(spark, sf_dir, "sheet").select(F.col("inventory_value").alias("key"))
            .filter(F.col("key").isNotNull() & ~F.col("key").contains("|")).distinct())
    recs = load(spark, sf_dir, "layout_records")
    return LK.lookup_exactly_one(keys, recs, "key", "inventory_no", "inv_", _preview_cols(spark, sf_dir))
