"""Matching reports: perfect matches, single/compound classes, key profiles,
duplicates, variant matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from kardex.operators import keys as K
from kardex.operators import matching as M
from kardex.plans.bindings import cte, load, read_table
from kardex.plans.catalog import register

_HKEY = "upper(replace(call_number, ' ', ''))"
_IKEY = "upper(replace(inventory_no, chr(160), ''))"


def _sources(spark, sf_dir):
    return (load(spark, sf_dir, "holdings"), load(spark, sf_dir, "digital"),
            load(spark, sf_dir, "inventory"))


# --------------------------------------------------------------------------- J1
PERFECT_SQL = cte("holdings", "inventory", "digital") + f"""
, h AS (SELECT {_HKEY} AS k, min(holding_id) AS holding_id FROM holdings GROUP BY 1 HAVING count(*) = 1)
, i AS (SELECT {_IKEY} AS k, min(inventory_id) AS inventory_id, min(title) AS title
        FROM inventory GROUP BY 1 HAVING count(*) = 1)
, d AS (SELECT inventory_number AS k, min(pk) AS pk, min(carrier_a) AS ca, min(carrier_a_location) AS cal,
               min(carrier_b) AS cb, min(carrier_b_location) AS cbl, min(hard_drive_name) AS hd,
               min(file_folder_name) AS ff, min(sub_folder_name) AS sf, min(file_name) AS fn
        FROM digital GROUP BY 1 HAVING count(*) = 1)
SELECT d.k AS inventory_number,
       coalesce(CAST(h.holding_id AS VARCHAR), '') AS holdings_id,
       coalesce(CAST(i.inventory_id AS VARCHAR), '') AS inventory_record_id,
       coalesce(CAST(d.pk AS VARCHAR), '') AS digital_record_id,
       coalesce(i.title, '') AS inventory_title,
       coalesce(d.ca, '') AS carrier_a, coalesce(d.cal, '') AS carrier_a_location,
       coalesce(d.cb, '') AS carrier_b, coalesce(d.cbl, '') AS carrier_b_location,
       coalesce(d.hd, '') AS hard_drive_name, coalesce(d.ff, '') AS file_folder_name,
       coalesce(d.sf, '') AS sub_folder_name, coalesce(d.fn, '') AS file_name
FROM d JOIN h ON h.k = d.k JOIN i ON i.k = d.k
ORDER BY inventory_number
"""


@register("perfect_matches", PERFECT_SQL)
def perfect_matches(spark, sf_dir):
    h, d, i = _sources(spark, sf_dir)
    return M.perfect_matches(h, d, i)


# ------------------------------------------------------------------ J2 / J3
_IDS_SQL = f"""
, ids AS (SELECT {_HKEY} AS key, 'holdings' AS source, holding_id AS id FROM holdings
          UNION ALL
          SELECT {_IKEY} AS key, 'inventory' AS source, CAST(inventory_id AS VARCHAR) AS id FROM inventory)
, cnt AS (SELECT key, count(*) FILTER (WHERE source = 'holdings') AS h,
                 count(*) FILTER (WHERE source = 'inventory') AS f
          FROM ids GROUP BY key)
, vals AS (SELECT DISTINCT inventory_value AS v FROM sheet WHERE inventory_value IS NOT NULL)
"""

_SINGLE_CLASSES_SQL = """
, singles AS (SELECT v AS key, coalesce(cnt.h, 0) AS h, coalesce(cnt.f, 0) AS f
              FROM vals LEFT JOIN cnt ON cnt.key = vals.v WHERE strpos(v, '|') = 0)
, cls AS (SELECT CASE WHEN f > 1 AND h = 0 THEN 'S1' WHEN h > 1 AND f = 0 THEN 'S2'
                      WHEN f > 1 AND h = 1 THEN 'S3' WHEN h > 1 AND f = 1 THEN 'S4'
                      WHEN f > 1 AND h > 1 THEN 'S5' WHEN f = 0 AND h = 0 THEN 'S6'
                      ELSE 'leftover' END AS section, key, h, f FROM singles)
"""

_COMPOUND_CLASSES_SQL = """
, parts AS (SELECT v AS original_value, unnest(string_split(v, '|')) AS key FROM vals WHERE strpos(v, '|') > 0)
, pj AS (SELECT p.original_value, p.key, coalesce(c.h, 0) AS h, coalesce(c.f, 0) AS f
         FROM parts p LEFT JOIN cnt c ON c.key = p.key)
, flags AS (SELECT original_value, bool_and(h + f = 1) AS all_one, bool_or(h > 1 OR f > 1) AS any_multi
            FROM pj GROUP BY original_value)
, sel AS (SELECT CASE WHEN all_one THEN 'M1' WHEN any_multi THEN 'M2' ELSE 'leftover' END AS section,
                 pj.key, pj.original_value, pj.h, pj.f
          FROM pj JOIN flags USING (original_value)
          WHERE all_one OR NOT any_multi OR pj.h > 1 OR pj.f > 1)
, ccls AS (SELECT section, key, min(original_value) AS original_value, min(h) AS h, min(f) AS f
           FROM sel GROUP BY section, key)
"""

SINGLE_SQL = cte("holdings", "inventory", "sheet") + _IDS_SQL + _SINGLE_CLASSES_SQL + """
SELECT cls.section, cls.key AS inventory_number, CAST(NULL AS VARCHAR) AS original_value,
       cls.h AS holdings_count, cls.f AS inventory_count, ids.source, ids.id AS record_id
FROM cls LEFT JOIN ids ON ids.key = cls.key
"""

COMPOUND_SQL = cte("holdings", "inventory", "sheet") + _IDS_SQL + _COMPOUND_CLASSES_SQL + """
SELECT ccls.section, ccls.key AS inventory_number, ccls.original_value,
       ccls.h AS holdings_count, ccls.f AS inventory_count, ids.source, ids.id AS record_id
FROM ccls LEFT JOIN ids ON ids.key = ccls.key
"""

CLASS_COUNTS_SQL = cte("holdings", "inventory", "sheet") + _IDS_SQL + _SINGLE_CLASSES_SQL + \
    _COMPOUND_CLASSES_SQL + """
SELECT section, sum(before) AS rows_before_dedupe, sum(after) AS rows_after_dedupe FROM (
  SELECT section, count(*) AS before, count(*) AS after FROM cls GROUP BY section
  UNION ALL SELECT section, count(*), 0 FROM sel GROUP BY section
  UNION ALL SELECT section, 0, count(*) FROM ccls GROUP BY section
) GROUP BY section
"""


def _classes(spark, sf_dir):
    h, _, i = _sources(spark, sf_dir)
    ids = M.source_ids(h, i)
    counts = M.source_counts(ids)
    vals = M.sheet_values(load(spark, sf_dir, "sheet"))
    return ids, counts, vals


@register("single_value_report", SINGLE_SQL)
def single_value_report(spark, sf_dir):
    ids, counts, vals = _classes(spark, sf_dir)
    return M.attach_ids(M.classify_single_values(vals, counts), ids)


@register("compound_value_report", COMPOUND_SQL)
def compound_value_report(spark, sf_dir):
    ids, counts, vals = _classes(spark, sf_dir)
    return M.attach_ids(M.classify_compound_values(vals, counts), ids)


@register("match_class_counts", CLASS_COUNTS_SQL.replace("sum(before)", "CAST(sum(before) AS BIGINT)")
          .replace("sum(after)", "CAST(sum(after) AS BIGINT)"))
def match_class_counts(spark, sf_dir):
    _, counts, vals = _classes(spark, sf_dir)
    single = M.classify_single_values(vals, counts)
    # The rows after de-duplication are the distinct numbers of each section.
    compound = M.classify_compound_values(vals, counts, dedupe=False)
    after = F.count_distinct("inventory_number")
    return (M.class_counts(single).select("section", F.col("rows").alias("rows_before_dedupe"),
                                          F.col("rows").alias("rows_after_dedupe"))
            .unionByName(compound.groupBy("section").agg(F.count(F.lit(1)).alias("rows_before_dedupe"),
                                                         after.alias("rows_after_dedupe")))
            .groupBy("section").agg(F.sum("rows_before_dedupe").alias("rows_before_dedupe"),
                                    F.sum("rows_after_dedupe").alias("rows_after_dedupe")))


# ------------------------------------------------------------------ A1 / A2
_SUMMARY_ROW = """SELECT '{src}' AS source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total,
  count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS repeats,
  count(*) FILTER (WHERE n = 1) AS singletons,
  CAST(coalesce(sum(n) FILTER (WHERE k = ''), 0) AS BIGINT) AS empty
FROM (SELECT {key} AS k, count(*) AS n FROM {tbl} GROUP BY 1)"""

KEY_SUMMARY_SQL = cte("holdings", "inventory", "digital") + "\n UNION ALL ".join([
    _SUMMARY_ROW.format(src="holdings", key=_HKEY, tbl="holdings"),
    _SUMMARY_ROW.format(src="inventory", key=_IKEY, tbl="inventory"),
    _SUMMARY_ROW.format(src="digital", key="inventory_number", tbl="digital"),
])


@register("key_summary", KEY_SUMMARY_SQL)
def key_summary(spark, sf_dir):
    from kardex.functions.text import holdings_key, inventory_key
    h, d, i = _sources(spark, sf_dir)
    return (K.key_summary(h, holdings_key("call_number"), "holdings")
             .unionByName(K.key_summary(i, inventory_key("inventory_no"), "inventory"))
             .unionByName(K.key_summary(d, "inventory_number", "digital")))


COMPOUND_SUMMARY_SQL = cte("sheet") + """
SELECT count(*) AS total, count(DISTINCT inventory_value) AS distinct_values,
       count(DISTINCT CASE WHEN strpos(inventory_value, '|') = 0 THEN inventory_value END) AS single_values,
       count(DISTINCT CASE WHEN strpos(inventory_value, '|') > 0 THEN inventory_value END) AS multiple_values,
       count(*) FILTER (WHERE inventory_value IS NULL) AS empty
FROM sheet
"""


@register("sheet_summary", COMPOUND_SUMMARY_SQL)
def sheet_summary(spark, sf_dir):
    return K.compound_summary(load(spark, sf_dir, "sheet"), "inventory_value")


# ------------------------------------------------------------------ A3
SINGLETONS_SQL = cte("holdings") + f"""
SELECT {_HKEY} AS key, count(*) AS n, CASE WHEN count(*) = 1 THEN 'singleton' ELSE 'repeat' END AS kind
FROM holdings GROUP BY 1
"""


@register("holdings_key_kinds", SINGLETONS_SQL)
def holdings_key_kinds(spark, sf_dir):
    from kardex.functions.text import holdings_key
    h = load(spark, sf_dir, "holdings")
    c = K.key_counts(h, holdings_key("call_number"))
    return c.select("key", "n", F.when(F.col("n") == 1, "singleton").otherwise("repeat").alias("kind"))


# ------------------------------------------------------------------ W1 / W2
DUPLICATES_SQL = """
SELECT doc_id, text, lang, source, n_chars, doc_id + 2 AS original_row_number
FROM (SELECT *, count(*) OVER (PARTITION BY text) AS c FROM documents) WHERE c > 1
"""


@register("duplicate_documents", DUPLICATES_SQL)
def duplicate_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return K.duplicate_rows(docs, "text", "doc_id")


KEEP_FIRST_SQL = """
SELECT doc_id, text, lang, source, n_chars
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
"""


@register("first_documents", KEEP_FIRST_SQL)
def first_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return K.keep_first(docs, "text", "doc_id", hashed=True)


# ------------------------------------------------------------------ J4
_TRIM = "trim({x}, ' ' || chr(160) || chr(9) || chr(10) || chr(13))"
_PREFIX_OR = " OR ".join(f"v LIKE '{p}%'" for p in M.VARIANT_PREFIXES)
VARIANT_SQL = cte("holdings", "inventory", "digital") + f"""
, d0 AS (SELECT pk, {_TRIM.format(x='inventory_number')} AS k, row_ordinal FROM digital)
, d AS (SELECT k, arg_min(pk, row_ordinal) AS pk FROM d0 WHERE k <> '' GROUP BY k)
, hv AS (SELECT {_TRIM.format(x='call_number')} AS v, holding_id FROM holdings)
, hidx AS (SELECT v AS key, holding_id FROM hv WHERE v <> ''
           UNION ALL
           SELECT v || s.suf AS key, holding_id FROM hv CROSS JOIN (VALUES (' M'), (' R'), (' T')) AS s(suf)
           WHERE v <> '' AND ({_PREFIX_OR}))
, h1 AS (SELECT key, min(holding_id) AS holding_id FROM hidx GROUP BY key HAVING count(*) = 1)
, iv AS (SELECT {_TRIM.format(x='inventory_no')} AS key, inventory_id FROM inventory)
, i1 AS (SELECT key, min(inventory_id) AS inventory_id FROM iv WHERE key <> '' GROUP BY key HAVING count(*) = 1)
SELECT d.k AS match_key, d.pk, h1.holding_id, i1.inventory_id
FROM d JOIN h1 ON h1.key = d.k JOIN i1 ON i1.key = d.k
"""


@register("variant_matches", VARIANT_SQL)
def variant_matches(spark, sf_dir):
    h, d, i = _sources(spark, sf_dir)
    return M.unique_variant_match(d, i, h).select("match_key", "pk", "holding_id", "inventory_id")


# ------------------------------------------------------------------ J6 / J13 / J14
CALLNO_SQL = cte("holdings", "inventory") + """
, inv AS (SELECT inventory_no, arg_max(inventory_id, row_ordinal) AS inventory_id,
                 arg_max(production_type, row_ordinal) AS production_type
          FROM inventory GROUP BY inventory_no)
SELECT h.mms_id, h.holding_id, h.call_number, inv.inventory_id, inv.production_type
FROM holdings h JOIN inv ON h.call_number = inv.inventory_no
"""


@register("call_number_matches", CALLNO_SQL)
def call_number_matches(spark, sf_dir):
    h, _, i = _sources(spark, sf_dir)
    return (M.match_by_call_number(h, i.select("inventory_no", "inventory_id", "production_type", "row_ordinal"))
             .select("mms_id", "holding_id", "call_number", "inventory_id", "production_type"))


DISTINCT_IDS_SQL = cte("holdings") + "SELECT DISTINCT mms_id AS id FROM holdings WHERE mms_id IS NOT NULL"


@register("distinct_bib_ids", DISTINCT_IDS_SQL)
def distinct_bib_ids(spark, sf_dir):
    return M.distinct_ids(load(spark, sf_dir, "holdings"), "mms_id")


UNMATCHED_SQL = cte("inventory", "digital") + f"""
SELECT d.*, 'no inventory record' AS reason FROM digital d
WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE {_IKEY} = d.inventory_number)
"""


@register("unmatched_digital", UNMATCHED_SQL)
def unmatched_digital(spark, sf_dir):
    from kardex.functions.text import inventory_key
    _, d, i = _sources(spark, sf_dir)
    return M.unmatched(d, i.select(inventory_key("inventory_no").alias("k")), "inventory_number", "k",
                       "no inventory record")


# ------------------------------------------------------------------ A11
_FUNNEL_SRC = """SELECT '{src}' AS source, stage, rows FROM (
  SELECT CAST(sum(n) AS BIGINT) AS r, CAST(coalesce(sum(n) FILTER (WHERE trim(k) <> ''), 0) AS BIGINT) AS kd,
         count(*) FILTER (WHERE n = 1) AS s
  FROM (SELECT {key} AS k, count(*) AS n FROM {tbl} GROUP BY 1))
  CROSS JOIN LATERAL (VALUES ('read', r), ('keyed', kd), ('singletons', s)) AS t(stage, rows)"""

FUNNEL_SQL = cte("holdings", "inventory", "digital") + "\n UNION ALL ".join([
    _FUNNEL_SRC.format(src="holdings", key=_HKEY, tbl="holdings"),
    _FUNNEL_SRC.format(src="digital", key="inventory_number", tbl="digital"),
    _FUNNEL_SRC.format(src="inventory", key=_IKEY, tbl="inventory"),
]) + f"""
 UNION ALL SELECT 'all' AS source, 'matched' AS stage, count(*) AS rows FROM
  (SELECT {_HKEY} AS k FROM holdings GROUP BY 1 HAVING count(*) = 1) h
  JOIN (SELECT inventory_number AS k FROM digital GROUP BY 1 HAVING count(*) = 1) d USING (k)
  JOIN (SELECT {_IKEY} AS k FROM inventory GROUP BY 1 HAVING count(*) = 1) i USING (k)
"""


@register("match_funnel", FUNNEL_SQL)
def match_funnel(spark, sf_dir):
    h, d, i = _sources(spark, sf_dir)
    return M.match_funnel(h, d, i)


# ------------------------------------------------------------------ A4 long form
ID_LISTS_SQL = cte("holdings") + f"""
SELECT {_HKEY} AS key, count(*) OVER (PARTITION BY {_HKEY}) AS n, holding_id AS id FROM holdings
"""


@register("holdings_id_lists", ID_LISTS_SQL)
def holdings_id_lists(spark, sf_dir):
    from kardex.functions.text import holdings_key
    h = load(spark, sf_dir, "holdings")
    return K.ids_by_key(h, holdings_key("call_number"), "holding_id")


# A third of the rows share the blank key.
HOT_IDS_SQL = cte("hot_holdings") + """
SELECT call_number AS key, count(*) OVER (PARTITION BY call_number) AS n, holding_id AS id FROM hot_holdings
"""


@register("hot_key_ids", HOT_IDS_SQL)
def hot_key_ids(spark, sf_dir):
    return K.ids_by_key(load(spark, sf_dir, "hot_holdings"), "call_number", "holding_id")


HOT_DUPLICATES_SQL = cte("hot_holdings") + """
SELECT holding_id, call_number, row_ordinal + 2 AS original_row_number
FROM (SELECT *, count(*) OVER (PARTITION BY call_number) AS c FROM hot_holdings) WHERE c > 1
"""


@register("hot_key_duplicates", HOT_DUPLICATES_SQL)
def hot_key_duplicates(spark, sf_dir):
    h = load(spark, sf_dir, "hot_holdings")
    return K.duplicate_rows(h, "call_number", "row_ordinal", hashed=False).drop("row_ordinal")
