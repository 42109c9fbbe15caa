"""Bibliographic reports: data-quality checks (H26-H33), features and
criteria (P13, H34-H36, H45, H46, A5), monographs (H37-H42, G4, P11), output
documents (P12), code table (S9, J12) and annotations (H43, A9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kardex.functions import marc as MC
from kardex.functions.text import title_score
from kardex.operators import bibs as B
from kardex.operators import matching as M
from kardex.operators.keys import keep_last
from kardex.operators.lookups import monograph_flags, valid_code_check
from kardex.plans.bindings import cte, load
from kardex.plans.catalog import register
from kardex.plans.marc_fixture import to_marc


def bibs_of(spark, sf_dir):
    """The bibs of the test tables as MARC records with their mentions."""
    return to_marc(load(spark, sf_dir, "bib_flat"))


def _codes(spark, sf_dir):
    # Later duplicate code wins.
    return keep_last(load(spark, sf_dir, "language_codes"), "code", "row_ordinal")


def _checks(bibs, codes, keep=()):
    b = valid_code_check(bibs.withColumn("lang_code", MC.language_code()), "lang_code", codes)
    t = MC.bib_title()
    return b.select(*keep, "bib_id", MC.no_008().alias("no_008"),
                    MC.invalid_language(F.col("code_valid")).alias("invalid_language"),
                    MC.no_26x_date().alias("no_26x_date"), MC.lacks_attribution().alias("lacks_attribution"),
                    t["title"].alias("bib_title"),
                    F.when(t["check_ind2"], "Yes").otherwise("").alias("check_245_indicator_2"))


_TRIM = "regexp_replace(trim({x}), '[\\s.,:;/=]+$', '')"
_A = _TRIM.format(x="a245")
_ART = f"(CASE WHEN lower({_A}) LIKE 'a %' THEN 2 WHEN lower({_A}) LIKE 'an %' THEN 3 WHEN lower({_A}) LIKE 'the %' THEN 4 ELSE 0 END)"
_NFC = "coalesce(TRY_CAST(ind2 AS INTEGER), 0)"


def _mv(off: str) -> str:
    return f"(trim(substr({_A}, {off} + 1)) || ', ' || trim(substr({_A}, 1, {off})))"


BIB_TITLE_SQL = f"""concat_ws('. ',
    nullif(CASE WHEN {_ART} > 0 AND {_NFC} <> 0 THEN CASE WHEN length({_A}) > {_NFC} THEN {_mv(_ART)} ELSE {_A} END
                WHEN {_ART} > 0 THEN {_mv(_ART)}
                WHEN {_NFC} <> 0 THEN {_mv(_NFC)}
                ELSE {_A} END, ''),
    nullif({_TRIM.format(x='b245')}, ''), nullif({_TRIM.format(x='n245')}, ''), nullif({_TRIM.format(x='p245')}, ''))"""
BIB_FLAG_SQL = f"""(CASE WHEN {_ART} > 0 AND {_NFC} <> 0 THEN length({_A}) > {_NFC} AND {_NFC} <> {_ART}
      WHEN {_ART} > 0 THEN true ELSE false END)"""
_CODE = "substr(f008, 36, 3)"
CHECKS_COLS_SQL = f"""
  CASE WHEN f008 IS NULL THEN 'Yes' ELSE '' END AS no_008,
  CASE WHEN f008 IS NULL THEN '' WHEN length(f008) < 38 THEN CASE WHEN trim(f008) = '' THEN 'BLANK' ELSE 'TOO SHORT' END
       WHEN {_CODE} = '   ' THEN 'BLANK'
       WHEN {_CODE} NOT IN (SELECT code FROM language_codes) THEN {_CODE} ELSE '' END AS invalid_language,
  CASE WHEN trim(coalesce(c260, '')) <> '' OR trim(coalesce(c264, '')) <> '' THEN '' ELSE 'Yes' END AS no_26x_date,
  CASE WHEN c245 IS NULL THEN 'Yes'
       WHEN lower(c245) LIKE '%directed by%' OR lower(c245) LIKE '%director%' OR lower(c245) LIKE '%a film by%'
         OR lower(c245) LIKE '%supervised by%' THEN '' ELSE 'Yes' END AS lacks_attribution,
  {BIB_TITLE_SQL} AS bib_title,
  CASE WHEN {BIB_FLAG_SQL} THEN 'Yes' ELSE '' END AS check_245_indicator_2"""

BIB_CHECKS_SQL = cte("bib_flat", "language_codes") + f"SELECT bib_id, {CHECKS_COLS_SQL} FROM bib_flat"


@register("bib_checks", BIB_CHECKS_SQL)
def bib_checks(spark, sf_dir):
    return _checks(bibs_of(spark, sf_dir), _codes(spark, sf_dir))


# --------------------------------------------------------------- H33
_TRIM_D = "trim({x}, ' ' || chr(160) || chr(9) || chr(10) || chr(13))"
_PREFIX_OR = " OR ".join(f"v LIKE '{p}%'" for p in M.VARIANT_PREFIXES)
MATCH_PROBLEMS_SQL = cte("holdings", "inventory", "digital", "bib_flat", "language_codes") + f"""
, d0 AS (SELECT pk, inventory_number, {_TRIM_D.format(x='inventory_number')} AS k, row_ordinal FROM digital)
, d AS (SELECT k, arg_min(inventory_number, row_ordinal) AS raw_number FROM d0 WHERE k <> '' GROUP BY k)
, hv AS (SELECT {_TRIM_D.format(x='call_number')} AS v, holding_id FROM holdings)
, hidx AS (SELECT v AS key, holding_id FROM hv WHERE v <> ''
           UNION ALL SELECT v || s.suf, holding_id FROM hv CROSS JOIN (VALUES (' M'), (' R'), (' T')) AS s(suf)
           WHERE v <> '' AND ({_PREFIX_OR}))
, h1 AS (SELECT key, min(holding_id) AS holding_id FROM hidx GROUP BY key HAVING count(*) = 1)
, iv AS (SELECT {_TRIM_D.format(x='inventory_no')} AS key, inventory_id FROM inventory)
, i1 AS (SELECT key, min(inventory_id) AS inventory_id FROM iv WHERE key <> '' GROUP BY key HAVING count(*) = 1)
, m AS (SELECT d.raw_number, h1.holding_id, i1.inventory_id FROM d JOIN h1 ON h1.key = d.k JOIN i1 ON i1.key = d.k)
, chk AS (SELECT bib_id, {CHECKS_COLS_SQL} FROM bib_flat)
, j AS (SELECT m.*, inv.title, chk.* FROM m JOIN holdings h ON h.holding_id = m.holding_id
        JOIN inventory inv ON inv.inventory_id = m.inventory_id LEFT JOIN chk ON chk.bib_id = h.mms_id)
SELECT coalesce(bib_id, '') AS bib_id, CAST(inventory_id AS VARCHAR) AS inventory_record_id,
  raw_number AS digital_inventory_number, coalesce(no_008, '') AS no_008,
  coalesce(invalid_language, '') AS invalid_language, coalesce(no_26x_date, '') AS no_26x_date,
  coalesce(lacks_attribution, '') AS lacks_attribution,
  CASE WHEN coalesce(bib_title, '') = '' OR coalesce(title, '') = '' THEN 0.0
       ELSE 1.0 - levenshtein(bib_title, title) / greatest(length(bib_title), length(title)) END AS title_match_score,
  coalesce(bib_title, '') AS bib_title, coalesce(title, '') AS inventory_title,
  coalesce(check_245_indicator_2, '') AS check_245_indicator_2
FROM j
"""


@register("match_problems", MATCH_PROBLEMS_SQL)
def match_problems(spark, sf_dir):
    h = load(spark, sf_dir, "holdings")
    d = load(spark, sf_dir, "digital")
    i = load(spark, sf_dir, "inventory")
    m = M.unique_variant_match(d, i, h, holdings_carry=["mms_id"], inventory_carry=["title"]).select(
        F.col("inventory_number").alias("raw_number"), "holding_id", "mms_id", "inventory_id", "title")
    # The few matched bibs first, then the checks on them alone.
    found = m.join(bibs_of(spark, sf_dir), F.col("mms_id") == F.col("bib_id"), "left")
    j = _checks(found, _codes(spark, sf_dir), keep=["raw_number", "inventory_id", "title"])
    e = lambda c: F.when(F.col("bib_id").isNull() & F.lit(c not in ("title",)), F.lit("")).otherwise(
        F.coalesce(F.col(c), F.lit("")))
    return j.select(e("bib_id").alias("bib_id"), F.col("inventory_id").cast("string").alias("inventory_record_id"),
                    F.col("raw_number").alias("digital_inventory_number"), e("no_008").alias("no_008"),
                    e("invalid_language").alias("invalid_language"), e("no_26x_date").alias("no_26x_date"),
                    e("lacks_attribution").alias("lacks_attribution"),
                    title_score(e("bib_title"), F.col("title")).alias("title_match_score"),
                    e("bib_title").alias("bib_title"), e("title").alias("inventory_title"),
                    e("check_245_indicator_2").alias("check_245_indicator_2"))


# --------------------------------------------------------------- P13 / H34 / A5
_DIR_N = ("(CASE WHEN c245 IS NULL THEN 0 WHEN (c245 LIKE '%directed%' OR c245 LIKE '%director%' "
          "OR c245 LIKE '%a film by%') AND NOT (c245 LIKE '%technical director%') "
          "THEN (CASE WHEN person1 IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN person2 IS NOT NULL THEN 1 ELSE 0 END) "
          "ELSE 0 END)")
_LANGX = "(CASE WHEN f008 IS NULL THEN '###' ELSE substr(f008, 36, 3) END)"
_FLAGS = [
    ("6.1", f"c = 1 AND a AND NOT pp AND NOT ed AND lang = 'eng'"),
    ("6.2", f"c = 1 AND a AND (ed OR lang <> 'eng')"),
    ("6.3", f"c = 1 AND ((a AND pp) OR (a AND n))"),
    ("6.4", f"c > 1 AND a AND NOT ed AND lang = 'eng'"),
    ("6.5", f"c > 1 AND a AND (ed OR lang <> 'eng')"),
    ("6.6", f"c > 1 AND ((a AND pp) OR (a AND n))"),
    ("6.7", "c = 0"),
    ("6.8", "p > 0"),
]
_FIRST = "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in _FLAGS) + " ELSE '6.9' END"
_ALL = ("coalesce(nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _FLAGS)
        + "), ''), '6.9')")
FEATURES_SQL = cte("bib_flat") + f"""
, f AS (SELECT bib_id, {_LANGX} AS lang, {_DIR_N} AS c, 0 AS p, a245 IS NOT NULL AS a, p245 IS NOT NULL AS pp,
               n245 IS NOT NULL AS n, a250 IS NOT NULL AS ed, person1, person2, c245 FROM bib_flat)
SELECT bib_id, lang AS language, {_FIRST} AS criterion, {_ALL} AS all_criteria,
  CASE WHEN c = 0 THEN '' WHEN person2 IS NULL THEN person1
       ELSE array_to_string(list_sort([person1, person2]), '; ') END AS directors_245c,
  '' AS directors_245p
FROM f
"""


def _features(bibs):
    return bibs.select("*", F.struct(*MC.bib_features("mentions")).alias("features"))


def feature_report(bibs):
    f = _features(bibs)
    return f.select(F.col("features.bib_id").alias("bib_id"), F.col("features.language").alias("language"),
                    MC.first_criterion("features").alias("criterion"),
                    F.array_join(MC.all_criteria("features"), ", ").alias("all_criteria"),
                    F.array_join(F.col("features.directors.f245c"), "; ").alias("directors_245c"),
                    F.array_join(F.col("features.directors.f245p"), "; ").alias("directors_245p"))


@register("bib_features", FEATURES_SQL)
def bib_features(spark, sf_dir):
    return feature_report(bibs_of(spark, sf_dir))


COMBOS_SQL = f"""
WITH x AS ({FEATURES_SQL})
SELECT all_criteria, count(*) AS records FROM x GROUP BY all_criteria
"""


@register("criteria_combinations", COMBOS_SQL)
def criteria_combinations(spark, sf_dir):
    return B.criteria_combinations(_features(bibs_of(spark, sf_dir))).orderBy("all_criteria")


def _jarr(*vals: str) -> str:
    return "'[' || " + " || ',' || ".join(f"'\"' || {v} || '\"'" for v in vals) + " || ']'"


MAMS_SQL = cte("bib_flat") + f"""
, x AS (SELECT *, {_LANGX} AS lang, {_DIR_N} AS c FROM bib_flat)
SELECT bib_id, '{{' || '"bib_id":"' || bib_id || '"'
  || ',"title":' || {_jarr('a245')}
  || coalesce(',"alternative_titles":' || {_jarr('a246')}, '')
  || coalesce(',"episode_titles":' || {_jarr('p245')}, '')
  || ',"series_title":' || {_jarr('a245')}
  || coalesce(',"subseries_titles":' || {_jarr("a490 || ' ' || a490")}, '')
  || coalesce(',"episode_numbers_245":' || {_jarr('n245')}, '')
  || CASE WHEN lang <> '' THEN ',"language":"' || lang || '"' ELSE '' END
  || coalesce(',"language_other":' || {_jarr('a041')}, '')
  || CASE WHEN c = 0 THEN '' WHEN person2 IS NULL THEN ',"directors":' || {_jarr('person1')}
          ELSE ',"directors":' || {_jarr('least(person1, person2)', 'greatest(person1, person2)')} END
  || '}}' AS document
FROM x
"""


@register("mams_documents", MAMS_SQL)
def mams_documents(spark, sf_dir):
    """P12 + P9: one JSON document per bib, empty members dropped."""
    f = _features(bibs_of(spark, sf_dir))
    return f.select("bib_id", F.to_json(MC.mams_projection("features")).alias("document"))


# --------------------------------------------------------------- H37-H42
_MONO_TYPES = list(MC.MONOGRAPH_TYPES.items())
_TYPE_LIST = "[" + ", ".join(f"'{k}'" for k, _ in _MONO_TYPES) + "]"
_TYPE_MAP = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _MONO_TYPES) + " END"
_FORM_MAP = "CASE f " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MC.FORM_NAMES.items()) + " ELSE f END"
_MONO_FORMS = ", ".join(f"'{x}'" for x in MC.MONOGRAPH_FORMS)
_NONMONO_FORMS = ", ".join(f"'{x}'" for x in MC.NON_MONOGRAPH_FORMS)
_NONMONO_TYPES = " OR ".join(f"contains(lower(coalesce(production_type, '')), '{x}')" for x in MC.NON_MONOGRAPH_TYPES)


def _bib_form(col: str, src: str | None) -> str:
    bare = f"regexp_replace({col}, '\\.+$', '')"
    if src:
        ok = f"CASE WHEN {src} = 'local' THEN {bare} IN ('Student films and video') ELSE {bare} IN ({_MONO_FORMS}) END"
    else:
        ok = f"{bare} IN ({_MONO_FORMS})"
    return f"CASE WHEN {col} IS NOT NULL AND ({ok}) THEN {bare} END"


MONOGRAPH_SQL = cte("holdings", "inventory", "bib_flat") + f"""
, inv AS (SELECT inventory_no, arg_max(production_type, row_ordinal) AS production_type FROM inventory GROUP BY 1)
, m AS (SELECT h.mms_id, inv.production_type, b.* FROM holdings h JOIN inv ON h.call_number = inv.inventory_no
        LEFT JOIN bib_flat b ON b.bib_id = h.mms_id)
, j AS (SELECT * FROM m WHERE bib_id IS NOT NULL)
, c AS (SELECT mms_id, production_type,
          CASE WHEN coalesce(production_type, '') <> '' THEN NOT ({_NONMONO_TYPES})
               ELSE NOT (p245 IS NOT NULL OR n245 IS NOT NULL OR a250 IS NOT NULL OR a505 IS NOT NULL
                         OR coalesce(form1 IN ({_NONMONO_FORMS}), false) OR coalesce(form2 IN ({_NONMONO_FORMS}), false)
                         OR coalesce(form1 = 'Anthologies' AND form2 = 'Short films', false)) END AS mono,
          list_transform(list_filter({_TYPE_LIST}, lambda t: contains(lower(coalesce(production_type, '')), lower(t))),
                         lambda t: {_TYPE_MAP}) AS inv_forms,
          list_transform(list_filter([{_bib_form('form1', 'form1_source')}, {_bib_form('form2', None)}],
                                     lambda f: f IS NOT NULL), lambda f: {_FORM_MAP}) AS bib_forms
        FROM j)
, r AS (SELECT mms_id,
          list_sort(list_distinct(list_filter(bib_forms, lambda x: list_contains(inv_forms, x)))) AS common,
          list_sort(list_distinct(list_filter(bib_forms, lambda x: NOT list_contains(inv_forms, x)))) AS ua,
          list_sort(list_distinct(list_filter(inv_forms, lambda x: NOT list_contains(bib_forms, x)))) AS uf
        FROM c WHERE mono)
SELECT mms_id, array_to_string(common, '|') AS common, array_to_string(ua, '|') AS unique_bib,
       array_to_string(uf, '|') AS unique_inventory, false AS bib_missing
FROM r WHERE len(ua) > 0 OR len(uf) > 0
UNION ALL SELECT mms_id, NULL, NULL, NULL, true FROM m WHERE bib_id IS NULL
"""


@register("monograph_report", MONOGRAPH_SQL)
def monograph_report(spark, sf_dir):
    h = load(spark, sf_dir, "holdings").select("mms_id", "call_number")
    i = load(spark, sf_dir, "inventory").select("inventory_no", "production_type", "row_ordinal")
    f = monograph_flags(M.match_by_call_number(h, i).drop("row_ordinal"), bibs_of(spark, sf_dir).drop("mentions"))
    text = lambda c: F.when(~F.col("bib_missing"), F.array_join(f"c.{c}", "|")).alias(c)
    # P11, and rows without a bib, which are reported too.
    return f.filter("form_mismatch or bib_missing").select(
        "mms_id", text("common"), text("unique_bib"), text("unique_inventory"), "bib_missing")


# --------------------------------------------------------------- P6 / H7 / H36
PICKED_SQL = cte("bib_flat") + """
SELECT bib_id, 1 AS control_fields, array_to_string(list_filter(['245', CASE WHEN form1 IS NOT NULL THEN '655' END,
  CASE WHEN form2 IS NOT NULL THEN '655' END], lambda x: x IS NOT NULL), '|') AS tags
FROM bib_flat
"""


@register("picked_fields", PICKED_SQL)
def picked_fields(spark, sf_dir):
    p = MC.pick_fields(["001", "245", "655"])
    return bibs_of(spark, sf_dir).select("bib_id", p.alias("p")).select(
        "bib_id", F.size("p.controlfield").alias("control_fields"),
        F.array_join(F.transform("p.datafield", lambda f: f["_tag"]), "|").alias("tags"))


REPLACED_SQL = cte("holdings") + """
SELECT holding_id, CASE WHEN row_ordinal % 11 = 0 OR row_ordinal % 7 = 0 THEN NULL WHEN row_ordinal % 5 = 0 THEN 'b=lib'
  ELSE 'b=lib|h=' || CASE WHEN length(call_number) >= 2 AND substr(call_number, length(call_number) - 1, 1) = ' '
        AND right(call_number, 1) IN ('T', 'M', 'R') AND strpos(call_number, '-') = 0
        AND strpos(lower(call_number), 'and') = 0
       THEN left(call_number, length(call_number) - 2) || right(call_number, 1) ELSE call_number END END AS subfields
FROM holdings
"""


@register("replaced_call_numbers", REPLACED_SQL)
def replaced_call_numbers(spark, sf_dir):
    """H7: the 852 field of each holding record with its call number compacted."""
    from kardex.operators.changes import compact_call_number, marc_first_subfield, marc_replace_subfield
    from kardex.plans.marc_fixture import holdings_records
    r = holdings_records(load(spark, sf_dir, "holdings"))
    f = r.select("holding_id", F.get(F.filter("record.datafield", lambda x: x["_tag"] == "852"), 0).alias("f"))
    new = marc_replace_subfield(F.col("f"), "h", compact_call_number(marc_first_subfield(F.col("f"), "h")))
    return f.select("holding_id", F.array_join(F.transform(
        new["subfield"], lambda s: F.concat(s["_code"], F.lit("="), s["_VALUE"])), "|").alias("subfields"))


SUFFIX_NAMES_SQL = """
SELECT p_partkey AS part_id, CASE p_size % 3 WHEN 0 THEN p_name || ', Jr.' WHEN 1 THEN p_name || ';' || p_brand
  ELSE p_name || ';Jr.;' || p_brand END AS names FROM part
"""


@register("name_suffixes", SUFFIX_NAMES_SQL)
def name_suffixes(spark, sf_dir):
    from kardex.plans.bindings import read_table
    p, jr = read_table(spark, sf_dir, "part"), F.lit("Jr.")
    names = (F.when(F.col("p_size") % 3 == 0, F.array("p_name", jr)).when(F.col("p_size") % 3 == 1, F.array("p_name", "p_brand"))
             .otherwise(F.array(F.col("p_name"), jr, F.col("p_brand"))))
    return p.select(F.col("p_partkey").alias("part_id"), F.array_join(MC.fix_name_suffix(names), ";").alias("names"))


# --------------------------------------------------------------- S9 / H43 / A9
CODES_SQL = cte("language_codes") + """
SELECT code, arg_max(name, row_ordinal) AS name FROM language_codes GROUP BY code
"""


@register("language_code_table", CODES_SQL)
def language_code_table(spark, sf_dir):
    return _codes(spark, sf_dir).select("code", "name").orderBy("code")


SPANS_SQL = cte("bib_flat") + """
SELECT bib_id, person1 AS name, strpos(c245, person1) - 1 AS start, strpos(c245, person1) - 1 + length(person1) AS "end"
FROM bib_flat WHERE person1 IS NOT NULL
UNION ALL
SELECT bib_id, person2, strpos(c245, person2) - 1, strpos(c245, person2) - 1 + length(person2)
FROM bib_flat WHERE person2 IS NOT NULL
"""


@register("name_spans", SPANS_SQL)
def name_spans(spark, sf_dir):
    b = bibs_of(spark, sf_dir)
    text = F.get(MC.subfields("245", "c"), 0)
    names = MC.person_names(F.col("mentions"))
    spans = MC.span_annotations(text, names)
    return (b.select("bib_id", F.arrays_zip(names.alias("name"), spans.alias("span")).alias("z"))
             .select("bib_id", F.explode("z").alias("z"))
             .select("bib_id", F.col("z.name").alias("name"), F.col("z.span.start").cast("long").alias("start"),
                     F.col("z.span.end").cast("long").alias("end")))


TOTALS_SQL = cte("bib_flat") + """
SELECT count(c245) AS texts,
       count(*) FILTER (WHERE person1 IS NOT NULL) + count(*) FILTER (WHERE person2 IS NOT NULL) AS names,
       count(*) AS other_entities
FROM bib_flat
"""


@register("entity_totals", TOTALS_SQL)
def entity_totals(spark, sf_dir):
    """Texts with a 245$c, PERSON mentions and other mentions."""
    return B.entity_totals(bibs_of(spark, sf_dir))


# --------------------------------------------------------------- A11 (monograph job stages)
_MONO_FUNNEL_TAIL = """
SELECT 'holdings_read' AS stage, (SELECT count(*) FROM holdings) AS rows
UNION ALL SELECT 'matched', (SELECT count(*) FROM holdings h JOIN inv ON h.call_number = inv.inventory_no)
UNION ALL SELECT 'with_bib', (SELECT count(*) FROM j)
UNION ALL SELECT 'monographs', (SELECT count(*) FROM c WHERE mono)
UNION ALL SELECT 'form_mismatches', (SELECT count(*) FROM r WHERE len(ua) > 0 OR len(uf) > 0)
"""
MONO_FUNNEL_SQL = MONOGRAPH_SQL[:MONOGRAPH_SQL.rindex("SELECT mms_id, array_to_string")] + _MONO_FUNNEL_TAIL


@register("monograph_funnel", MONO_FUNNEL_SQL)
def monograph_funnel(spark, sf_dir):
    """A11 for the monograph job: rows kept at each stage, from one pass over
    the holdings with their stage flags."""
    h = load(spark, sf_dir, "holdings").select("mms_id", "call_number")
    i = load(spark, sf_dir, "inventory").select("inventory_no", "production_type", "row_ordinal")
    inv = keep_last(i, "inventory_no", "row_ordinal").drop("row_ordinal").withColumn("matched", F.lit(True))
    rows = h.join(inv, F.col("call_number") == F.col("inventory_no"), "left")
    f = monograph_flags(rows, bibs_of(spark, sf_dir).drop("mentions"))
    kept = lambda c: F.count_if(F.coalesce(F.col("matched"), F.lit(False)) & c)
    stages = {"holdings_read": F.count(F.lit(1)), "matched": kept(F.lit(True)), "with_bib": kept(~F.col("bib_missing")),
              "monographs": kept(F.col("monograph")), "form_mismatches": kept(F.col("form_mismatch"))}
    one = f.agg(*[c.alias(n) for n, c in stages.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("rows")) for n in stages])))
