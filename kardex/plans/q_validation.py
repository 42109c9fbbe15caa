"""Validation reports over the derived layout tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kardex.operators import validation as V
from kardex.plans.bindings import cte, load
from kardex.plans.catalog import register

GE, DC, DS = "InventoryForLabeling_API", "NEW DIGITAL_API", "NEW DIGITAL STORAGE_API"
_NUMERIC = {"inventory_id", "Inventory_id_fk", "file_size"}


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _txt(name: str, alias: str = "r") -> str:
    col = f"{alias}.{_q(name)}"
    if name in _NUMERIC:
        return f"(CASE WHEN {col} IS NULL OR {col} = 0 THEN '' ELSE CAST({col} AS VARCHAR) END)"
    return f"coalesce(trim({col}), '')"


def _valid_date(v: str) -> str:
    y, m, d = (f"split_part({v}, '-', {i})" for i in (1, 2, 3))
    mi = f"least(greatest(TRY_CAST({m} AS INTEGER), 1), 12)"
    return (f"(regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') AND {y} <> '0000' "
            f"AND TRY_CAST({m} AS INTEGER) BETWEEN 1 AND 12 AND TRY_CAST({d} AS INTEGER) BETWEEN 1 AND "
            f"day(last_day(make_date(TRY_CAST({y} AS INTEGER), {mi}, 1))))")


def _rows(layout: V.Layout, src: str, where: str, rules: list[tuple[str, str, str]], meta_alias="r") -> str:
    meta = ", ".join(f"{_txt(s, meta_alias)} AS {d}" for d, s in layout.meta.items())
    parts = []
    for fieldname, cond, msg in rules:
        parts.append(f"SELECT '{layout.name}' AS layout, {meta}, '{fieldname}' AS field, {msg} AS violation "
                     f"FROM {src} WHERE {where}({cond})")
    return "\n UNION ALL ".join(parts)


def oracle_for(layout_name: str, recs: str, kids: str | None, parent_key: str | None,
               child_key: str | None) -> str:
    L = V.LAYOUTS[layout_name]
    scope = f"r.digital_record = '{L.digital_record}' AND " if L.digital_record is not None else ""
    rules = [(f, f"{_txt(f)} = ''", "'Field is null or empty.'") for f in L.required]
    t = _txt
    if "tv_series" in L.cross_rules:
        for ep in ("episode no.", "episode_title"):
            rules.append((ep, f"upper({t('production_type')}) = 'TELEVISION SERIES' AND {t(ep)} = ''",
                          f"'{ep} is null but production_type is ''TELEVISION SERIES''.'"))
    if "unknown_year" in L.cross_rules:
        y = t("release_broadcast_year")
        rules.append(("record_date", f"upper({y}) IN ('N/A', 'UNKNOWN') AND {t('record_date')} = ''",
                      f"'record_date is null but release_broadcast_year is ''' || {y} || '''.'"))
    if "temporary_retention" in L.cross_rules:
        for d in ("retention_start_date", "retention_end_date"):
            rules.append((d, f"upper({t('retention_status')}) = 'TEMPORARY' AND {t(d)} = ''",
                          f"'{d} is null but retention_status is ''Temporary''.'"))
    if "sound_format" in L.cross_rules:
        p = t("object_purpose")
        rules.append(("sound_format(1)",
                      f"upper({p}) IN ('PRESERVATION (FULL)', 'ACCESS (CORE)') AND {t('sound_format(1)')} = ''",
                      f"'sound_format(1) is null but object_purpose is ''' || {p} || '''.'"))
    sql = _rows(L, f"{recs} r", scope, rules)
    if kids and L.child_required:
        crules = []
        for f in L.child_required:
            crules.append((f, f"{_txt(f, 'c')} = ''", "'Field is null or empty.'"))
            if f in L.child_dates:
                v = _txt(f, "c")
                crules.append((f, f"NOT {_valid_date(v)}",
                               f"'Field value ''' || {v} || ''' is not a valid date in YYYY-MM-DD format.'"))
        src = f"{kids} c JOIN {recs} r ON c.{_q(child_key)} = r.{_q(parent_key)}"
        sql += "\n UNION ALL " + _rows(L, src, scope, crules)
    return sql


VALIDATION_SQL = cte("layout_records", "carrier_items", "storage_records", "storage_items") + \
    "\n UNION ALL ".join([
        oracle_for(GE, "layout_records", None, None, None),
        oracle_for(DC, "layout_records", "carrier_items", "inventory_id", "parent_id"),
        oracle_for(DS, "storage_records", "storage_items", "storage_id", "storage_id"),
    ])


def _all_violations(spark, sf_dir):
    recs = load(spark, sf_dir, "layout_records")
    items = load(spark, sf_dir, "carrier_items")
    srecs = load(spark, sf_dir, "storage_records")
    sitems = load(spark, sf_dir, "storage_items").withColumnRenamed("storage_id", "parent_storage_id")
    ge = V.violations(recs, GE).withColumn("layout", F.lit(GE))
    dc = V.violations(recs, DC, items, parent_key="inventory_id", child_key="parent_id").withColumn("layout", F.lit(DC))
    ds = V.violations(srecs, DS, sitems, parent_key="storage_id", child_key="parent_storage_id") \
        .withColumn("layout", F.lit(DS))
    # One report over several layouts.
    return ge.unionByName(dc).unionByName(ds).select("layout", *V.REPORT_COLUMNS)


@register("validation_report", VALIDATION_SQL)
def validation_report(spark, sf_dir):
    return _all_violations(spark, sf_dir)


TOTALS_SQL = f"""
WITH v AS ({VALIDATION_SQL})
SELECT layout, field, CASE WHEN violation = 'Field is null or empty.' THEN 'required'
                           WHEN violation LIKE 'Field value %' THEN 'date' ELSE 'cross field' END AS rule,
       count(*) AS violations FROM v GROUP BY ALL
"""


@register("violation_totals", TOTALS_SQL)
def violation_totals(spark, sf_dir):
    return V.violation_totals(_all_violations(spark, sf_dir), by=("layout", "field"))


SUMMARY_SQL = cte("layout_records", "storage_records") + f"""
, v AS (SELECT * FROM ({VALIDATION_SQL}))
SELECT l.layout, l.records_checked, coalesce(c.violations, 0) AS violations FROM (
    SELECT '{GE}' AS layout, count(*) FILTER (WHERE digital_record = '0') AS records_checked FROM layout_records
    UNION ALL SELECT '{DC}', count(*) FILTER (WHERE digital_record = '1') FROM layout_records
    UNION ALL SELECT '{DS}', count(*) FROM storage_records) l
LEFT JOIN (SELECT layout, count(*) AS violations FROM v GROUP BY layout) c ON c.layout = l.layout
"""


@register("validation_summary", SUMMARY_SQL)
def validation_summary(spark, sf_dir):
    """A10: records checked and violations per layout."""
    recs = load(spark, sf_dir, "layout_records")
    srecs = load(spark, sf_dir, "storage_records")
    checked = (V.records_checked(recs, GE).unionByName(V.records_checked(recs, DC))
               .unionByName(V.records_checked(srecs, DS)))
    counts = _all_violations(spark, sf_dir).groupBy("layout").agg(F.count(F.lit(1)).alias("violations"))
    return (checked.join(counts, "layout", "left")
                   .select("layout", "records_checked", F.coalesce("violations", F.lit(0)).alias("violations")))
