"""Standardisation reports: dirty text derived from clean columns; the oracle
computes the expected clean value from the clean column directly, so it does
not share any rule with the Spark implementation."""

from __future__ import annotations

from pyspark.sql import functions as F

from kardex.functions.dates import needs_review
from kardex.functions.standardise import standardise
from kardex.operators import changes as C
from kardex.plans.bindings import cte, load
from kardex.plans.catalog import register

AS_OF_YEAR = 2026

_Y = "CAST(year(clean_date) AS VARCHAR)"
_N2 = "lpad(CAST((year(clean_date) + 1) % 100 AS VARCHAR), 2, '0')"
_ISO = "CAST(CAST(clean_date AS DATE) AS VARCHAR)"
EXPECTED_DATE = f"""(CASE inventory_id % 10
  WHEN 0 THEN {_Y} || '?'
  WHEN 1 THEN {_Y}
  WHEN 2 THEN {_ISO}
  WHEN 3 THEN 'c' || {_Y}
  WHEN 4 THEN CASE WHEN (year(clean_date) + 1) % 100 BETWEEN 1 AND 12 THEN {_Y} || '-' || {_N2}
                   ELSE {_Y} || '-' || substr({_Y}, 1, 2) || {_N2} END
  WHEN 5 THEN {_Y} || '-' || lpad(CAST(month(clean_date) AS VARCHAR), 2, '0')
  WHEN 6 THEN {_ISO}
  WHEN 7 THEN substr({_Y}, 1, 3) || '-'
  WHEN 8 THEN 'Unknown'
  ELSE {_Y} || '; ' || CAST(year(clean_date) + 1 AS VARCHAR) END)"""
EXPECTED_YEAR = f"(CASE inventory_id % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'N/A' ELSE {_Y} END)"

DATES_SQL = cte("dated_records") + f"""
SELECT inventory_id, record_date, {EXPECTED_DATE} AS record_date_std,
       release_broadcast_year, {EXPECTED_YEAR} AS release_broadcast_year_std
FROM dated_records
"""


@register("standardise_dates", DATES_SQL)
def standardise_dates(spark, sf_dir):
    df = load(spark, sf_dir, "dated_records")
    df = standardise(df, "record_date", out="record_date_std", as_of_year=AS_OF_YEAR)
    df = standardise(df, "release_broadcast_year", out="release_broadcast_year_std", as_of_year=AS_OF_YEAR)
    return df.select("inventory_id", "record_date", "record_date_std",
                     "release_broadcast_year", "release_broadcast_year_std")


_P2, _P3 = f"substr({_Y}, 1, 2)", f"substr({_Y}, 1, 3)"
_PN = "CAST(year(clean_date) + 1 AS VARCHAR)"
PARTIAL_SQL = cte("partial_records") + f"""
SELECT inventory_id, record_date, CASE inventory_id % 16
  WHEN 0 THEN {_P3} || '-' WHEN 1 THEN {_P2} || '--?' WHEN 2 THEN {_P2} || '--?-' || {_Y} WHEN 3 THEN {_P3} || '-?'
  WHEN 4 THEN {_Y} WHEN 5 THEN {_P2} || '--?' WHEN 6 THEN {_P3} || '-?' WHEN 7 THEN {_Y} || ' or ' || {_PN}
  WHEN 8 THEN 'shown ' || {_Y} || '?' WHEN 9 THEN {_Y} || '-' || lpad(CAST(month(clean_date) AS VARCHAR), 2, '0')
  WHEN 10 THEN CASE WHEN year(clean_date) % 100 > {AS_OF_YEAR % 100} THEN {_ISO} ELSE record_date END WHEN 11 THEN {_ISO} WHEN 12 THEN record_date WHEN 13 THEN record_date
  WHEN 14 THEN {_P3} || '-?' ELSE {_Y} || '?' END AS record_date_std,
  inventory_id % 16 IN (8, 13) OR (inventory_id % 16 = 10 AND year(clean_date) % 100 <= {AS_OF_YEAR % 100}) AS needs_review
FROM partial_records
"""


@register("standardise_partial_dates", PARTIAL_SQL)
def standardise_partial_dates(spark, sf_dir):
    """Unknown digits, decades, marks, day 0 and lists of days, with the flag for a reader's eye."""
    df = standardise(load(spark, sf_dir, "partial_records"), "record_date", out="record_date_std", as_of_year=AS_OF_YEAR)
    return df.select("inventory_id", "record_date", "record_date_std", needs_review(F.col("record_date_std")).alias("needs_review"))


TYPES_SQL = cte("typed_parts") + """
SELECT part_id, production_type,
  CASE part_id % 6 WHEN 3 THEN 'B&W' || chr(13) || clean_type || ' AND SHORT'
                   WHEN 4 THEN 'NEWSREELS' || chr(13) || clean_type
                   WHEN 5 THEN clean_type || chr(13) || 'MADE FOR TV MOVIE'
                   ELSE clean_type END AS production_type_std
FROM typed_parts
"""


@register("standardise_production_types", TYPES_SQL)
def standardise_production_types(spark, sf_dir):
    df = load(spark, sf_dir, "typed_parts")
    return standardise(df, "production_type", out="production_type_std").select(
        "part_id", "production_type", "production_type_std")


LANG_SQL = cte("language_records") + """
SELECT customer_id, "Language" AS language,
  CASE customer_id % 5 WHEN 1 THEN clean_language || ', ' || clean_language2
                       WHEN 4 THEN 'Undetermined' ELSE clean_language END AS language_std
FROM language_records
"""


@register("standardise_languages", LANG_SQL)
def standardise_languages(spark, sf_dir):
    df = load(spark, sf_dir, "language_records")
    return standardise(df, "Language", out="language_std").select(
        "customer_id", F.col("Language").alias("language"), "language_std")


def _cap(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || substr({w}, 2))"


_C1, _C2 = _cap("split_part(clean_name, ' ', 1)"), _cap("split_part(clean_name, ' ', 2)")
DIRECTOR_SQL = cte("director_parts") + f"""
SELECT part_id, director,
  CASE part_id % 6 WHEN 4 THEN {_C1} || ', ' || {_C2} WHEN 5 THEN 'Unknown'
                   ELSE {_C1} || ' ' || {_C2} END AS director_std
FROM director_parts
"""


@register("standardise_directors", DIRECTOR_SQL)
def standardise_directors(spark, sf_dir):
    df = load(spark, sf_dir, "director_parts")
    return standardise(df, "director", out="director_std").select("part_id", "director", "director_std")


CHANGES_SQL = cte("dated_records") + f"""
, e AS (SELECT inventory_id, record_date, {EXPECTED_DATE} AS rd, release_broadcast_year,
               {EXPECTED_YEAR} AS ry FROM dated_records)
SELECT inventory_id, 'record_date' AS field, record_date AS old_value, rd AS new_value
FROM e WHERE record_date IS DISTINCT FROM rd
UNION ALL
SELECT inventory_id, 'release_broadcast_year', release_broadcast_year, ry
FROM e WHERE release_broadcast_year IS DISTINCT FROM ry
"""


def _changes(spark, sf_dir):
    df = load(spark, sf_dir, "dated_records")
    return df, C.change_log(df, ["record_date", "release_broadcast_year"], as_of_year=AS_OF_YEAR)


@register("change_log", CHANGES_SQL)
def change_log(spark, sf_dir):
    return _changes(spark, sf_dir)[1]


STATS_SQL = f"""
WITH c AS ({CHANGES_SQL})
SELECT (SELECT count(*) FROM orders) AS records_processed,
       count(DISTINCT inventory_id) AS records_updated, count(*) AS total_changes FROM c
"""


@register("change_stats", STATS_SQL)
def change_stats(spark, sf_dir):
    df, ch = _changes(spark, sf_dir)
    return C.change_stats(df, ch)
