"""Change tables instead of write-back.

The reference edits the source systems in place; here the result of a run is
a change table (one row per record and changed field) that a loader can
apply.  ``dry_run`` is therefore the only mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kardex.functions._util import as_col
from kardex.functions.standardise import standardise


def change_log(df: DataFrame, fields, id_col: str = "inventory_id", as_of_year: int = 2026) -> DataFrame:
    """Per record and field, old and new value where they differ.

    A blank old value that standardises to "Unknown"/"Undetermined" counts as
    a change.  One narrow projection plus one explode; no shuffle.
    """
    cur = df
    for f in fields:
        cur = standardise(cur, f, f, f"__new_{f}", as_of_year=as_of_year)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"),
                               F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")).alias("old_value"),
                               F.col(f"`__new_{f}`").alias("new_value")) for f in fields])
    return (cur.select(F.col(f"`{id_col}`").alias(id_col), F.explode(pairs).alias("c"))
               .select(id_col, "c.field", "c.old_value", "c.new_value")
               .filter(~F.col("old_value").eqNullSafe(F.col("new_value"))))


def change_stats(records: DataFrame, changes: DataFrame, id_col: str = "inventory_id") -> DataFrame:
    """Records processed, records with at least one change, total changes.

    Per-record change counts are partially aggregated, so the totals are two
    small aggregations (no join back to the records)."""
    per_record = changes.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    upd = per_record.agg(F.count(F.lit(1)).alias("records_updated"),
                         F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_changes"))
    processed = records.agg(F.count(F.lit(1)).alias("records_processed"))
    # Both sides are one-row aggregates: a union + max folds them without a join.
    a = processed.select("records_processed", F.lit(None).cast("long").alias("records_updated"),
                         F.lit(None).cast("long").alias("total_changes"))
    b = upd.select(F.lit(None).cast("long").alias("records_processed"), "records_updated", "total_changes")
    return a.unionByName(b).agg(F.max("records_processed").alias("records_processed"),
                                F.max("records_updated").alias("records_updated"),
                                F.max("total_changes").alias("total_changes"))


# ---------------------------------------------------------------------------
# Call numbers (H5-H7)
# ---------------------------------------------------------------------------

def compact_call_number(c) -> Column:
    """H5: drop the space before a final T/M/R when the value has no ``-``
    and no "and" (any case)."""
    c = as_col(c)
    cand = (c.rlike(r"(?s)^.* [TMR]$") & ~c.contains("-") & ~F.lower(c).contains("and"))
    return F.when(cand, F.concat(F.substring(c, 1, F.length(c) - 2), F.substring(c, -1, 1))).otherwise(c)


def marc_first_subfield(field: Column, code: str) -> Column:
    """First value of subfield ``code`` of one data field (null if none)."""
    return F.get(F.filter(field["subfield"], lambda s: s["_code"] == code), 0)["_VALUE"]


def marc_replace_subfield(field: Column, code: str, value: Column) -> Column:
    """H7: replace the first ``code`` subfield of a data field in place."""
    pos = F.array_position(F.transform(field["subfield"], lambda s: s["_code"]), F.lit(code))
    subs = F.transform(field["subfield"], lambda s, i: F.when(
        (i + 1) == pos, F.struct(s["_code"].alias("_code"), value.alias("_VALUE"))).otherwise(s))
    return field.withField("subfield", subs)


def call_number_changes(bibs: DataFrame, holdings_ids: DataFrame | None = None,
                        id_col: str = "holding_id", record_col: str = "record") -> DataFrame:
    """H6: per holding record, the first 852$h and its compacted form with a
    status: no record / no 852 / no $h / unchanged / change (dry-run plan).

    ``bibs`` carries ``id_col`` and a MARC record struct ``record_col`` (null
    when the lookup found nothing).  With ``holdings_ids`` given, ids without
    a record are reported as "no record".
    """
    rec = F.col(record_col)
    f852 = F.get(F.filter(rec["datafield"], lambda f: f["_tag"] == "852"), 0)
    old = marc_first_subfield(f852, "h")
    new = compact_call_number(old)
    out = bibs.select(F.col(id_col), old.alias("old_value"), new.alias("new_value"),
                      F.when(rec.isNull(), "no record")
                       .when(f852.isNull(), "no 852")
                       .when(old.isNull(), "no $h")
                       .when(old == new, "unchanged")
                       .otherwise("change").alias("status"))
    if holdings_ids is not None:
        missing = (holdings_ids.select(id_col).join(bibs.select(id_col).distinct(), id_col, "left_anti")
                   .select(id_col, F.lit(None).cast("string").alias("old_value"),
                           F.lit(None).cast("string").alias("new_value"), F.lit("no record").alias("status")))
        out = out.unionByName(missing)
    return out
