"""End-to-end jobs: source files -> operators -> report files.

These are the reference's command-line flows expressed as Spark jobs.  Each
returns small summary DataFrames; the reports themselves are written by the
distributed sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions import marc as MC
from kardex.functions.text import title_join, title_score
from kardex.operators import changes as C
from kardex.operators import matching as M
from kardex.operators import validation as V
from kardex.operators.lookups import monograph_flags, valid_code_check
from kardex.session import cut_lineage
from kardex.sinks import writers as W


def run_match_report(holdings: DataFrame, inventory: DataFrame, sheet: DataFrame, out_path: str, *,
                     call_number="call_number", holding_id="holding_id", inventory_no="inventory_no",
                     inventory_id="inventory_id", sheet_col="inventory_value") -> DataFrame:
    """Flow (a): single (S1-S6) and compound (M1, M2) classes written as one
    sectioned report (K4); returns the class counts (A8).

    The per-key counts feed both classifications, so they are cut from the
    lineage once (reliable checkpoint in ``spark.checkpoint.dir``): a lost
    executor does not send both branches back to the raw scans.
    """
    ids = M.source_ids(holdings, inventory, call_number=call_number, holding_id=holding_id,
                       inventory_no=inventory_no, inventory_id=inventory_id)
    counts = cut_lineage(M.source_counts(ids))
    vals = M.sheet_values(sheet, sheet_col)
    classes = M.classify_single_values(vals, counts).unionByName(M.classify_compound_values(vals, counts))
    report = (M.attach_ids(classes.filter(F.col("section") != "leftover"), ids)
              .withColumn("section", F.concat(F.col("section"), F.lit(") "),
                                               F.coalesce(F.create_map(*[x for k, v in {**M.SINGLE_SECTIONS,
                                                                                      **M.COMPOUND_SECTIONS}.items()
                                                                         for x in (F.lit(k), F.lit(v))])[F.col("section")],
                                                          F.lit("")))))
    W.write_sectioned_report(report.select("section", "inventory_number", "original_value", "source", "record_id"),
                             out_path)
    return M.class_counts(classes)


def run_validation(records: DataFrame, layouts, out_path: str, children: dict | None = None,
                   modified_col: str | None = None, start=None, end=None) -> DataFrame:
    """Flow (c): P1 date range, V5 per layout, one CSV per layout (K1, no file
    when empty); returns the totals (A10).  Each layout's violations are
    computed once: gate, file and totals read the checkpoint."""
    children = children or {}
    totals = None
    for layout in layouts:
        recs = V.modified_between(records, modified_col, start, end) if modified_col else records
        kids = children.get(layout)
        if isinstance(kids, tuple):
            v = V.violations(recs, layout, kids[0], parent_key=kids[1], child_key=kids[2])
        else:
            v = V.violations(recs, layout, kids)
        v = cut_lineage(v)
        W.write_report_csv(v, f"{out_path}/{layout.replace(' ', '_')}", V.REPORT_COLUMNS)
        t = V.violation_totals(v.withColumn("layout", F.lit(layout)))
        totals = t if totals is None else totals.unionByName(t)
    return totals


def run_match_problems(holdings: DataFrame, digital: DataFrame, inventory: DataFrame, bibs: DataFrame, codes: DataFrame,
                       out_path: str, *, call_number="call_number", holding_id="holding_id", bib="mms_id",
                       title=("title", "episode_title", "episode no.")) -> bool:
    """Match-problem report (H33): the checks of each uniquely matched bib,
    with the full inventory title (H31) beside the bib title."""
    parts = [F.col(f"`{t}`") for t in title if t in inventory.columns]
    inv = inventory.withColumn("full_title", title_join(*parts))
    m = M.unique_variant_match(digital, inv, holdings, call_number=call_number, holding_id=holding_id,
                               holdings_carry=[bib], inventory_carry=["full_title"])
    matched = m.select(F.col("inventory_number").alias("digital_inventory_number"), F.col(bib).alias("__bib"),
                       F.col("inventory_id").cast("string").alias("inventory_record_id"), "full_title")
    found = matched.join(bibs.withColumn("bib_id", MC.bib_id()), F.col("__bib") == F.col("bib_id"), "left")
    checked = valid_code_check(found.withColumn("lang_code", MC.language_code()), "lang_code", codes)
    t = MC.bib_title()
    known = lambda c: F.when(F.col("bib_id").isNotNull(), c).otherwise("")
    report = checked.select(
        F.coalesce("bib_id", F.lit("")).alias("bib_id"), "inventory_record_id", "digital_inventory_number",
        known(MC.no_008()).alias("no_008"), known(MC.invalid_language(F.col("code_valid"))).alias("invalid_language"),
        known(MC.no_26x_date()).alias("no_26x_date"), known(MC.lacks_attribution()).alias("lacks_attribution"),
        title_score(known(t["title"]), F.col("full_title")).alias("title_match_score"),
        known(t["title"]).alias("bib_title"), F.col("full_title").alias("inventory_title"),
        known(F.when(t["check_ind2"], "Yes").otherwise("")).alias("check_245_indicator_2"))
    return W.write_report_csv(report, out_path)


def run_monographs(holdings: DataFrame, inventory: DataFrame, bibs: DataFrame, out_path: str, *,
                   call_number="call_number", bib="mms_id") -> bool:
    """Monograph job (H37-H42): matched holdings whose forms differ between
    bib and inventory, and those without a bib.  ``inventory`` and ``bibs``
    carry ``row_ordinal``; of repeated numbers and ids the last wins."""
    matched = M.match_by_call_number(holdings, inventory, call_number=call_number).drop("row_ordinal")
    matched = matched.select(F.col(f"`{bib}`").alias("mms_id"), "production_type")
    f = monograph_flags(matched, bibs.withColumn("bib_id", MC.bib_id()))
    text = lambda c: F.when(~F.col("bib_missing"), F.array_join(f"c.{c}", "|")).alias(c)
    return W.write_report_csv(f.filter("form_mismatch or bib_missing").select(
        "mms_id", text("common"), text("unique_bib"), text("unique_inventory"), "bib_missing"), out_path)


def run_standardisation(records: DataFrame, fields, out_path: str, id_col: str = "inventory_id",
                        as_of_year: int = 2026) -> DataFrame:
    """Flow (b): change rows (H22) written as Parquet; returns the stats."""
    changes = C.change_log(records, fields, id_col=id_col, as_of_year=as_of_year)
    changes.write.mode("overwrite").parquet(out_path)
    written = records.sparkSession.read.parquet(out_path)
    return C.change_stats(records, written, id_col=id_col)
