"""Command line: ``python -m kardex <command> ...``.

Each command reads its inputs with the sources, runs the operators on Spark
and writes the report with the sinks.  On a cluster, submit the module with
``spark-submit`` so the cluster's session settings (including
``spark.checkpoint.dir``) apply.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _session():
    from kardex.session import get_session
    return get_session()


def _read_table(spark, path: str):
    """CSV (header), JSON array (.json), JSON lines (.jsonl)
    or Parquet, by extension."""
    from kardex.sources import readers as R
    low = path.lower().rstrip("/")
    if low.endswith(".csv"):
        return R.read_holdings(spark, path)
    if low.endswith(".json"):
        return R.read_records_json(spark, path, between=R.BETWEEN)
    if low.endswith(".jsonl"):
        return R.read_records_json(spark, path)
    return spark.read.parquet(path)


def _write_summary(df, out: str) -> None:
    """The summary of a run, whole, beside its report."""
    from kardex.sinks.writers import write_report_csv
    write_report_csv(df, out.rstrip("/") + "_summary")


def cmd_perfect_matches(a, spark):
    from kardex.operators.matching import perfect_matches
    from kardex.sinks.writers import write_report_csv
    from kardex.sources import readers as R
    h = R.read_holdings(spark, a.holdings)
    d = R.read_fixture_json(spark, a.digital, between=None if a.digital.endswith(".jsonl") else R.BETWEEN)
    i = _read_table(spark, a.inventory)
    out = perfect_matches(h, d, i, call_number="`Permanent Call Number`", holding_id="`Holding Id`")
    write_report_csv(out, a.out)


def cmd_match_report(a, spark):
    from kardex.plans.jobs import run_match_report
    from kardex.sources import readers as R
    h = R.read_holdings(spark, a.holdings)
    i = _read_table(spark, a.inventory)
    s = R.read_sheet(spark, a.sheet)
    counts = run_match_report(h, i, s, a.out, call_number="`Permanent Call Number`",
                              holding_id=f"`{a.holding_id_column}`", sheet_col=f"`{a.sheet_column}`")
    _write_summary(counts, a.out)


def cmd_validate(a, spark):
    from kardex.plans.jobs import run_validation
    recs = _read_table(spark, a.records)
    children = {}
    if a.children:
        children[a.layout] = (_read_table(spark, a.children), a.parent_key, a.child_key)
    elif a.portal:
        children[a.layout] = a.portal
    _write_summary(run_validation(recs, [a.layout], a.out, children, a.modified_column, a.start, a.end), a.out)


def cmd_standardise(a, spark):
    from kardex.plans.jobs import run_standardisation
    recs = _read_table(spark, a.records)
    _write_summary(run_standardisation(recs, a.fields.split(","), a.out, a.id_column, a.as_of_year), a.out)


def cmd_duplicates(a, spark):
    from kardex.operators.keys import duplicate_rows, with_file_order, without_duplicates
    from kardex.sinks.writers import write_report_csv
    df = _read_table(spark, a.sheet)
    if a.ordinal_column:
        df = df.withColumn("__ordinal", F.col(f"`{a.ordinal_column}`").cast("long"))
    else:
        df = with_file_order(df, "__ordinal")
    out = duplicate_rows(df, F.col(f"`{a.key}`"), "__ordinal").withColumnRenamed(
        "original_row_number", "Original Row Number").drop("__ordinal")
    write_report_csv(out, a.out)
    if a.deduplicated_out:
        left = without_duplicates(df, F.col(f"`{a.key}`"), "__ordinal").orderBy("__ordinal").drop("__ordinal")
        write_report_csv(left, a.deduplicated_out)


def cmd_match_problems(a, spark):
    from kardex.plans.jobs import run_match_problems
    from kardex.sources import readers as R
    if a.as_of and not R.export_is_recent(spark, [a.digital, a.inventory], a.as_of):
        raise SystemExit(f"The exports are older than one day before {a.as_of}.")
    run_match_problems(
        R.read_holdings(spark, a.holdings), R.read_fixture_json(spark, a.digital, between=None if a.digital.endswith(".jsonl") else R.BETWEEN),
        _read_table(spark, a.inventory), R.read_marc(spark, a.bibs), R.read_language_codes(spark, a.language_codes), a.out,
        call_number="`Permanent Call Number`", holding_id="`Holding Id`", bib=a.bib_column)


def cmd_monographs(a, spark):
    from kardex.operators.keys import with_file_order
    from kardex.plans.jobs import run_monographs
    from kardex.sources import readers as R
    inventory = with_file_order(R.read_headerless_csv(spark, a.inventory, ["inventory_no", "production_type"]), "row_ordinal")
    run_monographs(R.read_holdings(spark, a.holdings), inventory, with_file_order(R.read_marc(spark, a.bibs), "row_ordinal"),
                   a.out, call_number="`Permanent Call Number`", bib=a.bib_column)


def cmd_extract_codes(a, spark):
    from kardex.operators.lookups import extract_codes
    from kardex.sinks.writers import write_report_csv
    df = _read_table(spark, a.sheet)
    write_report_csv(df.withColumn(a.output_column, extract_codes(F.col(f"`{a.column}`"))), a.out)


def cmd_filename_mismatches(a, spark):
    from kardex.operators import files as FL
    from kardex.sinks.writers import write_sectioned_report
    from kardex.sources import readers as R
    files = FL.media_file_names(R.read_path_lists(spark, a.file_lists))
    meta = FL.metadata_file_names(R.read_assets(spark, a.metadata))
    write_sectioned_report(FL.filename_mismatches(files, meta), a.out)


def cmd_xml_to_json(a, spark):
    from kardex.sinks.writers import xml_to_json
    xml_to_json(spark, a.input, a.out, a.row_tag)  # malformed rows stay below <out>/malformed=true


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kardex")
    p.add_argument("--input-gb", type=int, help="size of the inputs: sizes the shuffles where not submitted")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("perfect-matches", help="keys unique in holdings, digital and inventory")
    s.add_argument("--holdings", required=True)
    s.add_argument("--digital", required=True, help="fixture JSON {model, pk, fields}")
    s.add_argument("--inventory", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_perfect_matches)

    s = sub.add_parser("match-report", help="single/compound sheet values vs holdings and inventory")
    s.add_argument("--holdings", required=True)
    s.add_argument("--inventory", required=True)
    s.add_argument("--sheet", required=True, help="one tab exported as CSV")
    s.add_argument("--sheet-column", default="Inventory Number [EXTRACTED]")
    s.add_argument("--holding-id-column", default="Holding Id")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_match_report)

    s = sub.add_parser("validate", help="layout validation report")
    s.add_argument("--records", required=True)
    s.add_argument("--layout", required=True)
    s.add_argument("--children", help="child rows table (joined on --parent-key/--child-key)")
    s.add_argument("--parent-key")
    s.add_argument("--child-key")
    s.add_argument("--portal", help="array<struct> column holding the child rows")
    s.add_argument("--modified-column")
    s.add_argument("--start")
    s.add_argument("--end")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_validate)

    s = sub.add_parser("standardise", help="change table for standardised fields (dry run)")
    s.add_argument("--records", required=True)
    s.add_argument("--fields", required=True, help="comma-separated field names")
    s.add_argument("--id-column", default="inventory_id")
    s.add_argument("--as-of-year", type=int, required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_standardise)

    s = sub.add_parser("duplicates", help="rows whose key occurs more than once")
    s.add_argument("--sheet", required=True)
    s.add_argument("--key", default="Legacy Path")
    s.add_argument("--ordinal-column", help="0-based row index column (file order needs one)")
    s.add_argument("--out", required=True)
    s.add_argument("--deduplicated-out", help="also write the sheet without the repeats, first rows kept")
    s.set_defaults(fn=cmd_duplicates)

    s = sub.add_parser("match-problems", help="checks of uniquely matched bibs, with titles side by side")
    s.add_argument("--holdings", required=True)
    s.add_argument("--digital", required=True)
    s.add_argument("--inventory", required=True)
    s.add_argument("--bibs", required=True, help="MARCXML")
    s.add_argument("--language-codes", required=True, help="code list XML")
    s.add_argument("--bib-column", default="MMS Id")
    s.add_argument("--as-of", help="refuse exports whose stamp is over a day before this time")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_match_problems)

    s = sub.add_parser("monographs", help="matched holdings whose forms differ between bib and inventory")
    s.add_argument("--holdings", required=True)
    s.add_argument("--inventory", required=True, help="CSV without header: number, production type")
    s.add_argument("--bibs", required=True, help="MARCXML")
    s.add_argument("--bib-column", default="MMS Id")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_monographs)

    s = sub.add_parser("extract-codes", help="inventory numbers found in a text column")
    s.add_argument("--sheet", required=True)
    s.add_argument("--column", default="Legacy Path")
    s.add_argument("--output-column", default="Inventory Number [EXTRACTED]")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_extract_codes)

    s = sub.add_parser("filename-mismatches", help="file lists vs asset metadata file names")
    s.add_argument("--file-lists", required=True, nargs="+")
    s.add_argument("--metadata", required=True, nargs="+")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_filename_mismatches)

    s = sub.add_parser("xml-to-json", help="XML documents to JSON lines")
    s.add_argument("--input", required=True)
    s.add_argument("--row-tag", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_xml_to_json)
    return p


def main(argv=None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    if spark is None:
        spark = _session()
        if args.input_gb:
            from kardex.session import scale_session
            scale_session(spark, args.input_gb << 30)
    args.fn(args, spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
