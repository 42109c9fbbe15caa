"""End-to-end jobs over the smallest test tables."""

from kardex.plans import jobs
from kardex.plans.bindings import load

SF = "/root/testdata/sf0.001"


def test_match_report_job(spark, tmp_path):
    counts = jobs.run_match_report(load(spark, SF, "holdings"), load(spark, SF, "inventory"),
                                   load(spark, SF, "sheet"), str(tmp_path / "report"))
    got = {r.section: r.rows for r in counts.collect()}
    out = spark.read.option("header", True).csv(str(tmp_path / "report"))
    sections = {r.section for r in out.select("section").distinct().collect()}
    assert sections and all(s.split(")")[0] in got for s in sections)


def test_validation_and_standardisation_jobs(spark, tmp_path):
    recs = load(spark, SF, "layout_records")
    items = load(spark, SF, "carrier_items")
    totals = jobs.run_validation(recs, ["InventoryForLabeling_API", "NEW DIGITAL_API"], str(tmp_path / "v"),
                                 children={"NEW DIGITAL_API": (items, "inventory_id", "parent_id")})
    assert totals.count() > 0
    stats = jobs.run_standardisation(load(spark, SF, "dated_records"), ["record_date"], str(tmp_path / "c")).first()
    assert stats.records_processed > 0 and stats.total_changes >= stats.records_updated > 0
