"""Command line on small files (in-process, sharing the test session)."""

import json
import os

import pytest

from kardex.__main__ import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_cli_perfect_matches_and_codes(spark, tmp_path):
    d = str(tmp_path)
    _write(d + "/h.csv", "﻿MMS Id,Holding Id,Permanent Call Number\n1,h1,M 10\n2,h2,M11\n3,h3,M 11\n")
    _write(d + "/dl.json", json.dumps([{"model": "m", "pk": 5, "fields": {"inventory_number": "M10",
                                                                         "file_name": "a.mov"}}]))
    _write(d + "/inventory.json", json.dumps([{"inventory_id": 7, "inventory_no": "m10 ", "title": "T"}]))
    assert main(["perfect-matches", "--holdings", d + "/h.csv", "--digital", d + "/dl.json",
                 "--inventory", d + "/inventory.json", "--out", d + "/pm"], spark) == 0
    rows = spark.read.option("header", True).csv(d + "/pm").collect()
    assert [(r.inventory_number, r.holdings_id, r.inventory_record_id, r.digital_record_id) for r in rows] == [
        ("M10", "h1", "7", "5")]
    _write(d + "/tapes.csv", "Legacy Path,x\nHFA27M_Reel,1\nXFE4098M_XFF104M_Final,2\nnone,3\n")
    assert main(["extract-codes", "--sheet", d + "/tapes.csv", "--out", d + "/codes"], spark) == 0
    got = sorted(r["Inventory Number [EXTRACTED]"] or "" for r in
                 spark.read.option("header", True).csv(d + "/codes").collect())
    assert got == ["", "HFA27M", "XFE4098M|XFF104M"]


def test_cli_match_report_and_duplicates(spark, tmp_path):
    d = str(tmp_path)
    _write(d + "/h.csv", "MMS Id,Holding Id,Permanent Call Number\n1,h1,M 10\n2,h2,M10\n3,h3,M12\n")
    _write(d + "/inventory.json", json.dumps([{"inventory_id": 7, "inventory_no": "m10"},
                                       {"inventory_id": 8, "inventory_no": "M13"},
                                       {"inventory_id": 9, "inventory_no": "M13"}]))
    _write(d + "/sheet.csv", "Legacy Path,Inventory Number [EXTRACTED]\n/a,M10\n/b,M13\n/a,M12|M13\n")
    assert main(["match-report", "--holdings", d + "/h.csv", "--inventory", d + "/inventory.json",
                 "--sheet", d + "/sheet.csv", "--out", d + "/report"], spark) == 0
    rep = spark.read.option("header", True).csv(d + "/report")
    sections = {r.section.split(")")[0] for r in rep.select("section").distinct().collect()}
    assert sections == {"S4", "S1", "M2"}
    assert main(["duplicates", "--sheet", d + "/sheet.csv", "--out", d + "/dups"], spark) == 0
    assert spark.read.option("header", True).csv(d + "/dups").count() == 2


def test_cli_validate_standardise_files_xml(spark, tmp_path):
    d = str(tmp_path)
    recs = [{"inventory_id": 1, "inventory_no": "M1", "digital_record": "0", "production_type": "TELEVISION SERIES",
             "Language": "", "record_date": "ca. 1950", "user_last_modified": "u", "date_modified": "2024-01-02"},
            {"inventory_id": 2, "inventory_no": "M2", "digital_record": "0", "production_type": "SHORT",
             "Language": "English", "record_date": "1999", "user_last_modified": "u", "date_modified": "2024-03-02"}]
    _write(d + "/recs.json", json.dumps(recs))
    assert main(["validate", "--records", d + "/recs.json", "--layout", "InventoryForLabeling_API",
                 "--modified-column", "date_modified", "--start", "2024-01-01", "--end", "2024-01-31",
                 "--out", d + "/v"], spark) == 0
    v = spark.read.option("header", True).csv(d + "/v/InventoryForLabeling_API")
    assert sorted(r.field for r in v.collect()) == ["Language", "episode no.", "episode_title"]
    assert main(["standardise", "--records", d + "/recs.json", "--fields", "record_date,Language",
                 "--as-of-year", "2026", "--out", d + "/c"], spark) == 0
    c = spark.read.parquet(d + "/c")
    assert sorted((r.inventory_id, r.field, r.new_value) for r in c.collect()) == [
        (1, "Language", "Undetermined"), (1, "record_date", "1950?")]
    _write(d + "/lists/a.txt", "/vol/x/a.mov\n/vol/x/meta.json\n/vol/y/b.MP4\n")
    _write(d + "/meta/m.json", json.dumps({"media": {"assets": [{"uuid": "u1", "file_name": "a.mov"},
                                                                {"uuid": "u2", "file_name": ""}]}}))
    assert main(["filename-mismatches", "--file-lists", d + "/lists", "--metadata", d + "/meta",
                 "--out", d + "/fn"], spark) == 0
    fn = spark.read.option("header", True).csv(d + "/fn")
    assert sorted((r.section, r.filename) for r in fn.collect()) == [
        ("file_lists_not_metadata", "b.MP4"), ("metadata_not_file_lists", "NO FILE NAME (u2)")]
    _write(d + "/xml/a.xml", "<doc><row><a>x</a></row><row><a>y</a></row></doc>")
    assert main(["xml-to-json", "--input", d + "/xml", "--row-tag", "row", "--out", d + "/js"], spark) == 0
    assert sorted(r.a for r in spark.read.json(d + "/js/malformed=false").collect()) == ["x", "y"]


def test_monographs_and_match_problems(spark, tmp_path):
    from test_io import MARCXML
    d = str(tmp_path)
    _write(d + "/bibs.xml", MARCXML)
    _write(d + "/h.csv", "MMS Id,Holding Id,Permanent Call Number\n9911,1,M1\n9912,2,M2\n404,3,M3\n")
    _write(d + "/inv.csv", "M1,SHORT\nM1,FEATURES\nM2,SHORT\nM3,SHORT\n")
    assert main(["monographs", "--holdings", d + "/h.csv", "--inventory", d + "/inv.csv", "--bibs", d + "/bibs.xml",
                 "--out", d + "/mono"], spark) == 0
    rows = spark.read.option("header", True).csv(d + "/mono").collect()
    assert ("404", "true") in [(r.mms_id, r.bib_missing) for r in rows]
    _write(d + "/dl_20250101_120000.json", json.dumps([{"model": "m", "pk": 5, "fields": {
        "inventory_number": "M1", "row_ordinal": 1}}]))
    _write(d + "/inventory_20250101_120000.json", json.dumps([
        {"inventory_id": 7, "inventory_no": "M1", "title": "Lost reel", "episode_title": "Two"}]))
    _write(d + "/lang.xml", "<c><language><name>English</name><code>eng</code></language></c>")
    args = ["match-problems", "--holdings", d + "/h.csv", "--digital", d + "/dl_20250101_120000.json", "--inventory",
            d + "/inventory_20250101_120000.json", "--bibs", d + "/bibs.xml", "--language-codes", d + "/lang.xml",
            "--out", d + "/problems", "--as-of"]
    assert main([*args, "2025-01-02 00:00:00"], spark) == 0
    row = spark.read.option("header", True).csv(d + "/problems").first()
    assert (row.bib_id, row.inventory_title, row.bib_title) == ("9911", "Lost reel. Two", "lost reel, The")
    with pytest.raises(SystemExit):
        main([*args, "2025-03-01 00:00:00"], spark)
