"""Sources and sinks: write to a scratch folder, read back, compare."""

import json
import os

from pyspark.sql import functions as F

from kardex.formats import CSV_READ
from kardex.functions import marc as MC
from kardex.sinks import writers as W
from kardex.sources import readers as R

MARCXML = """<?xml version="1.0" encoding="UTF-8"?>
<collection>
<record>
  <leader>00000cgm a2200000 a 4500</leader>
  <controlfield tag="001">9911</controlfield>
  <controlfield tag="008">850101s1995    xx            000 0 eng d</controlfield>
  <datafield tag="245" ind1="1" ind2="4">
    <subfield code="a">The lost reel /</subfield>
    <subfield code="c">directed by Ann Lee.</subfield>
  </datafield>
  <datafield tag="260" ind1=" " ind2=" "><subfield code="c">1995</subfield></datafield>
  <datafield tag="655" ind1=" " ind2="7"><subfield code="a">Shorts.</subfield></datafield>
</record>
<record>
  <leader>00000cgm a2200000 a 4500</leader>
  <controlfield tag="001">9912</controlfield>
  <datafield tag="245" ind1="0" ind2="0">
    <subfield code="a">A night out</subfield>
    <subfield code="p">Part one</subfield>
  </datafield>
</record>
</collection>
"""


def _write(path, text, mode="w", encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, encoding=encoding) as f:
        f.write(text)


def test_holdings_csv_with_bom(spark, tmp_path):
    p = str(tmp_path / "h.csv")
    _write(p, "﻿MMS Id,Holding Id,Permanent Call Number\r\n99,22,FE1605 T\r\n98,23,M28479\r\n")
    df = R.read_holdings(spark, p)
    assert df.columns == ["MMS Id", "Holding Id", "Permanent Call Number"]
    assert sorted(r[2] for r in df.collect()) == ["FE1605 T", "M28479"]


def test_fixture_and_assets_json(spark, tmp_path):
    fx = str(tmp_path / "fx.json")
    _write(fx, json.dumps([{"model": "m", "pk": 1, "fields": {"inventory_number": "M1", "file_name": "a.mov"}},
                           {"model": "m", "pk": 2, "fields": {"inventory_number": "M2", "file_name": ""}}]))
    df = R.read_fixture_json(spark, fx, multi_line=True)
    assert sorted(df.columns) == ["file_name", "inventory_number", "pk"]
    docs = str(tmp_path / "docs")
    _write(docs + "/a.json", json.dumps({"media": {"assets": [{"uuid": "u1", "file_name": "x.mov"},
                                                              {"uuid": "u2", "file_name": ""}]}}))
    _write(docs + "/b.json", json.dumps({"media": {"assets": [{"uuid": "u3", "file_name": "y.MP4"}]}}))
    a = R.read_assets(spark, docs)
    assert sorted(r.uuid for r in a.collect()) == ["u1", "u2", "u3"]


def test_path_lists_and_headerless(spark, tmp_path):
    p = str(tmp_path / "list.txt")
    _write(p, "  /a/b/c.mov \n/a/.hidden\n/x/y.json\n")
    paths = R.read_path_lists(spark, p)
    assert [r.path for r in paths.collect()] == ["/a/b/c.mov", "/a/.hidden", "/x/y.json"]
    c = str(tmp_path / "inventory_types.csv")
    _write(c, "inventory_no,production_type\nM1,SHORT\n")
    df = R.read_headerless_csv(spark, c, ["inventory_no", "production_type"])
    assert df.count() == 2  # the header line is data, as in the reference


def test_marcxml_source_and_checks(spark, tmp_path):
    p = str(tmp_path / "bibs.xml")
    _write(p, MARCXML)
    bibs = R.read_marc(spark, p)
    t = MC.bib_title()
    rows = {r.id: r for r in bibs.select(MC.bib_id().alias("id"), MC.no_008().alias("no008"),
                                          MC.no_26x_date().alias("nodate"), MC.lacks_attribution().alias("lacks"),
                                          t["title"].alias("title"), t["check_ind2"].alias("chk"),
                                          MC.non_monograph_bib().alias("nonmono"),
                                          MC.bib_forms().alias("forms")).collect()}
    assert rows["9911"].no008 == "" and rows["9912"].no008 == "Yes"
    assert rows["9911"].nodate == "" and rows["9912"].nodate == "Yes"
    assert rows["9911"].lacks == "" and rows["9912"].lacks == "Yes"
    assert rows["9911"].title == "lost reel, The" and rows["9911"].chk is False
    assert rows["9912"].title == "night out, A. Part one" and rows["9912"].chk is True
    assert rows["9912"].nonmono is True and rows["9911"].nonmono is False
    assert rows["9911"].forms == ["Shorts"]


def test_language_codes_both_forms(spark, tmp_path):
    p = str(tmp_path / "lang.xml")
    _write(p, """<codelist><languages>
      <language><uri>u1</uri><name authorized="yes">Abkhaz</name><code>abk</code></language>
      <language><uri>u2</uri><name>Afar</name><code status="current">aar</code></language>
      <language><uri>u3</uri><name>Abkhazian</name><code>abk</code></language>
    </languages></codelist>""")
    df = R.read_language_codes(spark, p)
    assert [(r.code, r.name) for r in df.collect()] == [("aar", "Afar"), ("abk", "Abkhazian")]


def test_export_stamps(spark, tmp_path):
    d = str(tmp_path / "exp")
    _write(d + "/digital_20250101_120000.json", json.dumps([{"a": 1}]))
    _write(d + "/inventory_20250102_080000.json", json.dumps([{"a": 2}]))
    assert R.export_is_recent(spark, [d], "2025-01-02 12:00:00") is True
    assert R.export_is_recent(spark, [d], "2025-01-03 12:00:01") is False


def test_report_csv_empty_and_sections(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, b string")
    assert W.write_report_csv(empty, str(tmp_path / "none")) is False
    assert not os.path.exists(str(tmp_path / "none"))
    df = spark.createDataFrame([("S1", "M1", "x"), ("S2", "M2", "y")], "section string, k string, extra string")
    assert W.write_report_csv(df, str(tmp_path / "r"), ["section", "k"]) is True
    back = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert back.columns == ["section", "k"] and back.count() == 2
    out = str(tmp_path / "sections")
    W.write_sectioned_report(df, out)
    W.write_sectioned_report(spark.createDataFrame([("S1", "M9", "z")], df.schema), out)
    got = spark.read.option("header", True).csv(out)
    assert [(r.section, r.k) for r in got.collect()] == [("S1", "M9")]  # S2 is gone with its rows


def test_xml_rows_round_trip_and_xml_to_json(spark, tmp_path):
    df = spark.createDataFrame([("1", "M1", None), ("2", "M2", "t")], "inventory_id string, Inventory_no string, title string")
    out = str(tmp_path / "xml")
    W.write_xml_rows(df, out)
    back = R.read_xml_rows(spark, out, "MediaResource")
    assert back.count() == 2
    src = str(tmp_path / "in")
    _write(src + "/good.xml", "<doc><row><a> x </a><b>1</b><b>2</b></row></doc>")
    _write(src + "/bad.xml", "<doc><row><a>oops</row></doc>")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.StringType()))])
    errors = W.xml_to_json(spark, src, str(tmp_path / "json"), "row", schema)
    good = spark.read.json(str(tmp_path / "json" / "malformed=false"))
    assert [r.a for r in good.filter(F.col("a").isNotNull()).collect()] == ["x"]
    assert errors.count() >= 1 and set(errors.columns) == {"source_file", "_corrupt_record"}
    assert [f.name for f in schema.fields] == ["a", "b"]  # the caller's schema is left alone
    W.xml_to_json(spark, src, str(tmp_path / "json"), "row", schema)


def test_xml_rows_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    texts = [f"é {i} <&> </Row>" if i % 3 else None for i in range(3000)]
    df = spark.createDataFrame([(i, texts[i], [f"a{i}", "b"][:i % 3]) for i in range(3000)], "id long, title string, tags array<string>")
    out = str(tmp_path / "xml")
    df.coalesce(1).write.format("xml").option("rootTag", "Rows").option("rowTag", "Row").save(out)
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("10007", "20k", most):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            cut = R.read_xml_rows(spark, out, "Row", df.schema, cut=True)
            assert cut.columns == df.columns and (size == most or cut.rdd.getNumPartitions() >= 10)
            assert sorted(map(str, cut.collect())) == sorted(map(str, R.read_xml_rows(spark, out, "Row", df.schema).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert {r.id: r.title for r in cut.collect()} == dict(enumerate(texts))


def test_one_malformed_record_leaves_the_others(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [f"  <row k='{i}'><a> t{i} </a>" + ("</row>" if i != 3 else "") for i in range(8)]
    rows[5] = "<row k='5'/>"
    rows[6] = "<row k='none'><a>x</a></row>"
    _write(src + "/a.xml", "<?xml version='1.0'?>\n<doc>\n" + "\n".join(rows) + "<rows>not one</rows>\n</doc>\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("_k", T.IntegerType()), T.StructField("a", T.StringType())])
    got = R.read_xml_records(spark, src, "row", schema).collect()
    assert sorted((r._k, r.a) for r in got if r._corrupt_record is None) == [
        (0, "t0"), (1, "t1"), (2, "t2"), (4, "t4"), (5, None), (7, "t7")]
    assert sorted(r._corrupt_record.strip()[:14] for r in got if r._corrupt_record) == ["<row k='3'><a>", "<row k='none'>"]
    errors = W.xml_to_json(spark, src, str(tmp_path / "json"), "row", schema)
    assert errors.count() == 2 and spark.read.json(str(tmp_path / "json" / "malformed=false")).count() == 6


def test_write_if_valid(spark, tmp_path):
    assets = spark.createDataFrame([("u1", "asset")], "uuid string, record_type string")
    problems = spark.createDataFrame([("u1", "bad")], "uuid string, problem string")
    assert W.write_if_valid(assets, problems, str(tmp_path / "a")) is not None
    assert not os.path.exists(str(tmp_path / "a"))
    assert W.write_if_valid(assets, problems.limit(0), str(tmp_path / "b")) is None
    assert spark.read.json(str(tmp_path / "b")).count() == 1


def test_tsv_single_document_and_nested_xml(spark, tmp_path):
    df = spark.createDataFrame([("1", ["a", "b"], {"x": 1})], "id string, names array<string>, m map<string,int>")
    W.write_tsv(df, str(tmp_path / "tsv"))
    back = spark.read.options(**CSV_READ).option("header", True).option("sep", "\t").csv(str(tmp_path / "tsv")).first()
    assert (back.id, back.names, back.m) == ("1", "a, b", '{"x":1}')
    assets = spark.createDataFrame([("u1", "asset"), ("u2", "track")], "uuid string, record_type string")
    W.write_asset_docs(assets, str(tmp_path / "doc"), per_document=1000)
    doc = spark.read.json(str(tmp_path / "doc")).first()
    assert sorted(a.uuid for a in doc.media.assets) == ["u1", "u2"]
    many = spark.range(500).selectExpr("CAST(id AS STRING) AS uuid")
    W.write_asset_docs(many, str(tmp_path / "docs"), per_document=20)
    docs = spark.read.json(str(tmp_path / "docs"))
    assert docs.count() > 10 and R.read_assets(spark, str(tmp_path / "docs")).count() == 500
    equal = spark.range(0, 5000, numPartitions=3).selectExpr("'u' AS uuid")
    W.write_asset_docs(equal, str(tmp_path / "equal"), per_document=40)
    sizes = [len(r.media.assets) for r in spark.read.json(str(tmp_path / "equal")).collect()]
    assert sorted(sizes) == [40] * 125
    from kardex.operators.lookups import match_resources, nested_parts
    rows = spark.createDataFrame([(1, "M1"), (2, "M2"), (3, ""), (4, "M1")], "inventory_id int, inventory_no string")
    res = spark.createDataFrame([("M1", "r1", 2), ("M1", "r2", 1), ("M2", "r3", 3), ("M9", "r4", 4)],
                                "Inventory_no string, title string, row_ordinal int")
    row_matches, key_res = match_resources(rows, res)
    assert sorted((r.inventory_id, r.resources) for r in row_matches.collect()) == [(1, 2), (2, 1), (4, 2)]
    assert sorted((r.title, r.inventory_rows) for r in key_res.collect()) == [("r1", 2), ("r2", 2), ("r3", 1)]
    parts = nested_parts(rows, res, ["title"])
    got = {r.inventory_no: (r.rows, [(m.inventory_id, m.title) for m in r.matched_resources]) for r in parts.collect()}
    assert got == {"M1": ([1, 4], [(None, "r1"), (None, "r2")]), "M2": ([2], [(2, "r3")])}
    hot = spark.range(2500).selectExpr("'M2' AS Inventory_no", "CAST(id AS STRING) AS title", "1 AS row_ordinal")
    many = nested_parts(rows, hot, ["title"]).collect()
    assert sorted(len(r.matched_resources) for r in many) == [500, 1000, 1000]
    equal = spark.range(5000).selectExpr("'M2' AS Inventory_no", "'same' AS title", "1 AS row_ordinal")
    assert [len(r.matched_resources) for r in nested_parts(rows, equal, ["title"]).collect()] == [1000] * 5
    W.write_nested_xml(parts, str(tmp_path / "nx"))
    back = R.read_xml_rows(spark, str(tmp_path / "nx"), "ROW")
    assert back.count() == 2


def test_csv_cells_survive(spark, tmp_path):
    rows = [("SHORT\rNEWS", "  lead trail  ", 'say "hi", ok'), ("back\\slash", "", None), (None, "b\\", "é\t"),
            ("", '"q"', 'ends\\"'), ("\r", "a,b", "tail\r ")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert W.write_report_csv(df, str(tmp_path / "r"))
    assert sorted(map(str, R.read_holdings(spark, str(tmp_path / "r")).collect())) == sorted(map(str, df.collect()))
    crlf = tmp_path / "crlf.csv"
    crlf.write_bytes("\ufeffId,Kind,No\r\n1,\"a\rb\",\"FE1 T\"\r\n2,,M2\r\n".encode())
    back = R.read_holdings(spark, str(crlf))
    assert back.columns == ["Id", "Kind", "No"]
    assert sorted(map(tuple, back.collect()), key=str) == [("1", "a\rb", "FE1 T"), ("2", None, "M2")]
    lines = tmp_path / "lines.csv"
    lines.write_text('a,b\n"x\ny",1\n')
    assert R.read_holdings(spark, str(lines), multi_line=True).collect()[0].a == "x\ny"
