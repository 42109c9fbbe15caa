"""MARC checks on records built in the test (the reference's cases for
titles, language, dates and attribution, plus criteria and monographs)."""

from pyspark.sql import functions as F

from kardex.functions import marc as MC

SCHEMA = ("controlfield array<struct<_tag:string,_VALUE:string>>, "
          "datafield array<struct<_tag:string,_ind1:string,_ind2:string,"
          "subfield:array<struct<_code:string,_VALUE:string>>>>")


def rec(control=None, fields=None):
    cf = [{"_tag": t, "_VALUE": v} for t, v in (control or {}).items()]
    dfs = [{"_tag": t, "_ind1": "1", "_ind2": ind2, "subfield": [{"_code": c, "_VALUE": v} for c, v in subs]}
           for t, ind2, subs in (fields or [])]
    return (cf, dfs)


def _df(spark, recs):
    return spark.createDataFrame(recs, SCHEMA)


PARTS = [("b", "Remainder of title"), ("n", "Number of part"), ("p", "Name of part")]


def test_titles(spark):
    cases = [
        (rec(fields=[("245", "4", [("a", "The main title")] + PARTS)]),
         "main title, The. Remainder of title. Number of part. Name of part", False),
        (rec(fields=[("245", "2", [("a", "A main title")] + PARTS)]),
         "main title, A. Remainder of title. Number of part. Name of part", False),
        (rec(fields=[("245", "3", [("a", "An main title")] + PARTS)]),
         "main title, An. Remainder of title. Number of part. Name of part", False),
        (rec(fields=[("245", "0", [("a", "Main title")] + PARTS)]),
         "Main title. Remainder of title. Number of part. Name of part", False),
        (rec(fields=[("245", "2", [("a", "The main title")] + PARTS)]),
         "main title, The. Remainder of title. Number of part. Name of part", True),
        (rec(fields=[("245", "3", [("a", "La main title")] + PARTS)]),
         "main title, La. Remainder of title. Number of part. Name of part", False),
        (rec(fields=[]), "", False),
    ] + [(rec(fields=[("245", bad, [("a", "The main title")] + PARTS)]),
          "main title, The. Remainder of title. Number of part. Name of part", True)
         for bad in ["X", "_", "", "0"]]
    df = _df(spark, [r for r, _, _ in cases])
    t = MC.bib_title()
    got = [(r.t, r.c) for r in df.select(t["title"].alias("t"), t["check_ind2"].alias("c")).collect()]
    assert got == [(e, f) for _, e, f in cases]


def test_language_date_attribution(spark):
    recs = [
        rec(control={"001": "1"}),
        rec(control={"001": "2", "008": "850101s1995"}),
        rec(control={"001": "3", "008": " " * 40}),
        rec(control={"001": "4", "008": "x" * 35 + "   " + "xx"}),
        rec(control={"001": "5", "008": "x" * 35 + "zzz" + "xx"}),
        rec(control={"001": "6", "008": "x" * 35 + "eng" + "xx"},
            fields=[("260", " ", [("c", "1999")]), ("245", "0", [("a", "T"), ("c", "Directed by X")])]),
        rec(control={"001": "7"}, fields=[("264", " ", [("c", "c2001")]), ("245", "0", [("c", "produced by Y")])]),
        rec(control={"001": "8"}, fields=[("260", " ", [("c", " ")]), ("245", "0", [("a", "T")])]),
    ]
    codes = spark.createDataFrame([("eng",), ("fre",)], "code string")
    from kardex.operators.lookups import valid_code_check
    df = valid_code_check(_df(spark, recs).withColumn("lc", MC.language_code()), "lc", codes)
    got = {r.id: (r.no008, r.lang, r.nodate, r.lacks) for r in df.select(
        MC.bib_id().alias("id"), MC.no_008().alias("no008"), MC.invalid_language(F.col("code_valid")).alias("lang"),
        MC.no_26x_date().alias("nodate"), MC.lacks_attribution().alias("lacks")).collect()}
    assert got == {
        "1": ("Yes", "", "Yes", "Yes"),
        "2": ("", "TOO SHORT", "Yes", "Yes"),
        "3": ("", "BLANK", "Yes", "Yes"),
        "4": ("", "BLANK", "Yes", "Yes"),
        "5": ("", "zzz", "Yes", "Yes"),
        "6": ("", "", "", ""),
        "7": ("Yes", "", "", "Yes"),
        "8": ("Yes", "", "Yes", "Yes"),
    }


def test_director_names_and_criteria(spark):
    recs = [
        rec(control={"001": "1", "008": "x" * 35 + "eng"},
            fields=[("245", "0", [("a", "Film"), ("c", "directed by Ann Lee and Bob Ray ; technical director Z")])]),
        rec(control={"001": "2", "008": "x" * 35 + "fre"},
            fields=[("245", "0", [("a", "Film"), ("c", "a film by John Smith")]), ("250", " ", [("a", "2nd")])]),
        rec(control={"001": "3"}, fields=[("245", "0", [("a", "Film"), ("c", "produced by Q")])]),
    ]
    mentions = [
        [("Ann Lee", "PERSON"), ("Bob Ray", "PERSON"), ("Z", "PERSON")],
        [("John Smith", "PERSON"), ("Jr.", "PERSON"), ("Acme", "ORG")],
        [("Q", "PERSON")],
    ]
    df = spark.createDataFrame([r + (m,) for r, m in zip(recs, mentions)],
                               SCHEMA + ", mentions array<struct<text:string,label:string>>")
    f = df.select(F.struct(*MC.bib_features("mentions")).alias("features"))
    got = [(r.id, r.d, r.c, r.all) for r in f.select(
        F.col("features.bib_id").alias("id"), F.col("features.directors.f245c").alias("d"),
        MC.first_criterion("features").alias("c"),
        F.array_join(MC.all_criteria("features"), ",").alias("all")).collect()]
    assert got == [("1", ["Ann Lee", "Bob Ray"], "6.4", "6.4"),
                   ("2", ["John Smith"], "6.2", "6.2"),
                   ("3", [], "6.7", "6.7")]


def test_fix_name_suffix_and_spans(spark):
    df = spark.createDataFrame([(["Sam Doe", "Jr."], "Directed by Sam Doe, Jr."), (["A", "B"], "A and B")],
                               "names array<string>, text string")
    out = df.select(MC.fix_name_suffix(F.col("names")).alias("n"),
                    MC.span_annotations(F.col("text"), F.array(F.lit("Sam Doe"), F.lit("Nobody"))).alias("s")).collect()
    assert out[0].n == ["Sam Doe, Jr."] and out[1].n == ["A", "B"]
    assert [(x.start, x.end) for x in out[0].s] == [(12, 19), (-1, 5)]


def test_monograph_rules(spark):
    recs = [
        rec(fields=[("245", "0", [("a", "T")]), ("655", " ", [("a", "Shorts.")]), ("655", " ", [("a", "Features")])]),
        rec(fields=[("245", "0", [("a", "T"), ("p", "Part")])]),
        rec(fields=[("245", "0", [("a", "T")]), ("655", " ", [("a", "Anthologies")]), ("655", " ", [("a", "Short films")])]),
        rec(fields=[("245", "0", [("a", "T")]), ("655", " ", [("a", "Student films and video"), ("2", "local")]),
                    ("655", " ", [("a", "Student films and video")])]),
    ]
    df = _df(spark, recs).withColumn("i", F.monotonically_increasing_id())
    got = [(r.nm, r.forms) for r in df.orderBy("i").select(MC.non_monograph_bib().alias("nm"),
                                                           MC.bib_forms().alias("forms")).collect()]
    assert got == [(False, ["Shorts", "Feature films"]), (True, []), (True, []), (False, ["Student films"])]
    types = spark.createDataFrame([("TELEVISION SERIES",), ("Short\rFeature Film",), ("",)], "t string")
    got = [(r.nm, r.forms) for r in types.select(MC.non_monograph_type(F.col("t")).alias("nm"),
                                                 MC.inventory_forms(F.col("t")).alias("forms")).collect()]
    assert got == [(True, []), (False, ["Feature films", "Shorts"]), (False, [])]
    cmp = spark.range(1).select(MC.compare_forms(F.array(F.lit("b"), F.lit("a")),
                                                 F.array(F.lit("a"), F.lit("c"))).alias("c")).first().c
    assert (cmp.common, cmp.unique_bib, cmp.unique_inventory) == (["a"], ["b"], ["c"])


def test_pick_fields_and_replace_subfield(spark):
    from kardex.operators.changes import call_number_changes, compact_call_number, marc_replace_subfield
    r = rec(control={"001": "1", "005": "x", "008": "y"},
            fields=[("245", "0", [("a", "T")]), ("500", " ", [("a", "note")]), ("655", " ", [("a", "Shorts")])])
    df = _df(spark, [r])
    picked = df.select(MC.pick_fields(["001", "008", "245", "246", "260", "655"]).alias("p")).first().p
    assert [c._tag for c in picked.controlfield] == ["001", "008"]
    assert [f._tag for f in picked.datafield] == ["245", "655"]
    f852 = F.struct(F.lit("852").alias("_tag"), F.lit("0").alias("_ind1"), F.lit(" ").alias("_ind2"),
                    F.array(*[F.struct(F.lit(c).alias("_code"), F.lit(v).alias("_VALUE"))
                              for c, v in [("b", "x"), ("h", "FE1605 T"), ("h", "second")]]).alias("subfield"))
    out = spark.range(1).select(marc_replace_subfield(f852, "h", compact_call_number(F.lit("FE1605 T"))).alias("f")).first().f
    assert [(s._code, s._VALUE) for s in out.subfield] == [("b", "x"), ("h", "FE1605T"), ("h", "second")]
    hold = spark.range(1).select(F.lit("h1").alias("holding_id"),
                                 F.struct(F.array().cast("array<struct<_tag:string,_VALUE:string>>").alias("controlfield"),
                                          F.array(f852).alias("datafield")).alias("record"))
    plan = call_number_changes(hold, spark.createDataFrame([("h1",), ("h2",)], "holding_id string")).collect()
    assert sorted((p.holding_id, p.old_value, p.new_value, p.status) for p in plan) == [
        ("h1", "FE1605 T", "FE1605T", "change"), ("h2", None, None, "no record")]
