"""Operator unit tests on small fixtures (the reference's example-based
cases, re-expressed as DataFrames)."""

from pyspark.sql import functions as F

from kardex.operators import keys as K
from kardex.operators import lookups as LK
from kardex.operators import matching as M
from kardex.operators.changes import compact_call_number

CODE_CASES = [
    ("HFA27M_Reel", "HFA27M"),
    ("VA13161T_KTLA", "VA13161T"),
    ("M190816Medea2", "M190816"),
    ("DVD13360_HouseOfCats_FromDVD_SD_2997FPS_VOB", "DVD13360"),
    ("GeraldMcBoingBoingShow_T119482_DerTeamfromZwisendorpff", "T119482"),
    ("XFE1915MX", "XFE1915"),
    ("Randy_Requiem1", ""),
    ("XFE4098M_XFF104M_DamagedLives_Finals", "XFE4098M|XFF104M"),
    ("XVE779T_ZVE780T_OneNightStand_WorldOfLennyBruce_CaptureFiles_SD_2997FPS_YUV", "XVE779T"),
    ("Max_From_DVD_H264", ""),
    ("HARVEST3000AUDIOMAG", ""),
    ("M46293SanFernandoCLEANEXPORT3", "M46293"),
    (r"AAC424\T70123_50Years_Kids_Programming\T70123_50Years_T1", "T70123"),
    (r"AAC442\Title_T01ASYNC_Surround", ""),
]


def test_extract_codes(spark):
    df = spark.createDataFrame(CODE_CASES + [(None, None)], "v string, expected string")
    got = df.select("v", "expected", LK.extract_codes("v").alias("got")).collect()
    assert [(r.v, r.got) for r in got if r.got != r.expected] == []


def test_compact_call_number(spark):
    cases = [("FE1605 T", "FE1605T"), ("VA19633 M", "VA19633M"), ("XFE1014 M", "XFE1014M"),
             ("M28479", "M28479"), ("VA11724 -725 T", "VA11724 -725 T"), ("M1 and M2 R", "M1 and M2 R"),
             (" T", "T"), ("X R", "XR")]
    df = spark.createDataFrame(cases, "v string, e string")
    got = df.select("e", compact_call_number("v").alias("g")).collect()
    assert all(r.e == r.g for r in got)


def test_singletons_and_repeats(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "y"), ("A", "z"), ("C", "w")], "inventory_number string, other string")
    assert sorted(r.key for r in K.singletons(df, "inventory_number").collect()) == ["B", "C"]
    assert [r.key for r in K.repeats(df, "inventory_number").collect()] == ["A"]


def test_duplicate_rows_and_keep_first(spark):
    rows = [(0, "/a", 1), (1, "/b", 2), (2, "/a", 3), (3, "/c", 4), (4, None, 5), (5, None, 6)]
    df = spark.createDataFrame(rows, "row_index int, `Legacy Path` string, other int")
    dup = K.duplicate_rows(df, F.col("`Legacy Path`"), "row_index")
    got = sorted((r.row_index, r.original_row_number) for r in dup.collect())
    assert got == [(0, 2), (2, 4), (4, 6), (5, 7)]  # nulls group together
    first = K.keep_first(df, F.col("`Legacy Path`"), "row_index")
    assert sorted(r.row_index for r in first.collect()) == [0, 1, 3, 4]
    none = K.duplicate_rows(df.filter("row_index in (0, 1)"), F.col("`Legacy Path`"), "row_index")
    assert none.count() == 0


def _assets(spark, rows):
    return spark.createDataFrame(rows, "uuid string, inventory_numbers array<string>, match_asset string, "
                                       "record_type string, row_ordinal int")


def test_validate_links(spark):
    base = [("12345", ["INV001"], None, "asset", 0), ("67890", ["INV002"], None, "asset", 1)]
    ok = _assets(spark, base + [("09876", ["INV001"], "12345", "track", 2)])
    assert LK.validate_links(ok).count() == 0
    missing = _assets(spark, base + [("09876", ["INV001"], "34567", "track", 2)])
    assert [r.problem for r in LK.validate_links(missing).collect()] == [
        "Match asset 34567 for record 09876 not found in batch."]
    differ = _assets(spark, base + [("09876", ["INV003"], "12345", "track", 2)])
    assert [r.problem for r in LK.validate_links(differ).collect()] == [
        "Inventory numbers do not match for match_asset relationship: "
        "track 09876: 'INV003', asset 12345: 'INV001'"]
    assert LK.validate_links(differ, check_keys=False).count() == 0
    blank = _assets(spark, base + [("09876", ["INV001"], "", "asset", 2)])
    assert LK.validate_links(blank).count() == 0
    counts = LK.count_by_type(differ).first()
    assert (counts.assets, counts.tracks) == (2, 1)


def _counts(spark):
    # key -> (holdings ids, inventory ids); covers every class.
    data = {
        "S1": (0, 2), "S2": (2, 0), "S3": (1, 3), "S4": (2, 1), "S5": (2, 2), "S6": (0, 0),
        "L1": (1, 0), "L2": (0, 1), "L3": (1, 1),
    }
    ids = []
    for k, (h, f) in data.items():
        ids += [(k, "holdings", f"h{k}{i}") for i in range(h)]
        ids += [(k, "inventory", f"i{k}{i}") for i in range(f)]
    ids = spark.createDataFrame(ids, "key string, source string, id string")
    return ids, M.source_counts(ids)


def test_classify_single_values(spark):
    ids, counts = _counts(spark)
    vals = spark.createDataFrame([(k,) for k in ["S1", "S2", "S3", "S4", "S5", "S6", "L1", "L2", "L3"]], "value string")
    got = {r.inventory_number: r.section for r in M.classify_single_values(vals, counts).collect()}
    assert got == {"S1": "S1", "S2": "S2", "S3": "S3", "S4": "S4", "S5": "S5", "S6": "S6",
                   "L1": "leftover", "L2": "leftover", "L3": "leftover"}
    long = M.attach_ids(M.classify_single_values(vals, counts), ids)
    assert long.filter("inventory_number = 'S3'").count() == 4
    assert long.filter("inventory_number = 'S6'").first().record_id is None


def test_classify_compound_values(spark):
    _, counts = _counts(spark)
    vals = spark.createDataFrame([("L1|L2",), ("L1|S1",), ("S2|L3|S6",), ("S6|L1",), ("L2|L1",)], "value string")
    out = M.classify_compound_values(vals, counts)
    got = sorted((r.section, r.inventory_number, r.original_value) for r in out.collect())
    assert got == [
        ("M1", "L1", "L1|L2"), ("M1", "L2", "L1|L2"),      # every part total 1 (dedupe keeps min value)
        ("M2", "S1", "L1|S1"), ("M2", "S2", "S2|L3|S6"),    # only multi parts are emitted
        ("leftover", "L1", "S6|L1"), ("leftover", "S6", "S6|L1"),
    ]
    before = M.classify_compound_values(vals, counts, dedupe=False)
    assert before.filter("section = 'M1'").count() == 4


def test_perfect_matches(spark):
    h = spark.createDataFrame([("1", "h1", "M 1"), ("2", "h2", "m2"), ("3", "h3", "M3"), ("4", "h4", "M 3")],
                              "mms_id string, holding_id string, call_number string")
    i = spark.createDataFrame([(10, "m1 ", "T1"), (11, "M2", "T2"), (12, "M4", "T4")],
                              "inventory_id int, inventory_no string, title string")
    d = spark.createDataFrame([(100, "M1"), (101, "M2"), (102, "M2"), (103, "M3")], "pk int, inventory_number string")
    out = M.perfect_matches(h, d, i).collect()
    assert [(r.inventory_number, r.holdings_id, r.inventory_record_id, r.digital_record_id, r.inventory_title) for r in out] == [
        ("M1", "h1", "10", "100", "T1")]


def test_unique_variant_match(spark):
    h = spark.createDataFrame([("h1", "DVD10"), ("h2", "DVD11 T"), ("h3", "DVD11"), ("h4", "M12")],
                              "holding_id string, call_number string")
    i = spark.createDataFrame([(1, "DVD10 M"), (2, "DVD11 T"), (3, "M12 T")], "inventory_id int, inventory_no string")
    d = spark.createDataFrame([(7, " DVD10 M ", 0), (8, "DVD10 M", 1), (9, "DVD11 T", 2), (10, "M12 T", 3)],
                              "pk int, inventory_number string, row_ordinal int")
    got = sorted((r.match_key, r.pk, r.holding_id, r.inventory_id) for r in M.unique_variant_match(d, i, h).collect())
    # DVD11 T is indexed twice in holdings (value and variant) -> ambiguous; M is not a variant prefix.
    assert got == [("DVD10 M", 7, "h1", 1)]


def test_first_suffix_match(spark):
    keys = spark.createDataFrame([("M1",), ("M2",), ("M3",)], "key string")
    idx = spark.createDataFrame([("M1R", "b9"), ("M1T", "b8"), ("M2", "b7"), ("M2M", "b1")], "call_key string, bib_id string")
    got = sorted((r.key, r.matched_key, r.bib_id, r.suffixed) for r in LK.first_suffix_match(keys, idx).collect())
    assert got == [("M1", "M1T", "b8", True), ("M2", "M2", "b7", False)]


def test_lookup_exactly_one(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "uuid string")
    items = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "item_uuid string, inventory_id_fk int")
    got = {r.uuid: (r.item_status, r.item_inventory_id_fk)
           for r in LK.lookup_exactly_one(keys, items, "uuid", "item_uuid", "item_", ["inventory_id_fk"]).collect()}
    assert got == {"a": ("ok", 1), "b": ("ambiguous", None), "c": ("missing", None)}


def test_key_and_compound_summary(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), ("",), ("",), ("",)], "k string")
    s = K.key_summary(df, "k").first()
    assert (s.total, s.distinct_keys, s.repeats, s.singletons, s.empty) == (6, 3, 2, 1, 3)
    sheet = spark.createDataFrame([("M1",), ("M1",), ("M1|M2",), (None,)], "v string")
    c = K.compound_summary(sheet, "v").first()
    assert (c.total, c.distinct_values, c.single_values, c.multiple_values, c.empty) == (4, 2, 1, 1, 1)


def test_drop_missing_key_preview_and_batch(spark):
    df = spark.createDataFrame([("M1", "1"), (" ", "1"), (None, "2"), ("M2", "2")], "k string, batch_number string")
    assert [r.k for r in K.drop_missing_key(df, "k").collect()] == ["M1", "M2"]
    assert K.preview_fields(df, ["batch_number", "missing", "k"]).columns == ["batch_number", "k"]
    assert LK.batch_records(df, "2").count() == 2


def test_match_classes_reference_cases(spark):
    holdings = {"INV_NO_01": ["A1"], "INV_NO_02": ["A2", "A3"], "INV_NO_05": ["A4"], "INV_NO_06": ["A5", "A6"],
                "INV_NO_07": ["A7", "A8"], "INV_NO_11": ["A11"], "INV_NO_13": ["A12", "A13"]}
    inventory = {"INV_NO_03": ["F1", "F2"], "INV_NO_04": ["F3"], "INV_NO_05": ["F4", "F5"], "INV_NO_06": ["F6"],
                 "INV_NO_07": ["F7", "F8"], "INV_NO_12": ["F12"]}
    ids = spark.createDataFrame([(k, "holdings", i) for k, v in holdings.items() for i in v]
                                + [(k, "inventory", i) for k, v in inventory.items() for i in v],
                                "key string, source string, id string")
    counts = M.source_counts(ids)
    singles = spark.createDataFrame([(v,) for v in ["INV_NO_03", "INV_NO_02", "INV_NO_05", "INV_NO_06",
                                                    "INV_NO_07", "INV_NO_99"]], "value string")
    got = {r.inventory_number: r.section for r in M.classify_single_values(singles, counts).collect()}
    assert got == {"INV_NO_03": "S1", "INV_NO_02": "S2", "INV_NO_05": "S3", "INV_NO_06": "S4",
                   "INV_NO_07": "S5", "INV_NO_99": "S6"}
    compounds = spark.createDataFrame([("INV_NO_11|INV_NO_12",), ("INV_NO_13|INV_NO_14",)], "value string")
    got = sorted((r.section, r.inventory_number) for r in M.classify_compound_values(compounds, counts).collect())
    assert got == [("M1", "INV_NO_11"), ("M1", "INV_NO_12"), ("M2", "INV_NO_13")]


def test_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n0\n1\n")
    (tmp_path / "b.csv").write_text("v\n" + "\n".join(map(str, range(2, 3000))) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = spark.read.option("header", True).csv(str(tmp_path))
        rows = K.with_file_order(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert sorted((r.row_index, int(r.v)) for r in rows) == [(i, i) for i in range(3000)]


def test_duplicates_removed(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "b", 2), (2, "a", 3), (3, None, 4), (4, None, 5)], "n int, k string, v int")
    left = K.without_duplicates(df, "k", "n").collect()
    assert sorted(r.v for r in left) == [1, 2, 4]


def test_repeated_bib_keeps_the_last(spark):
    from kardex.operators.lookups import attach_bib
    bibs = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "bib_id string, t string, o int")
    rows = spark.createDataFrame([("1",), ("2",)], "mms string")
    got = sorted((r.mms, r.t, r.bib_missing) for r in attach_bib(rows, bibs, "mms", ordinal="o").collect())
    assert got == [("1", "new", False), ("2", None, True)]
