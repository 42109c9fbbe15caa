"""Large JSON arrays: cut between records, joined again where a cut was none."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.operators.numbering import number_within, running_totals
from kardex.sources import readers as R

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField(
    "sub", T.ArrayType(T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.LongType())])))])


def write(path, records, **more):
    path.write_text(json.dumps(records, ensure_ascii=False, **more))


def same(got, want):
    rows = [(r.id, r.t, None if r.sub is None else [tuple(x) for x in r.sub]) for r in got.collect()]
    records = [(r["id"], r.get("t"), None if r.get("sub") is None else [(x.get("x"), x.get("y")) for x in r["sub"]]) for r in want]
    assert sorted(map(str, rows)) == sorted(map(str, records))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    want = [{"id": i, "t": f"title {i} é" * 5, "sub": None} for i in range(4000)]
    write(tmp_path / "a.json", want)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got = R.read_records_json(spark, str(tmp_path / "a.json"), SCHEMA, between=R.BETWEEN)
        assert got.rdd.getNumPartitions() > 8
        same(got, want)
        inferred = R.read_records_json(spark, str(tmp_path / "a.json"), between=R.BETWEEN)
        multi = R.read_records_json(spark, str(tmp_path / "a.json"), multi_line=True)
        assert sorted(map(str, inferred.select("id", "t").collect())) == sorted(map(str, multi.select("id", "t").collect()))
        # The same with the cut inside of texts and lists.
        hard = [{"id": i, "t": ['}, {', '"}, {"', "\\", '\\"}, {', "a"][i % 5] * 3,
                 "sub": [{"x": "}, {", "y": 1}, {"x": "[{", "y": 2}] if i % 3 else []} for i in range(1500)]
        write(tmp_path / "b.json", hard)
        same(R.read_records_json(spark, str(tmp_path / "b.json"), SCHEMA, between=R.BETWEEN), hard)
        same(R.read_records_json(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")], SCHEMA, between=R.BETWEEN),
             want + hard)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({"id": st.integers(0, 9), "t": st.one_of(st.none(), st.text(
    alphabet='}{,[]" \\a:', max_size=12)), "sub": st.one_of(st.none(), st.lists(st.fixed_dictionaries(
        {"x": st.sampled_from(["}, {", '"', "[", "z"]), "y": st.integers(0, 3)}), max_size=3))}), max_size=8),
       st.sampled_from([{}, {"indent": 2}, {"separators": (",", ":")}]))
def test_any_records(spark, tmp_path_factory, records, layout):
    path = tmp_path_factory.mktemp("json") / "x.json"
    write(path, records, **layout)
    same(R.read_records_json(spark, str(path), SCHEMA, between=R.BETWEEN), records)
    same(R.read_records_json(spark, str(path), SCHEMA, between="},\n  {"), records)


def test_fixtures_assets_and_empty_files(spark, tmp_path):
    write(tmp_path / "f.json", [{"model": "m", "pk": i, "fields": {"no": f"M{i}", "t": "}, {" * (i % 2)}} for i in range(50)])
    got = R.read_fixture_json(spark, str(tmp_path / "f.json"), between=R.BETWEEN)
    assert sorted((r.pk, r.no, r.t) for r in got.collect()) == [(i, f"M{i}", "}, {" * (i % 2)) for i in range(50)]
    docs = tmp_path / "docs"
    docs.mkdir()
    for n in range(3):
        write(docs / f"{n}.json", {"media": {"assets": [{"id": 10 * n + i, "t": "x}]}" * i} for i in range(n * 4)]}})
    (docs / "blank.json").write_text(" \n")
    got = R.read_asset_array(spark, str(docs), SCHEMA)
    assert sorted((r.id, r.t) for r in got.collect()) == [(10 * n + i, "x}]}" * i) for n in range(3) for i in range(n * 4)]


@pytest.mark.parametrize("bin_rows", [1, 7, 10_000])
def test_running_totals_and_places(spark, bin_rows):
    df = spark.range(0, 500, numPartitions=7).selectExpr("id AS i", "(id * 7) % 5 - 2 AS v")
    want, total = {}, 0
    for r in sorted(df.collect()):
        want[r.i] = total
        total += r.v
    assert {r.i: r.t for r in running_totals(df, "i", {"t": "v"}, bin_rows).collect()} == want
    keyed = df.select(F.when(F.col("i") % 3 == 0, "hot").when(F.col("i") % 3 == 1, F.concat(F.lit("k"), F.col("v"))).alias("k"))
    placed = number_within(keyed, "k", "place", bin_rows)
    for r in placed.groupBy("k").agg(F.sort_array(F.collect_list("place")).alias("p")).collect():
        assert r.k is not None and r.p == list(range(len(r.p)))
