"""Streaming validation and change rows over files that land in a folder."""

import uuid

from pyspark.sql import functions as F

from kardex.streaming import incremental as S


def test_stream_violations_and_changes(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(1, "M1", "1", "TELEVISION SERIES", "", "ca. 1950"), (2, "M2", "0", "SHORT", "English", "1999")]
    df = spark.createDataFrame(rows, "inventory_id int, inventory_no string, digital_record string, "
                                     "production_type string, Language string, record_date string")
    df.write.parquet(src + "/batch1")
    df.withColumn("inventory_id", F.col("inventory_id") + 10).write.parquet(src + "/batch2")
    stream = S.read_export_stream(spark, src + "/*", df.schema)
    q = S.stream_violations(stream, "NEW DIGITAL_API", str(tmp_path / "v"), name=f"v-{uuid.uuid4().hex}")
    q.awaitTermination(120)
    v = spark.read.parquet(str(tmp_path / "v"))
    assert sorted((r.inventory_id, r.field) for r in v.collect()) == [
        ("1", "Language"), ("1", "episode no."), ("1", "episode_title"),
        ("11", "Language"), ("11", "episode no."), ("11", "episode_title")]
    q2 = S.stream_changes(stream, ["record_date"], str(tmp_path / "c"), name=f"c-{uuid.uuid4().hex}")
    q2.awaitTermination(120)
    c = spark.read.parquet(str(tmp_path / "c"))
    assert sorted((r.inventory_id, r.new_value) for r in c.collect()) == [(1, "1950?"), (11, "1950?")]


def test_restarted_stream_appends_nothing_twice(spark, tmp_path):
    src, out, name = str(tmp_path / "in"), str(tmp_path / "c"), f"r-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "ca. 1950")], "inventory_id int, record_date string")
    df.write.parquet(src + "/batch1")
    for _ in range(2):
        S.stream_changes(S.read_export_stream(spark, src + "/*", df.schema), ["record_date"], out,
                         name=name).awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
