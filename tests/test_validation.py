"""Layout validation: required fields, three kinds of missing, child rows
(array column and separate table), dates and cross-field rules."""

import pytest
from pyspark.sql import functions as F

from kardex.operators import validation as V


def _records(spark):
    rows = [
        # id, no, digital, production_type, Language, release_year, record_date, episode no., retention, purpose
        (1, "M1", "1", "TELEVISION SERIES", "English", "N/A", "", "", "Temporary", "Access (Core)"),
        (2, "M2", "1", "SHORT", "  ", "1999", "", "3", "", ""),
        (0, "M3", "0", "television series", "French", "Unknown", "1999", "", "", ""),
    ]
    df = spark.createDataFrame(rows, "inventory_id int, inventory_no string, digital_record string, "
                                     "production_type string, Language string, release_broadcast_year string, "
                                     "record_date string, `episode no.` string, retention_status string, "
                                     "object_purpose string")
    return df.withColumn("user_last_modified", F.lit("u")).withColumn("date_modified", F.lit("2024-01-02"))


def test_digital_layout_rules(spark):
    recs = _records(spark)
    items = spark.createDataFrame(
        [(1, "", "2 GB", "2024-1-5", "A", "/p"), (1, "i2", "", "2024-02-30", "A", "/q"),
         (2, "i3", "1 GB", "", "A", "/r"), (2, "i4", "1 GB", "0000-01-01", "", " ")],
        "parent int, Item_unit_number string, file_size_display string, Creation_date string, "
        "audio_class string, file_path string")
    v = V.violations(recs, "NEW DIGITAL_API", items, parent_key="inventory_id", child_key="parent")
    got = sorted((r.inventory_id, r.field, r.violation) for r in v.collect())
    assert got == sorted([
        ("1", "Item_unit_number", "Field is null or empty."),
        ("1", "file_size_display", "Field is null or empty."),
        ("1", "Creation_date", "Field value '2024-02-30' is not a valid date in YYYY-MM-DD format."),
        ("1", "episode no.", "episode no. is null but production_type is 'TELEVISION SERIES'."),
        ("1", "episode_title", "episode_title is null but production_type is 'TELEVISION SERIES'."),
        ("1", "record_date", "record_date is null but release_broadcast_year is 'N/A'."),
        ("1", "retention_start_date", "retention_start_date is null but retention_status is 'Temporary'."),
        ("1", "retention_end_date", "retention_end_date is null but retention_status is 'Temporary'."),
        ("1", "sound_format(1)", "sound_format(1) is null but object_purpose is 'Access (Core)'."),
        ("2", "Language", "Field is null or empty."),
        ("2", "retention_status", "Field is null or empty."),
        ("2", "Creation_date", "Field is null or empty."),
        ("2", "Creation_date", "Field value '' is not a valid date in YYYY-MM-DD format."),
        ("2", "Creation_date", "Field value '0000-01-01' is not a valid date in YYYY-MM-DD format."),
        ("2", "audio_class", "Field is null or empty."),
        ("2", "file_path", "Field is null or empty."),
    ])
    # Absent required columns (donor_code, title, ...) are skipped, not violations.
    assert not any(r.field == "donor_code" for r in v.collect())


def test_children_as_array_column(spark):
    recs = _records(spark).filter("inventory_id = 2").withColumn(
        "portal", F.array(F.struct(F.lit("i3").alias("Item_unit_number"), F.lit("1 GB").alias("file_size_display"),
                                   F.lit("2024-12-01").alias("Creation_date"), F.lit("").alias("audio_class"),
                                   F.lit("/x").alias("file_path"))))
    v = V.violations(recs, "NEW DIGITAL_API", "portal")
    assert sorted((r.field, r.violation) for r in v.collect()) == [
        ("Language", "Field is null or empty."), ("audio_class", "Field is null or empty."),
        ("retention_status", "Field is null or empty.")]


def test_analog_scope_and_zero_is_blank(spark):
    recs = _records(spark)
    v = V.violations(recs, "InventoryForLabeling_API")
    got = sorted((r.inventory_id, r.inventory_no, r.field) for r in v.collect())
    # only digital_record = "0"; numeric 0 id reports as "" (Q8)
    assert got == [("", "M3", "episode no."), ("", "M3", "episode_title")]


def test_date_filters(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-10",), ("2024-02-01",)], "d string")
    assert V.modified_between(df, "d", "2024-01-01", "2024-01-10").count() == 2
    assert V.rolling_window(df, "d", "2024-01-14").count() == 2
    with pytest.raises(ValueError):
        V.modified_between(df, "d", "2024-01-01", None)


def test_missing_columns_error(spark):
    from kardex.operators.keys import MissingColumnsError, require_columns
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(MissingColumnsError):
        require_columns(df, ["a", "b"])
