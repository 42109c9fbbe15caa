"""Assemble MARC record structs (the MARCXML shape) from the flat
``bib_flat`` binding.  Test-input construction only: the operators under
test read the struct, never the flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sub(code, col):
    return F.when(F.col(col).isNotNull(), F.struct(F.lit(code).alias("_code"), F.col(col).alias("_VALUE")))


def _field(tag, subs, ind2=None):
    arr = F.filter(F.array(*subs), lambda s: s.isNotNull())
    return F.struct(F.lit(tag).alias("_tag"), F.lit(" ").alias("_ind1"),
                    (F.col(ind2) if ind2 else F.lit(" ")).alias("_ind2"), arr.alias("subfield"))


def to_marc(flat: DataFrame) -> DataFrame:
    cf = F.filter(F.array(
        F.struct(F.lit("001").alias("_tag"), F.col("bib_id").alias("_VALUE")),
        F.when(F.col("f008").isNotNull(), F.struct(F.lit("008").alias("_tag"), F.col("f008").alias("_VALUE"))),
    ), lambda x: x.isNotNull())
    fields = [
        (None, _field("041", [_sub("a", "a041")])),
        (None, _field("245", [_sub("a", "a245"), _sub("b", "b245"), _sub("n", "n245"),
                              _sub("p", "p245"), _sub("c", "c245")], ind2="ind2")),
        ("a246", _field("246", [_sub("a", "a246")])),
        ("a250", _field("250", [_sub("a", "a250")])),
        ("c260", _field("260", [_sub("c", "c260")])),
        ("c264", _field("264", [_sub("c", "c264")])),
        ("a490", _field("490", [_sub("a", "a490"), _sub("v", "a490")])),
        ("a505", _field("505", [_sub("a", "a505")])),
        ("form1", _field("655", [_sub("a", "form1"), _sub("2", "form1_source")])),
        ("form2", _field("655", [_sub("a", "form2")])),
    ]
    arr = []
    for guard, f in fields:
        if guard is None and f is not None:
            guard_col = "a041" if f is fields[0][1] else None
            arr.append(F.when(F.col(guard_col).isNotNull(), f) if guard_col else f)
        else:
            arr.append(F.when(F.col(guard).isNotNull(), f))
    df_arr = F.filter(F.array(*arr), lambda x: x.isNotNull())
    mentions = F.filter(F.array(
        F.when(F.col("person1").isNotNull(), F.struct(F.col("person1").alias("text"), F.lit("PERSON").alias("label"))),
        F.when(F.col("person2").isNotNull(), F.struct(F.col("person2").alias("text"), F.lit("PERSON").alias("label"))),
        F.struct(F.lit("Studio").alias("text"), F.lit("ORG").alias("label")),
    ), lambda x: x.isNotNull())
    return flat.select("bib_id", "row_ordinal", F.lit("00000cgm a2200000 a 4500").alias("leader"),
                       cf.alias("controlfield"), df_arr.alias("datafield"), mentions.alias("mentions"))


def holdings_records(holdings: DataFrame) -> DataFrame:
    """MARC holdings records (852 $b/$h) built from the holdings binding:
    every 11th has no record, every 7th no 852, every 5th an 852 without $h."""
    k = F.col("row_ordinal")
    f852 = F.struct(F.lit("852").alias("_tag"), F.lit("0").alias("_ind1"), F.lit(" ").alias("_ind2"),
                    F.filter(F.array(F.struct(F.lit("b").alias("_code"), F.lit("lib").alias("_VALUE")),
                                     F.when(k % 5 != 0, F.struct(F.lit("h").alias("_code"),
                                                                 F.col("call_number").alias("_VALUE")))),
                             lambda x: x.isNotNull()).alias("subfield"))
    other = F.struct(F.lit("866").alias("_tag"), F.lit(" ").alias("_ind1"), F.lit(" ").alias("_ind2"),
                     F.array(F.struct(F.lit("a").alias("_code"), F.lit("1 reel").alias("_VALUE"))).alias("subfield"))
    fields = F.when(k % 7 == 0, F.array(other)).otherwise(F.array(other, f852))
    rec = F.when(k % 11 != 0, F.struct(F.array().cast("array<struct<_tag:string,_VALUE:string>>").alias("controlfield"),
                                       fields.alias("datafield")))
    return holdings.select("holding_id", rec.alias("record"))
