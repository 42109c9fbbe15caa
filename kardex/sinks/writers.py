"""Sinks (K1-K8).  Writers are distributed (one file per task); the only
driver-side decisions are the ``isEmpty`` gates of K1/K8, which stop at the
first row found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.formats import CSV_WRITE
from kardex.operators.numbering import number_rows
from kardex.sources.readers import read_xml_records


def _stringify(df: DataFrame) -> DataFrame:
    """Arrays/structs rendered as text for flat formats."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, ", ")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_report_csv(df: DataFrame, path: str, columns: list[str] | None = None,
                     compression: str | None = None, mode: str = "overwrite") -> bool:
    """K1: fixed columns (extras dropped), header, no output when empty.
    Returns whether anything was written."""
    out = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    if out.isEmpty():
        return False
    w = _stringify(out).write.mode(mode).options(**CSV_WRITE).option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return True


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: tab-separated with header; arrays joined, structs as JSON."""
    _stringify(df).write.mode(mode).options(**CSV_WRITE).option("header", True).option("sep", "\t").csv(path)


def write_asset_docs(assets: DataFrame, path: str, per_document: int | None = None, mode: str = "overwrite") -> None:
    """K3: assets as JSON lines, or, with ``per_document``, as documents
    ``{"media": {"assets": [...]}}`` (one per line) of at most that many assets:
    as many documents as it takes, every asset in one of them, equal assets
    included; only the last one may be short."""
    if per_document is None:
        assets.write.mode(mode).json(path)
        return
    columns = [F.col(f"`{c}`") for c in assets.columns]
    numbered = number_rows(assets.select(F.struct(*columns).alias("__a")), "__i")
    (numbered.groupBy(F.floor(F.col("__i") / per_document).alias("__d"))
          .agg(F.collect_list("__a").alias("assets"))
          .select(F.struct("assets").alias("media")).write.mode(mode).json(path))


def write_sectioned_report(df: DataFrame, path: str, section: str = "section") -> None:
    """K4: one report in named sections (sheets).  A rerun replaces the whole
    report: a section it no longer has is gone."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**CSV_WRITE)
       .partitionBy(section).option("header", True).csv(path))


def write_xml_rows(df: DataFrame, path: str, root_tag: str = "Root", row_tag: str = "MediaResource",
                   mode: str = "overwrite") -> None:
    """K5: table to ``<Root><MediaResource>...`` with every cell as text;
    nulls are written as empty elements (the reference writes ``nan``)."""
    out = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    (out.write.mode(mode).format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
        .option("nullValue", "").save(path))


def write_nested_xml(parts: DataFrame, path: str, row_tag: str = "ROW", partition_by: str | None = None,
                     mode: str = "overwrite") -> None:
    """K6: one XML element per document part of a number (J8 document form)
    with its rows and nested resources; ``partition_by`` groups the output
    instead of one file per row."""
    w = parts.write.mode(mode).format("xml").option("rootTag", "ROWS").option("rowTag", row_tag)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def xml_to_json(spark, in_path: str, out_path: str, row_tag: str, schema: T.StructType | None = None,
                mode: str = "overwrite") -> DataFrame:
    """K7: XML documents to JSON lines; text is trimmed by the reader,
    repeated elements become arrays.  Everything is read and written once:
    records below ``<out>/malformed=false``, malformed ones, each with its own
    text, below ``<out>/malformed=true``.  Without a schema one is inferred,
    which reads the documents once more.  Returns the written table of
    malformed records."""
    corrupt = "_corrupt_record"
    if schema is None:
        found = spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", True).load(in_path).schema
        schema = T.StructType([f for f in found.fields if f.name != corrupt])
    df = read_xml_records(spark, in_path, row_tag, schema, corrupt=corrupt)
    df.withColumn("malformed", F.col(corrupt).isNotNull()).write.mode(mode).partitionBy("malformed").json(out_path)
    errors = T.StructType([T.StructField("source_file", T.StringType()), T.StructField(corrupt, T.StringType()),
                           T.StructField("malformed", T.BooleanType())])
    # The column is data here, not the reader's own mark of bad lines.
    written = spark.read.schema(errors).option("columnNameOfCorruptRecord", "__unreadable").json(out_path)
    return written.where("malformed").drop("malformed")


def write_if_valid(assets: DataFrame, problems: DataFrame, path: str, **kw) -> DataFrame | None:
    """K8: write the assets only when there are no problems; otherwise return
    the problem table (nothing written)."""
    if not problems.isEmpty():
        return problems
    write_asset_docs(assets, path, **kw)
    return None
