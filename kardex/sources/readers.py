"""Sources (S1-S11).  Every reader returns a lazy DataFrame; Spark splits
the files across tasks.  Large JSON arrays are cut between records
(``json_arrays``); with ``multi_line`` a JSON document is one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.formats import CSV_READ
from kardex.functions.text import strip
from kardex.operators.keys import with_file_order
from kardex.sources.json_arrays import BETWEEN, read_json_array

MARC_SCHEMA = T.StructType([
    T.StructField("leader", T.StringType()),
    T.StructField("controlfield", T.ArrayType(T.StructType([
        T.StructField("_tag", T.StringType()), T.StructField("_VALUE", T.StringType())]))),
    T.StructField("datafield", T.ArrayType(T.StructType([
        T.StructField("_tag", T.StringType()), T.StructField("_ind1", T.StringType()),
        T.StructField("_ind2", T.StringType()),
        T.StructField("subfield", T.ArrayType(T.StructType([
            T.StructField("_code", T.StringType()), T.StructField("_VALUE", T.StringType())])))]))),
])

_TEXT_OR_ATTR = T.StructType([T.StructField("_VALUE", T.StringType()),
                              T.StructField("_authorized", T.StringType())])
LANGUAGE_SCHEMA = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("code", _TEXT_OR_ATTR),
    T.StructField("name", _TEXT_OR_ATTR),
])


def _read_csv(spark: SparkSession, path, header: bool, multi_line: bool = False,
              schema: T.StructType | None = None) -> DataFrame:
    """All cells as text.  ``multi_line`` reads cells that hold a line feed, at
    the price of one task per file."""
    options = dict(CSV_READ, header=str(header).lower())
    if multi_line:
        options.pop("lineSep")
        options["multiLine"] = "true"
    r = spark.read.options(**options)
    df = (r.schema(schema) if schema is not None else r).csv(path)
    last = df.columns[-1] if df.columns else ""
    if schema is not None or last.endswith("\r"):
        # Lines that end in CR LF leave the CR on the last cell.
        cell = F.regexp_replace(F.col(f"`{last}`"), "\r$", "")
        df = df.withColumn(last, cell).withColumnRenamed(last, last.rstrip("\r"))
    return df


def read_holdings(spark: SparkSession, path, names: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Headered CSV, every column a string (a leading BOM is dropped by
    the CSV reader).  ``names`` renames the columns positionally."""
    df = _read_csv(spark, path, True, multi_line)
    # A BOM that survived (non-UTF-8 declared files) is removed from the name.
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    return df.toDF(*names) if names else df


def read_records_json(spark: SparkSession, path, schema: T.StructType | None = None,
                      multi_line: bool = False, between: str | None = None) -> DataFrame:
    """JSON lines, or JSON arrays of records: with ``between``, what the
    writer puts between two records, they are read by many tasks, with
    ``multi_line`` by one task a file (any layout, one value in a file too)."""
    if between is not None:
        return read_json_array(spark, path, schema, between)
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_fixture_json(spark: SparkSession, path, schema: T.StructType | None = None,
                      multi_line: bool = False, between: str | None = None) -> DataFrame:
    """S3: ``{model, pk, fields{...}}`` records unwrapped to ``fields.* + pk``."""
    return read_records_json(spark, path, schema, multi_line, between).select("fields.*", "pk")


def read_assets(spark: SparkSession, paths, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Asset documents ``{"media": {"assets": [...]}}`` flattened to one
    row per asset, with the source file name."""
    df = read_records_json(spark, paths, schema, multi_line)
    return (df.select(F.explode("media.assets").alias("a"), F.col("_metadata.file_name").alias("source_file"))
              .select("a.*", "source_file"))


def read_asset_array(spark: SparkSession, paths, schema: T.StructType | None = None, between: str = BETWEEN) -> DataFrame:
    """S4 for large documents: the assets of ``{"media": {"assets": [...]}}``
    files, read by many tasks (``schema``: of an asset)."""
    return read_json_array(spark, paths, schema, between, envelope=("media", "assets"))


def read_path_lists(spark: SparkSession, paths) -> DataFrame:
    """Text files, one stripped path per line."""
    return spark.read.text(paths).select(strip(F.col("value")).alias("path"))


def read_headerless_csv(spark: SparkSession, path, names: list[str]) -> DataFrame:
    """CSV without header; the names are imposed (a header line would be
    read as data, as in the reference)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _read_csv(spark, path, False, schema=schema)


def read_xml_rows(spark: SparkSession, path, row_tag: str, schema: T.StructType | None = None,
                  cut: bool = False) -> DataFrame:
    """XML row elements as records (built-in XML source, a file is one
    task).  With ``cut``, which needs the schema, many tasks read one file: it is
    cut at the end tags of the rows, which must stand nowhere else (in comments,
    say); so K5 and K6 write them.  Columns in folder names are not read then."""
    if cut:
        if schema is None:
            raise ValueError("Files are cut into rows of a given schema only.")
        return read_xml_records(spark, path, row_tag, schema).select(*[F.col(f"`{c}`") for c in schema.names])
    r = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def xml_records(spark: SparkSession, path, row_tag: str) -> DataFrame:
    """``(text, source_file)``: each element of that tag as text of its own,
    from a scan that cuts files at the end tags, so that many tasks read one file.
    An element that does not end is one, too, up to where the next begins."""
    end = f"</{row_tag}>"
    scan = spark.read.option("lineSep", end).text(path).select("value", F.col("_metadata.file_name").alias("source_file"))
    parts = F.split("value", rf"(?=<{re.escape(row_tag)}[\s/>])")
    # The cut took the end tag of the last element of a piece.
    whole = F.transform(parts, lambda part, i: F.when((i == F.size(parts) - 1) & ~part.rlike(r"^<[^>]*/>"), F.concat(
        part, F.lit(end))).otherwise(part))
    return scan.select(F.explode(F.filter(whole, lambda part: part.rlike(rf"^<{re.escape(row_tag)}[\s/>]"))).alias("text"),
                       "source_file")


#: Before texts of blanks alone (a character of the private use area).
_MARK = "\ue000"


def _unmarked(c, kind: T.DataType):
    """The value without marks, texts in lists and records included."""
    if isinstance(kind, T.StringType):
        return F.replace(c, F.lit(_MARK), F.lit(""))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _unmarked(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_unmarked(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def read_xml_records(spark: SparkSession, path, row_tag: str, schema: T.StructType, keep_blanks: bool = False,
                     corrupt: str = "_corrupt_record") -> DataFrame:
    """S7 for large or damaged files: the columns of ``schema``, ``corrupt`` and
    ``source_file``.  Every record is parsed on its own, so that one that is
    malformed (its text is in ``corrupt``) leaves the others of its file alone."""
    fields = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"rowTag": row_tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt,
               "ignoreSurroundingSpaces": str(not keep_blanks).lower()}
    # Blanks and tags of the surrounding document that follow an empty element.
    text = F.regexp_replace("text", r"(?s)^(<[^>]*/>).*$", "$1")
    if keep_blanks:
        # The parser takes a text of blanks alone for none: a mark keeps it.
        text = F.regexp_replace(text, r">( +)</", f">{_MARK}$1</")
    records = xml_records(spark, path, row_tag).select(text.alias("text"), "source_file")
    parsed = records.select(F.from_xml("text", fields, options).alias("r"), "source_file").select("r.*", "source_file")
    if not keep_blanks:
        return parsed
    return parsed.select(*[_unmarked(F.col(f.name), f.dataType).alias(f.name) for f in fields.fields], "source_file")


def read_marc(spark: SparkSession, path, row_tag: str = "record") -> DataFrame:
    """MARCXML records with the fixed MARC struct schema (binary ISO
    2709 is not read).  Blanks in fields are data: places count in 008."""
    return read_xml_records(spark, path, row_tag, MARC_SCHEMA, keep_blanks=True).select(*MARC_SCHEMA.names)


def read_language_codes(spark: SparkSession, path) -> DataFrame:
    """Code-list XML -> ``(code, name)``; a value may be plain text or an
    element with attributes (both read by one schema); later duplicate codes
    win; sorted by code."""
    df = with_file_order(read_xml_rows(spark, path, "language", LANGUAGE_SCHEMA), "__ord")
    flat = df.select(F.coalesce(F.col("code._VALUE"), F.lit("")).alias("code"),
                     F.coalesce(F.col("name._VALUE"), F.lit("")).alias("name"), "__ord")
    return (flat.groupBy("code").agg(F.max_by("name", "__ord").alias("name")).orderBy("code"))


def read_sheet(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    """One spreadsheet tab exported as CSV (all strings) or Parquet."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_holdings(spark, path)


_STAMP = r"_([0-9]{8}_[0-9]{6})\.[^.]+$"


def export_stamps(spark: SparkSession, path) -> DataFrame:
    """The file names below ``path`` and their ``YYYYMMDD_HHMMSS`` stamps (null
    when the name has none); the files are listed, not read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    stamp = F.regexp_extract(name, _STAMP, 1)
    return files.select(name.alias("file_name"), stamp.alias("stamp")).withColumn(
        "stamped_at", F.when(F.col("stamp") != "", F.try_to_timestamp(F.col("stamp"), F.lit("yyyyMMdd_HHmmss"))))


def export_is_recent(spark: SparkSession, paths: list[str], as_of) -> bool:
    """Every export file carries a stamp no older than ``as_of`` minus
    one day.  ``as_of`` is a parameter (never the clock).  Driver-side gate:
    one aggregate row is collected."""
    stamps = None
    for path in paths:
        s = export_stamps(spark, path)
        stamps = s if stamps is None else stamps.unionByName(s)
    limit = F.to_timestamp(F.lit(str(as_of))) - F.expr("INTERVAL 1 DAY")
    row = stamps.agg(F.bool_and(F.coalesce(F.col("stamped_at") >= limit, F.lit(False))).alias("ok")).first()
    return bool(row["ok"]) if row and row["ok"] is not None else False
