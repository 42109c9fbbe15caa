"""Large JSON arrays, read by many tasks.

An export is often one array of records in one file, which a multi-line JSON
scan gives to one task.  Here the file is scanned as text that is cut where one
record ends and the next begins, and each piece is parsed on its own.  Texts and
nested arrays may hold the cut, too.  Whether they do is seen from the quotes and brackets of
the pieces.  Only then are the pieces put in file order and joined to records,
from running totals of quotes and brackets.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.functions._util import let
from kardex.operators.keys import with_file_order
from kardex.operators.numbering import running_totals
from kardex.session import cut_lineage

#: What stands between two records where the writer puts one blank behind a comma.
BETWEEN = "}, {"


def _plain(text: Column) -> Column:
    """Without escaped characters."""
    return F.when(text.contains("\\"), F.regexp_replace(text, r"\\(?s:.)", "")).otherwise(text)


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _shape(text: Column, inside: Column | None = None) -> Column:
    """``(quotes, braces, brackets)`` of a piece: quotes that open or close a
    text, and what it opens more than it closes outside of texts.  ``inside``:
    the piece begins in the middle of a text."""
    def read(plain: Column) -> Column:
        begun = plain if inside is None else F.when(inside, F.concat(F.lit('"'), plain)).otherwise(plain)
        bare = F.regexp_replace(begun, '(?s)"[^"]*("|$)', "")
        return let(bare, lambda b: F.struct(
            _count(plain, '"').alias("quotes"), (_count(b, "{") - _count(b, "}")).alias("braces"),
            (_count(b, "[") - _count(b, "]")).alias("brackets")))

    return let(_plain(text), read)


def _patterns(envelope: Sequence[str]) -> tuple[str, str]:
    """What a file has before its first record and behind its last one."""
    head = "".join(rf'\{{\s*"{re.escape(name)}"\s*:\s*' for name in envelope)
    return rf"^﻿?\s*{head}\[\s*", r"\}\s*\]" + r"\s*\}" * len(envelope) + r"\s*$"


def _texts(pieces: DataFrame, envelope: Sequence[str]) -> DataFrame:
    """Pieces ``value`` that begin and end with records -> ``(text, whole)``: an
    array of these records, and whether its quotes and brackets come out even."""
    head, tail = _patterns(envelope)
    value = F.col("value")
    begun = F.when(value.rlike(head + r"\{"), F.regexp_replace(value, head + r"\{", "[{")).otherwise(F.concat(F.lit("[{"), value))
    shaped = pieces.where(~value.rlike(head + r"\]")).select(begun.alias("text")).withColumn("shape", _shape(F.col("text")))
    last = (F.col("shape.braces") == -len(envelope)) & (F.col("shape.brackets") == 0)
    more = (F.col("shape.braces") == 1) & (F.col("shape.brackets") == 1)
    return shaped.select(
        F.when(last, F.regexp_replace("text", tail, "}]")).when(more, F.concat("text", F.lit("}]"))).alias("text"),
        ((F.col("shape.quotes") % 2 == 0) & (last | more)).alias("whole"))


def _joined(scan: DataFrame, between: str, envelope: Sequence[str]) -> DataFrame:
    """Pieces joined to records, in file order."""
    head, _ = _patterns(envelope)
    pieces = cut_lineage(with_file_order(scan, "__i"))
    # Files follow one another: those of a whole file come out even.
    quotes = running_totals(pieces.withColumn("__q", _count(_plain(F.col("value")), '"')), "__i", {"__before": "__q"})
    inside = F.pmod("__before", F.lit(2)) == 1
    shaped = quotes.select("__i", "value", inside.alias("__inside"), _shape(F.col("value"), inside).alias("__s"))
    # A cut closes one brace and opens one, so that it adds nothing.
    opened = shaped.select("*", F.col("__s.braces").alias("__open"), F.col("__s.brackets").alias("__list"))
    depth = running_totals(opened, "__i", {"__braces": "__open", "__brackets": "__list"})
    between_records = (F.col("__braces") == len(envelope) + 1) & (F.col("__brackets") == 1)
    first = (F.col("__braces") == 0) & (F.col("__brackets") == 0) & F.col("value").rlike(head)
    start = F.when(~F.col("__inside") & (between_records | first), 1).otherwise(0)
    marked = depth.select("__i", "value", start.alias("__start"))
    numbered = running_totals(marked, "__i", {"__starts": "__start"})
    return numbered.groupBy((F.col("__starts") + F.col("__start")).alias("__record")).agg(
        F.array_sort(F.collect_list(F.struct("__i", "value"))).alias("__p")).select(
        F.array_join(F.col("__p.value"), between).alias("value"))


def read_json_array(spark: SparkSession, path, schema: T.StructType | None = None, between: str = BETWEEN,
                    envelope: Sequence[str] = ()) -> DataFrame:
    """The records of files that hold one JSON array of objects each, or, with
    ``envelope``, one below these names (``{"media": {"assets": [...]}}``).

    ``between`` is how the writer separates two records, brackets included; a
    file that separates them otherwise is read rightly, too, but not cut.  No
    schema: one is inferred from all records, which scans the files once more.
    Files without records give no rows; a piece that is no JSON gives none.
    """
    blank_file = (F.btrim("value", F.lit(" \r\n\t")) == "") & (F.octet_length("value") == F.col("_metadata.file_size"))
    scan = spark.read.option("lineSep", between).text(path).where(~blank_file)
    found = _texts(scan, envelope)
    if not found.where(~F.col("whole")).isEmpty():
        found = _texts(_joined(scan, between, envelope), envelope)
    if schema is None:
        jvm = spark.sparkContext._jvm
        strings = getattr(found.select("text")._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
        schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(strings).schema().json()))
    rows = found.select(F.explode(F.from_json("text", T.ArrayType(schema))).alias("__r"))
    return rows.where(F.col("__r").isNotNull()).select("__r.*")
