"""Incremental runs with Structured Streaming.

The reference re-runs validation and standardisation over the records
modified in the last 14 days (P3).  As a stream, new export files are picked
up as they land; validation (V5) and standardisation (H18/H22) are stateless
per record, so each micro-batch is a map-only projection and the stream needs
no state store.  Checkpoints go under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kardex.operators import changes as C
from kardex.operators import validation as V
from kardex.session import ensure_checkpoint_dir


def read_export_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """New export files under ``path`` as a stream (schema is required for
    file streams)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _checkpoint(spark: SparkSession, name: str) -> str:
    # A restarted stream must find its progress again: same folder, same name.
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def stream_violations(records: DataFrame, layout: str, out_path: str, name: str = "violations",
                      available_now: bool = True) -> StreamingQuery:
    """V5 over a record stream, appended to ``out_path`` as Parquet."""
    v = V.violations(records, layout)
    w = (v.writeStream.format("parquet").option("path", out_path)
          .option("checkpointLocation", _checkpoint(records.sparkSession, name)).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_changes(records: DataFrame, fields, out_path: str, id_col: str = "inventory_id",
                   as_of_year: int = 2026, name: str = "changes", available_now: bool = True) -> StreamingQuery:
    """H22 change rows over a record stream, appended to ``out_path``."""
    ch = C.change_log(records, fields, id_col=id_col, as_of_year=as_of_year)
    w = (ch.writeStream.format("parquet").option("path", out_path)
           .option("checkpointLocation", _checkpoint(records.sparkSession, name)).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
