"""File lists versus asset metadata (P7, G1, G2, H21, S4/S5 helpers).

Set differences are anti joins of the distinct names of both sides; no
collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kardex.functions.text import basename, strip, suffix


def path_name(c):
    """``PurePath(p).name``: last component, trailing slashes ignored."""
    return basename(F.regexp_replace(c, r"/+$", ""))


def media_file_names(paths: DataFrame, col: str = "path") -> DataFrame:
    """Basenames of paths that have an extension other than ``.json``
    (case-insensitive)."""
    p = strip(F.col(col))
    name = path_name(p)
    ext = suffix(name)
    return (paths.select(name.alias("filename"), ext.alias("__ext"))
                 .filter((F.col("__ext") != "") & (F.lower(F.col("__ext")) != ".json"))
                 .select("filename"))


def metadata_file_names(assets: DataFrame, name: str = "file_name", uuid: str = "uuid") -> DataFrame:
    """Metadata file names; an empty name becomes ``NO FILE NAME (uuid)``."""
    return assets.select(F.when(F.col(name) == "", F.format_string("NO FILE NAME (%s)", F.col(uuid)))
                          .otherwise(F.col(name)).alias("filename"))


def files_not_in_metadata(files: DataFrame, meta: DataFrame) -> DataFrame:
    """G1: distinct file-list names missing from the metadata."""
    # Distinct first: it combines map-side, and the anti join sees names once.
    return files.select("filename").distinct().join(meta.select("filename").distinct(), "filename", "left_anti")


def metadata_not_in_files(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Distinct metadata names missing from the file lists."""
    return meta.select("filename").distinct().join(files.select("filename").distinct(), "filename", "left_anti")


def filename_mismatches(files: DataFrame, meta: DataFrame) -> DataFrame:
    """G1 + G2 as one sectioned report (``section`` = sheet name)."""
    a = files_not_in_metadata(files, meta).withColumn("section", F.lit("file_lists_not_metadata"))
    b = metadata_not_in_files(files, meta).withColumn("section", F.lit("metadata_not_file_lists"))
    return a.unionByName(b).select("section", "filename")
