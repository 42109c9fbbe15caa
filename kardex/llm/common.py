"""Helpers shared by the training-data operators.

Word rule of most contracts: ``[^\\x20\\x09-\\x0D]+`` on UTF-8 text, which is
``bytes.split()``; ``bytes.lower()`` lower-cases A-Z only.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.session import ensure_checkpoint_dir

#: Documents that one Python step holds at a time.
SLICE_ROWS = 512
#: Bytes of text in these, but for a longer row.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI: this run's part of
    ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    return re.sub(r"^file:/+", "file:///", spark.sparkContext.getCheckpointDir())


def read_shared(folder: str) -> pa.Table:
    """In a task: the Parquet files that Spark wrote to a shared folder."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
    return pa.concat_tables([pq.read_table(f, filesystem=store) for f in files])


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that this run wrote."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(id_col: str, text_col: str) -> Column:
    """A narrow name of a row: its id and a 128-bit digest of its text, nulls
    told from empty ones.  Rows of one key are equal in both."""
    digest = F.unhex(F.md5(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))))
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("key"),
                    F.struct(F.col(text_col).isNull().alias("null"), digest.alias("digest")).alias("text"))


def hash_side(keys: DataFrame) -> DataFrame:
    """The side of a join that is built as a hash table in each task: the other
    side is shuffled, at every size, but not sorted."""
    return keys.hint("shuffle_hash")


def field(df: DataFrame, name: str, alias: str | None = None) -> T.StructField:
    return T.StructField(alias or name, df.schema[name].dataType, True)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """Values of a string column as UTF-8 bytes, null as None."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).to_pylist()


def _row_bytes(batch: pa.RecordBatch, columns: list[int]) -> np.ndarray:
    size = np.zeros(batch.num_rows, np.int64)
    for i in columns:
        size += pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    return size


def parts_by_bytes(batch: pa.RecordBatch, column: int | None = None, most: int = SLICE_BYTES,
                   rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch: at most ``rows`` rows each, and about ``most`` bytes
    of that string column, or of all of them (a longer row is a part of its own)."""
    texts = [i for i, f in enumerate(batch.schema) if pa.types.is_string(f.type) or pa.types.is_binary(f.type)
             or pa.types.is_large_string(f.type) or pa.types.is_large_binary(f.type)]
    ends = np.cumsum(_row_bytes(batch, texts if column is None else [column]))
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, base + most, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop


@contextmanager
def memory_given_back() -> Iterator[None]:
    """Python workers live on between tasks: what a task has freed goes back to
    the system when it ends, so that idle workers hold no heap of past stages."""
    try:
        yield
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType,
               rows: int = SLICE_ROWS) -> DataFrame:
    """``fn`` on slices of at most ``rows`` rows and some megabytes of text; it
    returns column arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        with memory_given_back():
            for batch in batches:
                for part in parts_by_bytes(batch, rows=rows):
                    got = fn(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(got[f.name], type=f.type) if not isinstance(got[f.name], (pa.Array, pa.ChunkedArray))
                         else (got[f.name].combine_chunks() if isinstance(got[f.name], pa.ChunkedArray) else got[f.name]).cast(f.type)
                         for f in out], schema=out)

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (public constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashed_sample(df: DataFrame, group: str, most: int, *order: str) -> DataFrame:
    """At most about ``most`` rows of each group, the first in each of some
    bins by ``order`` (hashes).  Few enough rows per bin are ranked that the
    engine's group limit drops the others before the shuffle."""
    bins = -(-most // 500)
    ranked = df.withColumn("__bin", F.pmod(F.xxhash64(*order), F.lit(bins)))
    place = F.row_number().over(Window.partitionBy(group, "__bin").orderBy(*order))
    return ranked.withColumn("__place", place).where(F.col("__place") <= -(-most // bins)).drop("__bin", "__place")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add (case-insensitive)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])
