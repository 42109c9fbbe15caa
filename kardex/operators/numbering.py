"""Places and running totals without a sort of a whole group in one task.

Rows are cut into bins of bounded size.  Only the bins' totals are added up in
order; inside a bin the rows are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.session import cut_lineage


def running_totals(df: DataFrame, order: str, sums: dict[str, str], bin_rows: int = 10_000) -> DataFrame:
    """Adds for each ``name: column`` of ``sums`` the total of the column over
    the rows before, by ``order``: a dense row number."""
    binned = df.withColumn("__bin", F.floor(F.col(order) / bin_rows))
    before = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = binned.groupBy("__bin").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()])
    # One row per bin.
    starts = totals.select("__bin", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__start_{n}") for n in sums])
    inside = Window.partitionBy("__bin").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = binned.join(starts, "__bin")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[
        (F.col(f"__start_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... over all rows, in the order they stand in, which
    a checkpoint makes final."""
    fixed = cut_lineage(df.withColumn("__id", F.monotonically_increasing_id()))
    # The id has the partition in its upper bits and the place in it below.
    placed = fixed.withColumn("__part", F.shiftright("__id", 33)).withColumn(
        "__place", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(starts, "__part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + F.col("__place")).alias(name))


def number_within(df: DataFrame, key: str, name: str, bin_rows: int = 10_000) -> DataFrame:
    """Adds ``name``: the place (0, 1, ...) of each row among the rows of its
    key, each place once, equal rows included; rows without a key are dropped.

    Rows get an id as they stand, which the checkpoint makes final, and are binned
    by it, so that a key with very many rows, equal or not, is spread over many bins.
    """
    fixed = cut_lineage(df.where(F.col(key).isNotNull()).withColumn("__id", F.monotonically_increasing_id()))
    binned = fixed.withColumn("__bin", F.floor(F.col("__id") / bin_rows))
    sizes = binned.groupBy(key, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias("__key"), F.col("__bin").alias("__of"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, "__bin").orderBy("__id")
    return (binned.join(starts, (F.col(key) == F.col("__key")) & (F.col("__bin") == F.col("__of")))
            .withColumn(name, F.col("__start") + F.row_number().over(inside) - 1)
            .drop("__id", "__bin", "__key", "__of", "__start"))
