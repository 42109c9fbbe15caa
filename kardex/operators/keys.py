"""Key profiling, duplicate detection and keep-first.

Skew note: a single key (typically the blank key) may hold a large share of
all rows.  Everything here aggregates with partial (map-side) aggregation
first - ``count``, ``min``, ``min_by`` all combine per map task - so a hot key
costs one row per map task in the shuffle, never a whole group in one task.
Windows partitioned by the key are avoided for that reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions._util import as_col
from kardex.functions.text import strip


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, names) -> DataFrame:
    """P5: fail at plan-build time listing missing and available columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(
            f"Columns not found: {missing}. Available columns are: {sorted(df.columns)}")
    return df


# Inventory fields shown in a record preview, in order.
PREVIEW_FIELDS = [
    "type", "inventory_no", "inventory_id", "format_type", "title", "aka", "director",
    "episode_title", "production_type", "Acquisition type", "Alma", "availability",
    "release_broadcast_year", "notes", "element_info", "spac", "episode no.", "film base",
    "donor_code",
]


def preview_fields(df: DataFrame, names=PREVIEW_FIELDS) -> DataFrame:
    """Keep those of ``names`` that exist, in the given order."""
    return df.select(*[F.col(f"`{n}`") for n in names if n in df.columns])


def with_file_order(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Dense 0-based row index in file order (path, then place in the file) of
    a DataFrame read from files.

    A split of a file is read by one task, in order: rows are numbered inside
    their split and shifted by the rows of the splits before it.  The table of
    splits has one row per split of the input.
    """
    split = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start")]
    tagged = df.select(*[F.col(f"`{c}`") for c in df.columns], *split,
                       F.monotonically_increasing_id().alias("__mid"))
    splits = tagged.groupBy("__path", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.orderBy("__path", "__start").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).drop("__n", "__first")
    return (tagged.join(shifts, ["__path", "__start"])
                  .withColumn(name, F.col("__mid") + F.col("__shift"))
                  .select(*[F.col(f"`{c}`") for c in df.columns], name))


def one_per_key(df: DataFrame, key, name: str, *aggregates: Column) -> DataFrame:
    """``(name, aggregates...)``: one row per key, for the reduced side of a
    join.

    The key leaves the aggregate inside a struct.  The join then shuffles both
    sides, and only so can AQE split the partition of a hot key on the other
    side; an aggregate that feeds the join on its own key blocks the split.
    """
    reduced = df.groupBy(as_col(key).alias("__key")).agg(
        F.max(F.struct(as_col(key).alias(name))).alias("__one"), *aggregates)
    return reduced.select("__one.*", *[c for c in reduced.columns if c not in ("__key", "__one")])


def drop_missing_key(df: DataFrame, key) -> DataFrame:
    """Drop rows whose key is null or blank after strip."""
    k = as_col(key)
    return df.filter(k.isNotNull() & (strip(k) != ""))


def key_counts(df: DataFrame, key, name: str = "key") -> DataFrame:
    """``(key, n)`` with partial aggregation."""
    return df.groupBy(as_col(key).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def key_summary(df: DataFrame, key, source: str | None = None) -> DataFrame:
    """A1: total, distinct, repeats, singletons and empty-key rows in one row."""
    counts = key_counts(df, key)
    out = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeats"),
        F.count_if(F.col("n") == 1).alias("singletons"),
        F.coalesce(F.sum(F.when(F.col("key") == "", F.col("n"))), F.lit(0)).cast("long").alias("empty"),
    )
    if source is not None:
        out = out.select(F.lit(source).alias("source"), "*")
    return out


def compound_summary(df: DataFrame, col, source: str | None = None) -> DataFrame:
    """A2: total rows, distinct non-null values, single and multiple (``|``)
    distinct values, and null (empty) cells - one aggregation pass."""
    c = as_col(col)
    multi = c.contains("|")
    out = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(c).alias("distinct_values"),
        F.count_distinct(F.when(~multi, c)).alias("single_values"),
        F.count_distinct(F.when(multi, c)).alias("multiple_values"),
        F.count_if(c.isNull()).alias("empty"),
    )
    if source is not None:
        out = out.select(F.lit(source).alias("source"), "*")
    return out


def singletons(df: DataFrame, key, name: str = "key") -> DataFrame:
    """A3: keys occurring exactly once."""
    return key_counts(df, key, name).filter(F.col("n") == 1).select(name)


def repeats(df: DataFrame, key, name: str = "key") -> DataFrame:
    """A3: keys occurring more than once."""
    return key_counts(df, key, name).filter(F.col("n") > 1).select(name)


def unique_rows(df: DataFrame, key, name: str = "key") -> DataFrame:
    """Rows whose key occurs exactly once, with the row as ``row`` struct.

    One aggregation: ``count`` and ``any_value`` combine map-side, so the row
    of a singleton key is carried through the same shuffle that counts it.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (df.groupBy(as_col(key).alias(name))
              .agg(F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*cols)).alias("row"))
              .filter(F.col("n") == 1)
              .select(name, "row"))


def ids_by_key(df: DataFrame, key, ident, name: str = "key") -> DataFrame:
    """A4: one ``(key, n, id)`` row per source row; ``n`` is how many ids the
    key has.

    The reference keeps ``key -> list of ids``; a list per key is an unbounded
    group (the blank key can hold millions of ids), so the table is long and
    whole: no list is built for any key.
    """
    long = df.select(as_col(key).alias(name), as_col(ident).cast("string").alias("id"))
    counts = one_per_key(long, name, "__k", F.count(F.lit(1)).alias("n"))
    return long.join(counts, F.col(name).eqNullSafe(F.col("__k"))).select(name, "n", "id")


def _key_for_grouping(c: Column) -> Column:
    # Long texts are grouped by their SHA-256 digest so the shuffle carries 64
    # characters instead of the whole text; nulls form their own group as in
    # pandas ``duplicated``.
    return F.coalesce(F.sha2(c.cast("string"), 256), F.lit("<null>"))


def duplicate_rows(df: DataFrame, key, ordinal, hashed: bool = True) -> DataFrame:
    """Every member of a key group with more than one row, plus
    ``original_row_number`` = 0-based ordinal + 2 (header + 1-based rows).

    Skew-safe: group counts are partially aggregated, then a semi join keeps
    the members; AQE splits a hot key on the big side of the join.
    """
    k = as_col(key)
    gk = _key_for_grouping(k) if hashed else k
    tagged = df.withColumn("__gk", gk)
    dup_keys = one_per_key(tagged, "__gk", "__gk", F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__gk")
    return (tagged.join(dup_keys, "__gk", "left_semi")
                  .withColumn("original_row_number", as_col(ordinal) + 2)
                  .drop("__gk"))


def without_duplicates(df: DataFrame, key, ordinal) -> DataFrame:
    """W1, removal half: the sheet without the repeats of a key.  The first
    row of each key group stays; null keys form one group, as in W1."""
    return keep_first(df, key, ordinal, hashed=True)


def keep_first(df: DataFrame, key, ordinal, hashed: bool = False) -> DataFrame:
    """Keep the row with the lowest ordinal per key (nulls group together).

    ``min_by`` over a struct of the row is a partial aggregate: each map task
    forwards one candidate per key, so a hot key never lands whole in a task.
    """
    k = as_col(key)
    gk = _key_for_grouping(k) if hashed else k
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (df.groupBy(gk.alias("__gk"))
              .agg(F.min_by(F.struct(*cols), as_col(ordinal)).alias("__row"))
              .select("__row.*"))


def keep_last(df: DataFrame, key, ordinal) -> DataFrame:
    """Last row wins per key (J6, J7, J9 duplicates)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (df.groupBy(as_col(key).alias("__gk"))
              .agg(F.max_by(F.struct(*cols), as_col(ordinal)).alias("__row"))
              .select("__row.*"))


def ordered_distinct(arr) -> Column:
    """De-duplicate an array keeping first occurrences (order preserving)."""
    return F.array_distinct(as_col(arr))
