"""Cross-source key matching and match classification (J1-J4, J6, J13, J14,
A8, A11).

Plans are declarative: per-source aggregations followed by equi-joins on the
normalised key.  The aggregates come out hash-partitioned on the key, so the
joins that follow reuse that partitioning (no extra exchange); AQE turns a
join into a broadcast only when the runtime size of one side is under the
configured threshold, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.functions._util import as_col
from kardex.functions.text import holdings_key, inventory_key, strip
from kardex.operators.keys import keep_first, keep_last, one_per_key, unique_rows

# Output columns of the perfect-match report, in order.
PERFECT_MATCH_COLUMNS = [
    "inventory_number", "holdings_id", "inventory_record_id", "digital_record_id",
    "inventory_title", "carrier_a", "carrier_a_location", "carrier_b",
    "carrier_b_location", "hard_drive_name", "file_folder_name",
    "sub_folder_name", "file_name",
]


def _text(c):
    # Missing / null values are reported as "" like ``dict.get(k, "")``.
    return F.coalesce(c.cast("string"), F.lit(""))


def perfect_matches(holdings: DataFrame, digital: DataFrame, inventory: DataFrame,
                    *, call_number="call_number", holding_id="holding_id",
                    inventory_no="inventory_no", inventory_id="inventory_id",
                    title="title", digital_key="inventory_number", pk="pk",
                    sort: bool = True) -> DataFrame:
    """Keys that occur exactly once in each source and in all three.

    Keys: holdings = spaces removed + upper; inventory = NBSP removed + upper;
    digital = raw.  Three partial aggregations (count + any_value) and two
    joins on the already-partitioned key.
    """
    h = unique_rows(holdings.select(holdings_key(as_col(call_number)).alias("__k"),
                                    as_col(holding_id).alias("holding_id")), "__k", "__k")
    i = unique_rows(inventory.select(inventory_key(as_col(inventory_no)).alias("__k"),
                                     as_col(inventory_id).alias("inventory_id"),
                                     as_col(title).alias("title")), "__k", "__k")
    dcols = ["carrier_a", "carrier_a_location", "carrier_b", "carrier_b_location",
             "hard_drive_name", "file_folder_name", "sub_folder_name", "file_name"]
    d = unique_rows(digital.select(as_col(digital_key).alias("__k"), as_col(pk).alias("pk"),
                                   *[(F.col(c) if c in digital.columns else F.lit(None).cast("string")).alias(c)
                                     for c in dcols]), "__k", "__k")
    joined = (d.withColumnRenamed("row", "d")
               .join(h.withColumnRenamed("row", "h"), "__k")
               .join(i.withColumnRenamed("row", "i"), "__k"))
    out = joined.select(
        F.col("__k").alias("inventory_number"),
        _text(F.col("h.holding_id")).alias("holdings_id"),
        _text(F.col("i.inventory_id")).alias("inventory_record_id"),
        _text(F.col("d.pk")).alias("digital_record_id"),
        _text(F.col("i.title")).alias("inventory_title"),
        _text(F.col("d.carrier_a")).alias("carrier_a"),
        _text(F.col("d.carrier_a_location")).alias("carrier_a_location"),
        _text(F.col("d.carrier_b")).alias("carrier_b"),
        _text(F.col("d.carrier_b_location")).alias("carrier_b_location"),
        _text(F.col("d.hard_drive_name")).alias("hard_drive_name"),
        _text(F.col("d.file_folder_name")).alias("file_folder_name"),
        _text(F.col("d.sub_folder_name")).alias("sub_folder_name"),
        _text(F.col("d.file_name")).alias("file_name"),
    )
    return out.orderBy("inventory_number") if sort else out


# ---------------------------------------------------------------------------
# Single / compound value classification
# ---------------------------------------------------------------------------

SINGLE_SECTIONS = {
    "S1": "Single value: several inventory, no holdings",
    "S2": "Single value: several holdings, no inventory",
    "S3": "Single value: several inventory, one holding",
    "S4": "Single value: several holdings, one inventory",
    "S5": "Single value: several of both",
    "S6": "Single value: no match",
}
COMPOUND_SECTIONS = {"M1": "Compound value: each part one record", "M2": "Compound value: a part with several records"}


def source_ids(holdings: DataFrame, inventory: DataFrame, *, call_number="call_number",
               holding_id="holding_id", inventory_no="inventory_no",
               inventory_id="inventory_id") -> DataFrame:
    """Long ``(key, source, id)`` table over both legacy sources (A4 long form)."""
    h = holdings.select(holdings_key(as_col(call_number)).alias("key"), F.lit("holdings").alias("source"),
                        as_col(holding_id).cast("string").alias("id"))
    i = inventory.select(inventory_key(as_col(inventory_no)).alias("key"), F.lit("inventory").alias("source"),
                         as_col(inventory_id).cast("string").alias("id"))
    return h.unionByName(i)


def source_counts(ids: DataFrame) -> DataFrame:
    """``(key, holdings_count, inventory_count)``: one partially aggregated shuffle."""
    return ids.groupBy("key").agg(
        F.count_if(F.col("source") == "holdings").alias("holdings_count"),
        F.count_if(F.col("source") == "inventory").alias("inventory_count"))


def sheet_values(sheet: DataFrame, col="inventory_value") -> DataFrame:
    """Distinct non-null sheet values (the reference's set of cell values)."""
    return sheet.select(as_col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()


def _single_section(h, f):
    return (F.when((f > 1) & (h == 0), "S1")
             .when((h > 1) & (f == 0), "S2")
             .when((f > 1) & (h == 1), "S3")
             .when((h > 1) & (f == 1), "S4")
             .when((f > 1) & (h > 1), "S5")
             .when((f == 0) & (h == 0), "S6")
             .otherwise("leftover"))


def classify_single_values(values: DataFrame, counts: DataFrame) -> DataFrame:
    """Class per distinct single (no ``|``) value.

    Output: ``section, inventory_number, original_value (null),
    holdings_count, inventory_count``.
    """
    singles = values.filter(~F.col("value").contains("|")).select(F.col("value").alias("key"))
    j = singles.join(counts, "key", "left")
    h = F.coalesce(F.col("holdings_count"), F.lit(0))
    f = F.coalesce(F.col("inventory_count"), F.lit(0))
    return j.select(_single_section(h, f).alias("section"), F.col("key").alias("inventory_number"),
                    F.lit(None).cast("string").alias("original_value"),
                    h.alias("holdings_count"), f.alias("inventory_count"))


def classify_compound_values(values: DataFrame, counts: DataFrame, dedupe: bool = True) -> DataFrame:
    """Split each ``|`` value; M1 when every part matches exactly one
    record in total, else M2 (emitting only the parts with >1 in a source)
    when any part does, else ``leftover``.  Then de-duplicate on
    ``(section, part)`` keeping the smallest original value.

    The group flags are a window over the compound value: values are
    distinct and a group is the parts of one cell, so it is bounded.
    """

    parts = (values.filter(F.col("value").contains("|"))
             .select(F.col("value").alias("original_value"),
                     F.explode(F.split(F.col("value"), r"\|")).alias("key")))
    j = parts.join(counts, "key", "left")
    h = F.coalesce(F.col("holdings_count"), F.lit(0))
    f = F.coalesce(F.col("inventory_count"), F.lit(0))
    w = Window.partitionBy("original_value")
    j = (j.withColumn("__h", h).withColumn("__f", f)
          .withColumn("__all_one", F.bool_and((F.col("__h") + F.col("__f")) == 1).over(w))
          .withColumn("__any_multi", F.bool_or((F.col("__h") > 1) | (F.col("__f") > 1)).over(w)))
    section = (F.when(F.col("__all_one"), "M1")
                .when(F.col("__any_multi"), "M2")
                .otherwise("leftover"))
    keep = F.col("__all_one") | ~F.col("__any_multi") | (F.col("__h") > 1) | (F.col("__f") > 1)
    out = (j.filter(keep)
            .select(section.alias("section"), F.col("key").alias("inventory_number"), "original_value",
                    F.col("__h").alias("holdings_count"), F.col("__f").alias("inventory_count")))
    if dedupe:
        out = (out.groupBy("section", "inventory_number")
                  .agg(F.min("original_value").alias("original_value"),
                       F.first("holdings_count").alias("holdings_count"),
                       F.first("inventory_count").alias("inventory_count")))
    return out


def attach_ids(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """Long report: one row per matched id; keys without ids keep one row with
    null ``source``/``record_id``.

    Written as inner join + anti join rather than a left join: the id side
    may hold a hot key (a third of all rows), and AQE can split a skewed
    partition on either side of an inner join but not on the right side of a
    left join.  The classes come out of joins on this key; passing them through
    ``one_per_key`` gives the join an exchange on both sides, without which
    AQE does not split.
    """
    names = classes.columns
    classes = one_per_key(classes, F.struct(*[F.col(c) for c in names]), "__c").select("__c.*")
    ids = ids.withColumnRenamed("key", "inventory_number").withColumnRenamed("id", "record_id")
    hit = classes.join(ids, "inventory_number")
    known = one_per_key(ids, "inventory_number", "inventory_number")
    miss = (classes.join(known, "inventory_number", "left_anti")
                   .withColumn("source", F.lit(None).cast("string"))
                   .withColumn("record_id", F.lit(None).cast("string")))
    return hit.unionByName(miss)


def class_counts(classes: DataFrame) -> DataFrame:
    """Rows per section."""
    return classes.groupBy("section").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------------------
# Variant-aware unique match
# ---------------------------------------------------------------------------

# Inventory-number prefixes that also index call-number suffix
# variants, and the suffixes themselves.
VARIANT_PREFIXES = ["DVD", "HFA", "VA", "VD", "XFE", "XFF", "XVE", "ZVB"]
VARIANT_SUFFIXES = [" M", " R", " T"]


def variant_index(df: DataFrame, value, ident, suffixes=VARIANT_SUFFIXES,
                  prefixes=VARIANT_PREFIXES, carry=()) -> DataFrame:
    """Index rows under their stripped value and, when the value starts with
    a listed prefix, under value + each suffix.  Blank values are skipped.
    ``carry`` columns ride along with the id."""
    v = strip(F.coalesce(as_col(value), F.lit("")))
    starts = F.lit(False)
    for p in prefixes:
        starts = starts | v.startswith(p)
    variants = F.array(v)
    if suffixes:
        variants = F.when(starts, F.array(v, *[F.concat(v, F.lit(s)) for s in suffixes])).otherwise(F.array(v))
    return (df.filter(v != "")
              .select(F.explode(variants).alias("key"), as_col(ident).alias("id"), *[F.col(c) for c in carry]))


def _exactly_one(idx: DataFrame, id_name: str, carry) -> DataFrame:
    row = F.any_value(F.struct(F.col("id").alias(id_name), *[F.col(c) for c in carry])).alias("__r")
    return (idx.groupBy("key").agg(F.count(F.lit(1)).alias("n"), row)
               .filter("n = 1").select("key", "__r.*"))


def unique_variant_match(digital: DataFrame, inventory: DataFrame, holdings: DataFrame, *,
                         digital_key="inventory_number", digital_ordinal="row_ordinal",
                         inventory_no="inventory_no", inventory_id="inventory_id",
                         call_number="call_number", holding_id="holding_id",
                         holdings_carry=(), inventory_carry=()) -> DataFrame:
    """First digital row per stripped key whose key has exactly one entry
    in the holdings variant index and exactly one in the inventory index.

    ``*_carry`` columns travel with the single matched entry through the
    same aggregation, so reports need no join back to the sources."""
    d = digital.withColumn("__key", strip(F.coalesce(as_col(digital_key), F.lit(""))))
    d = keep_first(d.filter(F.col("__key") != ""), "__key", digital_ordinal)
    hidx = variant_index(holdings, call_number, holding_id, carry=holdings_carry)
    iidx = variant_index(inventory, inventory_no, inventory_id, suffixes=[], carry=inventory_carry)
    h1 = _exactly_one(hidx, "holding_id", holdings_carry)
    i1 = _exactly_one(iidx, "inventory_id", inventory_carry)
    return (d.join(h1, d["__key"] == h1["key"]).drop("key")
             .join(i1, F.col("__key") == i1["key"]).drop("key")
             .withColumnRenamed("__key", "match_key"))


# ---------------------------------------------------------------------------
# Other joins
# ---------------------------------------------------------------------------

def match_by_call_number(holdings: DataFrame, inventory: DataFrame, *, call_number="call_number",
                         inventory_no="inventory_no", inventory_ordinal="row_ordinal") -> DataFrame:
    """Raw call number = raw inventory number; duplicate inventory keys:
    the last row wins; holdings rows are not de-duplicated."""
    inv = keep_last(inventory, inventory_no, inventory_ordinal)
    return holdings.join(inv, as_col(call_number) == inv[inventory_no])


def distinct_ids(df: DataFrame, col) -> DataFrame:
    """Distinct ids before any lookup."""
    return df.select(as_col(col).alias("id")).filter(F.col("id").isNotNull()).distinct()


def unmatched(left: DataFrame, right: DataFrame, left_key, right_key, reason: str) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` plus a reason column."""
    return (left.join(one_per_key(right, right_key, "__rk"), as_col(left_key) == F.col("__rk"), "left_anti")
                .withColumn("reason", F.lit(reason)))


def match_funnel(holdings: DataFrame, digital: DataFrame, inventory: DataFrame, *,
                 call_number="call_number", inventory_no="inventory_no",
                 digital_key="inventory_number") -> DataFrame:
    """Rows read, rows with a non-blank key and singleton keys per source,
    plus the number of perfect matches; one row per (stage, source)."""
    tagged = (holdings.select(holdings_key(as_col(call_number)).alias("k"), F.lit("holdings").alias("s"))
              .unionByName(digital.select(as_col(digital_key).alias("k"), F.lit("digital").alias("s")))
              .unionByName(inventory.select(inventory_key(as_col(inventory_no)).alias("k"), F.lit("inventory").alias("s"))))
    names = ("holdings", "digital", "inventory")
    # One aggregation per key over all sources, then one row of totals.
    counts = tagged.groupBy("k").agg(*[F.count_if(F.col("s") == n).alias(n) for n in names])
    keyed = strip(F.col("k")) != ""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = counts.agg(
        *[total(F.col(n)).alias(f"{n}_read") for n in names],
        *[total(F.when(keyed, F.col(n))).alias(f"{n}_keyed") for n in names],
        *[F.count_if(F.col(n) == 1).alias(f"{n}_singletons") for n in names],
        F.count_if(F.col("k").isNotNull() & (F.col("holdings") == 1) & (F.col("digital") == 1)
                   & (F.col("inventory") == 1)).alias("all_matched"))
    stages = [(n, s) for n in names for s in ("read", "keyed", "singletons")] + [("all", "matched")]
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("source"), F.lit(s).alias("stage"), F.col(f"{n}_{s}").alias("rows")) for n, s in stages])))
