"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (by a seeded hash of the id) and laid end
to end; the stream is cut into blocks of equal words.  The golden-ratio lattice
``p(n) = n * a mod N`` (``a`` next to ``N`` over the golden ratio, coprime with
``N``) maps slot n through the cumulative block counts of the sources: each
source gets exactly its share, spread evenly over all slots.  The r-th slot of
a source takes its r-th block; after the end of the stream it starts anew.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kardex.llm.common import cut, hash_side, row_key


def running_sum(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the group's earlier rows.  Rows
    must carry ``bin``, the leading part of the order; a group is summed bin
    by bin, so that a large group is not one task's work."""
    within = Window.partitionBy(group, "bin").orderBy(*order)
    sums = df.groupBy(group, "bin").agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy("__g").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(group).alias("__g"), F.col("bin").alias("__bin"), "__sum").withColumn(
        "__ahead", F.coalesce(F.sum("__sum").over(ahead), F.lit(0))).drop("__sum")
    return (df.withColumn("__in", F.coalesce(F.sum(value).over(
        within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("bin") == F.col("__bin")))
        .withColumn(name, F.col("__ahead") + F.col("__in")).drop("__in", "__ahead", "__g", "__bin"))


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources(source, source_size)`` -> adds ``rank`` and ``target``.

    Sources in code-point order (null last) weigh ``weights``, repeating, and
    divide ``share`` times all words; none gets above ``most`` times its size,
    the excess going to the others by weight.  One row per source: the windows
    here see the list of sources, not documents.
    """
    whole = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    by = whole.orderBy(F.col("__cap") / F.col("__w"), "rank")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    # Water level if exactly the sources before this one are full.
    level = (F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
             ) / F.sum("__w").over(after)
    open_level = F.when(F.col("__level") <= F.col("__cap") / F.col("__w"), F.col("__level"))
    first = F.min_by(open_level, F.when(open_level.isNotNull(), F.struct(F.col("__cap") / F.col("__w"), "rank"))).over(whole)
    return (ranked.withColumn("__level", level).withColumn("__first", first)
            .withColumn("target", F.least("__cap", F.coalesce(F.col("__w") * F.col("__first"), F.col("__cap"))))
            .select("source", "source_size", "rank", "target"))


def golden_step(n: int) -> int:
    """The multiplier of the lattice of ``n`` points."""
    step = max(1, round(n / ((1 + 5 ** 0.5) / 2)))
    while math.gcd(step, n) != 1:
        step += 1
    return step


def schedule(streams: DataFrame, per_source: DataFrame, block: int) -> DataFrame:
    """``(slot, source, block, row, start, end)``: which words of which stream
    row each slot takes; ``start, end`` are positions in the source's stream,
    which runs on into its second round."""
    plan = cut(per_source.withColumn("words", F.round("target").cast("long"))
               .withColumn("blocks", F.ceil(F.col("words") / F.lit(block)).cast("long")).where("blocks > 0"))
    total = plan.agg(F.sum("blocks")).first()[0] or 0
    if total == 0:
        return streams.limit(0).select(F.lit(0).cast("long").alias("slot"), "source", F.lit(0).cast("long").alias("block"),
                                       "begin", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    cover = 1 << 16
    edges = plan.withColumn("first", F.sum("blocks").over(Window.orderBy("rank")) - F.col("blocks"))
    edges = edges.withColumn("tile", F.explode(F.sequence(
        F.floor(F.col("first") / cover), F.floor((F.col("first") + F.col("blocks") - 1) / cover))))
    spark, step = streams.sparkSession, golden_step(total)
    points = spark.range(total).select(
        F.col("id").alias("slot"),
        F.expr(f"cast(pmod(cast(id as decimal(20,0)) * cast({step} as decimal(18,0)), cast({total} as decimal(18,0))) as long)").alias("point"))
    points = points.withColumn("tile", F.floor(F.col("point") / cover))
    slots = (points.join(edges, "tile").where("point >= first and point < first + blocks")
             .select("slot", "source", "rank", "words", F.lit(1).cast("long").alias("one"))
             .withColumn("bin", F.floor(F.col("slot") / 4096)))
    slots = running_sum(slots, "rank", ["slot"], "one", "block")
    sized = plan.select(F.col("rank"), F.col("source").alias("__s"), F.col("source_size").alias("length"), "words")
    # A stream row lies in round 0 and again, one stream length later, in round 1.
    laid = (streams.where("size > 0").select("source", "begin", "size")
            .join(sized, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
            .withColumn("round", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("from", F.col("begin") + F.col("round") * F.col("length"))
            .withColumn("to", F.least(F.col("from") + F.col("size"), "words")).where("from < to")
            .withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)))))
    return laid.drop("source", "words", "length", "round", "size").join(
        slots.select("rank", "block", "slot", "source"), ["rank", "block"]).select(
        "slot", "source", "block", "begin", F.greatest("from", F.col("block") * block).alias("start"),
        F.least("to", (F.col("block") + 1) * block).alias("end"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, block: int = 4096,
        seed: int = 7, rows_per_bin: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The mixed documents and the schedule.

    First frame, one row per document: ``id, source, size, source_size,
    target, taken``.  Second frame: see ``schedule``; ``begin`` names the
    document's place in its source's stream.

    Defined cases: a null text has size 0; a document without words takes
    nothing; null is a source of its own, the last; repeated rows are rows of
    their own; an empty table gives none; if nothing has words all targets are
    0.  Reruns agree: the shuffle is a hash of id and text.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words.alias("size"),
                           F.xxhash64(F.lit(seed), id_col, text_col).alias("h")))
    counted = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    per_source = cut(targets(counted.drop("n"), weights, share, most))
    # Each source has bins by its own number of rows: all bins are about as large.
    bins = counted.select(F.col("source").alias("__bs"), F.ceil(F.col("n") / rows_per_bin).cast("long").alias("__bins"))
    binned = rows.join(bins, F.col("source").eqNullSafe(F.col("__bs"))).withColumn("bin", F.pmod(F.xxhash64("h"), F.col("__bins")))
    streams = cut(running_sum(binned.drop("__bs", "__bins"), "source", ["h", "id", "size"], "size", "begin").drop("bin", "h"))
    pieces = schedule(streams, per_source, block)
    taken = pieces.groupBy(F.col("source").alias("__ts"), F.col("begin").alias("__tb")).agg(
        F.sum(F.col("end") - F.col("start")).alias("__taken"))
    mixed = (streams.join(taken, F.col("source").eqNullSafe(F.col("__ts")) & (F.col("begin") == F.col("__tb"))
                          & (F.col("size") > 0), "left")
             .join(per_source.select(F.col("source").alias("__ps"), "source_size", "target"),
                   F.col("source").eqNullSafe(F.col("__ps")))
             .select("id", "source", "size", "source_size", "target", F.coalesce("__taken", F.lit(0)).alias("taken")))
    return mixed, pieces


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """What ``mix`` decides on, with the texts: ``id, text, source, size,
    source_size, target, taken``.  The schedule sees narrow rows; the texts
    meet their rows once, without a sort.  Defined cases are those of ``mix``."""
    keyed = docs.withColumn("__key", row_key(id_col, text_col))
    mixed = cut(mix(keyed, "__key", text_col, **more)[0].withColumnRenamed("id", "__of"))
    own = keyed.select("__key", F.col(text_col).alias("text"))
    many = mixed.groupBy("__of").agg(F.count("*").alias("n")).where("n > 1").select(F.col("__of").alias("__key"))
    if not many.isEmpty():
        # Rows equal in id and text: their text once, merged before it is shuffled.
        some = hash_side(many)
        once = own.join(some, "__key", "left_semi").groupBy("__key").agg(F.first("text").alias("text"))
        own = own.join(some, "__key", "left_anti").unionByName(once)
    return own.join(hash_side(mixed), F.col("__key") == F.col("__of")).select(
        F.col("__key.key").alias("id"), "text", "source", "size", "source_size", "target", "taken")
