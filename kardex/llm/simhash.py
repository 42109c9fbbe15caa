"""SimHash near-duplicates with a pigeonring filter.

``fingerprints`` makes 64-bit SimHash values.  ``links`` finds the pairs of
distinct fingerprints within ``max_bits`` bits:

* The 64 bits are cut into a ring of ``segments`` segments.  By the pigeonring
  principle, two values within ``max_bits`` have a start segment from which
  each chain of l consecutive segments differs in at most
  ``l * max_bits / segments`` bits.  The first few budgets round down to zero,
  so this prefix of the chain is equal: it is the join key, one per start.
* In each bucket the longer chains must stay within their budgets before the
  full Hamming distance is taken.
* A crowded bucket (a large group of near copies) would give pairs with the
  square of its size.  Its members link through their one-bit neighbours
  instead: two values are within two bits exactly if they share a value that
  is at most one bit away from both.  That is linear and loses no link.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, field, hash_side, map_slices, row_key, texts
from kardex.llm.components import connected_components

_OFFSET = np.arange(8, dtype=np.int32) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the lower-cased word shingles (repeats count); no words: 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= width:
        digests, n = xxhash.xxh64_digest(flat, seed), 1
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        n = len(words) - width + 1
        starts = [0, *ends[:n - 1].tolist()]
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(flat[s:e], seed) for s, e in zip(starts, (ends[width - 1:] - 1).tolist())])
    cells = np.frombuffer(digests, np.uint8).reshape(n, 8) + _OFFSET
    counts = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * counts > n).ravel()).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 seed: int = 42) -> DataFrame:
    """``(id, fp)`` with ``fp`` the fingerprint's 64 bits as a signed long."""
    schema = T.StructType([field(docs, id_col, "id"), T.StructField("fp", T.LongType())])

    def run(batch):
        values = np.array([fingerprint(t, width, seed) for t in texts(batch.column(1))], np.uint64)
        return {"id": batch.column(0), "fp": values.view(np.int64)}

    return map_slices(docs.select(id_col, text_col), run, schema)


def chains(max_bits: int, segments: int) -> list[list[tuple[int, int]]]:
    """For each start on the ring: (mask, budget) of each chain length; masks
    are signed longs."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    masks = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(segments)]
    out = []
    for start in range(segments):
        mask, chain = 0, []
        for length in range(1, segments + 1):
            mask |= masks[(start + length - 1) % segments]
            chain.append((mask - (1 << 64) if mask >> 63 else mask, length * max_bits // segments))
        out.append(chain)
    return out


def links(distinct: DataFrame, max_bits: int = 2, segments: int = 7, crowd: int = 64) -> DataFrame:
    """Links ``(a, b)`` whose components are those of "within ``max_bits``"
    among the distinct values ``fp``.  All pairs of a bucket are compared up
    to ``crowd`` members; larger buckets link through shared neighbours (for
    ``max_bits`` 2; other limits compare every pair)."""
    ring = chains(max_bits, segments)
    exact = sum(1 for _, budget in ring[0] if budget == 0)
    keyed = cut(distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(chain[exact - 1][0])).alias("part"))
        for i, chain in enumerate(ring)])).alias("k")).select("fp", "k.start", "k.part"))
    sizes = (keyed.groupBy("start", "part").agg(F.max(F.struct("start", "part")).alias("r"), F.count("*").alias("n"))
             .where("n > 1").select("r.start", "r.part", "n"))
    members = cut(keyed.join(sizes, ["start", "part"]))
    small = members.where(F.col("n") <= crowd) if max_bits == 2 else members
    left = small.select("start", "part", F.col("fp").alias("a"))
    right = small.select("start", "part", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    within = F.lit(False)
    for i, chain in enumerate(ring):
        ok = F.col("start") == i
        for mask, budget in chain[exact:]:
            ok = ok & (F.bit_count(differ.bitwiseAND(F.lit(mask))) <= budget)
        within = within | ok
    pairs = (left.join(right, ["start", "part"]).where("a < b").where(within)
             .where(F.bit_count(differ) <= max_bits).select("a", "b"))
    if max_bits != 2:
        return pairs.distinct()
    flips = [0] + [1 << i for i in range(63)] + [-(1 << 63)]
    stars = members.where(F.col("n") > crowd).select("fp").distinct().select(
        F.col("fp").alias("a"), F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("z"))
    stars = cut(stars)
    first = (stars.groupBy("z").agg(F.min(F.struct("z", "a")).alias("r"), F.count("*").alias("n"))
             .where("n > 1").select("r.z", F.col("r.a").alias("b")))
    return pairs.union(stars.join(first, "z").where("a <> b").select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 2, segments: int = 7, crowd: int = 64) -> DataFrame:
    """One row per document: ``id, fp, component, group``: the smallest id
    reachable, and a fingerprint that names the group.

    Defined cases: null or empty text has fingerprint zero and links like any
    other; a null id never becomes a component unless all its ids are null;
    repeated rows stay repeated; an empty table gives no rows; other columns
    are not read.
    """
    marks = cut(fingerprints(docs, id_col, text_col, width))
    classes = cut(marks.groupBy("fp").agg(F.min("id").alias("low")))
    nodes = connected_components(links(classes.select("fp"), max_bits, segments, crowd)).withColumnRenamed("node", "fp")
    named = classes.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = named.groupBy("component").agg(F.max(F.struct("component")).alias("r"),
                                            F.min("low").alias("low")).select("r.component", F.col("low").alias("least"))
    answer = named.join(lowest, "component").select("fp", "component", "least")
    return marks.join(answer, "fp").select("id", "fp", F.col("least").alias("component"), F.col("component").alias("group"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group; of rows equal
    in the id one stays (null ids come last, rows equal in the id are ordered
    by their columns' hash).

    Decided on narrow rows: the id and a 128-bit digest of the text.  The
    texts then meet the keys of those to go, once, without a sort.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = row_key(id_col, text_col)
    found = near_duplicates(docs.select(key.alias("id"), F.col(text_col).alias("text")), "id", "text", **more)
    # A key stands for its rows: which of these stays does not matter yet.
    keys = cut(found.groupBy("id", "component").agg(F.count("*").alias("n")).select(
        F.col("id").alias("__key"), (F.col("id") == F.col("component")).alias("__stays"), (F.col("n") > 1).alias("__many")))
    out = keys.where(~F.col("__stays")).select("__key")
    marked = docs.withColumn("__key", key)
    left = marked.join(hash_side(out), "__key", "left_anti")
    many = keys.where("__stays AND __many").select("__key")
    if many.isEmpty():
        return left.select(*columns)
    # Rows equal in id and text: one of each, merged before they are shuffled.
    some = hash_side(many)
    merged = left.join(some, "__key", "left_semi").groupBy("__key").agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__row")).select("__row.*")
    return left.join(some, "__key", "left_anti").select(*columns).unionAll(merged)


def as_hex(column: Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
