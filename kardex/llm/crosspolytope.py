"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its hash is the signed axis with the largest coordinate.  ``hashes``
of these make a bucket of one table; each vector also enters the buckets of its
next-best axes (multiprobe).  Vectors that share a bucket are compared by exact
cosine.  Equal vectors are one class, compared once.  A crowded bucket is cut
into tiles, so that no task holds more than two blocks of it; pairs are counted
where they are found and never written out.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, field
from kardex.llm.components import connected_components


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two wide)."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, d) / math.sqrt(d)


class CrossPolytope:
    def __init__(self, dim: int, tables: int, hashes: int, probes: int, seed: int):
        self.dim, self.tables, self.hashes, self.probes = dim, tables, hashes, probes
        self.width = max(2, 1 << (dim - 1).bit_length())
        draw = np.random.default_rng([seed, dim])
        self.signs = draw.choice([-1.0, 1.0], size=(tables, hashes, 3, self.width))
        self.near = min(3, 2 * self.width)
        self.combos = np.array(list(itertools.product(range(self.near), repeat=hashes)))

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, tables * probes) bucket ids of unit vectors."""
        n = len(vectors)
        x = np.zeros((n, self.width))
        x[:, :self.dim] = vectors
        out = np.empty((n, self.tables, min(self.probes, len(self.combos))), np.int64)
        for t in range(self.tables):
            axes, losses = [], []
            for k in range(self.hashes):
                y = x
                for signs in self.signs[t, k]:
                    y = hadamard(y * signs)
                both = np.concatenate([y, -y], axis=1)
                top = np.argpartition(-both, self.near - 1, axis=1)[:, :self.near]
                value = np.take_along_axis(both, top, axis=1)
                by = np.argsort(-value, axis=1, kind="stable")
                top, value = np.take_along_axis(top, by, axis=1), np.take_along_axis(value, by, axis=1)
                axes.append(top)
                losses.append((value[:, :1] - value) ** 2)
            loss = sum(losses[k][:, self.combos[:, k]] for k in range(self.hashes))
            best = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
            code = np.zeros_like(best)
            for k in range(self.hashes):
                code = code * (2 * self.width) + np.take_along_axis(axes[k], self.combos[:, k][best], axis=1)
            out[:, t] = (self.dim * self.tables + t) * (2 * self.width) ** self.hashes + code
        return out.reshape(n, -1)


def tables_for(hashes: int) -> int:
    """Tables that keep recall as buckets get narrower: with four probes, of
    pairs at cosine 0.9 at least nine in ten meet for one to four hashes."""
    return 12 + 6 * max(0, hashes - 2)


def _units(flat: np.ndarray) -> np.ndarray:
    x = flat.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _classes(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v, key)``; ``v`` (the bytes) is null for a vector that is null,
    empty, zero, or has a null or non-finite component."""
    kind = "<f4" if isinstance(rows.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    schema = T.StructType([field(rows, id_col, "id"), T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            column, values = batch.column(1), []
            for i in range(len(column)):
                cell = column[i]
                got = None
                if cell.is_valid and cell.values.null_count == 0 and len(cell.values):
                    x = cell.values.to_numpy(zero_copy_only=False).astype(kind)
                    wide = x.astype(np.float64)
                    norm = np.linalg.norm(wide) if np.isfinite(wide).all() else 0.0
                    if 0 < norm < np.inf:
                        got = x.tobytes()
                values.append(got)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.field(0).type), pa.array(values, pa.binary())],
                                             schema=out)

    return rows.select(id_col, vector_col).mapInArrow(run, schema).withColumn("key", F.sha2("v", 256)), kind


def _group(ids, weights, sides, vectors, hasher, bucket, limit):
    """Compares one bucket (or tile); yields ``(id, links, low)``: the weight of
    the links counted here and the lowest id of its component here."""
    units = _units(vectors)
    linked = units @ units.T >= limit
    np.fill_diagonal(linked, False)
    if sides is not None:
        linked &= sides[:, None] != sides[None, :]
    if not linked.any():
        return None
    low = np.arange(len(ids))[np.argsort(np.argsort(ids))]
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], len(ids)).min(axis=1))
        new = np.minimum(new, new[np.argsort(ids)[new]])
        if (new == low).all():
            break
        low = new
    own = np.flatnonzero(linked.any(axis=1))
    all_buckets = np.zeros((len(ids), hasher.tables, hasher.probes), np.int64)
    all_buckets[own] = hasher.buckets(units[own]).reshape(len(own), hasher.tables, -1)
    a, b = np.nonzero(np.triu(linked))
    links = np.zeros(len(ids), np.int64)
    for at in range(0, len(a), 50_000):
        x, y = a[at:at + 50_000], b[at:at + 50_000]
        first = np.full(len(x), np.iinfo(np.int64).max)
        # A pair that meets in several buckets counts in the smallest of them.
        for p in range(hasher.probes):
            for q in range(hasher.probes):
                same = np.where(all_buckets[x, :, p] == all_buckets[y, :, q], all_buckets[x, :, p], np.iinfo(np.int64).max)
                first = np.minimum(first, same.min(axis=1))
        here = first == bucket
        np.add.at(links, x[here], weights[y[here]])
        np.add.at(links, y[here], weights[x[here]])
    return ids[own], links[own], np.sort(ids)[low[own]]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: float = 0.9,
                    tables: int | None = None, hashes: int | None = None, probes: int = 4, tile: int = 1024,
                    seed: int = 17) -> DataFrame:
    """One row per vector: ``id, n_links, component``.

    ``n_links`` counts the other rows whose cosine is at least ``limit``, as
    found; ``component`` is the smallest id reachable.  ``hashes`` per table
    follow from the number of classes (about 32 a bucket) unless given, and
    ``tables`` from the hashes (``tables_for``).  Classes are numbered, and
    told apart by 256 bits.

    Defined cases: a vector that is null, empty, zero or holds a null or
    non-finite component links with nothing and is its own component; vectors
    of different length never link; a null id is no component unless all its
    ids are null; equal rows link with each other; an empty table gives none.
    """
    named, kind = _classes(rows, id_col, vector_col)
    named = cut(named)
    size = np.dtype(kind).itemsize
    # The checkpoint makes the numbers final.
    classes = cut(named.where("v is not null").groupBy("key").agg(
        F.min("v").alias("v"), F.min("id").alias("low"), F.count("*").alias("n")).withColumn(
        "node", F.monotonically_increasing_id()))
    count = classes.count()
    widest = classes.agg(F.max(F.octet_length("v"))).first()[0] or size
    axes = 2 * max(2, 1 << (widest // size - 1).bit_length())
    hashes = hashes or max(1, math.ceil(math.log(max(2, count / 32)) / math.log(axes)))
    tables = tables or tables_for(hashes)

    def hasher(dim: int, memory={}):  # noqa: B006 (one set of rotations per task and width)
        if dim not in memory:
            made = CrossPolytope(dim, tables, hashes, probes, seed)
            made.probes = min(probes, len(made.combos))
            memory[dim] = made
        return memory[dim]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, weights, values = (batch.column(i) for i in range(3))
            cells = values.to_pylist()
            lengths = np.array([len(v) for v in cells])
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                flat = np.frombuffer(b"".join([cells[i] for i in at]), kind).reshape(len(at), -1)
                found = hasher(flat.shape[1]).buckets(_units(flat))
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(at)), weights.take(pa.array(at)), values.take(pa.array(at)),
                     pa.array(found.tolist(), pa.list_(pa.int64()))], names=["node", "n", "v", "buckets"])

    coded = cut(classes.select("node", "n", "v").mapInArrow(assign, "node long, n long, v binary, buckets array<long>"))
    placed = coded.select("node", "n", "v", F.explode(F.array_distinct("buckets")).alias("bucket"))
    sizes = cut(placed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"))
    crowded = sizes.select("bucket", F.ceil(F.col("members") / F.lit(tile)).alias("blocks"))
    placed = placed.join(crowded, "bucket").withColumn("side", F.pmod(F.xxhash64("node"), "blocks"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "n", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            held = None
            for batch in batches:
                table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
                key = np.column_stack([table.column(k).to_numpy() for k in ("bucket", "i", "j")])
                edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
                last = edges[-1] if len(edges) else 0
                yield table.slice(0, last), np.concatenate([[0], edges])
                held = table.slice(last)
            if held is not None and held.num_rows:
                yield held, np.array([0, held.num_rows])

        for table, edges in groups():
            if not table.num_rows:
                continue
            bucket, i, j, side, ids, weights = (table.column(k).to_numpy() for k in ("bucket", "i", "j", "side", "node", "n"))
            values = table.column("v").combine_chunks()
            found = []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if e - s < 2:
                    continue
                flat = np.frombuffer(b"".join(values.slice(s, e - s).to_pylist()), kind).reshape(e - s, -1)
                got = _group(ids[s:e], weights[s:e], side[s:e] if i[s] != j[s] else None, flat, hasher(flat.shape[1]),
                             bucket[s], limit)
                if got is not None:
                    found.append(got)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)],
                                                 names=["node", "links", "low"])

    met = cut(tiled.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(
        compare, "node long, links long, low long"))
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(met.select(F.col("node").alias("a"), F.col("low").alias("b")))
    whole = (classes.join(links, "node", "left").join(parts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = whole.groupBy("component").agg(F.max(F.struct("component")).alias("r"), F.min("low").alias("least")).select(
        "r.component", "least")
    answer = whole.join(least, "component").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least")
    return named.select("id", "key").join(answer, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("least")).alias("component"))
