"""Compression of vectors to one code per part, with adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has its own
codebook, refined in rounds of assigning and averaging.  Bounds after Drake and
Hamerly keep the rounds cheap.  Of each part are kept

* its entry, and an upper bound of the distance to it,
* its ``b`` next closest entries with a lower bound each, in rising order, and
* one outer bound, a lower bound for all other entries.

When entries move, the bounds give way by the distance moved.  While the upper
bound stays below the least lower bound the entry cannot have changed, and no
distance is taken.  Else the distance to the entry is taken anew, then those to
the first few neighbours whose bounds are not clear of it, and only where the
outer bound is not clear either those to all entries.  ``b`` is adapted after each
round to what the parts of that position needed.

All is integer: upper bounds are rounded up, lower bounds and outer bounds down,
and whatever they leave open is settled by integer squared distances, ties to
the lower index.  So the codes equal those of comparing with every entry.

The bounds are a table in the shared folder, written anew each round and
discarded when the next one is complete.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, discard, field, map_slices, shared_dir

#: Lower bound where there is nothing to be bounded.
FAR = 1 << 62
#: Rows of one numpy step.
ROWS = 4096


def whole_root(squares: np.ndarray, up: bool = False) -> np.ndarray:
    """Integer square roots, rounded down or up."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root + (root * root < squares) if up else root


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of parts ``(n, d)`` to ``(k, d)`` or ``(n, k, d)`` entries."""
    gap = x[:, None, :] - entries
    return np.einsum("nkd,nkd->nk", gap, gap)


def by_distance(square: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Order of each row by distance, ties to the lower entry."""
    return np.lexsort((entry, square), axis=1)


@dataclass
class Bounds:
    """Of the parts of one position: ``near (n, 1 + b)`` entries, the first one
    assigned; ``upper (n)``; ``lower (n, b)``; ``outer (n)``."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    @staticmethod
    def fresh(x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        n, k = len(x), len(book)
        square = squared(x, book)
        order = by_distance(square, np.broadcast_to(np.arange(k), (n, k)))
        root = np.take_along_axis(square, order, 1)
        upper = whole_root(root[:, 0], up=True)
        root = whole_root(root[:, 1:b + 2])
        outer = root[:, b] if k > b + 1 else np.full(n, FAR)
        return Bounds(order[:, :b + 1], upper, root[:, :b], outer)

    def move(self, moved: np.ndarray) -> None:
        """Entries moved by at most ``moved``."""
        self.upper = self.upper + moved[self.near[:, 0]]
        self.lower = self.lower - moved[self.near[:, 1:]]
        self.outer = np.where(self.outer == FAR, FAR, self.outer - moved.max(initial=0))
        self.sort()

    def sort(self) -> None:
        order = np.argsort(self.lower, axis=1, kind="stable")
        self.lower = np.take_along_axis(self.lower, order, 1)
        self.near = np.column_stack([self.near[:, 0], np.take_along_axis(self.near[:, 1:], order, 1)])

    def depth(self) -> np.ndarray:
        """Number of neighbours whose bounds are not clear of the upper bound;
        ``b + 1`` if the outer bound is not."""
        bounds = np.minimum(np.column_stack([self.lower, self.outer]), self.outer[:, None])
        return np.count_nonzero(self.upper[:, None] >= bounds, axis=1)

    def settle(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Makes the assigned entry the nearest one; returns the depths gone to."""
        b = self.lower.shape[1]
        depth = self.depth()
        rows = np.flatnonzero(depth)
        self.upper[rows] = whole_root(squared(x[rows], book[self.near[rows, :1]])[:, 0], up=True)
        depth = self.depth()
        for z in range(1, b + 1):
            rows = np.flatnonzero(depth == z)
            if len(rows):
                entry = self.near[rows, :z + 1]
                square = squared(x[rows], book[entry])
                order = by_distance(square, entry)
                square = np.take_along_axis(square, order, 1)
                self.near[rows, :z + 1] = np.take_along_axis(entry, order, 1)
                self.upper[rows] = whole_root(square[:, 0], up=True)
                self.lower[rows, :z] = whole_root(square[:, 1:])
        rows = np.flatnonzero(depth == b + 1)
        if len(rows):
            new = Bounds.fresh(x[rows], book, b)
            self.near[rows], self.upper[rows], self.lower[rows], self.outer[rows] = new.near, new.upper, new.lower, new.outer
        self.sort()
        return depth

    def shrink(self, b: int) -> None:
        if b < self.lower.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b])
            self.near, self.lower = self.near[:, :b + 1], self.lower[:, :b]


def lists(column: pa.Array, rows: int) -> np.ndarray:
    """Equally long lists as a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def bytes_of(column: pa.Array, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).astype(np.int64).reshape(rows, -1)


def load(near: pa.Array, bounds: pa.Array, rows: int, widths: list[int]) -> list[Bounds]:
    entries, values = bytes_of(near, rows), lists(bounds, rows)
    out, e, v = [], 0, 0
    for b in widths:
        out.append(Bounds(entries[:, e:e + b + 1], values[:, v].copy(), values[:, v + 1:v + 1 + b], values[:, v + 1 + b].copy()))
        e, v = e + b + 1, v + b + 2
    return out


def store(parts: list[Bounds], depths: np.ndarray) -> dict:
    near = np.column_stack([p.near for p in parts]).astype(np.uint8)
    bounds = np.column_stack([c for p in parts for c in (p.upper, p.lower, p.outer)])
    n = len(near)
    return {"near": [r.tobytes() for r in near], "used": [r.tobytes() for r in depths.astype(np.uint8)],
            "bounds": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bounds.shape[1]),
                                               pa.array(bounds.ravel()))}


def _totals(state: DataFrame, widths: list[int], entries: int) -> tuple[dict, dict]:
    """Per (position, entry) the component sums and the count; per (position,
    depth) the number of parts."""
    parts = len(widths)
    firsts = np.cumsum([0, *[b + 1 for b in widths[:-1]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = counts = depths = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                n = some.num_rows
                x = lists(some.column(0), n).reshape(n, parts, -1)
                codes = bytes_of(some.column(1), n)[:, firsts] + entries * np.arange(parts)
                used = bytes_of(some.column(2), n) + 256 * np.arange(parts)
                if sums is None:
                    sums = np.zeros((parts * entries, x.shape[2]), np.int64)
                    counts, depths = np.zeros(parts * entries, np.int64), np.zeros(parts * 256, np.int64)
                np.add.at(sums, codes.ravel(), x.reshape(n * parts, -1))
                counts += np.bincount(codes.ravel(), minlength=len(counts))
                depths += np.bincount(used.ravel(), minlength=len(depths))
        if sums is not None:
            rows = [("entry", i, int(counts[i]), sums[i].tolist()) for i in np.flatnonzero(counts).tolist()]
            rows += [("depth", i, int(depths[i]), []) for i in np.flatnonzero(depths).tolist()]
            yield pa.RecordBatch.from_pylist([dict(zip(("kind", "at", "n", "sums"), r)) for r in rows], schema=pa.schema([
                ("kind", pa.string()), ("at", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    found = state.select("x", "near", "used").mapInArrow(run, "kind string, at int, n long, sums array<long>")
    number = F.posexplode_outer("sums").alias("d", "part")
    added = (found.select("kind", "at", "n", number).groupBy("kind", "at", "d")
             .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    sums: dict = {}
    for r in added:
        if r["kind"] == "entry":
            sums.setdefault(divmod(r["at"], entries), [r["n"], {}])[1][r["d"]] = int(r["total"])
    return sums, {divmod(r["at"], 256): r["n"] for r in added if r["kind"] == "depth"}


def _adapted(width: int, depths: dict[int, int], least: int, share: float) -> int:
    """Least b that would have sent at most a ``share`` more of the parts of
    a position to all entries."""
    allowed = share * sum(depths.values())
    return next(b for b in range(min(least, width), width + 1)
                if sum(n for d, n in depths.items() if b < d <= width) <= allowed)


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, share: float = 0.01) -> DataFrame:
    """One row per kept vector: ``id, code, error, label_error, codebooks_sha256``
    (two hex digits a part; squared error, its sum over equal labels; digest of
    all final entries).

    Defined cases: vectors that are null, hold null or non-finite components, or
    cannot be cut like the first kept one (another length, or none that
    ``parts`` divide) are dropped.  Codebooks start at the vectors of the
    smallest ids, null ids last, equal ids by their components; with fewer
    vectors than ``entries`` there are fewer entries.  Repeated rows stay
    repeated.  Null labels count as equal.  An empty table gives no rows; other
    columns are not read.  Raises ValueError where a squared error could exceed a long
    (components beyond about 2**30 / scale / sqrt(dimension)).
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError("one to 256 entries")
    e = F.col("e")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = rows.where(e.isNotNull() & finite & (F.size(e) > 0) & (F.size(e) % parts == 0))
    x = F.transform(e, lambda v: F.floor(v * scale))
    first = rows.orderBy(F.col("id").asc_nulls_last(), e).limit(1).collect()
    schema = "id %s, code string, error long, label_error long, codebooks_sha256 string" % rows.schema["id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], schema)
    dim = len(first[0]["e"])
    rows = rows.where(F.size(e) == dim)
    most = rows.agg(F.max(F.array_max(F.transform(e, F.abs)))).first()[0]
    limit = int(np.ceil(most * scale)) + 1
    if dim * (2 * limit) ** 2 >= FAR:
        raise ValueError(f"component {most} is too large for squared errors in 64 bits")
    narrow = "array<short>" if limit < 1 << 15 else "array<int>"
    rows = rows.select("id", "label", x.cast(narrow).alias("x"))
    start = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    books = np.array([r["x"] for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    k = len(start)
    least, widths = min(max(2, k // 8), k - 1), [min(max(4, k // 4), k - 1)] * parts
    kept = [field(rows, c) for c in ("id", "label", "x")]
    out = T.StructType([*kept, T.StructField("near", T.BinaryType()), T.StructField("used", T.BinaryType()),
                        T.StructField("bounds", T.ArrayType(T.LongType()))])
    folder = f"{shared_dir(spark)}/vector-codes-{uuid.uuid4()}"

    def begin(books=books, widths=widths):
        def run(batch):
            n = batch.num_rows
            x = lists(batch.column(2), n).reshape(n, parts, -1)
            found = [Bounds.fresh(x[:, p], books[p], widths[p]) for p in range(parts)]
            return dict(zip(("id", "label", "x"), batch.columns)) | store(found, np.zeros((n, parts)))
        return run

    def advance(books, moved, before, after, last=False):
        def run(batch):
            n = batch.num_rows
            x = lists(batch.column(2), n).reshape(n, parts, -1)
            found, depths = load(batch.column(3), batch.column(4), n, before), np.zeros((n, parts), np.int64)
            error = np.zeros(n, np.int64)
            for p, bounds in enumerate(found):
                bounds.move(moved[p])
                depths[:, p] = bounds.settle(x[:, p], books[p])
                if last:
                    error += squared(x[:, p], books[p][bounds.near[:, :1]])[:, 0]
                bounds.shrink(after[p])
            if last:
                codes = np.column_stack([b.near[:, 0] for b in found]).astype(np.uint8)
                return {"id": batch.column(0), "label": batch.column(1), "error": error, "code": [r.tobytes().hex() for r in codes]}
            return dict(zip(("id", "label", "x"), batch.columns)) | store(found, depths)
        return run

    path = f"{folder}/0"
    map_slices(rows, begin(), out, ROWS).write.parquet(path, compression="zstd")
    stored = list(widths)
    for turn in range(rounds):
        state = spark.read.parquet(path)
        sums, depths = _totals(state, stored, k)
        moved = np.zeros((parts, k), np.int64)
        new = books.copy()
        for (p, entry), (n, total) in sums.items():
            new[p, entry] = [total[d] // n for d in range(books.shape[2])]
            moved[p, entry] = whole_root(((new[p, entry] - books[p, entry]) ** 2).sum(keepdims=True), up=True)[0]
        books = new
        if turn:
            widths = [_adapted(b, {d: n for (q, d), n in depths.items() if q == p}, least, share)
                      for p, b in enumerate(stored)]
        if turn + 1 < rounds:
            then = f"{folder}/{turn + 1}"
            rows = state.select("id", "label", "x", "near", "bounds")
            map_slices(rows, advance(books, moved, stored, widths), out, ROWS).write.parquet(then, compression="zstd")
            discard(spark, path)
            path, stored = then, list(widths)
    answer = T.StructType([*kept[:2], T.StructField("error", T.LongType()), T.StructField("code", T.StringType())])
    state = spark.read.parquet(path).select("id", "label", "x", "near", "bounds")
    coded = cut(map_slices(state, advance(books, moved, stored, widths, last=True), answer, ROWS))
    discard(spark, folder)
    # The label leaves the sum in a struct, so that both sides of the join are
    # dealt anew and a label with very many rows can be split.
    summed = coded.groupBy("label").agg(F.first(F.struct("label")).alias("r"), F.sum(F.col("error").cast(
        "decimal(38,0)")).alias("s")).select(F.col("r.label").alias("same"), F.col("s").cast("long").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(summed, F.col("label").eqNullSafe(F.col("same"))).select(
        "id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
