"""Resampling by importance towards a target distribution.

Features are runs of up to three words, hashed into buckets by CRC-32.  Target
texts and all documents are counted by bucket; the log ratio of their shares is
a bucket's gain, the sum of gains over a document's features its weight, and the
highest weights plus Gumbel noise are drawn.

No run is ever written out or hashed as text.  The distinct words of a slice of texts,
each between delimiters, are the dictionary of an Aho-Corasick automaton; an
entry's payload is the CRC of the word, that of the word behind a delimiter,
and the length it adds.  One scan of the slice emits the payloads in order, and
payloads of adjacent words compose to the CRC of the run: appending n bytes is a
linear map of the CRC so far, which is looked up in four tables for n, and the
CRC of what is appended is added.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, field, parts_by_bytes, texts

#: Bytes of text that one automaton scans (a longer word is scanned whole).
SLICE_BYTES = 256 << 10
#: Words above this length stand in the dictionary by a number.
LONGEST = 512
_VALUE = itemgetter(1)

#: Lower-cases A-Z; all other ASCII but letters and digits becomes a space.
_PLAIN = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _byte_table() -> np.ndarray:
    """CRC-32 of one byte (the reflected polynomial that zlib uses)."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> 1) ^ np.where(value & 1, np.uint32(0xEDB88320), np.uint32(0))
    return value


class Append:
    """The maps of a CRC when bytes are appended, as four tables per length."""

    def __init__(self):
        one, bytes4 = _byte_table(), np.arange(256, dtype=np.uint32)
        start = np.stack([bytes4 << np.uint32(8 * i) for i in range(4)])
        self.known = {0: start, 1: (start >> np.uint32(8)) ^ one[start & 255]}

    @staticmethod
    def apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (table[0][crc & 255] ^ table[1][(crc >> np.uint32(8)) & 255] ^ table[2][(crc >> np.uint32(16)) & 255]
                ^ table[3][crc >> np.uint32(24)])

    def table(self, length: int) -> np.ndarray:
        if length not in self.known:
            half = self.table(length // 2)
            made = self.apply(half, half)
            made = self.apply(self.known[1], made) if length % 2 else made
            if length > LONGEST:
                return made
            self.known[length] = made
        return self.known[length]

    def tables(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One flat array for the distinct lengths, and each length's start in it."""
        distinct, place = np.unique(lengths, return_inverse=True)
        return np.concatenate([self.table(int(n)).ravel() for n in distinct]).astype(np.int64), place * 1024


@dataclass
class Piece:
    """Words of one text; the first ``lead`` were counted with the piece before."""

    row: int
    lead: int
    words: list[bytes]
    size: int


def pieces(rows: list[bytes | None], most: int) -> Iterator[Piece]:
    """Each text in pieces of about ``most`` bytes that end where words do."""
    for row, text in enumerate(rows):
        plain, start, tail = (text or b"").translate(_PLAIN), 0, []
        while start < len(plain):
            end = plain.find(b" ", start + most) if len(plain) - start > most else -1
            end = len(plain) if end < 0 else end
            words = plain[start:end].split()
            if words:
                yield Piece(row, len(tail), tail + words, end - start)
                tail = (tail + words)[-2:]
            start = end + 1


class Scanner:
    """Buckets of all features of some texts."""

    def __init__(self, buckets: int, slice_bytes: int = SLICE_BYTES):
        self.buckets, self.slice_bytes, self.append = buckets, slice_bytes, Append()

    def scan(self, some: list[Piece]) -> tuple[np.ndarray, np.ndarray]:
        """The row of each word, and ``(3, words)`` buckets of the runs of one,
        two and three words that end there; ``buckets`` where none does or the
        piece before has it."""
        distinct = list({w for p in some for w in p.words})
        keys = [f" \x01{i} " if len(w) > LONGEST else f" {w.decode('latin-1')} " for i, w in enumerate(distinct)]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, key in enumerate(keys):
            automaton.add_word(key, i)
        automaton.make_automaton()
        lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
        crc = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct))
        behind = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.int64, len(distinct))
        flat, start = self.append.tables(lengths + 1)

        if lengths.max() > LONGEST:
            named = dict(zip(distinct, keys))
            text = " " + "".join([named[w][1:] for p in some for w in p.words])
        else:
            text = f" {b' '.join([w for p in some for w in p.words]).decode('latin-1')} "
        sizes = np.array([len(p.words) for p in some])
        n = int(sizes.sum())
        word = np.fromiter(map(_VALUE, automaton.iter(text)), np.int64, n)
        first = np.cumsum(sizes) - sizes
        place = np.arange(n) - np.repeat(first, sizes)
        lead = np.repeat(np.array([p.lead for p in some]), sizes)
        found = np.full((3, n), self.buckets)
        run = crc[word]
        found[0] = np.where(place >= lead, run % self.buckets, self.buckets)
        at, added = start[word], behind[word]
        for length in (2, 3):
            # The run that ends one word earlier, with this word appended.
            run, here = run[:-1], at[length - 1:]
            run = (flat[here + (run & 255)] ^ flat[here + (256 + (run >> 8 & 255))] ^ flat[here + (512 + (run >> 16 & 255))]
                   ^ flat[here + (768 + (run >> 24))] ^ added[length - 1:])
            whole = place[length - 1:] >= np.maximum(lead[length - 1:], length - 1)
            found[length - 1, length - 1:] = np.where(whole, run % self.buckets, self.buckets)
        return np.repeat(np.array([p.row for p in some]), sizes), found

    def slices(self, rows: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        some, size = [], 0
        for piece in pieces(rows, self.slice_bytes):
            some.append(piece)
            size += piece.size
            if size >= self.slice_bytes:
                yield self.scan(some)
                some, size = [], 0
        if some:
            yield self.scan(some)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = 10_000,
                  slice_bytes: int = SLICE_BYTES) -> np.ndarray:
    """Number of features of all texts by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, counts = Scanner(buckets, slice_bytes), np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for part in parts_by_bytes(batch, 0, slice_bytes):
                for _, found in scanner.slices(texts(part.column(0))):
                    counts += np.bincount(found.ravel(), minlength=buckets + 1)
        some = np.flatnonzero(counts[:buckets])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["bucket", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: 1000 times the log ratio of its shares in target and
    source (one added to each count), rounded down."""
    k = len(source)
    ratio = ((target + 1.0) * (source.sum() + float(k))) / ((source + 1.0) * (target.sum() + float(k)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(id, n_words, n_features, weight)``: the sum of gains over all
    features of each whole text; null and empty texts have none."""
    schema = T.StructType([field(docs, id_col, "id"), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(len(gain), slice_bytes)
        # The bucket past the last is no feature.
        value, one = np.append(gain.astype(np.float64), 0), np.append(np.ones(len(gain)), 0)
        for batch in batches:
            for part in parts_by_bytes(batch, 1, slice_bytes):
                rows = texts(part.column(1))
                words, features, weight = (np.zeros(len(rows)) for _ in range(3))
                for row, found in scanner.slices(rows):
                    words += np.bincount(row, one[found[0]], minlength=len(rows))
                    features += np.bincount(row, one[found].sum(0), minlength=len(rows))
                    weight += np.bincount(row, value[found].sum(0), minlength=len(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c.astype(np.int64)) for c in (words, features, weight)]],
                    names=["id", "n_words", "n_features", "weight"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def with_score(weights: DataFrame, seed: int = 42) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise of the id and the seed (a
    null id counts as empty text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return weights.withColumn("score", F.col("weight") + noise)


def with_rank(scored: DataFrame, percent: int = 5) -> DataFrame:
    """Adds ``rank`` (1, 2, ...) to the highest scores, ties to the smaller id,
    of the rows marked ``__may``, as many as ``percent`` of these; null for all
    others.  ``scored`` must be a table that reads the same each time."""
    spark = scored.sparkSession
    rows = scored.withColumn("__tie", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("__tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows dealt by ranges of the order; a rank is the rows of the ranges before plus the place in its own.
    ranged = cut(rows.where("__may").repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__tie"))
    placed = ranged.withColumn("__part", F.spark_partition_id()).withColumn(
        "__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    most = sum(n for _, n in sizes) * percent // 100
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    # One row per partition.
    starts = F.broadcast(spark.createDataFrame(offsets, "__part int, __before long"))
    place = F.col("__before") + F.col("__place") + 1
    ranked = placed.join(starts, "__part").withColumn("rank", F.when(place <= most, place)).drop("__part", "__place", "__before")
    rest = rows.where(~F.col("__may")).drop("__tie").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("__may")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42,
             slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: ``id, n_words, n_features, weight, score, rank``;
    ``percent`` of the documents with at least ``least_words`` words are drawn
    and ranked.

    Defined cases: null and empty texts have no words, no features and weight
    0; a null id counts as empty text in the noise and comes last among ties; repeated
    rows are rows of their own, with ranks of their own; an empty target gives
    each bucket the gain of no occurrence; an empty table gives no rows; other
    columns are not read.  A text is scanned in pieces, whatever its length.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, slice_bytes), bucket_counts(target, target_col, buckets, slice_bytes))
    scored = with_score(weigh(docs, gain, id_col, text_col, slice_bytes), seed)
    return with_rank(cut(scored.withColumn("__may", F.col("n_words") >= least_words)), percent=percent)
