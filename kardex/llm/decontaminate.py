"""Benchmark decontamination by an FM-index per training shard.

Documents are gathered into shards of about ``shard_words`` words inside each
task.  Each shard is indexed (suffix array, wavelet-tree ranks, sampled
positions), every test phrase is searched backwards in it, occurrences are
located, and their spans are merged per document.  Words that no benchmark item
has cannot be part of a phrase; a run of them is one separator of the index.
There is no shuffle, and no document is cut.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, map_slices, memory_given_back, parts_by_bytes, read_shared, shared_dir, texts, without
from kardex.llm.fm_index import FMIndex

#: Word bytes: lower-cased letters, digits and everything beyond ASCII.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                  for c in range(256))

_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class Phrases:
    """The distinct windows of the items, by length, and their items."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.symbol: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.symbol.setdefault(w, len(self.symbol) + 1) for w in words_of(text))
            for at in range(max(1, len(ids) - window + 1)) if ids else ():
                owners.setdefault(ids[at:at + window], set()).add(item)
        self.groups = []
        for length in sorted({len(p) for p in owners}):
            some = [p for p in owners if len(p) == length]
            self.groups.append((np.array(some, np.int64), [owners[p] for p in some]))


def _scan(phrases: Phrases, docs: list[bytes | None], sample: int):
    """Per document: number of words, merged spans ``(start, end)``, items."""
    get, parts, counts = phrases.symbol.get, [], []
    for text in docs:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    flat = np.concatenate(parts)
    # A run of symbols outside all phrases is one separator.
    kept = np.flatnonzero((flat != 0) | np.concatenate([[True], flat[:-1] != 0]))
    if flat[kept[-1]] != 0:
        kept = np.append(kept, len(flat) - 1)
    symbols = flat[kept]
    starts = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])
    change = np.zeros(len(flat) + 1, np.int64)
    found: list[set[str]] = [set() for _ in docs]
    index = FMIndex(symbols, len(phrases.symbol) + 1, sample) if phrases.groups else None
    for codes, owners in phrases.groups:
        low, high = index.search(codes)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        times = (high - low)[hit]
        phrase = np.repeat(hit, times)
        rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[hit], times)
        at = kept[index.locate(rows)]
        np.add.at(change, at, 1)
        np.add.at(change, at + codes.shape[1], -1)
        doc = np.searchsorted(starts, at, side="right") - 1
        for pair in np.unique(doc * len(owners) + phrase).tolist():
            found[pair // len(owners)] |= owners[pair % len(owners)]
    covered = np.cumsum(change[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    for start, end in edge.reshape(-1, 2).tolist():
        doc = int(np.searchsorted(starts, start, side="right")) - 1
        spans[doc].append((start - int(starts[doc]), end - int(starts[doc])))
    return counts, spans, found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[str]:
    """The items as Parquet in the shared folder, written by tasks, in folders of about
    ``block_bytes`` of text; returns the folders.  No text passes the driver."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    folder = f"{shared_dir(spark)}/items-{uuid.uuid4()}"
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        (items.where(block == k) if blocks > 1 else items).write.parquet(f"{folder}/{k}")
    return [f"{folder}/{k}" for k in range(blocks)]


def _load(folder: str, window: int) -> Phrases:
    table = read_shared(folder)
    return Phrases(sorted(zip(table.column("item").to_pylist(), texts(table.column("text")))), window)


def _searched(docs: DataFrame, blocks: list[str], text_col: str, keep_text: bool, window: int, shard_words: int,
              sample: int, cut_col: str | None) -> DataFrame:
    """The columns of ``docs`` (``text_col`` only if kept) with ``n_words,
    spans, items``, and in ``cut_col`` the text without its spans.  A task holds
    a shard and the phrases of one block at a time."""
    kept = [c for c in docs.columns if keep_text or c != text_col]
    schema = T.StructType([*[field(docs, c) for c in kept], *_MARK_FIELDS,
                           *([T.StructField(cut_col, T.StringType())] if cut_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        only = _load(blocks[0], window) if len(blocks) == 1 else None
        parts: list[pa.RecordBatch] = []
        shard: list[bytes | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts, spans, found = _scan(only or _load(blocks[0], window), shard, sample)
            for folder in blocks[1:]:
                _, more, others = _scan(_load(folder, window), shard, sample)
                spans = [_join(a, b) for a, b in zip(spans, more)]
                found = [a | b for a, b in zip(found, others)]
            table = pa.Table.from_batches(parts)
            rows = [[{"start": s, "end": e} for s, e in doc] for doc in spans]
            columns = [table.column(i).combine_chunks().cast(out.field(i).type) for i in range(len(kept))]
            left = [pa.array([None if t is None else without_spans(t, s) if s else t.decode() for t, s in zip(shard, spans)],
                             pa.string())] if cut_col else []
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int64()), pa.array(rows, out.field("spans").type),
                 pa.array([sorted(f) for f in found], out.field("items").type), *left], schema=out)

        with memory_given_back():
            for batch in batches:
                for part in parts_by_bytes(batch, batch.num_columns - 1):
                    values = texts(part.column(part.num_columns - 1))
                    parts.append(part.select(range(part.num_columns - 1)))
                    shard += values
                    size += sum(len(v) // 6 for v in values if v)
                    if size >= shard_words:
                        yield flush()
                        parts, shard, size = [], [], 0
            if shard:
                yield flush()

    columns = [F.col(f"`{c}`") for c in kept]
    return docs.select(*columns, F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, schema)


_MARKS = ("n_words", "spans", "items")
_MARK_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                     T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))]


def _join(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of ranges."""
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = 13, shard_words: int = 1 << 19, sample: int = 32,
         block_bytes: int = 8 << 20, keep_text: bool = True, cut_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with ``n_words, spans, items`` (columns of these
    names are replaced), and, if named, ``cut_col``: the text without the words
    of the spans and what lies between them (null for null).

    ``spans`` are the merged word ranges ``[start, end)`` inside occurrences of
    a ``window``-word phrase (an item with fewer words, but not none, is one
    phrase); ``items`` the ids, as sorted strings, of the items found.

    The test set lies in the shared folder in blocks of ``block_bytes`` of text;
    each shard of documents is searched for one block after the other, and the
    spans are joined.  Defined cases: null and empty texts have no words and
    match nothing; a null item id counts as the text ``null``; rows that repeat
    stay; an empty table on either side gives no rows, or rows without spans.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    return _searched(without(docs, *_MARKS), blocks, text_col, keep_text, window, shard_words, sample, cut_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **more) -> DataFrame:
    """``mark`` with the id alone: ``id, n_words, spans, items``."""
    return mark(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__body")), benchmark, "__body",
                keep_text=False, **more)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **more) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns, their texts
    without the words of test phrases.

    Defined cases are those of ``mark``, but that columns of any name stay; a null text stays null.
    """
    names = [f"__c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    left = mark(docs.toDF(*names), benchmark, text, keep_text=False, cut_col="__cut", **more)
    left = with_digest(left).where(~F.col("contaminated")).withColumnRenamed("__cut", text)
    return left.select(*names).toDF(*docs.columns)


def cut_spans(marked: DataFrame, text_col: str = "text") -> DataFrame:
    """Removes the words that an earlier ``mark`` found from the text, and what
    lies between them; a null text stays null, columns of the marks go."""
    schema = T.StructType([f for f in marked.schema.fields if f.name not in _MARKS])
    names = [f.name for f in schema.fields]
    at_text = names.index(text_col)

    def run(batch):
        spans = [[(x["start"], x["end"]) for x in row] for row in batch.column(len(names)).to_pylist()]
        cut = [None if t is None else without_spans(t, s) if s else t.decode() for t, s in zip(texts(batch.column(at_text)), spans)]
        return dict(zip(names, batch.columns)) | {text_col: cut}

    return map_slices(marked.select(*[F.col(f"`{c}`") for c in names], "spans"), run, schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> str:
    words = [m.span() for m in _WORD.finditer(text.translate(_TO_WORDS))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:words[start][0]])
        at = words[end - 1][1]
    return b"".join([*out, text[at:]]).decode()


def with_digest(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds ``n_hit, n_items, items_sha256, contaminated`` (hit words are at
    least one in ``share``)."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.withColumns({
        "n_hit": hit, "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256)}).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))

