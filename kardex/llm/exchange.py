"""Asking hash shards about the distinct keys of document batches.

Documents are dealt into batches of bounded size by a hash of the whole row and
its place, so that rows that repeat are spread, too.  A batch sends its distinct 64-bit keys, sorted, one slice per shard; a shard sees
each key at most once per batch, so that no key is hot, and answers each slice
in order.  The batch makes the same keys again when the answers arrive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batched(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """``(batch, k, id, text)`` and the number of shards, both counts from the
    bytes of all texts.  Equal rows have equal ``k``; others may be ordered by
    it.  ``docs`` is a table that reads the same each time."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    k = F.xxhash64(F.lit(3), "id", "text")
    dealt = F.pmod(F.xxhash64(k, F.monotonically_increasing_id()), F.lit(max(1, -(-total // batch_bytes))))
    return (rows.select(dealt.alias("batch"), k.alias("k"), "id", "text"),
            max(1, -(-total // shard_bytes)))


class Codes(dict):
    """Running number of each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class Batch:
    """The words of a batch's documents, in the order of ``k``, as one array."""

    def __init__(self, table: pa.Table, lower: bool = False):
        order = np.argsort(table.column("k").to_numpy(), kind="stable")
        self.rows = table.take(pa.array(order))
        texts = self.rows.column("text").combine_chunks().cast(pa.large_binary())
        vocabulary, parts = Codes(), []
        get = vocabulary.__getitem__
        for text in texts.to_pylist():
            words = (text.lower() if lower else text).split() if text else []
            parts.append(np.fromiter(map(get, words), np.int64, len(words)))
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.codes = np.concatenate([np.zeros(0, np.int64), *parts])
        self.words = list(vocabulary)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def hashes(self, seed: int = 9) -> np.ndarray:
        """64-bit hash of each distinct word."""
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key; rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def slices(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, start, end) of the shards that have some of the sorted keys."""
    shard = shard_of(keys, shards)
    at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(keys))
    return list(zip(shard[at].tolist(), at.tolist(), ends.tolist())) if len(keys) else []


def answers(table: pa.Table, parts: list[tuple[int, int, int]], column: str, kind: str) -> list[np.ndarray]:
    """The answer array of each slice, in the order of ``parts``."""
    got = dict(zip(table.column("shard").to_pylist(), table.column(column).to_pylist()))
    return [np.frombuffer(got[shard], kind) for shard, _, _ in parts]
