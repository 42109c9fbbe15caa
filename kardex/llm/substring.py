"""Substring de-duplication by difference-cover anchors.

In each document only the word positions in a difference cover modulo a period
are hashed, with an anchor of ``window - period + 1`` words.  For any two equal
windows some shift below the period brings both starts onto cover positions, so
equal windows share an aligned anchor.  Anchors that occur twice are extended:
the windows around them are hashed in full, with two independent hashes of 64
bits, and those that occur twice go.  (Anchors only propose: one hash will do.)

Both questions ("which of my keys occur anywhere else?") are put by batches of
documents to hash shards, see ``exchange``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, mix64
from kardex.llm.exchange import Batch, answers, batched, slices

#: A difference cover of each period: the differences of its members give all
#: remainders.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_K = 0x9E3779B97F4A7C15


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values, by doubling."""
    out, done = None, 0
    power, size = values, 1
    while True:
        if width & size:
            if out is None:
                out, done = power, size
            else:
                n = len(values) - done - size + 1
                out = out[:n] * np.uint64(pow(_K, size, 1 << 64)) + power[done:done + n]
                done += size
        if size * 2 > width:
            return mix64(out)
        n = len(values) - 2 * size + 1
        power = power[:n] * np.uint64(pow(_K, size, 1 << 64)) + power[size:size + n]
        size *= 2


class Windows(Batch):
    def __init__(self, table: pa.Table, window: int, period: int):
        super().__init__(table)
        self.window, self.period = window, period
        n = len(self.codes)
        self.end_of = np.repeat(self.ends, self.lengths)
        self.place = np.arange(n) - np.repeat(self.starts, self.lengths)
        self.hashed = self.hashes()[self.codes] if n else np.zeros(0, np.uint64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the anchors; distinct keys; index of each anchor's key;
        whether the key occurs twice here."""
        width = self.window - self.period + 1
        n = max(0, len(self.codes) - width + 1)
        cover = np.zeros(self.period, bool)
        cover[list(COVERS[self.period])] = True
        long = np.repeat(self.lengths >= self.window, self.lengths)[:n]
        at = np.flatnonzero(cover[self.place[:n] % self.period] & (np.arange(n) + width <= self.end_of[:n]) & long)
        return at, *_distinct(rolling(self.hashed, width)[at] if len(at) else np.zeros(0, np.uint64))

    def candidates(self, repeated: np.ndarray) -> tuple[np.ndarray, ...]:
        """The windows around repeated anchors, as ``anchors`` returns them, and
        the second hash of each distinct one."""
        n = max(0, len(self.codes) - self.window + 1)
        near = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(near, np.maximum(repeated - self.period + 1, 0), 1)
        np.add.at(near, repeated + 1, -1)
        at = np.flatnonzero((np.cumsum(near[:-1])[:n] > 0) & (np.arange(n) + self.window <= self.end_of[:n]))
        if not len(at):
            none = np.zeros(0, np.uint64)
            return at, none, np.zeros(0, np.int64), np.zeros(0, bool), none
        key = rolling(self.hashed, self.window)[at]
        check = rolling(self.hashes(10)[self.codes], self.window)[at]
        order = np.lexsort((check, key))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])])
        index = np.empty(len(at), np.int64)
        index[order] = np.cumsum(new) - 1
        return at, key[order][new], index, np.bincount(index) > 1, check[order][new]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, index, times = np.unique(keys, return_inverse=True, return_counts=True)
    return values, index, times > 1


def _ask(batch: int, keys: np.ndarray, twice: np.ndarray, shards: int, checks: np.ndarray | None = None) -> pa.Table:
    parts = slices(keys, shards)
    second = [None if checks is None else checks[s:e].tobytes() for _, s, e in parts]
    return pa.table({
        "shard": pa.array([p[0] for p in parts], pa.int64()), "batch": pa.array([batch] * len(parts), pa.int64()),
        "keys": pa.array([keys[s:e].tobytes() for _, s, e in parts], pa.binary()),
        "twice": pa.array([np.packbits(twice[s:e]).tobytes() for _, s, e in parts], pa.binary()),
        "checks": pa.array(second, pa.binary())})


_ASKED = "shard long, batch long, keys binary, twice binary, checks binary"
_ANSWERED = "batch long, shard long, found binary"


def _answer(table: pa.Table) -> pa.Table:
    """Of one shard: which keys of each batch occur anywhere else."""
    parts = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    sizes = [len(p) for p in parts]
    keys = np.concatenate(parts)
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n)
                            for t, n in zip(table.column("twice").to_pylist(), sizes)]).astype(bool)
    # Keys that were sent with a second hash are equal if both are.
    checks = np.concatenate([np.zeros(n, np.uint64) if c is None else np.frombuffer(c, np.uint64)
                             for c, n in zip(table.column("checks").to_pylist(), sizes)])
    order = np.lexsort((checks, keys)) if checks.any() else np.argsort(keys)
    ordered, second = keys[order], checks[order]
    same = (ordered[1:] == ordered[:-1]) & (second[1:] == second[:-1])
    found = twice.copy()
    again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    found[order[again]] = True
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({"batch": table.column("batch"), "shard": table.column("shard"), "found": pa.array(
        [np.packbits(f).tobytes() for f in np.split(found, cuts)], pa.binary())})


def _marks(replies: pa.Table, keys: np.ndarray, shards: int) -> np.ndarray:
    parts = slices(keys, shards)
    bits = [np.unpackbits(b, count=e - s) for b, (_, s, e) in zip(answers(replies, parts, "found", "u1"), parts)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   period: int = 21, batch_bytes: int = 6 << 20, shard_bytes: int = 24 << 20) -> DataFrame:
    """One row per document: ``id, n_words, n_removed, text`` with the kept
    words joined by one space.

    A word goes if some window of ``window`` words that covers it also starts
    anywhere else in the input.  Defined cases: a null text has no words and
    an empty kept text; a text shorter than the window stays; equal rows repeat
    each other, lose all windows and are spread over the batches; an empty
    table gives no rows.
    """
    rows, shards = batched(docs, id_col, text_col, batch_bytes, shard_bytes)

    def ask_anchors(table: pa.Table) -> pa.Table:
        _, keys, _, twice = Windows(table, window, period).anchors()
        return _ask(table.column("batch")[0].as_py(), keys, twice, shards)

    def ask_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _ask(0, np.zeros(0, np.uint64), np.zeros(0, bool), shards)
        words = Windows(table, window, period)
        at, keys, index, _ = words.anchors()
        _, keys, _, twice, checks = words.candidates(at[_marks(replies, keys, shards)[index]])
        return _ask(table.column("batch")[0].as_py(), keys, twice, shards, checks)

    schema = T.StructType([field(rows, "id"), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        words = Windows(table, window, period)
        first = replies.filter(pa.array(np.array(replies.column("phase").to_pylist()) == 1, pa.bool_()))
        second = replies.filter(pa.array(np.array(replies.column("phase").to_pylist()) == 2, pa.bool_()))
        at, keys, index, _ = words.anchors()
        at, keys, index, *_ = words.candidates(at[_marks(first, keys, shards)[index]])
        gone = at[_marks(second, keys, shards)[index]]
        cover = np.zeros(len(words.codes) + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + window, -1)
        kept = np.cumsum(cover[:-1]) == 0
        before = np.concatenate([[0], np.cumsum(kept)])
        left = before[words.ends] - before[words.starts]
        names, texts = np.array([*words.words, b""], dtype=object), []
        for start, end in zip(words.starts.tolist(), words.ends.tolist()):
            texts.append(b" ".join(names[words.codes[start:end][kept[start:end]]].tolist()).decode())
        return pa.table({"id": words.rows.column("id"), "n_words": words.lengths, "n_removed": words.lengths - left,
                         "text": pa.array(texts, pa.string())})

    by_batch = rows.groupBy("batch")
    first = by_batch.applyInArrow(ask_anchors, _ASKED).groupBy("shard").applyInArrow(_answer, _ANSWERED)
    second = by_batch.cogroup(first.groupBy("batch")).applyInArrow(ask_windows, _ASKED).groupBy("shard").applyInArrow(
        _answer, _ANSWERED)
    replies = first.withColumn("phase", F.lit(1)).unionAll(second.withColumn("phase", F.lit(2)))
    return by_batch.cogroup(replies.groupBy("batch")).applyInArrow(finish, schema)
