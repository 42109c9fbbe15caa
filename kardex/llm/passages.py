"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages, runs of 48 words, and only the bag has a
label.  Each passage is encoded from its words' forms and repeats; a gated
attention weighs the encodings, and the weighted sum is the document's
representation, which a logistic unit scores.  Encoder, attention and unit are
learned together from document labels.

Whole texts are scored: long ones go through in slices, and the attention's
softmax is kept as a running maximum, sum and weighted sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field as member

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, hashed_sample, map_slices, mix64, parts_by_bytes, texts
from kardex.llm.exchange import Codes

#: Words of a passage, and shape buckets of the words in it.
PASSAGE = 48
SHAPES = 48
#: Bytes of text read at a time.
SLICE_BYTES = 256 << 10

# Kinds of bytes: letter, capital, digit, full stops and the like, "!", other
# signs, lead byte of a letter beyond ASCII, its further bytes.
_KIND = np.full(256, 5, np.uint8)
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1] = 0, 1, 2
_KIND[np.frombuffer(b".,;:?'\"()-", np.uint8)], _KIND[ord("!")] = 3, 4
_KIND[0x80:0xC0], _KIND[0xC0:] = 7, 6
# In a word's shape letters, capitals and digits stand for one another.
_FORM = np.arange(256, dtype=np.uint64)
_FORM[ord("a"):ord("z") + 1] = _FORM[0x80:] = ord("a")
_FORM[ord("A"):ord("Z") + 1], _FORM[ord("0"):ord("9") + 1] = ord("A"), ord("0")
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

WORD_FIGURES = 11
FIGURES = WORD_FIGURES + SHAPES + 5


def word_figures(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word: figures of its letters and signs, and the bucket
    of its shape (runs of one kind count once)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(words), np.uint8)
    kinds = _KIND[data]
    count = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.float32) for k in range(8)], 1)
    chars = sizes - count[:, 7]
    upper = count[:, 1]
    figures = np.column_stack([
        np.minimum(chars, 40) / 10, np.minimum(chars, 40) ** 2 / 400, (count[:, :7] / np.maximum(chars, 1)[:, None]),
        (upper > 1) & (upper + count[:, 6] >= chars - count[:, 3:6].sum(1)), chars > 25]).astype(np.float32)
    form = _FORM[data]
    change = np.ones(len(data), bool)
    change[1:] = form[1:] != form[:-1]
    change[starts] = True
    turn = np.cumsum(change)
    turn -= np.repeat(turn[starts], sizes)
    shape = np.add.reduceat(np.where(change, form * _POWER[turn & 63], np.uint64(0)), starts)
    return figures, (mix64(shape) % np.uint64(SHAPES)).astype(np.int64)


def encode(passages: list[list[bytes]]) -> np.ndarray:
    """A row of figures per passage; an empty passage has zeros."""
    out = np.zeros((len(passages), FIGURES), np.float32)
    some = [i for i, p in enumerate(passages) if p]
    if not some:
        return out
    vocabulary = Codes()
    sizes = np.array([len(passages[i]) for i in some])
    codes = np.fromiter(map(vocabulary.__getitem__, (w for i in some for w in passages[i])), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(np.arange(len(some)), sizes)
    figures, shape = word_figures(list(vocabulary))
    n = sizes[:, None].astype(np.float32)
    means = np.add.reduceat(figures[codes], starts, axis=0) / n
    shapes = np.bincount(at * SHAPES + shape[codes], minlength=len(some) * SHAPES).reshape(-1, SHAPES) / n
    again = [np.bincount(at[d:], (codes[d:] == codes[:-d]) & (at[d:] == at[:-d]), minlength=len(some)) if len(codes) > d
             else np.zeros(len(some)) for d in (1, 2, 3)]
    key = np.sort(at * len(vocabulary) + codes)
    distinct = np.bincount(key[np.flatnonzero(np.diff(key, prepend=-1))] // len(vocabulary), minlength=len(some))
    out[some] = np.column_stack([means, shapes, np.stack(again, 1) / n, distinct / sizes, np.minimum(1, sizes / PASSAGE)])
    return out


def passages_of(text: bytes | None, slice_bytes: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Runs of 48 words; no words: one empty passage."""
    text, start, left, none = text or b"", 0, [], True
    while start < len(text):
        end = start + slice_bytes
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        left += text[start:end].split()
        whole = len(left) - len(left) % PASSAGE if end < len(text) else len(left)
        for i in range(0, whole, PASSAGE):
            yield left[i:i + PASSAGE]
            none = False
        left, start = left[whole:], end
    if none:
        yield []


def slices(rows: list[bytes | None], slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The row and the figures of each passage, some passages at a time."""
    most = max(1, slice_bytes // (6 * PASSAGE))
    at, some = [], []
    for row, text in enumerate(rows):
        for passage in passages_of(text, slice_bytes):
            at.append(row)
            some.append(passage)
            if len(some) >= most:
                yield np.array(at), encode(some)
                at, some = [], []
    if some:
        yield np.array(at), encode(some)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights by name; none: every text gets ``share``."""

    weights: dict[str, np.ndarray] = member(default_factory=dict)
    share: float = 0.5

    @staticmethod
    def start(figures: np.ndarray, hidden: int, gates: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, a ** -0.5, (a, b))
        return Model({"mean": figures.mean(0), "scale": 1 / (figures.std(0) + 0.02), "encode": draw(FIGURES, hidden),
                      "encode0": np.zeros(hidden), "look": draw(hidden, gates), "gate": draw(hidden, gates),
                      "attend": draw(gates, 1)[:, 0], "judge": draw(hidden, 1)[:, 0], "judge0": np.zeros(1)})

    def passages(self, figures: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scaled figures, encodings, look, gate and attention of passages."""
        w = self.weights
        x = np.clip((figures - w["mean"]) * w["scale"], -6, 6)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        look, gate = np.tanh(h @ w["look"]), _sigmoid(h @ w["gate"])
        return x, h, look, gate, (look * gate) @ w["attend"]

    def probability(self, rows: list[bytes | None], slice_bytes: int = SLICE_BYTES) -> np.ndarray:
        """Of whole texts; the softmax over passages is a running one."""
        if not self.weights:
            return np.full(len(rows), self.share)
        high, total = np.full(len(rows), -np.inf), np.zeros(len(rows))
        bag = np.zeros((len(rows), len(self.weights["judge"])))
        for at, figures in slices(rows, slice_bytes):
            _, h, _, _, a = self.passages(figures)
            top = high.copy()
            np.maximum.at(top, at, a)
            fade = np.exp(np.where(high == -np.inf, -np.inf, high - np.where(top == -np.inf, 0, top)))
            share = np.exp(a - top[at])
            total = total * fade + np.bincount(at, share, minlength=len(rows))
            bag *= fade[:, None]
            np.add.at(bag, at, share[:, None] * h)
            high = top
        return _sigmoid(bag / total[:, None] @ self.weights["judge"] + self.weights["judge0"])

    def gradients(self, figures: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss over bags that begin at ``starts``."""
        w = self.weights
        sizes = np.diff(np.append(starts, len(figures)))
        at = np.repeat(np.arange(len(starts)), sizes)
        x, h, look, gate, a = self.passages(figures)
        e = np.exp(a - np.maximum.reduceat(a, starts)[at])
        alpha = e / np.add.reduceat(e, starts)[at]
        bag = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        d = (_sigmoid(bag @ w["judge"] + w["judge0"]) - y) * weight / weight.sum()
        dbag = d[:, None] * w["judge"]
        reach = (h * dbag[at]).sum(1)
        da = alpha * (reach - np.add.reduceat(alpha * reach, starts)[at])
        dgated = da[:, None] * w["attend"]
        dlook, dgate = dgated * gate * (1 - look ** 2), dgated * look * gate * (1 - gate)
        dh = alpha[:, None] * dbag[at] + dlook @ w["look"].T + dgate @ w["gate"].T
        dpre = dh * (1 - h ** 2)
        return {"judge": bag.T @ d, "judge0": d.sum(keepdims=True), "attend": (look * gate).T @ da, "look": h.T @ dlook,
                "gate": h.T @ dgate, "encode": x.T @ dpre, "encode0": dpre.sum(0)}


def learn(bags: list[np.ndarray], y: np.ndarray, hidden: int = 24, gates: int = 12, turns: int = 40, batch: int = 128,
          rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam over shuffled batches of bags; both classes weigh the same."""
    model = Model.start(np.concatenate(bags), hidden, gates, seed)
    weight = np.where(y == 1, 1 / max(1, (y == 1).sum()), 1 / max(1, (y == 0).sum()))
    rng = np.random.default_rng(seed)
    first = {k: 0.0 for k in model.weights}
    second, step = dict(first), 0
    for turn in range(turns):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            some = order[i:i + batch]
            sizes = np.array([len(bags[j]) for j in some])
            found = model.gradients(np.concatenate([bags[j] for j in some]), np.cumsum(sizes) - sizes, y[some], weight[some])
            step += 1
            slow = rate * (1 - turn / turns)
            for k, g in found.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.weights[k] = model.weights[k] * (1 - slow * decay) - slow * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        rows_per_class: int = 2000, passages_per_row: int = 256) -> Model:
    """Learns from at most ``rows_per_class`` labelled rows of each class
    (smallest hashed ids); of a text with more than ``passages_per_row``
    passages as many, evenly spread, are learned from.  These bounds, and
    nothing else, are a sample; the share of the classes comes from all labels.
    Rows without a label or id are not learned from; an id labelled twice has
    the higher label; rows with equal passages and label count once.  With
    labels of one class only, or none, every score is the labels' share of 1
    (0.5 without any)."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    good, bad = counts.get(1, 0), sum(n for y, n in counts.items() if y != 1)
    share = good / (good + bad) if good + bad else 0.5
    sample = hashed_sample(marked.withColumn("h", F.xxhash64(F.lit(12), "id")), "y", rows_per_class, "h", "id").drop("h")
    # The sample's size is a parameter: two classes of rows_per_class ids.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")

    def run(batch):
        figures = []
        for text in texts(batch.column(1)):
            found = np.concatenate([f for _, f in slices([text])])
            keep = np.unique(np.linspace(0, len(found) - 1, min(len(found), passages_per_row)).astype(np.int64))
            figures.append(found[keep].astype(np.float16).tobytes())
        return {"y": batch.column(0), "figures": figures}

    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("figures", T.BinaryType())])
    found = sorted({(r["y"], bytes(r["figures"])) for r in map_slices(rows.select("y", "text"), run, schema).collect()})
    y = np.array([float(r[0] == 1) for r in found])
    if len(found) == 0 or y.min() == y.max():
        return Model(share=share)
    bags = [np.frombuffer(r[1], np.float16).astype(np.float64).reshape(-1, FIGURES) for r in found]
    model = learn(bags, y)
    # The classes weighed the same; their odds among all labels come back in.
    model.weights["judge0"] = model.weights["judge0"] + np.log(good / bad)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(id, score)`` of every whole text.

    Defined cases: null and empty texts are one empty passage; repeated rows
    stay; an empty table gives none; other columns are not read.
    """
    schema = T.StructType([field(docs, id_col, "id"), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_by_bytes(batch, 1, 4 * slice_bytes):
                found = model.probability(texts(part.column(1)), slice_bytes)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["id", "score"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
