"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for each piece of a fixed public vocabulary.
The likelihood of a word is the sum over all its segmentations into pieces,
taken by a forward algorithm; the text's likelihood is the product over its
words.  Piece probabilities are learned by expectation-maximisation (expected
piece counts over all segmentations) from a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import cut, field, hashed_sample, map_slices, without

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"
#: Longest word that is learned from; words of any length are scored.
LEARNED = 64
#: Letters between two turns of scaling, which keeps forward sums in range.
_TURN = 16
#: Words a task remembers; beyond, it forgets all and goes on.
MEMORY = 200_000


def load_pieces(path: str = VOCABULARY) -> dict[str, int]:
    """Lower-case letter pieces of a sentencepiece vocabulary; id 0 stands for
    any letter that is no piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    kept = sorted(p for p in pieces if (body := p.removeprefix(_START)) and _LETTERS.fullmatch(body) and body == body.lower())
    return {p: i for i, p in enumerate([_START, *kept], 1)}


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


_WIDTH = 4096


class Pieces:
    """A trie of the pieces in one array (row displacement): the child of state
    s by letter c is at ``base[s] + c`` if that cell's owner is s."""

    def __init__(self, pieces: dict[str, int]):
        letters = sorted({c for p in pieces for c in p})
        self.letter = np.zeros(max(map(ord, letters)) + 2, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        code = dict(zip(letters, range(1, len(letters) + 1)))
        children: list[dict[int, int]] = [{}]
        self.piece = [-1]
        for piece, place in pieces.items():
            state = 0
            for c in piece:
                state = children[state].setdefault(code[c], len(children))
                if state == len(children):
                    children.append({})
                    self.piece.append(-1)
            self.piece[state] = place
        room = 4 * len(children) + 2 * len(letters) + 2 * _WIDTH
        owner, child = np.full(room, -1, np.int32), np.zeros(room, np.int32)
        base, free, start = np.zeros(len(children), np.int32), np.ones(room, bool), 0
        for state in sorted(range(len(children)), key=lambda s: -len(children[s])):
            codes = np.fromiter(children[state], np.int64, len(children[state]))
            if not len(codes):
                continue
            while not free[start]:
                start += 1
            at = max(0, start - int(codes.min()))
            while True:
                # The first of many places at once where all children fit.
                fits = np.logical_and.reduce([free[at + c:at + c + _WIDTH] for c in codes.tolist()])
                if fits.any():
                    break
                at += _WIDTH
            at += int(fits.argmax())
            base[state] = at
            owner[at + codes], child[at + codes] = state, list(children[state].values())
            free[at + codes] = False
        self.base, self.owner, self.child = base, owner, child
        self.longest = max(map(len, pieces))
        self.piece = np.array(self.piece, np.int32)

    def spans(self, words: list[str]):
        """For equally long words: ``(start, end, rows, pieces)`` of every piece
        in them; a letter that is no piece counts as piece 0."""
        length = len(words[0])
        cells = np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length)
        codes = self.letter[np.minimum(cells, len(self.letter) - 1)]
        for start in range(length):
            rows, state = np.arange(len(words)), np.zeros(len(words), np.int32)
            for end in range(start, length):
                cell = self.base[state] + codes[rows, end]
                alive = self.owner[cell] == state
                if end == start:
                    piece = np.where(alive, self.piece[self.child[cell]], -1)
                    yield start, end + 1, rows, np.maximum(piece, 0)
                rows, state = rows[alive], self.child[cell[alive]]
                if not len(rows):
                    break
                if end > start:
                    piece = self.piece[state]
                    at = np.flatnonzero(piece >= 0)
                    if len(at):
                        yield start, end + 1, rows[at], piece[at]


class Lattice:
    """The pieces in equally long words, each word marked at its start."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.length = len(words[0]) + 1
        self.ids = {(i, j): (at, ids) for i, j, at, ids in pieces.spans([_START + w for w in words])}

    def forward(self, table: np.ndarray, n: int) -> np.ndarray:
        """(places, words, languages): probability of each prefix."""
        alpha = np.zeros((self.length + 1, n, table.shape[1]))
        alpha[0] = 1
        for (i, j), (at, ids) in self.ids.items():
            alpha[j, at] += alpha[i, at] * table[ids]
        return alpha

    def expected(self, table: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected piece counts; weights: (words, languages)."""
        n = len(weights)
        alpha = self.forward(table, n)
        beta = np.zeros_like(alpha)
        beta[-1] = weights / np.maximum(alpha[-1], 1e-300)
        for (i, j), (at, ids) in reversed(self.ids.items()):
            beta[i, at] += beta[j, at] * table[ids]
        for (i, j), (at, ids) in self.ids.items():
            np.add.at(out, ids, alpha[i, at] * table[ids] * beta[j, at])


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at, most = np.flatnonzero(lengths == n), max(1, min(10_000, 500_000 // int(n)))
        for k in range(0, len(at), most):
            yield at[k:k + most]


@dataclass
class Model:
    langs: list[str]
    pieces: Pieces
    table: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Natural log probability of each word in each language."""
        out = np.empty((len(words), len(self.langs)))
        for at in _by_length(words):
            out[at] = self._forward([words[i] for i in at])
        return out

    def _forward(self, words: list[str]) -> np.ndarray:
        """The forward sums of equally long words, of any length.  Only the places
        that a piece can reach are held; they are scaled every few letters, and
        the logarithms of the scales add up."""
        held = self.pieces.longest + 2
        alpha = np.zeros((held, len(words), len(self.langs)))
        alpha[0] = 1
        scale, at = np.zeros(alpha.shape[1:]), 0
        for i, j, rows, ids in self.pieces.spans([_START + w for w in words]):
            if i != at:
                alpha[at % held] = 0
                at = i
                if at % _TURN == 0:
                    factor = np.maximum(alpha[at % held], 1e-300)
                    alpha /= factor
                    scale += np.log(factor)
            alpha[j % held, rows] += alpha[i % held, rows] * self.table[ids]
        return scale + np.log(np.maximum(alpha[(len(words[0]) + 1) % held], 1e-300))


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        docs_per_lang: int = 1500, rounds: int = 2, smoothing: float = 0.1, vocabulary: str = VOCABULARY) -> Model:
    """Learns from at most about ``docs_per_lang`` whole texts of each language
    (those whose hashed id is smallest), from their words of up to ``LEARNED``
    letters.  These bounds are the only sample: they
    fit the classifier and nothing else.  Rows without a text, language or id
    are not learned from.  What reaches the driver is one row
    per language, then one per language and piece."""
    known = load_pieces(vocabulary)
    pieces = Pieces(known)
    labelled = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    labelled = labelled.withColumn("h", F.xxhash64(F.lit(11), "id"))
    few = cut(hashed_sample(labelled.select("lang", "h", "id").distinct(), "lang", docs_per_lang, "h", "id"))
    langs = sorted(r["lang"] for r in few.select("lang").distinct().collect())
    if not langs:
        return Model([], pieces, np.zeros((len(known) + 1, 0)))
    # The sample's size is a parameter: docs_per_lang ids of each language.
    chosen = labelled.join(F.broadcast(few), ["lang", "h", "id"])
    place = {lang: i for i, lang in enumerate(langs)}

    def count(batch):
        seen: dict[tuple[int, str], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word in words_of(text):
                if len(word) > LEARNED:
                    continue
                key = (place[lang], word)
                seen[key] = seen.get(key, 0) + 1
        return {"lang": [k[0] for k in seen], "word": [k[1] for k in seen], "n": list(seen.values())}

    words = cut(map_slices(chosen.select("lang", "text"), count, T.StructType([
        T.StructField("lang", T.IntegerType()), T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType())])).groupBy("lang", "word").agg(F.sum("n").alias("n")))
    table = np.full((len(known) + 1, len(langs)), 1.0 / (len(known) + 1))
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(table)
            for batch in batches:
                lang = batch.column(0).to_numpy()
                some = batch.column(1).to_pylist()
                weight = np.zeros((len(some), table.shape[1]))
                weight[np.arange(len(some)), lang] = batch.column(2).to_numpy()
                for at in _by_length(some):
                    Lattice([some[i] for i in at], pieces).expected(table, weight[at], total)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])],
                                             names=["piece", "lang", "n"])

        sums = words.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(
            F.sum("n").alias("n")).collect()
        table = np.full_like(table, smoothing)
        for r in sums:
            table[r["piece"], r["lang"]] += r["n"]
        table /= table.sum(axis=0)
    return Model(langs, pieces, table)


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the language with its posterior (equal
    priors) as the score.

    Defined cases: a text that is null or has no letter is ``und`` with score
    0, as is every text if the model learned no language; ties go to the first
    language by code point; columns of the new names are replaced; rows that
    repeat stay; an empty table gives no rows.
    """
    docs = without(docs, pred_col, score_col)
    schema = T.StructType([*[field(docs, c) for c in docs.columns], T.StructField(pred_col, T.StringType()),
                           T.StructField(score_col, T.DoubleType())])
    at_text, names = docs.columns.index(text_col), docs.columns
    memory: dict[str, int] = {}
    known = [np.zeros((0, len(model.langs)))]

    def run(batch):
        nonlocal memory
        found = [words_of(t) for t in batch.column(at_text).to_pylist()]
        if len(memory) > MEMORY:
            memory, known[0] = {}, known[0][:0]
        new = list({w for words in found for w in words if w not in memory}) if model.langs else []
        if new:
            memory.update(zip(new, range(len(memory), len(memory) + len(new))))
            known[0] = np.concatenate([known[0], model.word_scores(new)])
        preds, scores = [], []
        for words in found:
            if not words or not model.langs:
                preds.append("und")
                scores.append(0.0)
                continue
            total = known[0][np.fromiter(map(memory.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            preds.append(model.langs[best])
            scores.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
        return {c: batch.column(i) for i, c in enumerate(names)} | {pred_col: preds, score_col: scores}

    return map_slices(docs.select(*[F.col(f"`{c}`") for c in docs.columns]), run, schema)


def accepted(pred_col: str = "lang_pred", score_col: str = "score", least: float = 0.5) -> Column:
    """What a filter keeps: a language was told, with at least this posterior."""
    return (F.col(pred_col) != "und") & (F.col(score_col) >= least)
