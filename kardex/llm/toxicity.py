"""Toxicity by Levenshtein automata over a lexicon trie.

Terms and stems (beginnings of words that take many endings) are learned from
labelled rows.  Each distinct word of a text is the pattern of a Levenshtein
automaton, run against their trie: misspelled terms match within one or two
edits, stems match the word's beginning exactly.  A context window around each match tells
quotation (quote marks, reporting words) from abuse, and a logistic model over
the sums of these window scores gives the probability.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass, field as member

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, hashed_sample, map_slices

_STRIP = string.punctuation + "“”„«»‹›‘’…–—¿¡"
_OPEN, _CLOSE = set("\"“„«‹"), set("\"”“»›")
#: Words around a term that report or quote it.
REPORTING = frozenset("said says called quote quoted quoting wrote word term insult slur dit appelé mot sagte nannte "
                      "wort dijo llamó palabra".split())
ADDRESS = frozenset("you your you're youre tu toi vous du dich ihr usted ustedes eres".split())
WINDOW = 6
QUOTE_WINDOW = 12
#: Words a task remembers; beyond, it forgets all and goes on.
MEMORY = 400_000


def reach(term: str) -> int:
    """Edits allowed for a term of this length."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


#: Signs between letters or digits, quotes and apostrophes aside: they part words.
_INNER = re.compile(r"(?<=[^\W_])(?:[^\w\s'’\"“”„«»‹›]|_)+(?=[^\W_])")
#: Longest word whose automaton fits its 64-bit states.
_STATES = 61


def words_of(text: str | None) -> list[str]:
    """Lower-case words; signs stay at their edges, where they tell quotations."""
    return _INNER.sub(" ", text.lower()).split() if text else []


def within(word: str, term: str, most: int) -> int:
    """Edit distance, or above ``most``."""
    if abs(len(word) - len(term)) > most:
        return most + 1
    row = list(range(len(term) + 1))
    for i, x in enumerate(word, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(term, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


class Trie:
    """Of terms; one that ends in ``*`` is a stem."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.most: list[int] = [0]
        self.stem: list[int] = [-1]
        for place, word in enumerate(terms):
            node, body = 0, word.removesuffix("*")
            edits = reach(word) if body == word else 0
            for c in body:
                self.most[node] = max(self.most[node], edits)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.stem.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
            (self.term if body == word else self.stem)[node] = place
            self.most[node] = max(self.most[node], edits)
        self.terms = terms
        self.shortest = min((len(t.removesuffix("*")) - (0 if t[-1] == "*" else reach(t)) for t in terms), default=0)
        self.longest = max((_STATES if t[-1] == "*" else len(t) + reach(t) for t in terms), default=-1)
        self.stems = [(t[:-1], place) for place, t in enumerate(terms) if t[-1] == "*"]
        self.long = [(t, place) for place, t in enumerate(terms) if t[-1] != "*" and len(t) + reach(t) > _STATES]

    def _long(self, word: str) -> tuple[int, int]:
        """The match of a word beyond the states: a stem it begins with, else
        the closest of the terms that long, one by one."""
        found = [(0, place) for stem, place in self.stems if word.startswith(stem)]
        found = found or [(within(word, t, reach(t)), place) for t, place in self.long]
        best = min((f for f in found if f[0] <= reach(self.terms[f[1]])), default=None)
        return (best[1], best[0]) if best else (-1, 99)

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the closest term's index (-1: none) and its distance.

        The automaton of a word has a bit set of reached word places for each
        number of edits; all words step through the trie together, and a branch
        goes on with the words whose automaton is still alive.
        """
        best = np.full(len(words), -1, np.int64)
        distance = np.full(len(words), 99, np.int64)
        if not self.terms:
            return best, distance
        for i, w in enumerate(words):
            if len(w) > _STATES:
                best[i], distance[i] = self._long(w)
        at = np.array([i for i, w in enumerate(words) if self.shortest <= len(w) <= min(self.longest, _STATES)], np.int64)
        if not len(at):
            return best, distance
        some = [words[i] for i in at]
        width = max(map(len, some))
        cells = np.array(some, dtype=f"<U{width}").view(np.uint32).reshape(len(some), width)
        place = np.uint64(1) << np.arange(width, dtype=np.uint64)
        letters = {c for kids in self.children for c in kids}
        masks = {c: np.where(cells == ord(c), place, np.uint64(0)).sum(axis=1, dtype=np.uint64) for c in letters}
        end = np.uint64(1) << np.fromiter(map(len, some), np.uint64, len(some))
        one = np.uint64(1)
        start = [np.full(len(some), (1 << d + 1) - 1, np.uint64) for d in range(self.most[0] + 1)]
        stack = [(0, 0, np.arange(len(some)), start)]
        while stack:
            node, depth, rows, states = stack.pop()
            if (stem := self.stem[node]) >= 0:
                hit = at[rows[(states[0] & (one << np.uint64(depth))) != 0]]
                hit = hit[distance[hit] > 0]
                best[hit], distance[hit] = stem, 0
            if (term := self.term[node]) >= 0:
                for d in range(reach(self.terms[term]) + 1):
                    hit = at[rows[(states[d] & end[rows]) != 0]]
                    hit = hit[d < distance[hit]]
                    best[hit], distance[hit] = term, d
            for c, child in self.children[node].items():
                mask, after = masks[c][rows], []
                for d in range(self.most[child] + 1):
                    step = (states[d] & mask) << one
                    if d:
                        step |= states[d - 1] | (states[d - 1] << one) | (after[d - 1] << one)
                    after.append(step)
                alive = np.flatnonzero(after[-1])
                if len(alive):
                    stack.append((child, depth + 1, rows[alive], [s[alive] for s in after]))
        return best, distance


def window_scores(words: list[str], hits: list[tuple[int, float]]) -> list[float]:
    """Features of a text: strongest and summed abuse, summed quotation, and
    density, from its ``(place, weight)`` matches."""
    abuse = quoted = strongest = 0.0
    for at, weight in hits:
        lead = words[max(0, at - QUOTE_WINDOW):at + 1]
        tail = words[at:at + QUOTE_WINDOW + 1]
        opened = any(w[0] in _OPEN for w in lead)
        closed = any(w[-1] in _CLOSE or w.rstrip(".,;:!?")[-1:] in _CLOSE for w in tail)
        near = [w.strip(_STRIP) for w in words[max(0, at - WINDOW):at + WINDOW + 1]]
        score = weight
        if opened and closed:
            score *= 0.25
            quoted += weight
        elif any(w in REPORTING for w in near):
            score *= 0.5
        if any(w in ADDRESS for w in near):
            score = min(1.0, score * 1.5)
        abuse += score
        strongest = max(strongest, score)
    return [strongest, math.log1p(abuse), math.log1p(quoted), min(1.0, 20 * abuse / max(1, len(words)))]


@dataclass
class Model:
    terms: list[str]
    common: frozenset[str] = frozenset()
    weights: list[float] = member(default_factory=lambda: [0.0] * 5)

    def scorer(self):
        """texts -> features, with a bounded memory of words."""
        trie = Trie(self.terms)
        seen: set[str] = set()
        weight: dict[str, float] = {}

        def learn(new: list[str]) -> None:
            plain = [w.strip(_STRIP) for w in new]
            best, distance = trie.match(plain)
            for i in np.flatnonzero(best >= 0).tolist():
                if distance[i] == 0:
                    weight[new[i]] = 1.0
                elif plain[i] not in self.common:
                    weight[new[i]] = 0.9 if distance[i] == 1 else 0.8

        def features(texts: list[str | None]) -> np.ndarray:
            found = [words_of(t) for t in texts]
            if len(seen) > MEMORY:
                seen.clear()
                weight.clear()
            new = list({w for words in found for w in words} - seen)
            seen.update(new)
            learn(new)
            out = np.zeros((len(found), 4))
            for i, words in enumerate(found):
                hits = [(at, weight[w]) for at, w in enumerate(words) if w in weight]
                if hits:
                    out[i] = window_scores(words, hits)
            return out

        return features

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ np.array(self.weights[1:]), -30, 30)))


#: The strongest match explains a text first, sums and density add to it.
RIDGE = (0.05, 4.0, 4.0, 4.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: tuple[float, ...] = RIDGE, rounds: int = 50) -> list[float]:
    """Ridge-regularised logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows_per_class: int = 3000, least_share: float = 0.02, max_terms: int = 500) -> Model:
    """Learns terms and weights from at most ``rows_per_class`` labelled rows
    of each class (smallest hashed ids), the only sample.  Near copies in it
    count once.  Terms: words, and beginnings of words (4 to 8 letters), in at
    least ``least_share`` of the toxic texts and rare elsewhere; the
    ``max_terms`` strongest (the lexicon's documented size).  A beginning counts
    only if it occurs in half as many texts again as its commonest word; it
    then stands for its words.  Rows without a label or id are not learned from; an id labelled
    twice counts as toxic if any label says so."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    sample = hashed_sample(marked.withColumn("h", F.xxhash64(F.lit(5), "id")), "toxic", rows_per_class, "h", "id").drop("h")
    # The sample's size is a parameter: two classes of rows_per_class ids.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample), "id")

    def shrink(batch):
        near, lists = [], []
        for text in batch.column(1).to_pylist():
            words = [w.strip(_STRIP) for w in words_of(text)]
            grams = [" ".join(words[i:i + 2]) for i in range(max(1, len(words) - 1))]
            near.append(min(xxhash.xxh64_intdigest(g) for g in grams) >> 1)
            found = {w for w in words if w}
            lists.append(sorted(found | {w[:n] + "*" for w in found for n in range(4, 9) if n < len(w)}))
        return {"toxic": batch.column(0), "near": near, "words": lists}

    bags = map_slices(rows.select("toxic", "text"), shrink, T.StructType([
        T.StructField("toxic", T.IntegerType()), T.StructField("near", T.LongType()),
        T.StructField("words", T.ArrayType(T.StringType()))]))
    bags = bags.groupBy("near", "toxic").agg(F.min("words").alias("words"))
    totals = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in bags.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = bags.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("good"))
    bad, good = max(1, totals[1]), max(1, totals[0])
    ratio = (F.col("bad") / bad) / ((F.col("good") + 0.5) / good)
    strong = counts.where((F.col("bad") >= F.lit(max(3.0, least_share * bad))) & (ratio >= 8) & (F.length("word") >= 3))
    strong = strong.orderBy((F.col("bad") * F.log(ratio)).desc(), "word").limit(20 * max_terms).collect()
    words = {r["word"]: r["bad"] for r in strong if r["word"][-1] != "*"}
    stems: list[str] = []
    for r in strong:
        body = r["word"].removesuffix("*")
        # A stem must reach well beyond its commonest word.
        if body != r["word"] and not body.startswith(tuple(stems)) and r["bad"] >= 1.5 * max(
                [0, *(n for w, n in words.items() if w.startswith(body))]):
            stems.append(body)
    terms = [r["word"] for r in strong if (r["word"] in words and not r["word"].startswith(tuple(stems)))
             or r["word"][:-1] in stems and r["word"][-1] == "*"][:max_terms]
    # Words of clean texts are no misspellings.
    usual = frozenset(r["word"] for r in counts.where((F.col("good") >= F.lit(max(3.0, 0.0005 * good)))
                                                      & ~F.endswith("word", F.lit("*"))).select("word").collect()) - set(terms)
    trie = Trie(terms)
    close = trie.match(sorted(usual))[0]
    common = frozenset(w for w, b in zip(sorted(usual), close.tolist()) if b >= 0)
    model = Model(terms, common)
    features = _features(rows.select("id", "text", "toxic"), model, ["id", "toxic"]).select("toxic", "features").collect()
    if features and terms:
        model.weights = logistic(np.array([r["features"] for r in features]), np.array([r["toxic"] for r in features], float))
    else:
        share = (totals[1] + 0.5) / (totals[0] + totals[1] + 1)
        model.weights = [math.log(share / (1 - share)) if features else 0.0, 0, 0, 0, 0]
    return model


def _features(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    state: list = []

    def run(batch):
        if not state:
            state.append(model.scorer())
        return {c: batch.column(i) for i, c in enumerate(keep)} | {
            "features": state[0](batch.column(len(keep)).to_pylist()).tolist()}

    schema = T.StructType([*[field(docs, c) for c in keep], T.StructField("features", T.ArrayType(T.DoubleType()))])
    return map_slices(docs.select(*keep, text_col), run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every whole text.

    Defined cases: null and empty texts have no match and get the score of a
    text without terms; without labels every score is 0.5, without terms the
    share of toxic labels; rows that repeat stay; an empty table gives none.
    """
    schema = T.StructType([field(docs, id_col, "id"), T.StructField("score", T.DoubleType())])
    state: list = []

    def run(batch):
        if not state:
            state.append(model.scorer())
        return {"id": batch.column(0), "score": model.probability(state[0](batch.column(1).to_pylist()))}

    return map_slices(docs.select(id_col, F.col(text_col).cast("string")), run, schema)
