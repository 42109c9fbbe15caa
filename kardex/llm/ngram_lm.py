"""N-gram scores from an Elias-Fano trie.

The training words are counted first; each hash shard keeps its part of the
vocabulary as an Elias-Fano sequence of word hashes, whose ranks are the word
ids.  Then batches of documents ask the shards (see ``exchange``) twice: about
their distinct words, and about their distinct pairs of context and word.  For
these a shard sums the training counts, discounts them, builds the trie of its
contexts, writes it to the shared folder, maps that file into memory and
answers from it.

The model interpolates bigrams with unigrams by absolute discounting:
``p(w | c) = (n(cw) - d) / n(c) + d * followers(c) / n(c) * p(w)``.  Unigrams
give the discounted mass to one class of unknown words, which is backed off to
as any other word, so that after each context the probabilities sum to 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kardex.llm.common import field, mix64, shared_dir
from kardex.llm.elias_fano import EliasFano, Trie, pack, unpack
from kardex.llm.exchange import Batch, answers, batched, shard_of, slices

#: Stands for the end of a text; no word contains a line end.
END = b"\n"


def save(folder: str, name: str, data: bytes) -> str:
    """Writes a file of the shared folder; the name is unique to the attempt."""
    from pyarrow import fs

    place = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    files, path = fs.FileSystem.from_uri(place)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path, compression=None) as out:
        out.write(data)
    return place


def mapped(place: str) -> pa.Buffer:
    """The file's bytes, memory-mapped where the store allows it."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(place)
    if isinstance(files, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with files.open_input_file(path) as source:
        return source.read_buffer()


def planes(values: np.ndarray) -> bytes:
    """Differences of a rising sequence, byte by byte place: small numbers
    leave planes of zeros that the shuffle's compression removes."""
    values = values.astype(np.uint64)
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(np.uint64).ravel(), dtype=np.uint64)


def small(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def unsmall(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


class Tokens(Batch):
    """A batch's tokens: its words, lower-cased, and an end after each text."""

    def __init__(self, table: pa.Table):
        super().__init__(table, lower=True)
        self.train = self.rows.column("train").to_numpy().astype(bool)
        n, docs = len(self.codes) + len(self.lengths), np.arange(len(self.lengths))
        self.token_ends = self.ends + docs + 1
        self.tokens = np.empty(n, np.int64)
        last = np.zeros(n, bool)
        last[self.token_ends - 1] = True
        self.tokens[last], self.tokens[~last] = len(self.words), self.codes
        self.words = [*self.words, END]
        self.first = np.concatenate([[True], last[:-1]]) if n else last
        self.trained = np.repeat(self.train, self.lengths + 1)
        # Two bits less than a full hash: sequences of them fit signed numbers.
        hashed = self.hashes() & ~np.uint64(3)
        self.order = np.argsort(hashed)
        self.keys = hashed[self.order]
        self.rank = np.empty(len(self.order), np.int64)
        self.rank[self.order] = np.arange(len(self.order))

    def word_counts(self) -> np.ndarray:
        """Training count of each key."""
        return np.bincount(self.rank[self.tokens], weights=self.trained, minlength=len(self.keys)).astype(np.int64)


_WORDS = "shard long, keys binary, counts binary"
_LEVEL = "shard long, v long, n long, once long, twice long, path string"
_ASK = "shard long, batch long, keys binary"
_TELL = "batch long, shard long, counts binary, ids binary"
#: Stands for the start of a text among the word keys, which end in two zeros.
START = np.uint64(1)


def _slices_of(batches: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[Tokens]:
    """The tokens of a task's ``(text, train)`` rows, some bytes at a time."""
    for batch in batches:
        sizes = batch.column(0).cast(pa.large_binary())
        bounds = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + batch_bytes, side="right")) - 1)
            part = pa.Table.from_batches([batch.slice(at, to - at)], pa.schema(batch.schema))
            yield Tokens(part.append_column("k", pa.array(np.arange(to - at))))
            at = to


def _count_words(shards: int, batch_bytes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _slices_of(batches, batch_bytes):
            counts = words.word_counts()
            keys, counts = words.keys[counts > 0], counts[counts > 0]
            parts = slices(keys, shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.int64()), pa.array([planes(keys[s:e]) for _, s, e in parts], pa.binary()),
                 pa.array([small(counts[s:e]) for _, s, e in parts], pa.binary())], names=["shard", "keys", "counts"])

    return count


def _sum_words(folder: str):
    def add(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        counts = np.concatenate([unsmall(c) for c in table.column("counts").to_pylist()])
        keys, index = np.unique(np.concatenate([unplanes(k) for k in table.column("keys").to_pylist()]), return_inverse=True)
        total = np.bincount(index, weights=counts, minlength=len(keys)).astype(np.int64)
        # The vocabulary level of the trie: hashes in order, their rank the id.
        level = EliasFano.build((keys >> np.uint64(2)).astype(np.int64), 1 << 62)
        path = save(folder, f"words-{shard:06d}", pack([*level.parts(), total.astype(np.uint64)]))
        row = (shard, len(keys), int(total.sum()), int((total == 1).sum()), int((total == 2).sum()), path)
        return pa.table([pa.array([c]) for c in row], names=[c.split()[0] for c in _LEVEL.split(", ")])

    return add


def _level(path: str) -> tuple[EliasFano, np.ndarray]:
    parts = unpack(mapped(path))
    return EliasFano.of(parts[:4]), parts[4].view(np.uint64).astype(np.int64)


def _answer_words(paths: dict[int, str]):
    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        counts, ids = [], []
        level = _level(paths[shard]) if shard in paths else None
        for data in table.column("keys").to_pylist():
            keys = unplanes(data)
            total, place = np.zeros(len(keys), np.int64), np.full(len(keys), -1)
            if level is not None:
                none = np.zeros(len(keys), np.int64)
                at, found = level[0].successor(none, none + level[0].n, (keys >> np.uint64(2)).astype(np.int64))
                total[found], place[found] = level[1][at[found]], at[found]
            counts.append(np.ascontiguousarray(total.view(np.uint8).reshape(-1, 8).T).tobytes())
            ids.append(small(place + 1))
        return pa.table({"batch": table.column("batch"), "shard": table.column("shard"),
                         "counts": pa.array(counts, pa.binary()), "ids": pa.array(ids, pa.binary())})

    return answer


class Vocabulary:
    """What the driver knows of the vocabulary: one row per shard."""

    def __init__(self, stats: list, starts: int):
        self.base, self.paths = {}, {}
        self.size = self.tokens = once = twice = 0
        for r in sorted(stats, key=lambda r: r["shard"]):
            self.base[r["shard"]], self.paths[r["shard"]] = self.size, r["path"]
            self.size += r["v"]
            self.tokens += r["n"]
            once, twice = once + r["once"], twice + r["twice"]
        self.starts = starts
        self.discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
        #: Rest weight of each context that is dealt over several shards.
        self.hot: dict[int, float] = {}

    def most(self, shards: int) -> int:
        """Tokens that one context may bring to one shard: four shares."""
        return max(1, 4 * self.tokens // shards)

    def resolve(self, words: Tokens, replies: pa.Table, shards: int) -> None:
        """Gives ``words`` the count and id (-1: unknown) of each of its words."""
        parts = slices(words.keys, shards)
        counts = [np.ascontiguousarray(a.reshape(8, -1).T).view(np.int64).ravel()
                  for a in answers(replies, parts, "counts", "u1")]
        ids = [unsmall(a.tobytes()) for a in answers(replies, parts, "ids", "u1")]
        ids = [np.where(i > 0, i - 1 + self.base.get(p[0], 0), -1) for i, p in zip(ids, parts)]
        zero = np.zeros(0, np.int64)
        words.count = np.concatenate([zero, *counts])[words.rank]
        words.id = np.concatenate([zero, *ids])[words.rank]


def _hot_contexts(rows: DataFrame, vocabulary: Vocabulary, shards: int, discount: float, batch_bytes: int) -> dict[int, float]:
    """Rest weights of the contexts with more tokens than one shard takes (so
    fewer than there are shards): their pairs are spread over shards, and
    their followers are counted here, exactly, in a pass of their own."""
    share, spark = vocabulary.most(shards), rows.sparkSession
    if not vocabulary.tokens:
        return {}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(*(c.to_pylist() for c in batch.columns)):
                level, counts = _level(path)
                at = np.flatnonzero(counts > share)
                keys = level.get(at).astype(np.uint64) << np.uint64(2)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(at + vocabulary.base[shard]),
                                                  pa.array(counts[at])], names=["key", "id", "n"])

    paths = spark.createDataFrame(sorted(vocabulary.paths.items()), "shard long, path string")
    hot = {r["key"]: (r["id"], r["n"]) for r in paths.mapInArrow(find, "key long, id long, n long").collect()}
    if vocabulary.starts > share:
        hot[int(START)] = (vocabulary.size, vocabulary.starts)
    if not hot:
        return {}
    wanted = np.array(sorted(hot), np.int64).view(np.uint64)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _slices_of(batches, batch_bytes):
            key = words.keys[words.rank][words.tokens]
            before = np.where(words.first, START, np.concatenate([[START], key[:-1]]))
            at = np.isin(before, wanted) & words.trained
            both = np.unique(np.column_stack([before[at], key[at]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].view(np.int64)), pa.array(both[:, 1].view(np.int64))],
                                             names=["context", "word"])

    followers = rows.select("text", "train").mapInArrow(pairs, "context long, word long").distinct().groupBy("context").agg(
        F.count("*").alias("n")).collect()
    return {hot[r["context"]][0]: discount * r["n"] / hot[r["context"]][1] for r in followers}


class Pairs:
    """Distinct (context, word) pairs of a batch after known contexts, sorted by
    shard, context and word; all unknown words are one word, whose id is past
    the known ones.  A context with more tokens than one shard takes is
    dealt over several shards by the word; such a shard holds one context."""

    def __init__(self, words: Tokens, vocabulary: Vocabulary, shards: int):
        starts, token_id = vocabulary.starts, words.id[words.tokens]
        start = vocabulary.size
        before = np.where(words.first, start, np.concatenate([[0], token_id[:-1]])) if len(token_id) else token_id
        # Without training rows there is no context, not even the start.
        self.known = np.flatnonzero((before >= 0) & (starts > 0))
        radix = start + 1
        if radix >= 3_000_000_000:
            raise ValueError("a pair of words does not fit 64 bits beyond three thousand million distinct words")
        token_id = np.where(token_id >= 0, token_id, start)
        keys, index = np.unique(before[self.known] * radix + token_id[self.known], return_inverse=True)
        counts = np.bincount(index, weights=words.trained[self.known], minlength=len(keys)).astype(np.int64)
        context, word = keys // radix, keys % radix
        named, of = np.unique(context, return_inverse=True)
        order = np.argsort(words.id)
        at = np.minimum(np.searchsorted(words.id[order], named), len(order) - 1)
        by_id = np.where(named == start, starts, words.count[order[at]])[of]
        share = vocabulary.most(shards)
        pieces = -(-by_id // share)
        shard = shard_of(mix64(context.astype(np.uint64)), shards).astype(np.int64)
        hot = pieces > 1
        # Past the plain shards: one number for each piece of each hot context.
        piece = (mix64(word.astype(np.uint64)) % np.maximum(pieces, 1).astype(np.uint64)).astype(np.int64)
        shard = np.where(hot, shards + context * (shards + 1) + piece, shard)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.index = place[index]
        self.shard, self.keys, self.counts, self.size = shard[order], keys[order], counts[order], by_id[order]
        at = np.flatnonzero(np.concatenate([[True], self.shard[1:] != self.shard[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.parts = list(zip(self.shard[at].tolist(), at.tolist(), np.append(at[1:], len(keys)).tolist())) if len(keys) else []


_PAIR_ASK = "shard long, batch long, keys binary, counts binary, size long"
_PAIR_TELL = "batch long, shard long, pair binary, rest binary, pair_bins binary, rest_bins binary"


def _sum_pairs(folder: str, vocabulary: Vocabulary, shards: int, discount: float):
    radix = vocabulary.size + 1

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [unplanes(k).astype(np.int64) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([unsmall(c) for c in table.column("counts").to_pylist()])
        keys, index = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(index, weights=counts, minlength=len(keys)).astype(np.int64)
        asked_context, asked_word = keys // radix, keys % radix
        seen = total > 0
        context, word, n = asked_context[seen], asked_word[seen], total[seen].astype(float)
        _, of, followers = np.unique(context, return_inverse=True, return_counts=True)
        hot = shard >= shards
        size = np.bincount(of, weights=n) if not hot else np.full(len(followers), table.column("size")[0].as_py(), float)
        log_p = np.log10((n - discount) / size[of])
        log_rest = np.log10(discount * followers / size)
        path = save(folder, f"pairs-{shard:06d}", Trie.build(context, word, log_p, log_rest, radix).dump())
        trie = Trie.load(mapped(path))
        pair, rest = trie.look_up(asked_context, asked_word)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        bins = trie.bins.tobytes(), trie.rest_bins.tobytes()
        out = [(b, shard, pair[i].tobytes(), None if hot else rest[i].tobytes(), *bins)
               for b, i in zip(table.column("batch").to_pylist(), np.split(index, cuts))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), *[pa.binary()] * 4))],
                        names=[c.split()[0] for c in _PAIR_TELL.split(", ")])

    return answer


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", discount: float = 0.75,
          batch_bytes: int = 4 << 20, shard_bytes: int = 8 << 20, folder: str | None = None) -> DataFrame:
    """One row per document: ``id, n_tokens, n_known, train_tokens, base_score,
    score``.  The model learns from the rows where ``train`` (a condition on
    the column ``id``) holds; its trie files stay in ``folder`` (default: a new
    one in the shared folder).

    Defined cases: a null or empty text is one end; words are lower-cased A-Z;
    without training rows the only class is the unknown word, with probability
    1; rows that repeat are learned and scored each; an empty table gives none.
    """
    folder = folder or f"{shared_dir(docs.sparkSession).rstrip('/')}/ngrams-{uuid.uuid4()}"
    rows, shards = batched(docs, id_col, text_col, batch_bytes, shard_bytes)
    rows = rows.withColumn("train", F.coalesce(train, F.lit(False)))
    by_batch = rows.groupBy("batch")
    stats = (rows.select("text", "train").mapInArrow(_count_words(shards, batch_bytes), _WORDS)
             .groupBy("shard").applyInArrow(_sum_words(folder), _LEVEL).collect())
    vocabulary = Vocabulary(stats, rows.where("train").count())
    vocabulary.hot = _hot_contexts(rows, vocabulary, shards, discount, batch_bytes)

    def ask_words(table: pa.Table) -> pa.Table:
        words, batch = Tokens(table), table.column("batch")[0].as_py()
        parts = slices(words.keys, shards)
        return pa.table({"shard": pa.array([p[0] for p in parts], pa.int64()),
                         "batch": pa.array([batch] * len(parts), pa.int64()),
                         "keys": pa.array([planes(words.keys[s:e]) for _, s, e in parts], pa.binary())})

    words_told = by_batch.applyInArrow(ask_words, _ASK).groupBy("shard").applyInArrow(
        _answer_words(vocabulary.paths), _TELL)

    def ask_pairs(table: pa.Table, replies: pa.Table) -> pa.Table:
        words, batch = Tokens(table), table.column("batch")[0].as_py()
        vocabulary.resolve(words, replies, shards)
        pairs = Pairs(words, vocabulary, shards)
        parts = pairs.parts
        return pa.table({"shard": pa.array([p[0] for p in parts], pa.int64()),
                         "batch": pa.array([batch] * len(parts), pa.int64()),
                         "keys": pa.array([planes(pairs.keys[s:e]) for _, s, e in parts], pa.binary()),
                         "counts": pa.array([small(pairs.counts[s:e]) for _, s, e in parts], pa.binary()),
                         "size": pa.array([int(pairs.size[s]) for _, s, _ in parts], pa.int64())})

    pairs_told = (by_batch.cogroup(words_told.groupBy("batch")).applyInArrow(ask_pairs, _PAIR_ASK)
                  .groupBy("shard").applyInArrow(_sum_pairs(folder, vocabulary, shards, discount), _PAIR_TELL))

    schema = T.StructType([field(rows, "id"), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    total, kinds = vocabulary.tokens, vocabulary.size
    base_log = np.log10(total + kinds + 1)

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        words = Tokens(table)
        asked = np.array(replies.column("step").to_pylist())
        vocabulary.resolve(words, replies.filter(pa.array(asked == 1, pa.bool_())), shards)
        pairs = Pairs(words, vocabulary, shards)
        second = replies.filter(pa.array(asked == 2, pa.bool_()))
        got = {r["shard"]: r for r in second.select(["shard", "pair", "rest", "pair_bins", "rest_bins"]).to_pylist()}
        direct, rest = np.zeros(len(pairs.keys)), np.zeros(len(pairs.keys))
        for shard, s, e in pairs.parts:
            row = got[shard]
            code = np.frombuffer(row["pair"], np.uint8)
            direct[s:e] = np.where(code > 0, 10 ** np.frombuffer(row["pair_bins"])[code], 0)
            if shard >= shards:
                rest[s:e] = vocabulary.hot.get((shard - shards) // (shards + 1), 0.0)
            else:
                code = np.frombuffer(row["rest"], np.uint8)
                rest[s:e] = np.where(code > 0, 10 ** np.frombuffer(row["rest_bins"])[code], 0)
        d, count = vocabulary.discount, words.count
        single = np.where(count > 0, (count - d) / max(1, total), d * kinds / max(1, total)) if total else np.ones(len(count))
        p = single[words.tokens]
        # A word never seen after this context, known or not, has the context's
        # rest; after an unknown word all take the unigram.
        known = pairs.known
        p[known] = direct[pairs.index] + np.where(rest[pairs.index] > 0, rest[pairs.index], 1.0) * p[known]
        logs = np.log10(p)
        base = (np.log10(count + 1) - base_log)[words.tokens]
        at = words.token_ends - words.lengths - 1
        sums = [np.add.reduceat(x, at) if len(at) else np.zeros(0) for x in (base, logs, (count > 0)[words.tokens].astype(np.int64))]
        return pa.table({"id": words.rows.column("id"), "n_tokens": words.lengths + 1, "n_known": sums[2],
                         "train_tokens": np.full(len(at), total), "base_score": sums[0], "score": sums[1]})

    none, nothing = F.lit(None).cast("binary"), {"counts": "binary", "ids": "binary"}
    replies = words_told.select(F.lit(1).alias("step"), "batch", "shard", "counts", "ids", none.alias("pair"), none.alias("rest"),
                                none.alias("pair_bins"), none.alias("rest_bins")).unionAll(
        pairs_told.select(
            F.lit(2).alias("step"), "batch", "shard", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()],
            "pair", "rest", "pair_bins", "rest_bins"))
    return by_batch.cogroup(replies.groupBy("batch")).applyInArrow(finish, schema)
