"""Language-model scores: an interpolated modified Kneser-Ney model of word pairs.

Spark counts; the model is stored as sorted arrays, and scoring tasks map them into memory, so a
worker's memory does not grow with the model. Words are 64-bit hashes, sorted: the place of a
word is its number. A pair is the number of its context and of its word in one 64-bit key, sorted.

The arrays are split into shards by ranges of hashes and of keys. Shards of pairs are cut where
the counts of the contexts say that they are equally large, within a frequent context too.
"""

from __future__ import annotations

import mmap
import os
import sys
import uuid
from collections.abc import Iterable, Iterator
from copy import copy
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.text import SPACED, Words, chunks
from plumbline.session import shared_folder

# What a task has counted is passed on when it holds so many different words or pairs.
HELD = 4 << 20
# The hash of the end of a text. Words that hash to it, one in 2**64, count as the end.
END = np.uint64(0x5BD1E995C6A4A793)
_PARTS = "shard int, keys binary, counts binary"


def model_folder(spark: SparkSession) -> str:
    """A new folder for a model, as a path: the arrays are mapped, so the shared folder has to be
    mounted on the executors."""
    folder = shared_folder(spark)
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError(f"memory-mapped models need a mounted shared folder, not {folder}")
    path = f"{folder.removeprefix('file://').removeprefix('file:')}/ngrams-{uuid.uuid4().hex}"
    os.makedirs(path, exist_ok=True)
    return path


def _save(path: str, name: str, shard: int, values: np.ndarray) -> None:
    """All or nothing: a task that runs twice, or dies, leaves no half of a file."""
    os.makedirs(path, exist_ok=True)
    context = TaskContext.get()
    part = f"{path}/.{name}-{shard}-{context.taskAttemptId()}.npy"
    np.save(part, values)
    os.replace(part, f"{path}/{name}-{shard}.npy")


# A mapped file needs no open one from Python 3.13 on, so that only the number of maps is bounded.
_KEEPS_NO_FILE = {"trackfd": False} if sys.version_info >= (3, 13) else {}
MAPPED = 1024 if _KEEPS_NO_FILE else 64


def _map(file: str) -> np.ndarray:
    """The array of a file, mapped into memory."""
    with open(file, "rb") as opened:
        np.lib.format.read_magic(opened)
        shape, _, kind = np.lib.format.read_array_header_1_0(opened)
        if 0 in shape:
            return np.empty(shape, kind)
        data = mmap.mmap(opened.fileno(), 0, access=mmap.ACCESS_READ, **_KEEPS_NO_FILE)
        return np.frombuffer(data, kind, int(np.prod(shape)), opened.tell()).reshape(shape)


class Maps:
    """The arrays of a folder. One is mapped when it is asked for, and those that were not used for
    longest are let go, so that a worker keeps few files and maps, whatever the shards."""

    def __init__(self, path: str):
        self._path = path
        self._map = lru_cache(maxsize=MAPPED)(_map)

    def of(self, name: str, shard: int) -> np.ndarray:
        return self._map(f"{self._path}/{name}-{shard}.npy")


def _planes(values: np.ndarray) -> bytes:
    """Bytes of sorted numbers, all first bytes first: these hardly vary and are compressed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _small_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts in one byte each: a key with more has several entries."""
    times = (counts + 254) // 255
    keys = np.repeat(keys, times)
    out = np.full(len(keys), 255, dtype=np.uint8)
    out[np.cumsum(times) - 1] = counts - 255 * (times - 1)
    return keys, out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _parts(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[tuple]:
    """(shard, keys, counts) of each shard, from sorted keys."""
    edges = np.flatnonzero(np.diff(shard)) + 1
    for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
        if b > a:
            some, small = _small_counts(keys[a:b], counts[a:b])
            yield int(shard[a]), _planes(some), small.tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    shards, keys, counts = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
        names=["shard", "keys", "counts"],
    )


def _gathered(parts: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    keys = [_from_planes(x, "<u8") for x in parts.column("keys").to_pylist()]
    counts = [np.frombuffer(x, np.uint8) for x in parts.column("counts").to_pylist()]
    return parts.column("shard")[0].as_py(), *_summed(np.concatenate(keys), np.concatenate(counts))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text followed by the end, and the text of each."""
    words = Words(texts, SPACED)
    doc = np.concatenate([words.doc, np.arange(len(texts))])
    order = np.argsort(doc, kind="stable")  # the end comes last
    return np.concatenate([words.hashes, np.full(len(texts), END)])[order], doc[order]


def _counted(streams: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted different values and their counts, over as many streams as HELD allows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for values in streams:
        held.append(np.unique(values, return_counts=True))
        if sum(len(keys) for keys, _ in held) > HELD:
            yield _summed(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield _summed(*map(np.concatenate, zip(*held, strict=True)))


class Vocabulary:
    """Hashes of the words of the corpus, in order; a word's number is its place from 1 on."""

    def __init__(self, path: str, sizes: list[int], totals: list[int]):
        self.path, self.shards = path, len(sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(totals)]).astype(np.int64)
        self.size, self.total = int(self.first[-1]), int(self.before[-1])

    def shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def open(self) -> Vocabulary:
        """Also for reading its arrays."""
        opened = copy(self)
        opened.maps = Maps(self.path)
        return opened

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Of sorted hashes; 0 for unknown words."""
        out = np.zeros(len(hashes), dtype=np.int64)
        edges = np.searchsorted(self.shard(hashes), np.arange(self.shards + 1))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a and self.first[k + 1] > self.first[k]:
                words = self.maps.of("words", k)
                at = np.minimum(np.searchsorted(words, hashes[a:b]), len(words) - 1)
                out[a:b] = np.where(words[at] == hashes[a:b], at + 1 + self.first[k], 0)
        return out

    def look_up(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """What the arrays of a name hold for sorted numbers; 0 for number 0."""
        out = np.zeros(len(numbers), dtype=np.int64)
        edges = np.searchsorted(numbers, self.first + 1)
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                out[a:b] = self.maps.of(name, k)[numbers[a:b] - 1 - self.first[k]]
        return out


def count_words(documents: DataFrame, path: str, shards: int) -> Vocabulary:
    """Write the sorted words of the corpus, with their counts and running sums of these."""
    layout = Vocabulary(path, [0] * shards, [0] * shards)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _counted(tokens(texts)[0] for _, texts in chunks(batches)):
            yield _batch(list(_parts(keys, counts, layout.shard(keys))))

    def store(parts: pa.Table) -> pa.Table:
        shard, keys, counts = _gathered(parts)
        _save(path, "words", shard, keys)
        _save(path, "counts", shard, counts)
        _save(path, "running", shard, np.cumsum(counts) - counts)
        row = {"shard": pa.array([shard], pa.int32()), "n": [len(keys)]}
        return pa.table({**row, "total": [int(counts.sum())]})

    rows = (
        documents.mapInArrow(count, _PARTS)
        .groupBy("shard")
        .applyInArrow(store, "shard int, n bigint, total bigint")
        .collect()  # a row for each shard
    )
    stored = {row["shard"]: row for row in rows}
    return Vocabulary(
        path,
        [stored[k]["n"] if k in stored else 0 for k in range(shards)],
        [stored[k]["total"] if k in stored else 0 for k in range(shards)],
    )


def _pairs(vocabulary: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Keys (context number, word number), different words' numbers, each token's place among
    these, and each token's text."""
    hashes, doc = tokens(texts)
    unique, place = np.unique(hashes, return_inverse=True)
    numbers = vocabulary.numbers(unique)
    word = numbers[place]
    context = np.concatenate([[0], word[:-1]])
    starts = np.concatenate([[True], doc[1:] != doc[:-1]])
    # Context 0 is the beginning of a text; an unknown context has no number.
    context = np.where(starts, 0, np.where(context == 0, -1, context))
    return context, word, numbers, place, doc


def _discounts(n: list[int]) -> np.ndarray:
    """Of counts 1, 2 and 3 or more, from how many have count 1 to 4; 0 where none can tell."""
    if not n[0]:
        return np.zeros(3)
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.0 for k in range(3)]
    return np.clip(raw, 0.0, [1.0, 2.0, 3.0])


class Model:
    """What a scoring task needs to map the arrays of a folder."""

    def __init__(self, vocabulary: Vocabulary, starts: int, stats: list[dict]):
        self.vocabulary, self.starts, self.shards = vocabulary, starts, len(stats)
        self.first_key = [row["first"] for row in stats]
        self.last_key = [row["last"] for row in stats]
        self.pair_discounts = _discounts(np.sum([row["n"] for row in stats], axis=0).tolist())

    def with_words(self, n_words: list[int], three: int) -> Model:
        """``n_words``: how many words follow 1, 2, 3, 4 different contexts; ``three``: 3 or more."""
        self.word_discounts = _discounts(n_words)
        self.total_pairs = sum(row for row in self.n_pairs)
        weight = self.word_discounts @ np.array([n_words[0], n_words[1], three])
        self.rest = float(weight / self.total_pairs) if self.total_pairs else 1.0
        return self


def _shard_of(vocabulary: Vocabulary, starts: int, shards: int, keys: np.ndarray) -> np.ndarray:
    """Shards of sorted keys: equal shares of all tokens, by the counts of their contexts."""
    context = (keys >> np.uint64(32)).astype(np.int64)
    unique, place = np.unique(context, return_inverse=True)
    size = np.where(unique > 0, vocabulary.look_up("counts", unique), starts)
    at = vocabulary.look_up("running", unique)
    of = np.searchsorted(vocabulary.first + 1, unique, side="right") - 1
    before = np.where(unique > 0, starts + at + vocabulary.before[np.maximum(of, 0)], 0)
    inside = (keys & np.uint64(0xFFFFFFFF)).astype(np.float64) / (vocabulary.size + 1)
    weight = before[place] + size[place] * inside
    return np.minimum(shards - 1, (weight * (shards / (vocabulary.total + starts + 1)))).astype(int)


def count_pairs(documents: DataFrame, vocabulary: Vocabulary, starts: int) -> Model:
    """Write the sorted pairs with their counts, what follows each context, and in how many
    contexts each word stands."""
    path, shards = vocabulary.path, vocabulary.shards
    fields = "shard int, keys binary, counts binary, first string, last string, n array<bigint>"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = vocabulary.open()

        def keys_of(texts: list[bytes]) -> np.ndarray:
            context, word, *_ = _pairs(opened, texts)
            return context.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)

        for keys, counts in _counted(keys_of(texts) for _, texts in chunks(batches)):
            yield _batch(list(_parts(keys, counts, _shard_of(opened, starts, shards, keys))))

    def store(parts: pa.Table) -> pa.Table:
        shard, keys, counts = _gathered(parts)
        _save(path, "pairs", shard, keys)
        _save(path, "pair-counts", shard, counts.astype("<u4"))
        contexts, place = np.unique(keys >> np.uint64(32), return_inverse=True)
        _save(path, "contexts", shard, contexts.astype(np.int64))
        follow = [np.bincount(place, counts == k, len(contexts)) for k in (1, 2)]
        follow.append(np.bincount(place, counts >= 3, len(contexts)))
        _save(path, "follow", shard, np.array(follow, dtype="<u4"))
        words, n = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
        of = np.searchsorted(vocabulary.first + 1, words.astype(np.int64), side="right") - 1
        rows = [(*row, None, None, None) for row in _parts(words, n, of)]
        # Its own group below, as its number is below 0.
        stats = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(keys)]
        rows.append((-1 - shard, None, None, str(int(keys[0])), str(int(keys[-1])), stats))
        return _table(rows)

    def gather(parts: pa.Table) -> pa.Table:
        shard = parts.column("shard")[0].as_py()
        if shard < 0:
            return parts
        _, words, n = _gathered(parts)
        _save(path, "before", shard, n.astype("<u4"))
        stats = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n >= 3).sum())]
        return _table([(shard, None, None, None, None, stats)])

    def _table(rows: list[tuple]) -> pa.Table:
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.list_(pa.int64())]
        names = ["shard", "keys", "counts", "first", "last", "n"]
        return pa.table(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    rows = (
        documents.mapInArrow(count, _PARTS)
        .groupBy("shard")
        .applyInArrow(store, fields)
        .groupBy("shard")
        .applyInArrow(gather, fields)
        .select("shard", "first", "last", "n")
        .collect()  # two rows for each shard
    )
    pairs = {-1 - row["shard"]: row for row in rows if row["shard"] < 0}
    words = [row["n"] for row in rows if row["shard"] >= 0]
    model = Model(
        vocabulary,
        starts,
        [
            {"first": int(pairs[k]["first"]), "last": int(pairs[k]["last"]), "n": pairs[k]["n"][:4]}
            for k in sorted(pairs)
        ]
        or [{"first": 1, "last": 0, "n": [0] * 4}],
    )
    model.pair_shards = sorted(pairs)
    model.n_pairs = [pairs[k]["n"][4] for k in sorted(pairs)]
    totals = np.sum(words, axis=0).tolist() if words else [0] * 5
    return model.with_words(totals[:4], totals[4])


class Scorer:
    """A model opened by a task."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, model.vocabulary.open()
        self._maps = self.vocabulary.maps
        stored = len(model.pair_shards)  # none for a model of no text
        sides = (model.first_key[:stored], model.last_key[:stored])
        self._keys = [np.array(side, dtype=np.uint64) for side in sides]
        self._contexts = [(side >> np.uint64(32)).astype(np.int64) for side in self._keys]

    def _parts(self, values: np.ndarray, ends: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """Shards that some of the sorted values may lie in, and which these are."""
        low = np.searchsorted(values, ends[0])
        high = np.searchsorted(values, ends[1], side="right")
        for k in np.flatnonzero(high > low).tolist():
            yield self.model.pair_shards[k], int(low[k]), int(high[k])

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), dtype=np.int64)
        for shard, a, b in self._parts(keys, self._keys):
            pairs, counts = self._maps.of("pairs", shard), self._maps.of("pair-counts", shard)
            at = np.searchsorted(pairs, keys[a:b])
            out[a:b] = np.where(pairs[at] == keys[a:b], counts[at], 0)
        return out

    def _weights(self, contexts: np.ndarray) -> np.ndarray:
        """Discounted mass after sorted contexts; a frequent context lies in several shards."""
        out = np.zeros(len(contexts))
        for shard, a, b in self._parts(contexts, self._contexts):
            known, follow = self._maps.of("contexts", shard), self._maps.of("follow", shard)
            at = np.searchsorted(known, contexts[a:b])
            mass = self.model.pair_discounts @ follow[:, at]
            out[a:b] += np.where(known[at] == contexts[a:b], mass, 0.0)
        return out

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base score, score."""
        v, model, n = self.vocabulary, self.model, len(texts)
        context, word, numbers, place, doc = _pairs(v, texts)
        order = np.argsort(numbers, kind="stable")
        count, before = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        count[order] = v.look_up("counts", numbers[order])
        before[order] = v.look_up("before", numbers[order])
        base = np.log10((count + 0.5) / (v.total + 0.5 * (v.size + 1)))[place]
        less = np.concatenate([[0.0], model.word_discounts])[np.minimum(before, 3)]
        lower = (before - less) / max(1, model.total_pairs) + model.rest / (v.size + 1)

        both = (context >= 0) & (word > 0)
        keys = context[both].astype(np.uint64) << np.uint64(32) | word[both].astype(np.uint64)
        unique, at = np.unique(keys, return_inverse=True)
        together = np.zeros(len(word), dtype=np.int64)
        together[both] = self._pair_counts(unique)[at]
        contexts, at = np.unique(context, return_inverse=True)
        total = v.look_up("counts", np.maximum(contexts, 0))
        total = np.where(contexts == 0, model.starts, total)[at]
        mass = self._weights(contexts)[at]
        less = np.concatenate([[0.0], model.pair_discounts])[np.minimum(together, 3)]
        seen = (context >= 0) & (total > 0)
        safe = np.maximum(total, 1)
        p = np.where(seen, (together - less) / safe + mass / safe * lower[place], lower[place])
        return (
            np.bincount(doc, minlength=n),
            np.bincount(doc, count[place] > 0, n).astype(np.int64),
            np.bincount(doc, base, n),
            np.bincount(doc, np.log10(np.maximum(p, 1e-300)), n),
        )


def train(documents: DataFrame) -> Model:
    """A model of the texts of ``documents``, in a new folder below the shared one."""
    spark = documents.sparkSession
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    documents = documents.select("doc_id", "text")
    vocabulary = count_words(documents, model_folder(spark), shards)
    return count_pairs(documents, vocabulary, documents.select("doc_id").count())


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row of ``documents``; the scores
    are log10 probabilities of the whole text and its end.

    Null and empty texts are the end alone. A model of no text gives every token the same
    probability. Rows with one doc_id are scored one by one. An empty table gives no rows. Only
    ``doc_id`` and ``text`` are read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for keys, texts in chunks(batches):
            n_tokens, n_known, base, full = scorer.score(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(n_known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(full, pa.float64()),
                ],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )


def held_out():
    """Rows that are kept from learning. A null doc_id is taken as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


@query("op1_language_model_kneser_ney")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train(documents.filter(~held_out()))
    scored = score(documents, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
