"""Stretches of texts that repeat with a period: found, reported and collapsed.

Candidates come from a harmonic grid: for each period ``q`` every word at a multiple of ``2 q`` is
compared with the word ``q`` further on. A run is so long that it meets the grid with at least
three words that agree. How far a candidate reaches is a longest common extension, answered
from a difference cover: only suffixes at sampled positions are sorted, a query compares a
few words until both of its positions are sampled, and a sparse table gives the rest.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.text import chunks

# A run has so many words at least, and so many periods.
MIN_WORDS = 6
MIN_PERIODS = 4

# A perfect difference set: every difference modulo 31 is one of two of its members.
COVER_MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)

# Candidates that are looked at together.
BATCH = 1 << 20


class CoverLCE:
    """How many words agree from two positions on, for a sequence whose last word is unique."""

    def __init__(self, ids: np.ndarray):
        v = COVER_MODULUS
        self._n = len(ids)
        self._ids = np.concatenate([ids, np.full(2 * v, -1, dtype=ids.dtype)])
        cover = np.array(COVER)
        self._number = np.full(v, -1)
        self._number[cover] = np.arange(len(cover))
        # For positions of two residues, the least step to a pair of sampled positions.
        steps = np.arange(v)
        sampled = self._number >= 0
        both = sampled[(steps[:, None, None] + steps) % v] & sampled[(steps[None, :, None] + steps) % v]
        self._step = both.argmax(axis=2)
        grid = (np.arange(0, self._n, v)[:, None] + cover).ravel()
        self._samples = grid[grid < self._n]
        self._sort()

    def _index(self, positions: np.ndarray) -> np.ndarray:
        return positions // COVER_MODULUS * len(COVER) + self._number[positions % COVER_MODULUS]

    def _first_ranks(self) -> np.ndarray:
        """Ranks of the samples by their first words, as many as the modulus."""
        width = max(1, int(self._ids.max() + 1).bit_length())
        per_key, keys = 63 // width, []
        for first in range(0, COVER_MODULUS, per_key):
            key = np.zeros(len(self._samples), dtype=np.int64)
            for k in range(first, min(first + per_key, COVER_MODULUS)):
                key = (key << width) | (self._ids[self._samples + k].astype(np.int64) + 1)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), dtype=bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        return _ranks(order, new)

    def _sort(self) -> None:
        size, sampled = len(self._samples), len(COVER)
        levels = [self._first_ranks()]
        while size and levels[-1].max() < size - 1:
            ranks, ahead = levels[-1], sampled << (len(levels) - 1)
            later = np.full(size, -1, dtype=np.int64)
            later[: max(0, size - ahead)] = ranks[ahead:]
            key = ranks * (size + 1) + later + 1
            order = np.argsort(key, kind="stable")
            new = np.zeros(size, dtype=bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            levels.append(_ranks(order, new))
        self._rank = levels[-1]
        order = np.empty(size, dtype=np.int64)
        order[self._rank] = np.arange(size)
        self._mins = _sparse_table(self._common(order[:-1], order[1:], levels))

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that pairs of samples have in common, from the ranks of each round of the sort."""
        size, found = len(self._samples), np.zeros(len(a), dtype=np.int64)
        first, second = self._samples[a], self._samples[b]
        for level in reversed(range(len(levels))):
            ranks = np.append(levels[level], -1)
            same = ranks[np.minimum(a, size)] == ranks[np.minimum(b, size)]
            same &= (a < size) & (b < size)
            ahead = (len(COVER) << level) * same
            a, b = a + ahead, b + ahead
            found += (COVER_MODULUS << level) * same
        return found + self._compare(first + found, second + found, np.full(len(a), COVER_MODULUS))

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words in common, looked at one by one, up to ``most``."""
        found = np.zeros(len(a), dtype=np.int64)
        left = np.flatnonzero(most > 0)
        while len(left):
            at = found[left]
            left = left[self._ids[a[left] + at] == self._ids[b[left] + at]]
            found[left] += 1
            left = left[found[left] < most[left]]
        return found

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common from ``a`` and from ``b`` on, pair by pair; no position equals its partner."""
        step = self._step[a % COVER_MODULUS, b % COVER_MODULUS]
        found = self._compare(a, b, step)
        far = np.flatnonzero(found == step)
        if len(far):
            first = self._rank[self._index(a[far] + step[far])]
            second = self._rank[self._index(b[far] + step[far])]
            low, high = np.minimum(first, second), np.maximum(first, second)
            # Two overlapping ranges of a power of two cover those between the ranks.
            level = np.frexp((high - low).astype(float))[1] - 1
            width = 1 << level
            found[far] += np.minimum(self._mins[level, low], self._mins[level, high - width])
        return found


def _ranks(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _sparse_table(values: np.ndarray) -> np.ndarray:
    """Row ``k`` has the least of the 2^k values from each place on."""
    rows = [values]
    while 1 << len(rows) <= len(values):
        half = 1 << (len(rows) - 1)
        row = rows[-1].copy()
        row[:-half] = np.minimum(row[:-half], rows[-1][half:])
        rows.append(row)
    return np.array(rows)


def _grid(ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods where three words in a row agree with those a period further on.

    The texts are sorted from the longest, with a word of their own after each, so that a period
    looks only at those that are long enough for it.
    """
    ends = np.cumsum(lengths + 1)
    ids = np.concatenate([ids, np.full(3, -1, dtype=ids.dtype)])
    places, periods, held = [], [], 0
    longest = int(lengths.max(initial=0))
    for q in range(1, longest // MIN_PERIODS + 1):
        long_enough = np.searchsorted(-lengths, -max(MIN_WORDS, MIN_PERIODS * q), side="right")
        if not long_enough:
            break
        limit = int(ends[long_enough - 1])
        at = np.flatnonzero(ids[0 : limit - q : 2 * q] == ids[q : limit : 2 * q]) * (2 * q)
        for k in (1, 2):
            at = at[ids[at + k] == ids[at + k + q]]
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), q))
            held += len(at)
            if held >= BATCH:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _runs_of(lce: CoverLCE, at: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and period of the runs that candidates belong to, once each."""
    least = np.maximum(MIN_WORDS, MIN_PERIODS * q) - q  # words that agree with those a period on
    end = at + lce(at, at + q)
    enough = end - at > least - 2 * q
    at, q, end, least = at[enough], q[enough], end[enough], least[enough]
    # A stretch that agrees is known by its end; its first place on the grid is kept.
    order = np.lexsort((at, end, q))
    at, q, end, least = at[order], q[order], end[order], least[order]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (q[1:] != q[:-1]) | (end[1:] != end[:-1])
    at, q, end, least = at[first], q[first], end[first], least[first]
    # It begins after the grid's place before: the first position from which it reaches ``at``.
    low, high = np.maximum(at - 2 * q + 1, 0), at.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        reaches = np.zeros(len(at), dtype=bool)
        reaches[open_] = lce(middle[open_], middle[open_] + q[open_]) >= (at - middle)[open_]
        high = np.where(open_ & reaches, middle, high)
        low = np.where(open_ & ~reaches, middle + 1, low)
    whole = end - low >= least
    return low[whole], (end + q)[whole], q[whole]


def runs_of_texts(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Start, length and least period of every run of each sequence of word ids (0 and up)."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long_enough = [k for k, ids in enumerate(texts) if len(ids) >= MIN_WORDS]
    order = sorted(long_enough, key=lambda k: -len(texts[k]))
    if not order:
        return found
    top = max(int(texts[k].max()) for k in order) + 1

    def joined(numbers: Iterable[int]) -> np.ndarray:
        parts = [part for n, k in enumerate(numbers) for part in (texts[k], [top + n])]
        return np.concatenate(parts).astype(np.int64)

    lengths = np.array([len(texts[k]) for k in order])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    for at, q in _grid(joined(order), lengths):
        of_text = np.searchsorted(starts, at, side="right") - 1
        chosen, own = np.unique(of_text, return_inverse=True)
        own_starts = np.concatenate([[0], np.cumsum(lengths[chosen] + 1)[:-1]])
        lce = CoverLCE(np.unique(joined([order[c] for c in chosen]), return_inverse=True)[1])
        start, end, period = _runs_of(lce, at - starts[of_text] + own_starts[own], q)
        text = np.searchsorted(own_starts, start, side="right") - 1
        start, end = start - own_starts[text], end - own_starts[text]
        for t, s, e, p in zip(chosen[text].tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
            found[order[t]].append((s, e - s, p))
    return [_of_least_period(runs) for runs in found]


def _of_least_period(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """A run agrees at every multiple of its period, with the same ends: the least is its own."""
    least: dict[tuple[int, int], int] = {}
    for start, length, period in runs:
        least[start, length] = min(period, least.get((start, length), period))
    return sorted((start, length, period) for (start, length), period in least.items())


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            dropped[start + period] += 1
            dropped[start + length] -= 1
        words = [word for word, n in zip(words, np.cumsum(dropped).tolist()) if not n]
    return b" ".join(words)


def collapse_runs(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and the collapsed ``text`` of every row.

    Words are what ASCII white space separates. A run is a stretch of words with a smallest period
    ``q``, of 6 words and 4 periods at least, which no word beside it prolongs. Of each run the
    first period stays; a word is dropped if any run holds it after that, and those that stay are
    joined by blanks. ``runs`` has ``start`` (from 0), ``length`` and ``period``, sorted.

    Each task works on its own rows, some megabytes of text at a time, and a text is never cut, so
    memory follows the longest text. Null and empty texts have no words, no runs and an empty
    text; rows with one doc_id are worked on one by one; an empty table gives no rows; columns
    besides ``doc_id`` and ``text`` are not read.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("text", pa.binary())]
    )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches):
            numbers = defaultdict(count().__next__)
            words = [text.split() for text in texts]
            ids = [np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)) for own in words]
            runs = runs_of_texts(ids)
            kept = [_collapsed(own, found) for own, found in zip(words, runs, strict=True)]
            flat = np.array([r for found in runs for r in found], dtype=np.int64).reshape(-1, 3)
            offsets = np.concatenate([[0], np.cumsum([len(found) for found in runs])])
            columns = [pa.array(flat[:, k]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(own) for own in words], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(run))
                    ),
                    pa.array(kept, pa.binary()),
                ],
                schema=schema,
            )

    found = documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        work,
        "doc_id bigint, n_words bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, text binary",
    )
    return found.withColumn("text", F.col("text").cast("string"))


def repeating(documents: DataFrame) -> DataFrame:
    """The documents, some of them made periodic: of an id whose checksum ends in 0 each word from
    a place on becomes one of the words that follow that place, again and again."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    parts = documents.select(
        "doc_id",
        "text",
        F.when(checksum % 10 == 0, words).alias("words"),
        F.floor(checksum / 10).alias("g"),
    )
    n = F.size("words").cast("bigint")
    a = F.col("g") % n
    placed = parts.withColumn("a", F.when(n > 0, a)).withColumn(
        "p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    )
    chosen = F.transform(
        "words",
        lambda word, i: F.when(i < F.col("a"), word).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        ),
    )
    made = F.when(F.col("p").isNotNull(), F.array_join(chosen, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", made.alias("text"))


def _of_best(name: str) -> Column:
    return F.col(f"best.{name}")


@query("op13_periodic_runs_difference_cover")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(repeating(table(spark, sf_dir, "documents")))
    # The longest, then the one that starts first, then the one of the least period.
    ranked = F.transform(
        "runs",
        lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", F.array_max(ranked)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-_of_best("start")).alias("start"),
        _of_best("length").alias("length"),
        (-_of_best("period")).alias("period"),
        F.floor(1000 * _of_best("length") / -_of_best("period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("text"), 256).alias("collapsed_sha256"),
    )
