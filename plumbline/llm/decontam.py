"""Benchmark passages in training texts, by suffix arrays of the training texts.

A task sorts the suffixes of its texts, shard by shard, as far as a window reaches, and searches
every test suffix in each shard by bisection. Words that no test text has end every match, so the
suffixes that hold one within the shortest window are left out of the array before it is sorted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.linededup import LOWER, UPPER
from plumbline.llm.registry import query, table
from plumbline.llm.text import PLAIN, Words, chunks
from plumbline.session import materialize

WINDOW = 13
# A document is contaminated if it has hit words, and one in so many words or more is hit.
SHARE = 20
# Test texts that one pass over the documents searches for, by bytes; more take more passes.
SLICE_BYTES = 8 << 20
# Windows that are searched for together.
BLOCK = 1 << 16

_MATCH = "array<struct<start: bigint, length: bigint, item_id: bigint, item_start: bigint>>"


class TestSuffixes:
    """The test texts of one slice: word numbers, and each different window once.

    Items of the same words are one, with several ids. ``arrays`` is all there is to it, as plain
    arrays: that is what executors get, so that they need no copy of the package.
    """

    __test__ = False  # not a pytest class

    def __init__(self, arrays: dict):
        self.arrays = arrays
        self.vocabulary, self.words = arrays["vocabulary"], arrays["words"]
        self.first, self.size, self.item_ids = arrays["first"], arrays["size"], arrays["item_ids"]
        # By length: one place of each window; all places, grouped by window, and their bounds.
        self.windows = arrays["windows"]
        self.shortest = min((w[0] for w in self.windows), default=0)

    @classmethod
    def of(cls, items: list[tuple[int | None, str]], window: int = WINDOW) -> TestSuffixes:
        """Of items in the order of their ids."""
        texts = [(text or "").encode() for _, text in items]
        words = Words(texts, PLAIN)
        vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
        numbers = (numbers + 1).astype(np.int32)
        bounds = words.bounds(len(items))
        ids: dict[bytes, list[int | None]] = {}
        for (item_id, _), a, b in zip(items, bounds[:-1], bounds[1:], strict=True):
            ids.setdefault(numbers[a:b].tobytes(), []).append(item_id)
        own = np.frombuffer(b"".join(ids), dtype=np.int32)
        size = np.array([len(item) // 4 for item in ids], dtype=np.int64)
        first = np.cumsum(size) - size
        windows = []
        for length in np.unique(np.minimum(size[size > 0], window)).tolist():
            whole = size >= window if length == window else size == length
            starts = np.concatenate(
                [np.arange(a, a + n - length + 1) for a, n in zip(first[whole], size[whole])]
            )
            starts, bounds = _grouped(own, starts, length)
            windows.append((length, starts[bounds[:-1]], starts, bounds))
        arrays = {"vocabulary": vocabulary, "words": own, "first": first, "size": size}
        return cls({**arrays, "item_ids": list(ids.values()), "windows": windows})

    def blocks(self, length: int, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The windows at some places as rows, so many at a time, and the number of the first."""
        for first in range(0, len(places), BLOCK):
            some = places[first : first + BLOCK]
            yield first, self.words[some[:, None] + np.arange(length)].astype(np.int64)

    def item_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, place, side="right") - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words of no test text."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _grouped(words: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of windows, the places of equal windows together and in order, and the bounds of
    these groups; by keys that each hold as many words as fit."""
    width = max(1, int(words.max(initial=0)).bit_length())
    per_key, keys = 63 // width, []
    for k in range(length):
        if k % per_key == 0:
            keys.append(np.zeros(len(starts), dtype=np.int64))
        keys[-1] = (keys[-1] << width) | words[starts + k]
    order = np.lexsort([starts, *keys])
    new = np.ones(len(order), dtype=bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return starts[order].astype(np.int32), np.append(np.flatnonzero(new), len(order)).astype(np.int32)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the first ``depth`` words or more, by doubling. Zero words end a
    suffix; they are not in the array."""
    places = np.flatnonzero(words)
    rank = words.astype(np.int64)
    reach, order = 1, places[np.argsort(words[places], kind="stable")]
    while reach < depth:
        ahead = np.zeros_like(rank)
        ahead[:-reach] = rank[reach:]  # nothing, where no place has one so far ahead
        # A suffix that has ended has nothing ahead.
        key = rank[places] * (int(rank.max(initial=0)) + 1) + ahead[places]
        by_key = np.argsort(key, kind="stable")
        order, key = places[by_key], key[by_key]
        new = np.zeros_like(rank)
        new[order] = np.cumsum(np.concatenate([[1], key[1:] != key[:-1]])) if len(key) else 0
        rank, reach = new, 2 * reach
    return order


def ranges(words: np.ndarray, array: np.ndarray, windows: np.ndarray) -> tuple:
    """For each window, where the suffixes that begin with it lie in the array: [low, high).

    All windows are searched together, a word-wise comparison of each with one suffix at a step.
    """
    length = windows.shape[1]
    padded = np.concatenate([words, np.zeros(length, dtype=words.dtype)])
    ends = []
    for after in (False, True):
        low = np.zeros(len(windows), dtype=np.int64)
        high = np.full(len(windows), len(array), dtype=np.int64)
        for _ in range(int(len(array)).bit_length()):
            open_ = low < high
            middle = (low + high) // 2
            suffix = padded[array[np.minimum(middle, len(array) - 1)][:, None] + np.arange(length)]
            differs = suffix != windows
            at = differs.argmax(axis=1)
            rows = np.arange(len(windows))
            equal = ~differs[rows, at]
            less = (suffix[rows, at] < windows[rows, at]) | (equal & after)
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        ends.append(low)
    return ends[0], ends[1]


def _longest(tests: TestSuffixes, words: np.ndarray, place: int, starts: np.ndarray) -> tuple:
    """The longest match of the text at ``place`` with a test text at one of ``starts``."""
    best = (0, 0)
    for start in starts.tolist():
        item = int(tests.item_of(np.array([start]))[0])
        end = int(tests.first[item] + tests.size[item])
        room = min(end - start, len(words) - place)
        differs = tests.words[start : start + room] != words[place : place + room]
        length = int(differs.argmax()) if differs.any() else room
        best = max(best, (length, -start))
    return best[0], -best[1]


def search(tests: TestSuffixes, texts: list[bytes]) -> tuple[np.ndarray, list, list, list]:
    """Of each text of a shard: number of words, hit ranges, longest matches and items."""
    n = len(texts)
    words = Words(texts, PLAIN)
    bounds = words.bounds(n)
    hits: list[list] = [[] for _ in range(n)]
    matches: list[list] = [[] for _ in range(n)]
    items: list[set] = [set() for _ in range(n)]
    numbers = tests.numbers(words.hashes)
    if not tests.windows or not len(numbers):
        return np.diff(bounds), hits, matches, items
    # Stretches of known words within a text, long enough for a window; a zero word after each.
    known = numbers > 0
    begins = known & np.concatenate([[True], ~known[:-1] | (words.doc[1:] != words.doc[:-1])])
    stretch = np.cumsum(begins) - 1
    keep = known & (np.bincount(stretch[known], minlength=1)[np.maximum(stretch, 0)] >= tests.shortest)
    at = np.flatnonzero(keep)
    if not len(at):
        return np.diff(bounds), hits, matches, items
    gap = np.flatnonzero(np.diff(stretch[at], prepend=-1)).astype(np.int64)
    place = np.insert(at, gap, -1)
    shard = np.append(np.where(place >= 0, numbers[place], 0), 0)
    place = np.append(place, -1)
    array = suffix_array(shard, max(w[0] for w in tests.windows))

    reach = np.zeros(len(shard), dtype=np.int64)  # of the longest window that begins here
    group = np.zeros(len(shard), dtype=np.int64)
    for k, (length, places, starts, of) in enumerate(tests.windows):
        searched = [ranges(shard, array, rows) for _, rows in tests.blocks(length, places)]
        low, high = (np.concatenate(ends) for ends in zip(*searched, strict=True))
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        spots = array[
            np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        ]
        window = np.repeat(found, counts)
        reach[spots] = length
        group[spots] = window + (k << 40)
        document = words.doc[place[spots]]
        pairs = np.unique(document.astype(np.int64) << 32 | window)
        for pair in pairs.tolist():
            w = pair & 0xFFFFFFFF
            items[pair >> 32].update(np.unique(tests.item_of(starts[of[w] : of[w + 1]])).tolist())
    spot = np.flatnonzero(reach)
    if not len(spot):
        return np.diff(bounds), hits, matches, items
    end = np.maximum.accumulate(spot + reach[spot])
    fresh = np.concatenate([[True], spot[1:] > end[:-1]])
    firsts, lasts = spot[fresh], end[np.append(np.flatnonzero(fresh)[1:] - 1, len(spot) - 1)]
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        document = int(words.doc[place[first]])
        offset = int(place[first]) - first - int(bounds[document])
        hits[document].append((first + offset, last + offset))
        furthest = 0
        for p in range(first, last):
            if not reach[p]:
                continue
            _, _, starts, of = tests.windows[int(group[p]) >> 40]
            w = int(group[p]) & 0xFFFFFFFFFF
            length, start = _longest(tests, shard, p, starts[of[w] : of[w + 1]])
            # A match is listed if it reaches further than all that begin before it.
            if p + length > furthest:
                furthest = p + length
                item = int(tests.item_of(np.array([start]))[0])
                matches[document].append((p + offset, length, item, start - int(tests.first[item])))
    return np.diff(bounds), hits, matches, items


def _pass(documents: DataFrame, tests: TestSuffixes) -> tuple[DataFrame, Broadcast]:
    """What one slice finds, and what was sent to the executors for it."""
    shared = documents.sparkSession.sparkContext.broadcast(tests.arrays)
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    match = pa.struct([(c, pa.int64()) for c in ("start", "length", "item_id", "item_start")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(shared.value)
        for keys, texts in chunks(batches):
            n_words, hits, matches, items = search(tests, texts)
            named = [[(s, n, tests.item_ids[i][0], j) for s, n, i, j in row] for row in matches]
            ids = [sorted({own for i in row for own in tests.item_ids[i]} - {None}) for row in items]
            fields = ("start", "length", "item_id", "item_start")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(n_words, pa.int64()),
                    pa.array([[dict(zip(("start", "end"), h)) for h in row] for row in hits], pair),
                    pa.array(
                        [[dict(zip(fields, m)) for m in row] for row in named], pa.list_(match)
                    ),
                    pa.array(ids, pa.list_(pa.int64())),
                ],
                names=["key", "n_words", "hits", "matches", "items"],
            )

    found = documents.mapInArrow(
        run,
        "key bigint, n_words bigint, hits array<struct<start: bigint, end: bigint>>, "
        f"matches {_MATCH}, items array<bigint>",
    )
    return found, shared


def _that_reach_further(matches: Column) -> Column:
    """Of the matches of several slices, those that reach further than all that begin before them; of
    those that begin together the longest, then the one of the least id and place."""
    ordered = F.array_sort(
        F.transform(
            matches,
            lambda m: F.struct(
                m["start"].alias("start"), (-m["length"]).alias("shorter"), m["item_id"].alias("item_id"),
                m["item_start"].alias("item_start"), m["length"].alias("length"),
            ),
        )
    )
    kept = F.filter(
        ordered,
        lambda m, i: (i == 0)
        | (
            m["start"] + m["length"]
            > F.array_max(F.transform(F.slice(ordered, 1, i), lambda b: b["start"] + b["length"]))
        ),
    )
    return F.transform(
        kept, lambda m: F.struct(m["start"], m["length"], m["item_id"], m["item_start"])
    ).cast(_MATCH)


def _union_size(ranges_: Column) -> Column:
    """Words in the union of [start, end) ranges."""
    zero = F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.array_sort(ranges_),
        zero,
        lambda a, x: F.struct(
            F.greatest(a["reach"], x["end"]).alias("reach"),
            (a["n"] + F.greatest(x["end"] - F.greatest(a["reach"], x["start"]), F.lit(0))).alias("n"),
        ),
        lambda a: a["n"],
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, matches, contaminated`` of every row of ``documents``.

    ``items`` are the ids of the test items of which a window occurs, ``matches`` the longest
    verbatim matches (start, length, item_id, item_start; in words): from each place on the longest,
    if it reaches further than all that begin before it; from left to right. Null and empty texts have no words and are clean; null and empty test texts
    have no window; a test item without an id marks words, but isn't named. Rows with one doc_id
    are answered one by one. An empty benchmark leaves all clean; an empty table gives no rows.
    Only ``doc_id``, ``text`` and the benchmark's ``item_id``, ``text`` are read.

    The test texts are searched for in slices of bounded size: one pass over the documents for
    each, one after another, of which the hits are put together. There is one slice for a benchmark
    of 8 MB, and never more than one on the driver or an executor.
    """
    documents = documents.select("doc_id", "text")
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // slice_bytes) or 1
    if slices == 1:
        found, _ = _pass(documents, TestSuffixes.of(_collected(items)))
        found = found.withColumnRenamed("key", "doc_id")
    else:
        rows = materialize(
            documents.withColumn("row", F.monotonically_increasing_id()), "documents-with-rows"
        )
        of = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
        passes = []
        for k in range(slices):
            tests = TestSuffixes.of(_collected(items.filter(of == k)))
            one, shared = _pass(rows.select("row", "text"), tests)
            passes.append(materialize(one, f"slice-{k}"))
            shared.destroy()
        together = reduce(DataFrame.unionByName, passes).groupBy("key").agg(
            F.max("n_words").alias("n_words"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "matches", "items")],
        )
        together = together.withColumn("matches", _that_reach_further(F.col("matches")))
        found = rows.select("row", "doc_id").join(together, rows["row"] == together["key"])
    return found.select(
        "doc_id",
        "n_words",
        _union_size(F.col("hits")).alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        "matches",
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def _collected(items: DataFrame) -> list[tuple[int | None, str]]:
    return [(row["item_id"], row["text"]) for row in items.orderBy("item_id", "text").collect()]


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` less the rows with a contaminated text; all columns as they are. Rows that share
    a doc_id, or have none, are judged one by one."""
    row = F.xxhash64("doc_id", "text")
    bad = (
        contamination(documents.select(row.alias("doc_id"), "text"), benchmark)
        .filter("contaminated")
        .select(F.col("doc_id").alias("_bad"))
    )
    return documents.join(bad, row == F.col("_bad"), "left_anti")


OP4_SQL = f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
),
lengths AS (SELECT DISTINCT least(len(words), {WINDOW}) AS n FROM items WHERE len(words) > 0),
windows AS (
    SELECT item_id, n, unnest(list_transform(range(1, CAST(len(words) - n + 2 AS BIGINT)),
        lambda i: array_to_string(words[i:i + n - 1], ' '))) AS part
    FROM items JOIN lengths ON n = least(len(words), {WINDOW})
),
places AS (
    SELECT doc_id, n, unnest(range(1, CAST(len(words) - n + 2 AS BIGINT))) AS place, words
    FROM texts, lengths WHERE len(words) >= n
),
spots AS (
    SELECT doc_id, n, place, array_to_string(words[place:place + n - 1], ' ') AS part FROM places
),
found AS (SELECT doc_id, spots.n, place, item_id FROM spots JOIN windows USING (n, part)),
hit AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(place, place + n)) AS word FROM found) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op4_decontaminate_suffix_arrays", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
