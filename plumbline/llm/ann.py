"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by centroids of its own; a pair of centroids is a cell. A query
walks the pairs from the most promising on, with a heap over the sums of its inner products with
the centroids of both halves, until the cells it has seen hold ``candidates`` vectors; the vectors
of these cells are ranked by their exact inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.sample import least_hashed
from plumbline.session import materialize

NEAREST = 20
# The centroids are fitted on at most so many vectors, chosen by a hash of their ids.
SAMPLE = 20_000
# Vectors in a cell on average, as long as there are no more centroids than MOST_CENTROIDS.
CELL = 12
MOST_CENTROIDS = 256
# Vectors that a query looks at: this share of all that are indexed, and not fewer than CANDIDATES.
# Measured recall: see the README.
SHARE = 0.5
CANDIDATES = 22_000
# Cells of one first centroid are a unit; a unit of more vectors than this, and than most units
# have, is split.
UNIT = 2_000


def centroids(vectors: np.ndarray, n: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Means of ``n`` clusters, by Lloyd's rounds."""
    rng = np.random.RandomState(seed)
    means = vectors[rng.choice(len(vectors), n, replace=len(vectors) < n)].copy()
    for _ in range(rounds):
        nearest = closest(vectors, means)
        count = np.bincount(nearest, minlength=n)
        sums = np.zeros_like(means)
        np.add.at(sums, nearest, vectors)
        means = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], means)
    return means


def closest(vectors: np.ndarray, means: np.ndarray) -> np.ndarray:
    return np.argmin((means**2).sum(axis=1) - 2 * vectors @ means.T, axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in falling order of ``first[i] + second[j]`` until they hold ``wanted`` vectors."""
    n = len(second)
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    cells, held = [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * n + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        # A pair follows the one before it in its own row; a row follows the first of the last one.
        if j + 1 < n:
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))
    return cells


def valid(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, embedding: array<double>) of the rows that take part. ``row`` numbers them, once
    they are written."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & finite)
        .filter(F.exists("embedding", lambda x: x != 0))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1)


def best_of(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ``k`` largest finite scores of each row; ties go to the least own."""
    k = min(k, scores.shape[1])
    least = np.partition(scores, -k, axis=1)[:, -k] if k else np.empty(0)
    rows, columns = np.nonzero((scores >= least[:, None]) & (scores > -np.inf)) if k else ([], [])
    rows, columns = np.array(rows, dtype=np.int64), np.array(columns, dtype=np.int64)
    order = np.lexsort((own[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def nearest(vectors: DataFrame, candidates: int | None = None, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each vec_id divisible by 20.

    A query looks at ``candidates`` vectors; if none are given, at SHARE of those that are indexed
    and CANDIDATES at least, so that recall does not fall with their number.
    Nearest is the largest inner product; ties go to the smaller vec_id; a row is no candidate
    of its own query. Vectors that are null, zero, or hold a null or non-finite component take no
    part; nor do rows without a vec_id and vectors of another length than most. Rows that share a
    vec_id are queries and candidates one by one. Of equal vectors the k + 1 smallest ids are
    searched, as no others can be among the nearest. Fewer candidates than k are all returned; an empty table
    gives no rows. Only ``vec_id`` and ``embedding`` are read.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = materialize(valid(vectors), "vectors")
    lengths = rows.groupBy(F.size("embedding").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").first()
    if most is None:
        return empty
    length, half = most["n"], most["n"] // 2
    rows = rows.filter(F.size("embedding") == length)
    same = Window.partitionBy("embedding").orderBy("vec_id", "row")
    indexed = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)

    drawn = least_hashed(rows, ["vec_id", "embedding"], SAMPLE).select("embedding").toArrow()
    sample = _matrix(drawn.column("embedding").combine_chunks())
    n = int(np.clip(np.sqrt(most["count"] / CELL), 1, MOST_CENTROIDS))
    left, right = centroids(sample[:, :half], n), centroids(sample[:, half:], n)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2))
            cell = closest(x[:, :half], left) * n + closest(x[:, half:], right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), *batch.columns], names=["cell", "row", "vec_id", "embedding"]
            )

    entries = materialize(
        indexed.select("row", "vec_id", "embedding").mapInArrow(
            assign, "cell bigint, row bigint, vec_id bigint, embedding array<double>"
        ),
        "cells",
    )
    sizes = np.zeros(n * n, dtype=np.int64)
    for row in entries.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2
        sizes[row["cell"]] = row["count"]
    if candidates is None:
        candidates = max(CANDIDATES, int(np.ceil(SHARE * sizes.sum())))
    most_held = max(UNIT, int(sizes.sum()) // n)
    parts = np.maximum(1, -(-sizes.reshape(n, n).sum(axis=1) // most_held))

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each unit that a query has to see, the second centroids of its cells there."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2))
            firsts, seconds = x[:, :half] @ left.T, x[:, half:] @ right.T
            for start in range(0, len(x), 64):
                rows = []
                for i in range(start, min(start + 64, len(x))):
                    cells = np.sort(walk(firsts[i], seconds[i], sizes, candidates))
                    for unit in np.unique(cells // n).tolist():
                        inside = cells[cells // n == unit] % n
                        rows += [(i, unit, part, inside) for part in range(parts[unit])]
                at, units, numbers, inside = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(units, pa.int64()),
                        pa.array(numbers, pa.int32()),
                        pa.array([True] * len(at)),
                        batch.column(0).take(pa.array(at)),
                        batch.column(1).take(pa.array(at)),
                        batch.column(2).take(pa.array(at)),
                        pa.array(inside, pa.list_(pa.int32())),
                    ],
                    names=["unit", "part", "asks", "row", "id", "embedding", "cells"],
                )

    asking = rows.filter(F.col("vec_id") % 20 == 0).mapInArrow(
        probe,
        "unit bigint, part int, asks boolean, row bigint, id bigint, embedding array<double>, "
        "cells array<int>",
    )
    n_parts = F.get(F.array(*[F.lit(int(p)) for p in parts]), F.col("unit").cast("int"))
    held = entries.withColumn("unit", F.floor(F.col("cell") / n)).select(
        "unit",
        F.pmod(F.xxhash64("row"), n_parts).cast("int").alias("part"),
        F.lit(False).alias("asks"),
        "row",
        F.col("vec_id").alias("id"),
        "embedding",
        F.array((F.col("cell") % n).cast("int")).alias("cells"),
    )

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors of a unit come first and are held; its queries pass by."""
        now, stored, unit = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            units, numbers = np.array(batch.column(0)), np.array(batch.column(1))
            asks = np.array(batch.column(2).cast(pa.int8()))
            row, keys = np.array(batch.column(3)), np.array(batch.column(4))
            x, bounds = _matrix(batch.column(5)), np.array(batch.column(6).offsets)
            cells = np.array(batch.column(6).values)
            change = (np.diff(units) != 0) | (np.diff(numbers) != 0) | (np.diff(asks) != 0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(units)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if now != (units[a], numbers[a]):
                    now, stored, unit = (units[a], numbers[a]), [], None
                if not asks[a]:
                    stored.append((row[a:b], keys[a:b], x[a:b], cells[bounds[a] : bounds[b]]))
                    continue
                if not stored:
                    continue
                if unit is None:
                    unit = list(map(np.concatenate, zip(*stored, strict=True)))
                    order = np.lexsort((unit[0], unit[1]))
                    unit = [part[order] for part in unit]
                for c in range(a, b, 64):
                    d = min(c + 64, b)
                    sees = np.zeros((d - c, n), dtype=bool)
                    widths = np.diff(bounds[c : d + 1])
                    sees[np.repeat(np.arange(d - c), widths), cells[bounds[c] : bounds[d]]] = True
                    some = np.flatnonzero(sees.any(axis=0)[unit[3]])
                    own = unit[0][some]
                    # einsum adds up every pair alike, so that equal vectors tie exactly.
                    scores = np.einsum("qd,vd->qv", x[c:d], unit[2][some])
                    scores[~sees[:, unit[3][some]] | (row[c:d, None] == own)] = -np.inf
                    # In the order of ids, and of rows of one id.
                    at, best = best_of(scores, np.arange(len(some)), k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row[c:d][at], pa.int64()),
                            pa.array(keys[c:d][at], pa.int64()),
                            pa.array(own[best], pa.int64()),
                            pa.array(unit[1][some][best], pa.int64()),
                            pa.array(scores[at, best], pa.float64()),
                        ],
                        names=["asker", "query_id", "row", "vec_id", "score"],
                    )

    found = (
        held.union(asking)
        .repartition("unit", "part")
        .sortWithinPartitions("unit", "part", "asks")
        .mapInArrow(rank, "asker bigint, query_id bigint, row bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


@query("op8_nearest_multi_index")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
