"""Connected components of a graph given as edges, by rounds of joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import shared_folder


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint), the component being its
    smallest node.

    Large-star and small-star in turn: every node's larger neighbours, then its smaller ones, are
    linked to the smallest node next to it. The number of rounds grows with the logarithm of the
    longest path. Neighbours are never collected: the smallest one is an aggregate that is joined
    back, and AQE splits the join where a node has very many. Each round's edges are written to
    the shared folder.
    """
    spark = edges.sparkSession
    folder = f"{shared_folder(spark)}/components-{uuid.uuid4().hex}"
    schema = "big bigint, small bigint"

    def stored(rows: DataFrame, n: int) -> DataFrame:
        rows.write.parquet(f"{folder}/{n}")
        return spark.read.schema(schema).parquet(f"{folder}/{n}")

    def directed(rows: DataFrame) -> DataFrame:
        return (
            rows.filter("a <> b")
            .select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
            .distinct()
        )

    def large_star(rows: DataFrame) -> DataFrame:
        both = rows.union(rows.select(F.col("small"), F.col("big"))).toDF("node", "next")
        least = both.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("root"))
        linked = both.filter("next > node").join(least, "node")
        return directed(linked.select(F.col("next").alias("a"), F.col("root").alias("b")))

    def small_star(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("big").agg(F.min("small").alias("root"))
        linked = rows.join(least, "big")
        return directed(
            linked.select(F.col("small").alias("a"), F.col("root").alias("b")).union(
                least.select("big", "root")
            )
        )

    rows, n = stored(directed(edges.toDF("a", "b")), 0), 0
    while True:
        n += 1
        new = stored(small_star(large_star(rows)), n)
        # Both sides hold each edge once: equal when as many rows have the same sum of hashes.
        total = [
            side.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
            for side in (rows, new)
        ]
        rows = new
        if total[0] == total[1]:
            break
    roots = rows.select("small").distinct()
    return rows.select(F.col("big").alias("node"), F.col("small").alias("component")).union(
        roots.select(F.col("small").alias("node"), F.col("small").alias("component"))
    )
