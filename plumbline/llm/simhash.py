"""Near-copies by fingerprints that differ in few bits.

A fingerprint is mapped to the bit counts of its segments. Counts differ by no more than bits do,
so two fingerprints within two bits lie within Manhattan distance two, and then some grid cell is
within one step of both. Each fingerprint is entered in its own cell and the cells one step away;
cells that hold a single fingerprint are dropped. What is left is verified without listing pairs:
two fingerprints differ in two bits or fewer exactly when some value is one bit or less from each,
and that value lies in a shared cell. So each fingerprint names the values of its shared cells,
and fingerprints that name one value are linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.components import components
from plumbline.llm.registry import query, table
from plumbline.llm.shingles import sets, sketches
from plumbline.llm.text import chunks
from plumbline.session import materialize

SHINGLE = 3
SEED = 42
SEGMENT_BITS = 4
SEGMENTS = 64 // SEGMENT_BITS
# Shingles whose bits are counted at once.
COUNTED = 1 << 16
# Of near copies: the least Jaccard similarity of their shingles, in tenths.
TENTHS = 8
# Texts that a text is compared to, where those of its bands are not all similar.
ORDERS = 16
# Texts compared to one text in one task.
COMPARED = 64


def fingerprint(text: bytes) -> int:
    """Of one text: a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash

    # Of bytes, ``lower`` and ``split`` know A-Z and ASCII white space only.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    firsts, lasts = starts[:n].tolist(), ends[len(words) - n :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, n, COUNTED):
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(firsts[k : k + COUNTED], lasts[k : k + COUNTED], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > n, bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, bits): the fingerprint of each row as a signed 64-bit number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([fingerprint(text) for text in texts], pa.int64()),
                ],
                names=["doc_id", "bits"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, bits bigint")


def _segment(bits: Column, k: int) -> Column:
    return F.bit_count(
        F.shiftrightunsigned(bits, SEGMENT_BITS * k).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    )


def _embedding(bits: Column) -> Column:
    """The bit counts of all segments, one in each four bits of a number."""
    cell = F.lit(0).cast("bigint")
    for k in range(SEGMENTS):
        cell = cell.bitwiseOR(F.shiftleft(_segment(bits, k).cast("bigint"), 4 * k))
    return cell


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): numbers of fingerprints that link, from (bits, node), each value of bits once.

    Every value that links fingerprints gives one edge from each to the smallest of them.
    """
    cells = distinct.withColumn("own", _embedding(F.col("bits")))
    steps = [F.struct(F.lit(-1).alias("segment"), F.lit(0).alias("up"), F.col("own").alias("cell"))]
    for k in range(SEGMENTS):
        count, unit = _segment(F.col("bits"), k), F.lit(_signed(1 << (4 * k)))
        for up, ok in ((1, count < SEGMENT_BITS), (0, count > 0)):
            # Counts reach from 0 to 4 and so never carry into the next four bits.
            cell = F.col("own") + unit if up else F.col("own") - unit
            steps.append(
                F.when(
                    ok,
                    F.struct(
                        F.lit(k).alias("segment"), F.lit(up).alias("up"), cell.alias("cell")
                    ),
                )
            )
    entered = (
        cells.select("bits", "node", F.explode(F.array(*steps)).alias("at"))
        .filter(F.col("at").isNotNull())
        .select("bits", "node", "at.*")
    )
    shared = (
        entered.groupBy("cell")
        .agg(F.min("bits").alias("least"), F.max("bits").alias("most"))
        .filter("least <> most")
        .select("cell")
    )
    # The values within one bit of a fingerprint that lie in a shared cell: itself in its own cell,
    # elsewhere the fingerprint with one bit of the segment set or cleared.
    flips = F.transform(
        F.filter(
            F.array(*[F.lit(b) for b in range(SEGMENT_BITS)]),
            lambda b: F.call_function(
                "getbit", F.col("bits"), F.col("segment") * SEGMENT_BITS + b
            )
            != F.col("up"),
        ),
        lambda b: F.col("bits").bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("segment") * SEGMENT_BITS + b)
        ),
    )
    values = F.when(F.col("segment") < 0, F.array("bits")).otherwise(flips)
    named = entered.join(shared, "cell", "left_semi").select(
        "node", F.explode(values).alias("value")
    )
    # At most 65 fingerprints are within one bit of a value, so the sets are small.
    return (
        named.groupBy("value")
        .agg(F.collect_set("node").alias("nodes"))
        .filter(F.size("nodes") > 1)
        .select(F.explode("nodes").alias("a"), F.array_min("nodes").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def near_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, bits, component_id) of every row; the component is the smallest doc_id reachable
    by links of two bits or fewer.

    Texts that are null, empty or without words have the fingerprint 0, which links like others.
    Fewer than three words are one shingle. Rows with one doc_id are fingerprinted one by one and
    are one node each; rows without a doc_id take part, and where no row of a component has one,
    its id is null. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    rows = materialize(fingerprints(documents), "fingerprints")
    # A fingerprint stands for all its copies. Its node is its own number, so that no two meet.
    distinct = materialize(
        rows.groupBy("bits").agg(F.min("doc_id").alias("least")).select("bits", "least"),
        "fingerprint-classes",
    )
    edges = links(distinct.select("bits", F.col("bits").alias("node")))
    found = components(edges)
    merged = found.join(distinct.withColumnRenamed("bits", "node"), "node")
    smallest = merged.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = (
        distinct.join(found, distinct["bits"] == found["node"], "left")
        .join(smallest, "component", "left")
        .select("bits", F.coalesce("component_id", "least").alias("component_id"))
    )
    return rows.join(classes, "bits").select("doc_id", "bits", "component_id")


def _starred(entries: DataFrame, orders: int = 1) -> DataFrame:
    """(a, b): each node of (at, node) with the first node at the same value. Nodes have so many
    orders, one for each value; in the only order, of one, the least comes first."""
    order = F.xxhash64("node", F.pmod("at", F.lit(orders))) if orders > 1 else F.col("node")
    first = (
        entries.groupBy("at")
        .agg(F.min_by("node", order).alias("b"), F.min("node").alias("x"), F.max("node").alias("y"))
        .filter("x <> y")
        .select("at", "b")
    )
    return entries.join(first, "at").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _at_bands(nodes: DataFrame) -> DataFrame:
    """(at, node): the bands of a node, whose keys hold the number of the band."""
    return nodes.select(F.explode("bands").alias("at"), "node")


def _at_rare_shingles(shingles: DataFrame) -> DataFrame:
    """(at, node) of (node, shingles): the rarest shingles of a node, as many as it cannot lack in
    common with a similar one. Rare is what few of these nodes hold."""
    held = shingles.select("node", F.explode("shingles").alias("at"))
    counts = held.groupBy("at").agg(F.count("*").alias("nodes"))
    n = F.size("ordered")
    prefix = n - F.ceil(F.lit(TENTHS) * n / 10).cast("int") + 1
    return (
        held.join(counts, "at")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("nodes", "at"))).alias("ordered"))
        .select("node", F.explode(F.slice("ordered", F.lit(1), prefix)).alias("rare"))
        .filter("rare.nodes > 1")
        .select("rare.at", "node")
    )


def _judged(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(a, b, similar): whether two nodes share enough of their shingles.

    A node that very many are compared to is dealt to several tasks, each with its shingles.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("parts"))
    ones = pairs.join(shingles.toDF("a", "x"), "a").join(parts, "b")
    others = shingles.toDF("b", "y").join(parts, "b")
    others = others.select("b", "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = F.size(F.array_intersect("x", "y"))
    # Jaccard similarity, in whole numbers.
    similar = (TENTHS + 10) * both >= TENTHS * (F.size("x") + F.size("y"))
    return (
        ones.withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
        .join(others, ["b", "part"])
        .select("a", "b", similar.alias("similar"))
    )


def similar_texts(nodes: DataFrame, shingles_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): links of nodes (node, bits, bands) whose five-word shingles have a Jaccard similarity
    of 0.8 or more, each verified on the shingles. ``shingles_of`` gives (node, shingles) for the
    nodes that it is asked for.

    Candidates are fingerprints within two bits, by the grid, and texts that agree in a band of
    minima: at a similarity of 0.8 fingerprints are some ten bits apart, which no grid of bit counts
    tells from chance. Texts of one band are compared to one of them. Where that one is not similar
    to all, as where they only share a passage, those of its bands are compared once more, by the
    rarest of their shingles: similar texts have one of these in common. They are then compared to
    up to ORDERS of the texts around them. A link is lost if its texts differ in all bands, or if
    none of those that they are compared to is similar to both; not by the size of a group.
    """
    # One after the other: the grid's entries are many and take the memory of a job of their own.
    alike = materialize(nodes.groupBy("bits").agg(F.min("node").alias("node")), "fingerprint-classes")
    near = materialize(links(alike), "near-fingerprints")
    pairs = (
        _starred(_at_bands(nodes))
        .union(_starred(nodes.select(F.col("bits").alias("at"), "node")))
        .union(near)
        .distinct()
    )
    pairs = materialize(pairs, "near-candidates")
    judged = materialize(
        _judged(pairs, shingles_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))),
        "near-judged",
    )
    found = judged.filter("similar").select("a", "b")
    mixed = judged.filter("not similar").select("b").distinct()
    left = judged.join(mixed, "b", "left_semi").select(F.col("a").alias("node"))
    shingles = shingles_of(left)
    again = _starred(_at_rare_shingles(shingles), ORDERS).join(judged, ["a", "b"], "left_anti")
    again = materialize(again, "near-candidates")
    return found.union(_judged(again, shingles).filter("similar").select("a", "b"))


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """One row of ``documents`` of each group of near copies, all columns as they are: that with the
    smallest doc_id, and of several with this doc_id the one of least hash of id and text.

    Texts are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more
    (see ``similar_texts``), or the same words in the same order; groups are reached by links. Texts
    that are null, empty or without words are copies of each other; one to four words are one
    shingle. Rows are picked by id and text, so that rows that share an id, or have none, are
    copies of each other only if their texts are. An empty table gives no rows.
    """
    row = F.xxhash64("doc_id", "text")
    texts = documents.select(row.alias("key"), "doc_id", "text")
    rows = materialize(sketches(texts), "sketches")
    ids = texts.select("key", "doc_id").distinct()
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    # Copies are one node, and their least row stands for them.
    nodes = materialize(
        rows.groupBy("key")
        .agg(*[F.first(c).alias(c) for c in ("node", "bits", "bands")])
        .join(ids, "key")
        .groupBy("node")
        .agg(F.min(first).alias("least"), *[F.first(c).alias(c) for c in ("bits", "bands")]),
        "near-nodes",
    )

    def shingles_of(asked: DataFrame) -> DataFrame:
        keys = nodes.join(asked.distinct(), "node", "left_semi").select(F.col("least.key").alias("key"), "node")
        found = sets(texts.join(keys, "key").select(F.col("node").alias("key"), "text"))
        # Rows that agree in id and text are several rows of one node.
        once = found.groupBy("key").agg(F.first("shingles").alias("shingles"))
        return materialize(once, "near-shingles").toDF("node", "shingles")

    edges = similar_texts(nodes.select("node", "bits", "bands"), shingles_of)
    chosen = (
        nodes.select("node", "least")
        .join(components(edges), "node", "left")
        .groupBy(F.coalesce("component", "node").alias("component"))
        .agg(F.min("least")["key"].alias("_kept"))
        .select("_kept")
    )
    columns = documents.columns
    order = Window.partitionBy("_kept").orderBy(F.col("text").asc_nulls_last())
    return (
        documents.withColumn("_row", row)
        .join(chosen, F.col("_row") == F.col("_kept"))
        .withColumn("_place", F.row_number().over(order))
        .filter("_place = 1")
        .select(*[F.col(f"`{c}`") for c in columns])
    )


@query("op6_simhash_popcount_grid")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
