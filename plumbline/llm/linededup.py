"""Lines that repeat across documents, by levelled sorted runs of line hashes.

Documents come in batches. The line hashes of a batch are one sorted run at level 0; when a level
holds ``fanout`` runs, they are merged into one run of the next level, so that there are few runs
and each hash is rewritten once a level. A new batch is anti-joined with the runs to find the
lines that no earlier batch has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.session import shared_folder

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RUN = "key binary, documents bigint, last bigint"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else. ``lower`` does this for ASCII, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def line_text(line: Column) -> Column:
    """What two lines have to share to be the same: case of A-Z and blanks around don't count."""
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def line_hash(value: Column) -> Column:
    """128 bits, so that even 10**15 different lines are told apart."""
    return F.unhex(F.md5(value))


def document_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, key), the hash of each different line of a document that is long enough."""
    lines = F.split(lower_ascii(F.col("text")), "\n")
    trimmed = F.transform(lines, lambda x: F.btrim(x, F.lit(BLANK)))
    long_ones = F.filter(trimmed, lambda x: F.length(x) >= MIN_CHARS)
    return documents.select("doc_id", F.explode(F.array_distinct(long_ones)).alias("line")).select(
        "doc_id", line_hash(F.col("line")).alias("key")
    )


class LineRuns:
    """Runs of (key, documents, last) in a folder: how many documents hold a line, and the
    largest doc_id of them. A document has to come in one batch."""

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = folder or f"{shared_folder(spark)}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self._written = 0

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.folder}/level-{level}/run-{self._written}"
        self._written += 1
        run.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], _RUN)
        return self.spark.read.schema(_RUN).parquet(*paths)

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(
            F.sum("documents").alias("documents"), F.max("last").alias("last")
        )

    def rows(self) -> DataFrame:
        """All runs as they are: a key has a row in each run that holds it."""
        return self._read([path for level in self.levels for path in level])

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` (doc_id, key) whose key is in no run."""
        return lines.join(self.rows(), "key", "left_anti")

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, key) rows as a run, and merge the levels that are full."""
        document = F.coalesce("doc_id", F.lit(-(1 << 63)))
        self._write(
            lines.groupBy("key").agg(
                F.count_distinct(document).alias("documents"), F.max("doc_id").alias("last")
            ),
            0,
        )
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merge(self._read(full)), level + 1)
            level += 1

    def totals(self) -> DataFrame:
        """One row per key."""
        if sum(map(len, self.levels)) == 1:
            return self.rows()
        return self._merge(self.rows())


def fresh_lines(runs: LineRuns, batch: DataFrame) -> DataFrame:
    """For lines that arrive over time: (doc_id, key) of the batch's lines that no earlier batch
    has, written before the batch is added to the runs. Within a batch the smallest doc_id keeps
    a line."""
    lines = runs.unseen(document_lines(batch)).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    path = f"{runs.folder}/fresh-{uuid.uuid4().hex}"
    lines.select("doc_id", "key").write.parquet(path)
    runs.add(document_lines(batch))
    return runs.spark.read.parquet(path)


def drop_repeated_lines(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES
) -> DataFrame:
    """``documents`` with the repeated lines taken out of ``text``, and ``n_lines`` and
    ``n_dropped``.

    A line of MIN_CHARS code points or more, without the blanks around it and the case of A-Z,
    that ``min_documents`` documents hold stays only in the largest doc_id of them, there in all
    its places. Null and empty texts are one empty line, and come back as empty text. Rows with
    one doc_id count as one document. A row without a doc_id is a document smaller than all
    others. An empty table gives an empty one. Other columns stay as they are; columns named
    ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = documents.sparkSession
    folder = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    # Read by every batch and by the last join: written once, in a folder for each batch.
    document_lines(documents).withColumn(
        "batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    ).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema("doc_id bigint, key binary, batch int").parquet(folder)
    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).select("doc_id", "key"))
    repeated = runs.totals().filter(F.col("documents") >= min_documents).select("key", "last")
    drops = (
        lines.select("doc_id", "key")
        .join(repeated, "key")
        .filter(F.col("last").isNotNull())
        .filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
        .groupBy(F.col("doc_id").alias("_drop_id"))
        .agg(F.collect_set(F.lower(F.hex("key"))).alias("_drops"))
    )
    return without_lines(documents, drops)


def without_lines(documents: DataFrame, drops: DataFrame) -> DataFrame:
    """Take the lines named by (_drop_id, _drops: hashes) out of the documents."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    drop, n = F.col("_drops"), F.col("_buckets")
    # The hashes of a document are looked up in buckets: a long document may have very many.
    buckets = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.filter(drop, lambda x: F.pmod(F.xxhash64(x), n) == i),
    )

    def stays(line: Column) -> Column:
        key = F.md5(line_text(line))
        bucket = F.get(F.col("_lookup"), F.pmod(F.xxhash64(key), n).cast("int"))
        return ~F.array_contains(bucket, key)

    kept = F.when(drop.isNull(), F.col("_lines")).otherwise(F.filter(F.col("_lines"), stays))
    columns = [F.col(f"`{c}`") for c in documents.columns if c not in ("n_lines", "n_dropped")]
    return (
        documents.join(drops, F.col("doc_id").eqNullSafe(F.col("_drop_id")), "left")
        .withColumn("_lines", lines)
        .withColumn("_buckets", F.ceil(F.sqrt(F.size("_drops"))).cast("int"))
        .withColumn("_lookup", F.when(drop.isNotNull(), buckets))
        .withColumn("_kept", kept)
        .withColumn("n_lines", F.size("_lines").cast("bigint"))
        .withColumn("n_dropped", (F.size("_lines") - F.size("_kept")).cast("bigint"))
        .withColumn("text", F.array_join("_kept", "\n"))
        .select(*columns, "n_lines", "n_dropped")
    )


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5_SQL = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM parts
),
keyed AS (
    SELECT *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM lines
),
repeated AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
),
marked AS (
    SELECT keyed.*, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
        AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op5_line_dedup_runs", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )
