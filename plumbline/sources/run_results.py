"""Run-result documents: one JSON file per run, flattened to one row per check."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import naming
from plumbline.functions.parsing import instant_or
from plumbline.functions.scoring import status_severity
from plumbline.sources import history

logger = logging.getLogger(__name__)

DOCUMENT = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("invocation_id", T.StringType()),
                    T.StructField("generated_at", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("unique_id", T.StringType()),
                        T.StructField("status", T.StringType()),
                        T.StructField("execution_time", T.DoubleType()),
                        T.StructField("failures", T.LongType()),
                        T.StructField("message", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All documents below ``path``, with their file and its folder. A file that cannot be read is
    an error that names it."""
    return (
        spark.read.schema(DOCUMENT)
        .options(multiLine=True, mode="FAILFAST")
        .json(path)
        .withColumn("file", F.col("_metadata.file_path"))
        .withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]*$", 1))
    )


def flatten(
    documents: DataFrame, *, read_at: Column | None = None, hashed_names: bool = False
) -> DataFrame:
    """One row per check result, in the columns of the check history.

    ``documents`` has the columns of ``DOCUMENT`` and, where known, ``folder``. ``read_at``
    stands in for a missing or unreadable time. ``hashed_names`` names generic checks by the
    hash at the end of their id, for histories that were kept that way.
    """
    folder = F.col("folder") if "folder" in documents.columns else F.lit(None).cast("string")
    file = F.col("file") if "file" in documents.columns else F.lit("")
    # Without an id, what a document says and where it lies tell it from others.
    told = F.to_json(F.struct("metadata", "results"))
    own_id = F.concat(F.lit("unnamed-"), F.sha2(F.concat_ws("\n", file, told), 256))
    result = F.col("result")
    unique_id = F.coalesce(result["unique_id"], F.lit(""))
    exploded = documents.select(
        F.coalesce("metadata.invocation_id", own_id).alias("run_id"),
        instant_or(
            F.col("metadata.generated_at"),
            F.current_timestamp() if read_at is None else read_at,
        ).alias("run_at"),
        folder.alias("folder"),
        F.explode("results").alias("result"),
    )
    named = exploded.select(
        "*",
        (naming.last_segment if hashed_names else naming.short_name)(unique_id).alias("test_name"),
    )
    status = F.coalesce(result["status"], F.lit("unknown"))
    return named.select(
        "run_id",
        "run_at",
        "test_name",
        naming.table_of(unique_id).alias("model_name"),
        naming.column_of(unique_id).alias("column_name"),
        status.alias("status"),
        status_severity(status, F.col("test_name")).alias("severity"),
        F.coalesce(result["failures"], F.lit(0)).alias("failure_count"),
        result["execution_time"].alias("execution_time_s"),
        naming.kept_message(result["message"]).alias("message"),
        F.concat(
            F.col("folder"),
            F.lit("/compiled/"),
            F.get(F.split(unique_id, r"\."), F.lit(1)),
            F.lit("/tests/"),
            F.col("test_name"),
            F.lit(".sql"),
        ).alias("compiled_sql_path"),
    )


def log_run_results(spark: SparkSession, path: str | list[str], log_path: str) -> int:
    """Add all documents below ``path`` to the check history; returns the number of results."""
    written = Observation()
    results = flatten(read_documents(spark, path)).observe(
        written, F.count(F.lit(1)).alias("rows")
    )
    history.append(results, log_path, history.CHECK_RESULTS)
    rows = written.get["rows"]
    if not rows:
        logger.warning("no results in %s", path)
    return rows


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``modified`` and ``bytes`` of the documents below ``path``; none of them is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(
        F.col("path").alias("file"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def log_new_run_results(spark: SparkSession, path: str, log_path: str, files_path: str) -> int:
    """As ``log_run_results``, for those documents alone that ``files_path`` does not list yet with
    the same time and size; returns the number of results.

    Documents that are known cost a place in the listing and are not opened. A document that was
    written anew is read again and replaces its run. The list is written after the results, so
    that what a failure leaves unlisted is read once more, to the same end.
    """
    history.ensure(spark, files_path, history.READ_FILES)
    known = history.read(spark, files_path, history.READ_FILES).select("file", "modified", "bytes")
    new = listed_files(spark, path).join(known, ["file", "modified", "bytes"], "left_anti")
    files = new.collect()  # one for each new run
    if not files:
        return 0
    rows = log_run_results(spark, [row.file for row in files], log_path)
    reading = f"read-{uuid.uuid4().hex}"
    listed = spark.createDataFrame(
        [(reading, *row) for row in files], history.READ_FILES
    )
    history.append(listed, files_path, history.READ_FILES)
    return rows
