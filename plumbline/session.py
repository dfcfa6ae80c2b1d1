"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps are read and written as UTC. A join whose partitioning a later window reuses is
# still split when one key is hot: the extra shuffle is added only where AQE finds the skew.
# Generated methods stay within what HotSpot compiles, which the 50-column stages would not.
_RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# What a task reads of files at once, however few cores there are to share them, and the least number
# of parts of a shuffle, of which adaptive execution joins small ones. With more than 200 a task that
# writes a shuffle would hold its rows in memory.
_TASK_BYTES = "32m"
_SHUFFLE_PARTS = 200


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Keep what a task has to sort the same when tables grow, for plans whose tasks sort all that
    they read. A session that asks for less a task keeps its settings."""
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if bytes_of(spark.conf.get("spark.sql.files.maxPartitionBytes")) > bytes_of(_TASK_BYTES):
        spark.conf.set("spark.sql.files.maxPartitionBytes", _TASK_BYTES)
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < _SHUFFLE_PARTS:
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(_SHUFFLE_PARTS)
        )
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own, which goes when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="plumbline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, for results that several branches scan.

    The written table prunes columns per branch and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written; nothing happens where there is none."""
    files, hadoop = _files(spark, path)
    files.delete(hadoop, True)


def forget(stored: DataFrame) -> None:
    """Delete what ``materialize`` has written, once nothing reads it any more."""
    for folder in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        remove(stored.sparkSession, folder)


def folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the outermost partition column of a table, from one listing of its folder; values
    that need no escape."""
    files, hadoop = _files(spark, path)
    if not files.exists(hadoop):
        return []
    names = [status.getPath().getName() for status in files.listStatus(hadoop)]
    return [name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}=")]


def recover(spark: SparkSession, path: str) -> None:
    """End a swap that was cut short: the table at ``path`` is then the new one if it was whole, and
    else the old one, and nothing else of it is left. For tables that nobody else is writing."""
    files, hadoop = _files(spark, path)
    folder = hadoop.getParent()
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    left = {
        kind: [f"{folder}/{name}" for name in names if name.startswith(f"{hadoop.getName()}.{kind}-")]
        for kind in ("new", "old")
    }
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    if not files.exists(hadoop):
        whole = [new for new in left["new"] if files.exists(path_of(f"{new}/_SUCCESS"))]
        for candidate in (whole if left["old"] else []) + left["old"]:
            if files.rename(path_of(candidate), hadoop):
                break
    for rest in left["new"] + left["old"]:
        files.delete(path_of(rest), True)


def write_then_swap(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Put ``df`` in place of the table at ``path``, which stays as it is until the new one is
    whole; ``df`` may read it. A process that ends between the two renames leaves no table there
    until ``recover`` puts one back."""
    spark = df.sparkSession
    new, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    files, hadoop = _files(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    try:
        writer.parquet(new)
    except Exception:
        files.delete(path_of(new), True)
        raise
    if files.exists(hadoop) and not files.rename(hadoop, path_of(old)):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(path_of(new), hadoop):
        files.rename(path_of(old), hadoop)
        raise OSError(f"{new} cannot be moved to {path}")
    files.delete(path_of(old), True)
