"""Session settings, the code on the executors, and the shared folder that every job writes to."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: What the plans rely on. Sizes (partitions, memory, broadcast threshold) stay as the cluster set them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: split oversized join partitions, also where a later step wanted their partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_folders: dict[str, str] = {}
_sessions: dict[str, SparkSession] = {}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their Python has no other way to find it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parent
    archive = Path(os.path.realpath(tempfile.mkdtemp(prefix="ratecraft-code-")), "ratecraft.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder below ``spark.checkpoint.dir``.

    The cluster names a folder that all executors reach. Where the setting is missing, a local
    session (tests, a laptop) uses a temporary folder, and any other session is refused: its executors
    would each write to a disk of their own. The folder goes when the Python process ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="ratecraft-")
            spark.sparkContext.setCheckpointDir(root)
        elif spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        _folders[app] = f"{root.rstrip('/')}/ratecraft-{app}-{uuid.uuid4().hex[:8]}"
        _sessions[app] = spark
    return _folders[app]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete all that this application has stored in the shared folder; frames that read it end with it."""
    path = _folders.pop(spark.sparkContext.applicationId, None)
    if path:
        _delete(spark, path)


@atexit.register
def _at_exit() -> None:
    for app, path in list(_folders.items()):
        with contextlib.suppress(Exception):  # a session that was stopped cannot delete any more
            _delete(_sessions[app], path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has written yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_copy(df: DataFrame, name: str = "copy", file_rows: int = 0) -> DataFrame:
    """Write to the shared folder and read back: the columnar way to cut the lineage of a large table.

    ``file_rows`` is for rows that are large by themselves: so many in a file at most.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # a table without rows may have no files
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a ``stored_copy`` that nothing reads any more, such as the last round's of an iteration."""
    if table := getattr(df, "_table", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if path := getattr(df, "_stored_at", None):
        _delete(df.sparkSession, path)


def stored_buckets(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """A ``stored_copy`` whose rows lie by ``key``, an integer: grouping by it and by more columns moves nothing.

    Rows that ``df`` already has by ``key``, in as many partitions, are not moved to be written.
    """
    spark = df.sparkSession
    table = f"ratecraft_{name}_{uuid.uuid4().hex[:12]}"
    path = new_path(spark, name)
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._stored_at, out._table = path, table
    return out


@contextlib.contextmanager
def kept_in_place(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside take a table as it lies if that is by some of their keys, where Spark asks for all of them."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
