"""Sinks: CSV and JSON output, and tables computed once and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratecraft.session import exists, shared_folder
from ratecraft.sources.readers import TIMESTAMP


#: Rows of a CSV file at most: one with line breaks in its values is read by a single task.
FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, file_rows: int = FILE_ROWS, compression: str = "none") -> str:
    """Header line, no row index, files of ``file_rows`` rows at most; values with line breaks are quoted."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", file_rows).option("compression", compression)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)  # values as they are
       .option("timestampNTZFormat", TIMESTAMP).csv(path))
    return path


def write_json(df: DataFrame, path: str, compression: str = "none") -> str:
    """``compression`` is for long texts; Spark's readers know it by the files' names."""
    df.write.mode("overwrite").option("timestampNTZFormat", TIMESTAMP).option("compression", compression).json(path)
    return path


def materialize(spark: SparkSession, name: str, build: Callable[[], DataFrame], use_cache: bool = True,
                folder: str | None = None) -> DataFrame:
    """Load the table if an earlier run finished writing it, otherwise compute, write and read back.

    ``use_cache=False`` forces a recomputation. The name must carry every parameter
    that changes the content.
    """
    path = f"{folder or shared_folder(spark)}/{name}"
    if not (use_cache and exists(spark, f"{path}/_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
