"""Line-oriented text files (one record per line, header included)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scan text files into one ``value`` string column, one row per line.

    Splittable: a large file is read by many tasks in parallel
    (``spark.sql.files.maxPartitionBytes`` sizes the splits).
    """
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite") -> str:
    """Write one string column as text, one file per partition."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)
    return path
