"""Repeatable sampling and splitting keyed on a hash of each row's key.

Both work on any partitioning and give the same rows on every run and every
cluster size, since the decision for a row depends on its key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HEAD_DIGITS = 4


def sample_key(key_cols: list[str], seed: int) -> Column:
    """md5 of ``"seed:key1:key2..."``: a uniform, repeatable order of rows."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws(":", *parts))


def sample_exact(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, without replacement: the first by hash.

    Rows are first counted by the leading digits of their hash (65,536 counts
    at most, reading the key columns only), which gives the digits that hold
    the first ``n`` rows; only the rows up to there are ordered. So about ``n``
    rows move in all, however many partitions the table has. The limit is the
    feature here. Unlike pandas, asking for more rows than exist returns all.
    """
    head = F.substring(sample_key(key_cols, seed), 1, HEAD_DIGITS)
    counts = df.select(head.alias("head")).groupBy("head").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("head"))
    last = counts.withColumn("before", so_far - F.col("n")).where(F.col("before") < n) \
        .agg(F.max("head").alias("last"))
    return df.where(head <= last.scalar()).orderBy(sample_key(key_cols, seed)).limit(n)


def hash_split(df: DataFrame, key_cols: list[str], fraction: float,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split rows into (first, rest): a row is in ``first`` when its hash < fraction.

    Every row lands in exactly one side. The cut compares the first eight hex
    digits of the md5 as text, which orders the same way in every engine.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    cut = format(min(int(fraction * 16 ** 8), 16 ** 8 - 1), "08x") if fraction < 1.0 else "g"
    head = F.substring(sample_key(key_cols, seed), 1, 8)
    return df.where(head < F.lit(cut)), df.where(head >= F.lit(cut))
