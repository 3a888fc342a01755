"""Row positions, key-to-id maps and keyed joins.

``row_positions`` numbers rows 0..N-1 in a stated order without funnelling
all rows through one task (which a global ``row_number()`` window does):

1. range-partition on the order and sort within partitions (Spark samples
   the keys to pick balanced ranges); the other columns of a row are part of
   the order, so rows with equal keys are told apart the same way in any
   partitioning, and a run of them can be split over ranges;
2. tag each row with its range (partition id) and its index inside the
   range, read from ``monotonically_increasing_id()`` (partition id in the
   upper 31 bits, row index in the lower 33, as documented); the sort makes
   that index the same on any retry;
3. write the tagged rows to the shared scratch folder (one job; survives a
   lost executor);
4. count rows per range (one small row per range) and prefix-sum them;
   position = offset of the range + index inside it.

The rows are written before they are ranged, since range partitioning reads its
input twice: give it narrow ones, the key and what the caller needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfit.session import drop_table, write_table

_ROW_BITS = 33


def row_positions(df: DataFrame, order: list[Column], pos_col: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``pos`` (BIGINT, from 0) following ``order``; ties are in the order
    of the rows' columns."""
    src = write_table(df, "positions-input")
    total = [*order, *[F.col(c).asc() for c in df.columns]]
    ranged = (src.repartitionByRange(num_partitions, *total) if num_partitions
              else src.repartitionByRange(*total))
    pid = F.spark_partition_id().cast("bigint")
    tagged = ranged.sortWithinPartitions(*total).select(
        "*", pid.alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid, _ROW_BITS)).alias("_local"))
    fixed = write_table(tagged, "positions")
    drop_table(src)
    counts = fixed.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # One offset row per range: as many as the shuffle has partitions.
    return (fixed.join(F.broadcast(offsets), "_pid")
                 .withColumn(pos_col, (F.col("_off") + F.col("_local")).cast("bigint"))
                 .drop("_pid", "_local", "_off"))


def key_index(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """(key, id): the position of the *last* row of each key, rows taken in
    ascending ``order_cols`` order (ties in the order of the key).

    A later row with the same key overwrites an earlier one, as when a map is
    built from the rows in turn. The max per key is map-side combined.
    """
    cols = [key] + [c for c in order_cols if c != key]
    pos = row_positions(df.select(*cols), [F.col(c).asc() for c in order_cols])
    return pos.groupBy(key).agg(F.max("pos").alias("id"))


def keyed_join(left: DataFrame, right: DataFrame, on: str | list[str],
               how: str = "inner") -> DataFrame:
    """Equi-join on key columns; duplicate keys fan out as in any inner join.

    Spark picks the method; AQE switches to a broadcast join at run time when
    one side turns out small and splits skewed partitions of a sort-merge join.
    """
    return left.join(right, on, how)


def join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per key: rows on each side and the rows their inner join would produce.

    Each side is reduced to one row per key first (map-side combined), so a
    key with k rows on both sides costs two counts and a product, never the
    k*k pairs themselves.
    """
    lc = left.groupBy(key).agg(F.count("*").alias("n_left"))
    rc = right.groupBy(key).agg(F.count("*").alias("n_right"))
    return (lc.join(rc, key, "inner")
              .withColumn("n_pairs", F.col("n_left") * F.col("n_right")))


def keyed_join_sorted(left: DataFrame, right: DataFrame, on: str, pos_col: str = "pos") -> DataFrame:
    """Inner join, then number the joined rows in key order (``pos``); rows of
    equal keys are in the order of their other columns."""
    return row_positions(left.join(right, on, "inner"), [F.col(on).asc()], pos_col)
