"""Vectors in array columns: which rows take part, and sums over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.common import ship


def finite_vectors(df: DataFrame, id_col: str, vec_col: str, keep_type: bool = False) -> DataFrame:
    """(id, vec) of the rows whose vector is there, not empty, and has neither
    null nor non-finite entries; entries are doubles unless the type is kept."""
    vec = F.col(vec_col) if keep_type else F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return df.select(F.col(id_col).alias("id"), vec.alias("vec")).where((F.size(vec) > 0) & ~bad)


def common_length(vectors: DataFrame, vec_col: str = "vec") -> int:
    """The length that most of the vectors have, the larger of equally frequent
    ones; 0 where there are none."""
    found = vectors.groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), F.desc("d")).first()
    return found["d"] if found else 0


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """The rows of a list column, each of ``d`` entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def summed(df: DataFrame, add: Callable[[Iterable[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray:
    """Sum over all tasks of the matrix that ``add`` makes of a task's rows.

    Only the matrix goes to the driver. A row of it is added up where all tasks'
    versions of that row meet, in the order of the tasks, so that a rerun gives
    the same sum."""
    ship(df.sparkSession)
    part = "i int, task int, v array<double>"

    def partial(batches):
        got = add(batches)
        if got is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(got)), pa.int32()), pa.array([task] * len(got), pa.int32()),
                 pa.array(list(got), pa.list_(pa.float64()))], names=["i", "task", "v"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            vs = batch.column(2)
            for k, i in enumerate(batch.column(0).to_pylist()):
                v = vs[k].values.to_numpy(zero_copy_only=False)
                sums[i] = sums[i] + v if i in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int32()),
                 pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["i", "task", "v"])

    rows = df.mapInArrow(partial, part).repartition("i").sortWithinPartitions("i", "task") \
        .mapInArrow(total, part).orderBy("i").collect()
    return np.array([r["v"] for r in rows])
