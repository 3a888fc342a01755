"""Batch fits on in-row term counts: a dense partial gradient from each task.

Rows are (id, y, idx, tf): one per document, its known words' indexes and counts
as two arrays, persisted for the fit. A step sends the weights (one double a word
of the vocabulary) to the tasks; each task adds up one vector over all of its
rows (gradient, loss and counts), and the tasks' vectors are summed in a tree of
two levels, in the order of the tasks. So a step shuffles vectors, never rows or
(row, word) pairs, and the driver holds one vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.functions.numeric import sigmoid, threshold
from sparkfit.operators.logistic import (LOGIT_L2, LOGIT_RATE, LOGIT_STEPS, LOGIT_STOP_TOL, LogisticFit, start_weights)
from sparkfit.operators.text import counted_words
from sparkfit.session import ship_package

SVM_STEPS = 10
SVM_PATIENCE = 5
SVM_EPSILON = 1e-9              # shortfalls and gains below are rounding: a step often puts a margin at 1
_GUARD = 1e-12                  # inside the logarithms of the loss

_PART = "grp int, task int, v binary"


def example_rows(df: DataFrame, id_col: str, label: Column | str, tokens: Column, words: list[str]) -> DataFrame:
    """(id, y, idx, tf), a row for each row of ``df``; unknown words drop."""
    y = F.col(label) if isinstance(label, str) else label
    rows = df.select(F.col(id_col).alias("id"), y.cast("double").alias("y"), tokens.alias("tokens"))
    return counted_words(rows, ["id", "y"], F.col("tokens"), words)


class Batch:
    """The term counts of an Arrow batch of rows."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        idx, tf = batch.column("idx"), batch.column("tf")
        self.n = batch.num_rows
        self.y = batch.column("y").to_numpy(zero_copy_only=False) if "y" in batch.schema.names else None
        self.idx = idx.flatten().to_numpy(zero_copy_only=False)
        self.tf = tf.flatten().to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(self.n), idx.value_lengths().to_numpy(zero_copy_only=False))

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.tf * w[self.idx], self.n)

    def by_word(self, of_row: np.ndarray, k: int) -> np.ndarray:
        """Per word, the sum over rows of a value of the row times its count."""
        return np.bincount(self.idx, of_row[self.row] * self.tf, k)


def summed_vector(rows: DataFrame, kernel: Callable[[Batch], np.ndarray], width: int) -> np.ndarray:
    """The sum of ``kernel`` over all batches of all tasks, as one vector; the
    tree's first level has as many nodes as the root of the shuffle partitions."""
    ship_package(rows.sparkSession)
    groups = max(1, math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def row(grp, task, v):
        return pa.RecordBatch.from_arrays([pa.array([grp], pa.int32()), pa.array([task], pa.int32()),
                                           pa.array([v.tobytes()], pa.binary())], names=["grp", "task", "v"])

    def partial(batches: Iterable[pa.RecordBatch]):
        total, task = None, TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                got = kernel(Batch(batch))
                total = got if total is None else total + got
        if total is not None:
            yield row(task % groups, task, total)

    def merge(batches: Iterable[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for grp, v in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                got = np.frombuffer(v.as_buffer(), float)
                sums[grp] = sums[grp] + got if grp in sums else got
        for grp, v in sorted(sums.items()):
            yield row(0, grp, v)

    first = rows.mapInArrow(partial, _PART).repartition(groups, "grp").sortWithinPartitions("grp", "task") \
        .mapInArrow(merge, _PART)
    last = first.repartition(1).sortWithinPartitions("task").mapInArrow(merge, _PART) if groups > 1 else first
    found = last.select("v").collect()
    return np.frombuffer(found[0]["v"], float).copy() if found else np.zeros(width)


def _sent(rows: DataFrame, w: np.ndarray, kernel: Callable[[Batch, np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """``summed_vector`` of a kernel that needs the weights."""
    shared = rows.sparkSession.sparkContext.broadcast(w)
    try:
        return summed_vector(rows, lambda b: kernel(b, shared.value), width)
    finally:
        shared.unpersist()


def start_vector(spark, k: int, init: float | None = None, seed: int = 7) -> np.ndarray:
    """``start_weights`` of a vocabulary of k words, as a vector."""
    w = start_weights(spark.range(k).select(F.col("id").cast("int").alias("idx")), init, seed)
    return np.array([r["w"] for r in w.orderBy("idx").collect()])


def weight_rows(spark, w: np.ndarray) -> DataFrame:
    """(idx, w), a row per word."""
    return spark.createDataFrame(pa.table({"idx": pa.array(np.arange(len(w), dtype=np.int32)), "w": pa.array(w)}))


def _logistic_kernel(k: int):
    def kernel(b: Batch, w: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-b.scores(w)))
        loss = -b.y * np.log(p + _GUARD) - (1 - b.y) * np.log((1 - p) + _GUARD)
        hits = (p >= 0.5).astype(float) == b.y
        return np.append(b.by_word(p - b.y, k), [loss.sum(), hits.sum(), b.n])
    return kernel


def fit_logistic_rows(rows: DataFrame, k: int, rate: float = LOGIT_RATE, steps: int = LOGIT_STEPS, l2: float = LOGIT_L2,
                      init: float | None = None, seed: int = 7, tol: float = LOGIT_STOP_TOL) -> LogisticFit:
    """The descent of ``fit_logistic``, step rule and history alike, over rows of
    in-row counts of a vocabulary of k words. The caller persists the rows."""
    spark = rows.sparkSession
    w = start_vector(spark, k, init, seed)
    kernel = _logistic_kernel(k)
    history, prev_norm, n, stopped = [], 0.0, 0.0, False
    for i in range(steps):
        s = _sent(rows, w, kernel, k + 3)
        g, (loss, hits, n) = s[:k], s[k:]
        if n == 0:
            raise ValueError("fit_logistic_rows: no examples")
        w = w - rate * g / n
        norm = float(np.linalg.norm(w))
        if abs(norm - prev_norm) < tol:
            stopped = True
            break
        prev_norm = norm
        w = w - 2.0 * l2 * w
        history.append((i, float(loss / n), float(hits / n), float(np.linalg.norm(g) / n)))
    trace = spark.createDataFrame(history, "iteration INT, loss DOUBLE, acc DOUBLE, grad_norm DOUBLE")
    return LogisticFit(weights=weight_rows(spark, w), trace=trace, size=int(n), stopped_early=stopped)


def score_counted(rows: DataFrame, w: np.ndarray, intercept: float = 0.0) -> DataFrame:
    """(id, y, z): each row's weighted sum of counts."""
    ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        for batch in batches:
            z = Batch(batch).scores(shared.value) + intercept
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(z)], names=["id", "y", "z"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "y", "idx", "tf").mapInArrow(run, f"id {kind}, y double, z double")


def vector_of(weights: DataFrame) -> np.ndarray:
    """The vector of (idx, w) rows; one double a word of the vocabulary."""
    return np.array([r["w"] for r in weights.orderBy("idx").collect()])


def predict_logistic_rows(rows: DataFrame, weights: DataFrame, cut: float = 0.5) -> DataFrame:
    """(id, y, p, pred) per row; ``pred = p >= cut``."""
    p = sigmoid(F.col("z"))
    return score_counted(rows, vector_of(weights)) \
        .select("id", F.col("y").cast("int").alias("y"), p.alias("p"), threshold(p, cut).alias("pred"))


@dataclass
class SvmFit:
    weights: DataFrame      # (idx INT, w DOUBLE) on plain counts, a row per word
    intercept: float
    trace: DataFrame        # (iteration INT, loss, grad_norm DOUBLE, errors BIGINT, target DOUBLE)
    best: int               # the iteration whose weights these are


def word_deviations(rows: DataFrame, k: int) -> np.ndarray:
    """Standard deviation (n - 1) of each word's count over all rows."""
    def kernel(b: Batch) -> np.ndarray:
        return np.concatenate([np.bincount(b.idx, b.tf, k), np.bincount(b.idx, b.tf * b.tf, k), [b.n]])

    s = summed_vector(rows, kernel, 2 * k + 1)
    total, squares, n = s[:k], s[k:2 * k], s[2 * k]
    if n < 2:
        return np.zeros(k)
    return np.sqrt(np.maximum(squares - total * total / n, 0.0) / (n - 1))


def fit_svm_rows(rows: DataFrame, k: int, steps: int = SVM_STEPS) -> SvmFit:
    """Linear SVM with intercept: mean hinge loss over counts scaled by their
    deviation (words of one and the same count everywhere get no weight), by
    ``steps`` passes of subgradient descent from zero. The caller persists rows.

    Step rule: with f the loss and b the best so far, the aimed-at loss is
    t = max(0, b - d); d starts as the first loss and is halved after
    ``SVM_PATIENCE`` passes that don't improve b; the step is (f - t) / |g|^2
    along -g. The weights of the best pass are returned.
    """
    spark = rows.sparkSession
    sd = word_deviations(rows, k)
    scale = np.divide(1.0, sd, out=np.zeros(k), where=sd > 0)

    def kernel(b: Batch, w: np.ndarray) -> np.ndarray:
        side = np.where(b.y > 0.5, 1.0, -1.0)
        z = b.scores(w[:k] * scale) + w[k]
        short = 1.0 - side * z
        short[short <= SVM_EPSILON] = 0.0
        active = np.where(short > 0.0, -side, 0.0)
        wrong = (z > 0) != (side > 0)
        return np.concatenate([b.by_word(active, k) * scale,
                               [active.sum(), short.sum(), wrong.sum(), b.n]])

    w = np.zeros(k + 1)
    history, best, best_at, best_w, slack, stale = [], math.inf, 0, w, None, 0
    for i in range(steps):
        s = _sent(rows, w, kernel, k + 4)
        n = s[k + 3]
        if n == 0:
            raise ValueError("fit_svm_rows: no examples")
        g, loss = s[:k + 1] / n, float(s[k + 1] / n)
        slack = loss if slack is None else slack
        if loss < best - SVM_EPSILON:
            best, best_at, best_w, stale = loss, i, w, 0
        else:
            stale += 1
            if stale == SVM_PATIENCE:
                slack, stale = slack / 2, 0
        target = max(0.0, best - slack)
        size = float(g @ g)
        history.append((i, loss, math.sqrt(size), int(s[k + 2]), target))
        if size:
            w = w - (loss - target) / size * g
    trace = spark.createDataFrame(history, "iteration INT, loss DOUBLE, grad_norm DOUBLE, errors BIGINT, target DOUBLE")
    return SvmFit(weight_rows(spark, best_w[:k] * scale), float(best_w[k]), trace, best_at)


def predict_svm_rows(rows: DataFrame, fit: SvmFit) -> DataFrame:
    """(id, y, score, pred) per row; ``pred = score > 0``."""
    return score_counted(rows, vector_of(fit.weights), fit.intercept) \
        .select("id", F.col("y").cast("int").alias("y"), F.col("z").alias("score"), (F.col("z") > 0).cast("int").alias("pred"))


def persisted(rows: DataFrame) -> DataFrame:
    return rows.persist(StorageLevel.MEMORY_AND_DISK)
