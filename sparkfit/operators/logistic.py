"""Logistic regression by batch gradient descent on long-form term frequencies.

Data layout: ``examples`` = (id, y, idx, tf, head), hash-partitioned by id,
sorted by (id, idx) and persisted for the duration of the fit. A row with no
known word keeps one row with NULL idx so that it still scores 0. ``head``
marks one row per id. The model has a weight for each word of the vocabulary.

Each step is one pass over ``examples``:

* the weights (idx, w), a written table of a row per word, are left-joined on
  idx; Spark broadcasts them by their measured size;
* the score z = sum(tf*w) per id is a window over id; the data is already
  partitioned and sorted by id, so the window adds no shuffle and no sort;
* gradient sums per idx, plus loss and hits on ``head`` rows, come out of
  one ``groupBy(idx)`` that is combined map-side (a row per word and one more leave each task);
  the current weights join that same aggregation through a union, so the
  step needs no join;
* the per-word sums are written as a table in the shared scratch
  folder, which cuts the lineage each step in one job; one row of plain sums
  read from it gives loss, accuracy, the gradient norm and the norm of the
  moved weights (for the early stop); the next weights are a projection of
  that table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfit.functions.numeric import log_loss, sigmoid, threshold
from sparkfit.session import drop_table, write_table

# The model's step size, step count, L2 factor, stop tolerance
# and the spread of the random start.
LOGIT_RATE = 0.0003
LOGIT_STEPS = 5
LOGIT_L2 = 0.01
LOGIT_STOP_TOL = 1e-7
LOGIT_INIT_STD = 0.1


@dataclass
class LogisticFit:
    weights: DataFrame      # (idx INT, w DOUBLE), a row per word
    trace: DataFrame        # (iteration INT, loss, acc, grad_norm DOUBLE)
    size: int               # number of examples
    stopped_early: bool


def build_examples(tf: DataFrame, labels: DataFrame, id_col: str = "id",
                   label_col: str = "y") -> DataFrame:
    """(id, y, idx, tf, head), one row per (id, known word); ``fit_logistic``
    persists it for the duration of the fit."""
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    feats = tf.select(F.col(id_col).alias("id"), F.col("idx").cast("int").alias("idx"),
                      F.col("tf").cast("double").alias("tf"))
    # The window partitions and sorts by id, unless the join's sides are so already.
    first = Window.partitionBy("id").orderBy("idx")
    return lab.join(feats, "id", "left").withColumn("head", F.row_number().over(first) == 1)


def start_weights(vocab: DataFrame, init: float | None = None, seed: int = 7) -> DataFrame:
    """(idx, w) for each word of the vocabulary: a constant start, or N(0, 0.1)
    drawn from the md5 digits of the seed and the word's index, the same in any
    run, partitioning and engine."""
    base = vocab.select(F.col("idx").cast("int").alias("idx"))
    if init is not None:
        return base.withColumn("w", F.lit(float(init)))

    def uniform(part: int):
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(part)), F.col("idx").cast("string"))), 1, 10)
        return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 40)
    normal = F.sqrt(F.lit(-2.0) * F.log(uniform(0))) * F.cos(F.lit(2 * math.pi) * uniform(1))
    return base.withColumn("w", normal * F.lit(LOGIT_INIT_STD))


def score_rows(examples: DataFrame, weights: DataFrame) -> DataFrame:
    """Every example row with its id's score z and probability p."""
    joined = examples.join(weights.select("idx", "w"), "idx", "left")
    z = F.sum(F.coalesce(F.col("tf") * F.col("w"), F.lit(0.0))).over(Window.partitionBy("id"))
    return joined.withColumn("z", z).withColumn("p", sigmoid(F.col("z")))


def fit_logistic(examples: DataFrame, vocab: DataFrame, rate: float = LOGIT_RATE,
                 steps: int = LOGIT_STEPS, l2: float = LOGIT_L2,
                 init: float | None = None, seed: int = 7,
                 tol: float = LOGIT_STOP_TOL, persist: bool = True) -> LogisticFit:
    """Batch descent over the words of ``vocab`` (its ``idx``) with the step rule:

    w <- w - rate * grad;  stop if | ||w|| - ||w_prev|| | < tol (this step is
    then left out of the history and not shrunk);  w <- w - 2*l2*w.

    History rows hold accuracy, loss and gradient norm measured with the
    weights *before* the step. ``persist=False`` when the caller already keeps
    ``examples`` persisted (e.g. to score them after the fit).
    """
    spark = examples.sparkSession
    if not persist:
        return _descend(spark, examples, vocab, rate, steps, l2, init, seed, tol)
    examples = examples.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _descend(spark, examples, vocab, rate, steps, l2, init, seed, tol)
    finally:
        examples.unpersist()


def _descend(spark: SparkSession, examples: DataFrame, vocab: DataFrame, rate: float, steps: int,
             l2: float, init: float | None, seed: int, tol: float) -> LogisticFit:
    weights = write_table(start_weights(vocab, init, seed), "logit-start")
    previous = weights
    prev_norm = 0.0
    history = []
    stopped = False
    size = 0
    y, p, head = F.col("y"), F.col("p"), F.col("head")
    none = F.lit(None).cast("double")
    for i in range(steps):
        scored = score_rows(examples, weights)
        # Per-row contributions and the current weights go through one
        # groupBy(idx): a single map-side-combined shuffle, no join.
        contrib = scored.select(
            "idx", none.alias("w_old"), ((p - y) * F.col("tf")).alias("g"),
            F.when(head, log_loss(y, p)).alias("loss"),
            F.when(head, (threshold(p).cast("double") == y).cast("double")).alias("hit"),
            head.cast("long").alias("head"))
        current = weights.select("idx", F.col("w").alias("w_old"), none.alias("g"), none.alias("loss"),
                                 none.alias("hit"), F.lit(0).cast("long").alias("head"))
        step = write_table(
            contrib.unionByName(current).groupBy("idx").agg(
                F.max("w_old").alias("w_old"), F.sum("g").alias("gsum"),
                F.sum("loss").alias("loss_sum"), F.sum("hit").alias("hits"),
                F.sum("head").alias("heads")),
            f"logit-step{i}")
        drop_table(previous)            # superseded: the new weights come from `step`
        previous = step
        known = F.col("idx").isNotNull()
        g = F.coalesce(F.col("gsum"), F.lit(0.0))
        # ||w - a*g||^2 = Sww - 2a*Swg + a^2*Sgg, with a = rate/n: one pass of plain sums.
        s = step.agg(
            F.sum("heads").alias("n"), F.sum("loss_sum").alias("loss_sum"),
            F.sum("hits").alias("hits"),
            F.sum(F.when(known, F.col("w_old") * F.col("w_old"))).alias("sww"),
            F.sum(F.when(known, F.col("w_old") * g)).alias("swg"),
            F.sum(F.when(known, g * g)).alias("sgg"),
        ).first()
        size = int(s["n"] or 0)
        if size == 0:
            raise ValueError("fit_logistic: no examples")
        a = rate / size
        norm = math.sqrt(max((s["sww"] or 0.0) - 2 * a * (s["swg"] or 0.0) + a * a * (s["sgg"] or 0.0), 0.0))
        moved = F.col("w_old") - F.lit(rate) * g / F.lit(float(size))
        if abs(norm - prev_norm) < tol:
            weights = step.where(known).select("idx", moved.alias("w"))
            stopped = True
            break
        prev_norm = norm
        weights = step.where(known).select("idx", (moved - F.lit(2.0 * l2) * moved).alias("w"))
        history.append((i, (s["loss_sum"] or 0.0) / size, (s["hits"] or 0.0) / size,
                        math.sqrt(s["sgg"] or 0.0) / size))
    trace = spark.createDataFrame(
        history, "iteration INT, loss DOUBLE, acc DOUBLE, grad_norm DOUBLE")
    return LogisticFit(weights=weights, trace=trace, size=size, stopped_early=stopped)


def predict_logistic(examples: DataFrame, weights: DataFrame, cut: float = 0.5) -> DataFrame:
    """(id, y, p, pred) per example; ``pred = p >= cut``.

    ``groupBy(id, y)`` reuses the examples' partitioning by id: no shuffle.
    """
    joined = examples.join(weights.select("idx", "w"), "idx", "left")
    z = F.sum(F.coalesce(F.col("tf") * F.col("w"), F.lit(0.0)))
    scored = joined.groupBy("id", "y").agg(z.alias("z"))
    p = sigmoid(F.col("z"))
    return scored.select("id", F.col("y").cast("int").alias("y"), p.alias("p"),
                         threshold(p, cut).alias("pred"))


def top_coefficients(weights: DataFrame, vocab: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` words with the largest weights, listed rising (rank 0 = smallest
    of them). Ties go to the smaller word."""
    best = (weights.join(vocab.select("word", "idx"), "idx")
                   .orderBy(F.desc("w"), F.asc("word")).limit(n))
    rising = Window.orderBy(F.asc("w"), F.desc("word"))
    return best.select((F.row_number().over(rising) - 1).cast("int").alias("rank"), "word", "idx", "w")
