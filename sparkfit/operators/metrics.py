"""Classifier metrics as single aggregations.

Counts come from one pass; per-class metrics come from the confusion matrix,
which has at most classes^2 rows whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_metrics(pred: DataFrame, label: str = "y", prediction: str = "pred",
                      size: int | None = None) -> DataFrame:
    """One row: acc, tp, fp, fn, tn, f1 for a 0/1 label and 0/1 prediction.

    ``f1 = 2tp / (2tp + fn + fp)``, NULL when nothing is positive. ``acc`` is
    hits divided by ``size`` when given (the row count otherwise).
    """
    y, p = F.col(label), F.col(prediction)
    counts = pred.agg(
        F.count("*").alias("n"),
        F.count_if(p == y).alias("hits"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y != 1)).alias("fp"),
        F.count_if((p != 1) & (y == 1)).alias("fn"),
        F.count_if((p != 1) & (y != 1)).alias("tn"),
    )
    denom = F.col("n").cast("double") if size is None else F.lit(float(size))
    two_tp = F.lit(2.0) * F.col("tp")
    return counts.select(
        F.try_divide(F.col("hits").cast("double"), denom).alias("acc"),
        "tp", "fp", "fn", "tn",
        F.try_divide(two_tp, two_tp + F.col("fn") + F.col("fp")).alias("f1"),
    )


def multiclass_metrics(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """One row: n, accuracy and label-weighted F1, as the multiclass evaluator
    defines them (classes are those present in the label column; a class with
    no true positives contributes 0).

    Each confusion-matrix cell counts once for its true class and once for
    its predicted class, so one ``groupBy(class)`` gives true count, true
    positives and predicted count per class: no join.
    """
    cm = pred.groupBy(F.col(label).cast("double").alias("l"),
                      F.col(prediction).cast("double").alias("p")).agg(F.count("*").alias("c"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("l") == F.col("p"), F.col("c")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("l").alias("cls"), F.col("c").alias("t"), hit.alias("h"), zero.alias("q")),
        F.struct(F.col("p").alias("cls"), zero.alias("t"), zero.alias("h"), F.col("c").alias("q")))
    per_class = (cm.select(F.inline(sides))
                   .groupBy("cls").agg(F.sum("t").alias("n_true"), F.sum("h").alias("tp"),
                                       F.sum("q").alias("n_pred"))
                   .where(F.col("n_true") > 0))
    tp = F.col("tp").cast("double")
    precision = F.coalesce(F.try_divide(tp, F.col("n_pred").cast("double")), F.lit(0.0))
    recall = F.try_divide(tp, F.col("n_true").cast("double"))
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * precision * recall / (precision + recall))
    return per_class.agg(
        F.sum("n_true").cast("bigint").alias("n"),
        (F.sum(tp) / F.sum("n_true")).alias("accuracy"),
        (F.sum(f1 * F.col("n_true")) / F.sum("n_true")).alias("weighted_f1"),
    )
