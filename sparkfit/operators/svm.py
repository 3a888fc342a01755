"""Linear SVM on sparse term-frequency vectors (Spark MLlib).

Features come from ``CountVectorizerModel.from_vocabulary`` with our own
top-K vocabulary, so the second corpus is counted against the first corpus's
words, in our tie order. The vocabulary (at most K words) is the only thing
that goes to the driver: MLlib models keep it there.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.operators.metrics import multiclass_metrics


def vocab_words(vocab: DataFrame) -> list[str]:
    """Words of a (word, idx) vocabulary in idx order; at most K rows."""
    return [r["word"] for r in vocab.orderBy("idx").select("word").collect()]


def tf_vectors(df: DataFrame, words: list[str], tokens_col: str = "tokens",
               output_col: str = "features") -> DataFrame:
    """Sparse TF vectors over ``words``; unknown tokens are dropped."""
    model = CountVectorizerModel.from_vocabulary(words, inputCol=tokens_col, outputCol=output_col)
    return model.transform(df)


def sparse_entries(df: DataFrame, keep: list[str], features: str = "features") -> DataFrame:
    """(keep..., idx, tf): the stored entries of sparse vectors, one row each.

    The vector's own fields are read, so it costs its entries and not its size.
    The outer generator keeps Spark from testing the array below it, where the
    vectors would be made a second time."""
    rows = df.select(*keep, F.unwrap_udt(F.col(features)).alias("v"))
    return rows.select(*rows.columns[:-1], F.inline_outer(F.arrays_zip(
        F.col("v.indices").alias("idx"), F.col("v.values").alias("tf")))).where(F.col("idx").isNotNull())


def fit_svm(train: DataFrame, features: str = "features", label: str = "labels",
            partitions: int | None = None, **params) -> LinearSVCModel:
    """``LinearSVC`` with its defaults unless overridden (maxIter 100,
    regParam 0, tol 1e-6, standardization on, threshold 0).

    The fit keeps the input's partitions; ``partitions`` merges them to so many
    first, for inputs in far more pieces than the optimiser's 100 passes need.
    ``aggregationDepth`` (MLlib's own parameter) sums the dense gradients of
    many partitions in a tree instead of on the driver."""
    data = train.select(features, F.col(label).cast("double").alias(label))
    if partitions is not None:
        data = data.coalesce(partitions)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return LinearSVC(featuresCol=features, labelCol=label, **params).fit(data)
    finally:
        data.unpersist()


def evaluate_svm(model: LinearSVCModel, test: DataFrame, label: str = "labels") -> DataFrame:
    """One row: accuracy and label-weighted F1 of the model on ``test``.

    Rows are scored by a copy, which has no training summary: that holds the
    session, which tasks can't get once it has had an ``Observation``."""
    pred = model.copy().transform(test)
    return multiclass_metrics(pred, label=label, prediction="prediction")
