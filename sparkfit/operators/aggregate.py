"""Per-key rollups: the feature table, per-key value lists, distinct keys.

Every aggregate here is algebraic (sum / count / avg), so Spark combines on the
map side (partial ``HashAggregate``) before the one shuffle on the key. A key
holding a third of all rows therefore costs one partial row per map task, not
a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_features(df: DataFrame, key: str = "app", rating: str = "rating",
                    rating_count: str = "rating_count", min_install: str = "min_install",
                    price: str = "price", max_install: str = "max_install",
                    vector_col: str | None = None) -> DataFrame:
    """One row per key: mean rating, summed rating count, non-zero min-install
    count, summed price, and the target: non-zero max-install count.

    One ``groupBy`` gives all five, so the columns line up by key by
    construction. ``vector_col`` adds the four features as an array.
    """
    out = df.groupBy(key).agg(
        F.avg(rating).alias("rating"),
        F.sum(rating_count).cast("double").alias("rating_count"),
        F.count_if(F.col(min_install) != 0).cast("bigint").alias("min_install"),
        F.sum(price).cast("double").alias("price"),
        F.count_if(F.col(max_install) != 0).cast("bigint").alias("max_install"),
    )
    if vector_col:
        out = out.withColumn(vector_col, F.array(
            F.col("rating").cast("double"), F.col("rating_count").cast("double"),
            F.col("min_install").cast("double"), F.col("price").cast("double")))
    return out


def collect_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """All values of each key, as a multiset in long form: (key, value, cnt).

    The sorted list of a key's values is the rows of that key ordered by value,
    each repeated ``cnt`` times. Long form keeps a hot key spread over many
    rows and tasks instead of one unbounded in-memory list.
    """
    return (df.groupBy(F.col(key).alias("key"), F.col(value).alias("value"))
              .agg(F.count("*").alias("cnt")))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
