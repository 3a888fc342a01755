"""Row-level helpers that keep expensive expressions from being evaluated twice.

Catalyst pushes a ``where`` on a computed column below the projection that
computes it (and below a ``repartition``), inlining the expression there. For
cheap predicates that is what we want. For expensive ones (tokenizers, regex
parsers) it evaluates them twice, and before any repartition meant to spread
that work. A predicate evaluated inside a generator cannot be pushed down.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_items(df: DataFrame, keep: list, items: Column, name: str,
                  pos_name: str | None = None) -> DataFrame:
    """One row per array element (``keep`` columns repeated), empty arrays dropped.

    ``explode_outer`` plus a NULL filter *above* the generator: with a plain
    ``explode`` Spark infers ``size(array) > 0`` and pushes it down to the
    scan, evaluating the array expression once more there.
    """
    if pos_name:
        gen = F.posexplode_outer(items).alias(pos_name, name)
    else:
        gen = F.explode_outer(items).alias(name)
    return df.select(*keep, gen).where(F.col(name).isNotNull())


def filter_late(df: DataFrame, predicate: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``df`` for which ``predicate(row_struct)`` is true, tested after
    ``df``'s own projections have run (each expression evaluated once).

    ``predicate`` receives the row as a struct column: ``lambda r: r["x"] > 0``.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    # A one-element array for kept rows, NULL otherwise; explode_outer keeps
    # Spark from inferring (and pushing down) a size filter, and every piece
    # is a built-in, code-generated expression.
    kept = F.when(F.coalesce(predicate(row), F.lit(False)), F.array(row))
    return df.select(F.explode_outer(kept).alias("_row")).where(F.col("_row").isNotNull()) \
        .select("_row.*")
