"""Helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfit.session import ship_package as ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The documents table, or the named columns of it."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*cols) if cols else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has (Spark's column
    names ignore case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` also folds other letters, but not
    where every character is one byte long; it is much the faster one there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
            .otherwise(F.translate(text, UPPER, LOWER))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _matching(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """Semi or anti join of documents with (id, text_hash) rows."""
    (own,) = fresh(docs, "text_hash")
    hashed = docs.withColumn(own, F.xxhash64(F.col(text_col)))
    keys = keys.select(F.col("id").alias("key_id"), F.col("text_hash").alias("key_hash"))
    return hashed.join(keys, hashed[id_col].eqNullSafe(keys["key_id"]) & (hashed[own] == keys["key_hash"]), how) \
        .select(*[hashed[c] for c in docs.columns])


def without_rows(docs: DataFrame, losers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents but those whose id and text hash are in ``losers``."""
    return _matching(docs, losers, id_col, text_col, "left_anti")


def single_rows(docs: DataFrame, repeats: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row each of the documents whose id and text hash are in ``repeats``,
    all other rows as they are. Nothing is moved where there are no repeats."""
    if repeats.isEmpty():
        return docs
    rest = without_rows(docs, repeats, id_col, text_col)
    return rest.unionAll(_matching(docs, repeats, id_col, text_col, "left_semi")
                         .dropDuplicates([id_col, text_col]))


def slices_by_bytes(batch: pa.RecordBatch, column: str, target: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows whose texts hold about ``target``
    bytes, so that working memory follows bytes and not rows. A single longer
    text makes a run of its own."""
    arr = batch.column(batch.schema.get_field_index(column))
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(arr).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > target:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def check_bound(what: str, n: int, most: int) -> None:
    """Stop where something that is sent to every executor outgrows its bound."""
    if n > most:
        raise ValueError(f"{what}: {n} is more than the {most} that may be held by every task")


def runs_by_key(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal values in an integer column, over batches
    sorted by it; a run that goes on into the next batch is put together."""
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if carry and carry[-1].column(column)[-1].as_py() != keys[0]:
            yield _joined(carry)
            carry = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            carry.append(batch.slice(a, b - a))
            if b < len(keys):
                yield _joined(carry)
                carry = []
    if carry:
        yield _joined(carry)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
