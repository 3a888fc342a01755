"""Token counts of whole texts by batch encoding in Arrow functions.

A task takes its Arrow batches in runs of equal bytes, cuts the texts where the
tokenizer cuts too (so a long text is many short chunks), encodes the distinct
chunks it hasn't seen in batches of equal bytes, and returns lengths only: no
id leaves the encoder.

Results for special inputs: a null text counts as empty (0 bytes, 0 tokens);
repeated rows each get their row; an empty table gives an empty result; other
columns are ignored, whatever their names; a text of any length is counted
whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.chunks import AT_BLANKS, ENDINGS, ChunkCache, as_list, distinct_parts, in_batches
from sparkfit.llm.common import ship, slices_by_bytes
from sparkfit.llm.vocab import LibraryTokenizer, PieceTokenizer, once_per_process, shared_file

BATCH_CHARS = 1 << 18       # characters of a call of the library


class Counter:
    """Token counts of Arrow arrays of texts; chunks that recur are encoded once."""

    def __init__(self, tokenizer):
        self.whole = tokenizer.cut is not AT_BLANKS
        self.encode = lambda strings: in_batches(strings, tokenizer.counts, BATCH_CHARS)
        self.cache = ChunkCache(self.encode, endings=None if self.whole else
                                dict(zip(ENDINGS, self.encode(list(ENDINGS)), strict=True)))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        texts = texts.fill_null("")
        if self.whole:
            return np.array(self.encode(texts.to_pylist()), dtype=np.int64)
        if not len(texts):
            return np.empty(0, dtype=np.int64)
        firsts, number, distinct = distinct_parts(pc.split_pattern(pc.replace_substring(texts, "\n", " "), " "))
        words = as_list(distinct)
        known = self.cache.resolve(set(words))
        counts = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
        return np.add.reduceat(counts[number], firsts)


def json_counter(content: bytes) -> Counter:
    return Counter(LibraryTokenizer(content))


def model_counter(content: bytes) -> Counter:
    return Counter(PieceTokenizer(content))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``over_limit``: more
    than ``limit`` tokens. A .json file is read by the tokenizers library, a
    .model file by sentencepiece."""
    spark = docs.sparkSession
    ship(spark)
    shared = shared_file(spark, tokenizer_path)
    build = model_counter if tokenizer_path.endswith(".model") else json_counter

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once_per_process(shared.value, build)
        for batch in batches:
            for part in slices_by_bytes(batch, "t"):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counter(part.column(1)))],
                                                 names=["i", "n_bytes", "n_tokens"])

    id_type = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("b"))
    return rows.mapInArrow(run, f"i {id_type}, n_bytes bigint, n_tokens bigint") \
               .withColumnRenamed("i", id_col) \
               .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
