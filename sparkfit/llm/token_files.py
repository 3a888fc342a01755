"""Token-id files: Parquet lists in ascending document order.

Documents are range-partitioned and sorted by id, encoded as a stream, and
written by Spark's Parquet writer: one file per range, file order = id order.
A file's columns are

    part      range of ids the file holds
    doc_id    ascending
    start     ids of all documents before it in this file
    n_tokens  ids of the document, its end id included
    ids       list of token ids

``ids`` is dictionary-encoded (a page of ids is then bit-packed to the width of
the ids in use and compressed); the ascending columns are delta-encoded. Row
groups and pages have fixed sizes and the writer adds page indexes, so a filter
on ``doc_id`` reads the pages that can match and metadata reads (all columns
but ``ids``) never touch token pages.

Results for special inputs: a null text is an empty one (only the end id); null
ids come first; rows with equal ids are ordered by a hash of the text, repeated
rows are each written; an empty table gives an empty file; other columns are
ignored, whatever their names; texts of any length are written whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfit.llm.chunks import BEFORE_BLANK, ArrayEncoder
from sparkfit.llm.common import ship, slices_by_bytes
from sparkfit.llm.vocab import LibraryTokenizer, once_per_process, shared_file

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
WRITER_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start": "false",
}
FILE_SCHEMA = "part int, doc_id {id_type}, start bigint, n_tokens bigint, ids array<int>"


class DocumentEncoder:
    """Ids of Arrow arrays of texts, each text with the end id."""

    def __init__(self, tokenizer: LibraryTokenizer):
        self.chunked = ArrayEncoder(tokenizer.arrays, tokenizer.word_arrays) if tokenizer.cut is BEFORE_BLANK else None
        self.encode = tokenizer.arrays

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids of each text)."""
        if self.chunked:
            return self.chunked(texts, end_id)
        ids, counts = self.encode(texts.fill_null(""))
        return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def document_encoder(content: bytes) -> DocumentEncoder:
    return DocumentEncoder(LibraryTokenizer(content))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document with the tokenizers library and write the files."""
    spark = docs.sparkSession
    ship(spark)
    shared = shared_file(spark, tokenizer_path)
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    tie = F.xxhash64("t")
    ordered = rows.repartitionByRange(F.col("i").asc_nulls_first(), tie) \
                  .sortWithinPartitions(F.col("i").asc_nulls_first(), tie) \
                  .withColumn("p", F.spark_partition_id())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_process(shared.value, document_encoder)
        before = 0
        for batch in batches:
            for part in slices_by_bytes(batch, "t"):
                ids, counts = encoder(part.column(1), end_id)
                ends = np.cumsum(counts)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(0), pa.array(before + ends - counts), pa.array(counts),
                     pa.ListArray.from_arrays(offsets, pa.array(ids))],
                    names=["part", "doc_id", "start", "n_tokens", "ids"])
                before += int(ends[-1])

    ordered.mapInArrow(run, FILE_SCHEMA.format(id_type=id_type)).write.options(**WRITER_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The files as written; filters on doc_id reach the page indexes."""
    return spark.read.schema(FILE_SCHEMA.format(id_type=id_type)).parquet(path)


def global_starts(files: DataFrame) -> DataFrame:
    """(part, before): ids in all parts before this one. One row per file range,
    so as many rows as the writing shuffle had partitions."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))


def token_metadata(files: DataFrame) -> DataFrame:
    """(doc_id, start over all files, n_tokens) without reading any token page."""
    return files.select("part", "doc_id", "start", "n_tokens") \
        .join(F.broadcast(global_starts(files)), "part") \
        .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens")


def document_checksums(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files: the unsigned crc32
    of each document's ids as little-endian unsigned 32-bit integers."""
    id_type = dict(files.dtypes)["doc_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            ends = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False)).astype("<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends).astype(np.int64)),
                 pa.array(sums, type=pa.int64())], names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    found = files.select("part", "doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, f"part int, doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(F.broadcast(global_starts(files)), "part") \
        .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
