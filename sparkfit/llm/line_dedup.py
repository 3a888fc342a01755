"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z
lower-cased, as a 128-bit hash. Documents come in batches. A batch is counted
(documents per key), merge-anti-joined with the runs of settled keys (those
that have reached the number of documents at which lines go), and what is left
is added as a new run of level 0. Two runs of a level are compacted into one of
the next level by a merge join that adds their counts; keys that reach the
number of documents on the way are settled. Runs are bucketed by hash and
sorted within the bucket, so these joins read them as they lie.

All counts combine on the map side, joins on a frequent key are on narrow rows
and may be split by Spark when skewed, and texts move once, to be rebuilt.

Results for special inputs: a null or empty text is one empty line; empty keys
never go; repeated rows count as documents of their own; a line is dropped in
every document that has it, the first included; an empty table gives an empty
result; other columns are ignored, whatever their names; texts of any length
are split whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfit.llm.common import ship, slices_by_bytes
from sparkfit.session import drop_table, scratch_path, scratch_table, write_table

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
MOST_SETTLED = 4            # runs of settled keys that a batch is joined with
EDGES = b" \t\n\x0b\x0c\r"


class LineRuns:
    """Levelled runs of (h, n): a line hash and the documents that have it.

    ``add`` takes the line hashes of a batch of documents, one row for each
    document and distinct line. ``frequent`` gives the hashes found in at least
    ``min_docs`` documents of all batches.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[str | None] = []      # a run or none at each level
        self.settled: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        """A run as a table bucketed by hash and sorted; one file per bucket."""
        name = scratch_table(self.spark, "line-run")
        rows.repartition(self.buckets, "h").write.format("parquet").bucketBy(self.buckets, "h").sortBy("h") \
            .saveAsTable(name)
        return name

    def _merged(self, one: str, other: str) -> DataFrame:
        """Two runs as one, counts added."""
        a, b = self.spark.table(one), self.spark.table(other)
        return a.hint("merge").join(b, a["h"] == b["h"], "full_outer").select(
            F.coalesce(a["h"], b["h"]).alias("h"), (F.coalesce(a["n"], F.lit(0)) + F.coalesce(b["n"], F.lit(0))).alias("n"))

    def add(self, hashes: DataFrame) -> None:
        counts = hashes.groupBy("h").agg(F.count("*").alias("n"))
        for name in self.settled:
            counts = counts.join(self.spark.table(name).select("h").hint("merge"), "h", "left_anti")
        run, level = self._write(counts), 0
        while level < len(self.levels) and self.levels[level]:
            run = self._compact(self.levels[level], run)
            self.levels[level] = None
            level += 1
        self.levels[level:level + 1] = [run]

    def _compact(self, one: str, other: str) -> str:
        merged = write_table(self._merged(one, other), "line-merge")
        enough = F.col("n") >= self.min_docs
        self.settled.append(self._write(merged.where(enough)))
        rest = self._write(merged.where(~enough))
        drop_table(merged)
        self._drop([one, other])
        if len(self.settled) > MOST_SETTLED:
            first, second, *later = self.settled
            self.settled = [self._write(self._merged(first, second)), *later]
            self._drop([first, second])
        return rest

    def frequent(self) -> DataFrame:
        """(h) of the lines that go; all runs are compacted into one first."""
        left = [n for n in self.levels if n]
        while len(left) > 1:
            left = [self._compact(left[0], left[1]), *left[2:]]
        self.levels = list(left)
        out = self.spark.createDataFrame([], "h binary")
        for n in [*self.settled, *left]:
            out = out.unionAll(self.spark.table(n).where(F.col("n") >= self.min_docs).select("h"))
        return write_table(out, "line-frequent")

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")

    def close(self) -> None:
        self._drop([n for n in self.levels if n] + self.settled)
        self.levels, self.settled = [], []


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text_hash, h, at): per row and distinct key its hash and the places
    (from 0) of the lines that have it; keys below ``min_chars`` are left out."""
    ship(docs.sparkSession)
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t"):
                row: list[int] = []
                hashes: list[bytes] = []
                places: list[list[int]] = []
                for i, text in enumerate(part.column(2).to_pylist()):
                    own: dict[bytes, list[int]] = {}
                    for at, line in enumerate((text or "").encode().split(b"\n")):
                        key = line.strip(EDGES).lower()
                        if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                            own.setdefault(xxhash.xxh3_128_digest(key), []).append(at)
                    row.extend([i] * len(own))
                    hashes.extend(own)
                    places.extend(own.values())
                take = pa.array(row, type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(hashes, type=pa.binary()),
                     pa.array(places, type=pa.list_(pa.int32()))], names=["id", "text_hash", "h", "at"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {id_type}, text_hash bigint, h binary, at array<int>")


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
               min_chars: int = MIN_CHARS, batches: int = BATCHES, digest: bool = False) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) per row; with ``digest`` the last is
    ``kept_sha256``, the SHA-256 of the kept text, and no text leaves the task."""
    spark = docs.sparkSession
    batch = F.pmod(F.col("text_hash"), F.lit(batches)).cast("int")
    # One table of line keys; a batch of documents is a part of it.
    path = scratch_path(spark, "line-keys")
    keyed = line_keys(docs, id_col, text_col, min_chars).withColumn("batch", batch)
    keyed.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keyed.schema).parquet(path)
    runs = LineRuns(spark, min_docs)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b).select("h"))
    gone = runs.frequent()
    runs.close()

    drops = keys.join(gone, "h", "left_semi").groupBy("id", "text_hash") \
        .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("drops"))
    rows = docs.select(F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("t"))
    found = rows.join(drops, F.col("i").eqNullSafe(F.col("id")) & (F.col("th") == F.col("text_hash")), "left") \
        .select("i", "t", "drops")
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    last = "kept_sha256" if digest else "kept_text"

    def rebuild(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t"):
                total, dropped, kept = [], [], []
                for text, drops in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    lines = (text or "").split("\n")
                    out = set(drops or ())
                    rest = text or "" if not out else "\n".join([x for i, x in enumerate(lines) if i not in out])
                    total.append(len(lines))
                    dropped.append(len(out))
                    kept.append(hashlib.sha256(rest.encode()).hexdigest() if digest else rest)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, type=pa.int64()), pa.array(dropped, type=pa.int64()),
                     pa.array(kept, type=pa.string())], names=["i", "n_lines", "n_dropped", last])

    return found.mapInArrow(rebuild, f"i {id_type}, n_lines bigint, n_dropped bigint, {last} string") \
                .withColumnRenamed("i", id_col)
