"""CSV records that may hold line breaks in quotes, read by many tasks a file.

A file is scanned as lines, in blocks that Spark may cut anywhere between two
lines. A line break is inside a field exactly if an odd number of quotes precede
it (a quote in a field is written twice, so it doesn't change the parity):

1. quotes are counted per block, one row a block (map-side combined);
2. a running sum over a file's blocks gives each block's parity at its start;
3. every block is cut into records on its own: those that end in the block are
   given whole, what is left at its ends are fragments;
4. fragments, at most two a block, are put together by a running count of record
   starts over the blocks.

So no record, file or block order has to be known to one task; the block table
has one row for each ``spark.sql.files.maxPartitionBytes`` of input, and lines
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfit.session import ship_package

_PIECE = "file string, start bigint, seq int, whole boolean, opens boolean, first boolean, record string"
_FIELDS = ["file", "start", "seq", "whole", "opens", "first", "record"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): lines in their order within a block; a carriage
    return stays part of its line."""
    return spark.read.option("lineSep", "\n").text(path) \
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def odd_blocks(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(file, start) of the blocks that begin inside quotes."""
    n = F.char_length("value") - F.char_length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    blocks = lines.groupBy("file", "start").agg(F.sum(n).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("odd", F.sum("quotes").over(before) % 2).where("odd = 1").select("file", "start")


class _Block:
    """Cuts the lines of one block into records."""

    def __init__(self, file: str, start: int, odd: bool) -> None:
        self.file, self.start, self.odd = file, start, odd
        self.held: list[str] = []       # lines of the record that isn't ended
        self.ours = not odd             # whether that record began in this block
        self.records = 0

    def cut(self, lines: list[str], quotes: np.ndarray) -> tuple[list[str], list[tuple]]:
        """(records begun and ended in this block, the fragment that ends here)."""
        inside = (np.cumsum(quotes) + self.odd) % 2 == 1
        whole, pieces, at = [], [], 0
        for end in (np.flatnonzero(~inside) + 1).tolist():
            if end - at == 1 and not self.held:
                record = lines[at]
            else:
                record = "\n".join([*self.held, *lines[at:end]])
                self.held = []
            if self.ours:
                whole.append(record)
            else:
                pieces.append((self.file, self.start, 0, False, False, False, record))
                self.ours = True
            at = end
        self.held += lines[at:]
        self.odd = bool(inside[-1]) if len(inside) else self.odd
        return whole, pieces

    def rest(self) -> list[tuple]:
        """What is left when the block ends: a record that goes on after it."""
        if not self.held:
            return []
        begins = self.ours
        return [(self.file, self.start, 1 if begins else 0, False, begins, begins and self.start == 0 and not self.records,
                 "\n".join(self.held))]


def _pieces(lines: DataFrame, odd: DataFrame, quote: str) -> DataFrame:
    """Whole records and fragments of every block, as ``_PIECE`` rows."""
    # One row a block at most; a broadcast join keeps the order of the lines.
    marked = lines.join(F.broadcast(odd.withColumn("odd", F.lit(True))), ["file", "start"], "left") \
        .select("file", "start", F.coalesce("odd", F.lit(False)).alias("odd"), "value")
    ship_package(lines.sparkSession)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                                          names=_FIELDS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            counts = pc.count_substring(batch.column(3), quote).to_numpy(zero_copy_only=False)
            codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                key = (files[a].as_py(), int(starts[a]))
                out = []
                if block is None or (block.file, block.start) != key:
                    out += block.rest() if block else []
                    block = _Block(*key, batch.column(2)[a].as_py())
                whole, pieces = block.cut(batch.column(3).slice(a, b - a).to_pylist(), counts[a:b])
                out += pieces
                for r in whole:
                    out.append((*key, 0, True, True, block.start == 0 and not block.records, r))
                    block.records += 1
                if out:
                    yield rows(out)
        if block and (left := block.rest()):
            yield rows(left)

    return marked.mapInArrow(run, _PIECE)


def joined_fragments(pieces: DataFrame) -> DataFrame:
    """(file, first, record) of the records that lie in more than one block."""
    order = Window.partitionBy("file").orderBy("start", "seq")
    begun = pieces.where(~F.col("whole")).withColumn("number", F.sum(F.col("opens").cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "seq", "record")))
    return begun.groupBy("file", "number").agg(F.max("first").alias("first"), parts.alias("parts")) \
        .select("file", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def csv_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, first, record): every record of the files, the header (``first``)
    included, without its line end. Blank lines between records aren't records; a
    file that ends inside quotes gives what is left as its last record."""
    lines = _lines(spark, path)
    pieces = _pieces(lines, odd_blocks(lines, quote), quote)
    whole = pieces.where("whole").select("file", "first", "record")
    records = whole.unionByName(joined_fragments(pieces))
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
