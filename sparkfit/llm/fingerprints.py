"""Document fingerprints by consistent weighted sampling.

A document is a set of terms (lower-cased words) with weights (how often they
occur). For each of ``SAMPLES`` samples every term has its own gamma-distributed
r and c and uniform b, all from hashes of the term; a term of weight s gets

    t = floor(ln s / r + b),   ln a = ln c - r (t - b + 1)

and the sample is the term of the smallest a, with its t. Two documents agree
in a sample with a probability equal to the generalised Jaccard similarity of
their weights (sum of the smaller over sum of the larger weights), so the part
of the samples that agree estimates it. The gamma quantiles are looked up in
tables of 65,536 steps; everything else is array arithmetic over the document's
terms.

``edited_fingerprints`` also fingerprints an edit of each document that takes
in the start of the next one in id order. Documents are dealt into parts by
ranges of (id, text hash), each part also gets the first row of the part behind it, and a
task streams over a part in order, so no text is looked up by a join.

Results for special inputs: a null text is an empty one; a text without words
has the empty fingerprint, which is like another empty one only; null ids come
first; rows with equal ids are ordered by a hash of the text, and repeated rows
are next to each other; the document after the last is the first, also where it
is the only one; an empty table gives an empty result; other columns are
ignored, whatever their names; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkfit.llm.common import check_bound, ship, slices_by_bytes
from sparkfit.llm.words import mix, word_hashes

SAMPLES = 64
STEPS = 1 << 16
PARTS_PER_PARTITION = 4
MAX_PARTS = 1_000_000
SLICE_BYTES = 1 << 20
COLUMNS = 4096              # terms sampled at a time

_multiply = np.random.default_rng(20240315).integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables: list[np.ndarray] = []


def _quantiles() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma distribution of shape 2 in the middle of each
    step, and their logarithms (by bisection of 1 - (1 + x) exp(-x))."""
    if not _tables:
        u = (np.arange(STEPS) + 0.5) / STEPS
        low, high = np.zeros(STEPS), np.full(STEPS, 64.0)
        for _ in range(60):
            x = (low + high) / 2
            below = 1 - (1 + x) * np.exp(-x) < u
            low, high = np.where(below, x, low), np.where(below, high, x)
        _tables.extend([high.astype(np.float32), np.log(high).astype(np.float32)])
    return _tables[0], _tables[1]


def samples(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """16-bit samples of a document's distinct terms (64-bit hashes, ascending)
    and their weights; none without terms."""
    if not len(terms):
        return np.empty(0, dtype=np.uint16)
    gamma, log_gamma = _quantiles()
    best = np.full(SAMPLES, np.inf, dtype=np.float32)
    found = np.zeros(SAMPLES, dtype=np.uint64)
    rows = np.arange(SAMPLES)
    for a in range(0, len(terms), COLUMNS):
        x = terms[None, a:a + COLUMNS] * _multiply[:, None]
        x ^= x >> np.uint64(29)
        r = gamma[(x >> np.uint64(48)).astype(np.intp)]
        ln_a = log_gamma[(x >> np.uint64(32)).astype(np.intp) & (STEPS - 1)]
        b = ((x >> np.uint64(16)) & np.uint64(STEPS - 1)).astype(np.float32) * np.float32(1 / STEPS)
        t = np.floor(np.log(weights[a:a + COLUMNS].astype(np.float32))[None, :] / r + b)
        ln_a -= r * (t - b + np.float32(1))
        at = ln_a.argmin(axis=1)
        low = ln_a[rows, at]
        code = x[rows, at] + t[rows, at].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        better = low < best
        best[better], found[better] = low[better], code[better]
    return (mix(found) >> np.uint64(48)).astype(np.uint16)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    h, first = word_hashes([t.encode() for t in texts])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append(samples(*np.unique(h[a:b], return_counts=True)))
    return out


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Part of the samples that agree."""
    if len(one) != len(other):
        return 0.0
    return float((one == other).mean()) if len(one) else 1.0


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    ship(docs.sparkSession)
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t", SLICE_BYTES):
                found = fingerprints([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(as_text, found)), type=pa.string())],
                                                 names=["i", "fingerprint"])

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")) \
        .mapInArrow(run, f"i {id_type}, fingerprint string").withColumnRenamed("i", id_col)


class Bounds:
    """First (id, text hash) of each part, in order; null ids come first."""

    def __init__(self, rows: Iterable[tuple], id_type: pa.DataType):
        rows = set(rows)
        self.of_nulls = np.array(sorted(h for i, h in rows if i is None), dtype=np.int64)
        rest = sorted((i, h) for i, h in rows if i is not None)
        self.ids = pa.array([i for i, _ in rest], type=id_type)
        self.hashes = np.array([h for _, h in rest], dtype=np.int64)
        self.parts = max(1, len(rows))

    def place(self, ids: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(part, is the part's first row) of each row."""
        null = ids.is_null().to_numpy(zero_copy_only=False)
        at = np.empty(len(ids), dtype=np.int64)
        edge = np.zeros(len(ids), dtype=bool)
        at[null] = np.searchsorted(self.of_nulls, hashes[null], side="right") - 1
        edge[null] = self.of_nulls[at[null]] == hashes[null]
        rows = np.flatnonzero(~null)
        if len(rows):
            starts = self.ids.to_numpy(zero_copy_only=False)
            values = ids.filter(pa.array(~null)).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(starts, values, side="left"), np.searchsorted(starts, values, side="right")
            own = high - 1                          # the last part that begins before the id or with it
            for first in np.unique(low[low < high]).tolist():
                among = np.flatnonzero((low == first) & (low < high))
                end = int(high[among[0]])
                own[among] = first - 1 + np.searchsorted(self.hashes[first:end], hashes[rows[among]], side="right")
                edge[rows[among]] = (own[among] >= first) & (self.hashes[own[among]] == hashes[rows[among]])
            at[rows] = own + len(self.of_nulls)
        return at, edge


def in_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(i, t, part, ahead): rows sorted by id and a hash of the text within
    parts that follow each other in that order, so that one id over many rows is
    split too. Each part ends with the first rows of the next one (``ahead``);
    the last part ends with the first rows of all."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.xxhash64(F.col(text_col)).alias("h"))
    order = F.col("i").asc_nulls_first(), F.col("h")
    ranges = rows.select("i", "h").repartitionByRange(PARTS_PER_PARTITION * n, *order) \
        .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("i", "h")).alias("least"))
    found = ranges.limit(MAX_PARTS + 1).collect()
    check_bound("parts", len(found), MAX_PARTS)
    bounds = Bounds(((r["least"]["i"], r["least"]["h"]) for r in found), to_arrow_type(rows.schema["i"].dataType))
    shared = spark.sparkContext.broadcast(bounds)

    @F.arrow_udf("part int, edge boolean")
    def place(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        at, edge = shared.value.place(ids, hashes.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(edge)], names=["part", "edge"])

    placed = rows.withColumn("at", place("i", "h"))
    own = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("ahead"))
    ahead = F.struct(F.pmod(F.col("at.part") - 1, F.lit(bounds.parts)).alias("part"), F.lit(True).alias("ahead"))
    return placed.select("i", "t", "h", F.explode(F.when(F.col("at.edge"), F.array(own, ahead)).otherwise(F.array(own)))
                         .alias("at")) \
        .select("i", "t", "h", "at.part", "at.ahead").repartition(n, "part") \
        .sortWithinPartitions("part", "ahead", *order).select("i", "t", "part", "ahead")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row: its text, the text edited with the next row's, and
    how alike its fingerprint is to the edited text's and the next row's."""
    ship(docs.sparkSession)
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    names = ["i", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(pairs: list[tuple], id_arrow: pa.DataType) -> pa.RecordBatch:
        """Rows of ((id, text, fingerprint), (id, text, fingerprint) of the next)."""
        edits = [edited(own[1], after[1]) for own, after in pairs]
        prints = fingerprints(edits)
        return pa.RecordBatch.from_arrays([
            pa.array([own[0] for own, _ in pairs], type=id_arrow),
            pa.array([len(own[1]) for own, _ in pairs], type=pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], type=pa.string()),
            pa.array([as_text(own[2]) for own, _ in pairs], type=pa.string()),
            pa.array([as_text(p) for p in prints], type=pa.string()),
            pa.array([likeness(own[2], p) for (own, _), p in zip(pairs, prints, strict=True)], type=pa.float64()),
            pa.array([likeness(own[2], after[2]) for own, after in pairs], type=pa.float64())], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting = -1, None
        for batch in batches:
            for piece in slices_by_bytes(batch, "t", SLICE_BYTES):
                ids, texts, numbers, aheads = (c.to_pylist() for c in piece.columns)
                texts = [t or "" for t in texts]
                prints = fingerprints(texts)
                pairs = []
                for i, text, number, ahead, found in zip(ids, texts, numbers, aheads, prints, strict=True):
                    if number != part:
                        part, waiting = number, None
                    row = (i, text, found)
                    if waiting is not None:
                        pairs.append((waiting, row))
                    waiting = None if ahead else row
                if pairs:
                    yield compared(pairs, piece.schema.field(0).type)

    return in_parts(docs, id_col, text_col).mapInArrow(
        run, f"i {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double").withColumnRenamed("i", id_col)
