"""Keyed combiners given by the user, and per-key lists in parts.

``combine_by_key`` takes the three functions of a keyed combiner (create, merge
a value, merge two combiners). Tasks combine their own rows first, holding at
most ``held`` combiners and sending them on when there are more; what is shuffled
are combiners, dealt by (key, salt) so that a hot key's meet in several tasks,
then by key. Each of these merges reads its rows in key order from Spark's sort,
which spills, and holds one combiner at a time.

A combiner that grows with its key's rows (a list, a set) must not hold all of a
hot key: with ``size`` and ``limit`` one that has reached the limit is finished.
Finished combiners aren't merged any more and are dealt over all tasks by a number
of their own, so a key's result is several rows of bounded size and no task gets
them all. The functions must be free of order, as for any combiner that runs in
parallel; rows are sorted in full, so that a task that is run again gives what it gave.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from sparkfit.operators.keys import row_positions
from sparkfit.session import ship_package

_BATCH = 4096

Create = Callable[[Any], Any]
Merge = Callable[[Any, Any], Any]


class _Rows:
    """Collects rows into Arrow batches, by count and by bytes."""

    def __init__(self, schema: pa.Schema, most_bytes: int = 8 << 20) -> None:
        self.schema, self.most, self.rows, self.held = schema, most_bytes, [], 0

    def add(self, row: tuple, weight: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += weight
        if len(self.rows) >= _BATCH or self.held >= self.most:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        cols = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.schema]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, self.schema, strict=True)],
                                         schema=self.schema)
        self.rows, self.held = [], 0
        return out


class _Finished:
    """Numbers for finished combiners: no two of a job are the same, and none is
    below ``salts``, the numbers of those still to be merged."""

    def __init__(self, salts: int, level: int) -> None:
        self.salts, self.level, self.task, self.count = salts, level, TaskContext.get().partitionId(), 0

    def next(self) -> int:
        self.count += 1
        return self.salts + ((((self.task << 30) + self.count) << 2) | self.level)


def _partials(create: Create, merge_value: Merge, held: int, salts: int, size, limit, out: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt, finished = TaskContext.get().partitionId() % salts, _Finished(salts, 0)
        own: dict = {}
        rows = _Rows(out)

        def send(key, part, combiner):
            data = pickle.dumps(combiner)
            return rows.add((key, part, data), len(data))

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key in own:
                    own[key] = merge_value(own[key], value)
                else:
                    own[key] = create(value)
                if size and size(own[key]) >= limit:
                    yield from send(key, finished.next(), own.pop(key))
            if len(own) > held:
                for key, combiner in own.items():
                    yield from send(key, salt, combiner)
                own = {}
        for key, combiner in own.items():
            yield from send(key, salt, combiner)
        yield rows.batch()
    return run


def _merges(merge_combiners: Merge, salts: int, out: pa.Schema, size, limit, level: int, last: bool):
    """Merge the unfinished combiners of sorted (key, dealt, part, data) rows with
    equal key and ``dealt``; the last merge gives combiners, not their data."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, finished = _Rows(out), _Finished(salts, level)
        now, own = None, None

        def send(key, part, combiner, data=None):
            data = data or pickle.dumps(combiner)
            return rows.add((key, part, combiner if last else data), len(data))

        for batch in batches:
            for key, dealt, part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part >= salts:
                    yield from send(key, part, pickle.loads(data) if last else None, data)
                    continue
                if own is not None and now != (key, dealt):
                    yield from send(*now, own)
                    own = None
                now = (key, dealt)
                own = pickle.loads(data) if own is None else merge_combiners(own, pickle.loads(data))
                if size and size(own) >= limit:
                    yield from send(key, finished.next(), own)
                    own = None
        if own is not None:
            yield from send(*now, own)
        yield rows.batch()
    return run


def combine_by_key(df: DataFrame, key: str, value: str, create: Create, merge_value: Merge, merge_combiners: Merge,
                   combiner_type: str, held: int = 50_000, salts: int = 16,
                   size: Callable[[Any], int] | None = None, limit: int | None = None) -> DataFrame:
    """(key, part, combiner): the rows of each key combined by the three functions.

    ``combiner_type`` is the Spark type of a combiner (a DDL string). ``part`` is
    0; with ``size`` and ``limit`` a key also has rows of combiners that have
    reached the limit, whose parts are other numbers, all different. Null keys are a key of their own; a
    null value is given to the functions as None, and a combiner is never None.
    """
    if (size is None) != (limit is None):
        raise ValueError("size and limit go together")
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType
    if kind.typeName() in ("array", "map", "struct", "variant"):
        raise ValueError("the key must be of a plain type")
    mid = StructType([StructField("key", kind), *_parse_datatype_string("part bigint, data binary").fields])
    out = StructType([StructField("key", kind), *_parse_datatype_string(f"part bigint, combiner {combiner_type}").fields])
    rows = df.select(F.col(key).alias("key"), F.col(value).alias("value"))
    partial = rows.mapInArrow(_partials(create, merge_value, held, salts, size, limit, to_arrow_schema(mid)), mid)

    def merged(parts: DataFrame, dealt: Column, schema: StructType, level: int, last: bool) -> DataFrame:
        return parts.select("key", dealt.alias("dealt"), "part", "data").repartition("key", "dealt") \
            .sortWithinPartitions("key", "dealt", "part", "data") \
            .mapInArrow(_merges(merge_combiners, salts, to_arrow_schema(schema), size, limit, level, last), schema)

    salted = merged(partial, F.col("part"), mid, 1, False)
    return merged(salted, F.when(F.col("part") < salts, F.lit(0)).otherwise(F.col("part")), out, 2, True)


def lists_by_key(df: DataFrame, key: str, value: str, part_rows: int = 10_000) -> DataFrame:
    """(key, part, n, values): each key's values, null ones too, rising, as lists
    of ``part_rows`` values, the last one shorter.

    Part p holds the values at places p * part_rows and on, so the parts of a key
    one after the other are its whole list. Values get their places by ranges of
    (key, value), and a list is gathered by (key, part): a hot key is as many
    lists, in as many tasks, as its rows need."""
    rows = df.select(F.col(key).alias("key"), F.col(value).alias("value"), F.monotonically_increasing_id().alias("row_no"))
    placed = row_positions(rows, [F.col("key").asc_nulls_first(), F.col("value").asc_nulls_last()], "at")
    firsts = placed.groupBy("key").agg(F.min("at").alias("first")).withColumnRenamed("key", "own")
    place = F.col("at") - F.col("first")
    parts = placed.join(firsts, F.col("key").eqNullSafe(F.col("own"))) \
        .select("key", F.floor(place / part_rows).cast("int").alias("part"), "at", "value")
    lists = parts.groupBy("key", "part").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("v"))
    return lists.select("key", "part", F.size("v").alias("n"), F.transform("v", lambda e: e["value"]).alias("values"))


