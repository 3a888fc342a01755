"""Approximate nearest neighbours by multiprobe p-stable hashing.

Rows with equal vectors are one class, which keeps the ids that a search can need
(the k + 1 smallest); so a vector held by a third of all rows is hashed and
compared once. Every class is entered in each of ``TABLES`` hash tables under M
values floor((a.(v - mean) + b) / w) with Gaussian a (the 2-stable law). M grows
with the logarithm of the classes, for ``PER_BUCKET`` of them in a bucket.

A query visits perturbed buckets in the order of their estimated success: the
chance that a neighbour at distance r lies in the bucket, which for 2-stable
projections is a product of normal probabilities, with mean b.x and variance
r^2 - r^4 / (4 R^2) for a query that projects to x (b = 1 - r^2 / (2 R^2), R the
spread of the vectors: a far neighbour is nearer to the mean than the query).
Visits go on until the chances add up to p with 1 - (1 - p)^TABLES = ``SUCCESS``,
for each of a few distances r: quantiles of the neighbour distances of ``SAMPLE``
classes, measured against all others. So near copies and far neighbours are both
looked for, and the number of visits follows from the data; it isn't capped.

Buckets are cut into blocks of some ``BLOCK`` classes, each of which meets the
bucket's visitors as a unit of work; a task keeps the best k + 1 of each visitor
over its blocks, so what is shuffled are neighbours and not candidates. Distances
are those of the original vectors in double precision: a product of matrices
finds what can be among the best, with a margin for its rounding, and the
differences themselves give the distance. Visitors that found fewer than k rows
are searched again against all classes in blocks, the exact way, which is also
what measures the sample.

Defined results. Vectors that are null, empty, zero, or have null or non-finite
entries, and those of another length than most have, take no part. Rows without
an id are candidates, last among ties, but no queries. A repeated row is a
candidate for its copies. With k candidates or fewer all are returned; an empty
table, or one without queries, has no rows. Other columns aren't read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfit.llm.common import check_bound, ship
from sparkfit.llm.vectors import common_length, finite_vectors, matrix, summed
from sparkfit.session import drop_table, write_table

TABLES = 4
SUCCESS = 0.96
SAMPLE = 256                # classes whose neighbours are measured to fit the radii
RADII = (0.05, 0.5, 0.9)    # quantiles of the sample's neighbour distances
PER_BUCKET = 512
WIDTH = 1.5                 # of a hash cell, in spreads of the projected vectors
BITS = 1.46                 # entropy of a normal value in cells of that width
BLOCK = 1024
MAX_DIM = 8192
SEED = 20_011
_VISITORS = 256             # compared with a block at once
_HELD = 200_000             # found rows that a task holds before it reduces them

_GRID = np.linspace(-9, 9, 36_001)
_PHI = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in _GRID])


@dataclass(frozen=True)
class Tables:
    """What the hash functions and the order of visits depend on."""
    d: int
    m: int
    mean: np.ndarray
    width: float
    spread: float
    radii: tuple[float, ...]

    def functions(self, table: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng((SEED, table))
        return rng.standard_normal((self.d, self.m)), rng.uniform(0, self.width, self.m)

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        """One 64-bit name for each row of cell numbers."""
        odd = np.random.default_rng(SEED).integers(1, 2 ** 62, self.m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        mixed = (cells.astype(np.int64).view(np.uint64) * odd).sum(axis=1, dtype=np.uint64)
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)

    def entries(self, vectors: np.ndarray):
        """(table, bucket of each vector) for every table."""
        off = vectors - self.mean
        for t in range(TABLES):
            a, b = self.functions(t)
            yield t, self.bucket(np.floor((off @ a + b) / self.width))

    def visits(self, vectors: np.ndarray):
        """(table, row of the visitor, bucket), the likeliest buckets first."""
        off = vectors - self.mean
        enough = 1 - (1 - SUCCESS) ** (1 / TABLES)
        for t in range(TABLES):
            a, b = self.functions(t)
            for row, x in enumerate(off @ a):
                cells = [best_cells(*self.moments(x, r), b, self.width, enough) for r in self.radii]
                yield t, row, np.unique(self.bucket(np.concatenate(cells)))

    def moments(self, x: np.ndarray, r: float) -> tuple[np.ndarray, float]:
        """Mean and deviation of a neighbour's projections at distance r."""
        share = min(r / self.spread, math.sqrt(2)) if self.spread else 0.0
        left = share * share - share ** 4 / 4
        return x * (1 - share * share / 2), max(math.sqrt(max(left, 0.0)), 1e-3) * (self.spread or 1.0)


def normal_cdf(z: np.ndarray) -> np.ndarray:
    return np.interp(z, _GRID, _PHI)


def best_cells(mean: np.ndarray, deviation: float, offset: np.ndarray, width: float, enough: float) -> np.ndarray:
    """The cells that a normal point with these means falls into, likeliest
    first, until their chances add up to ``enough``."""
    reach = int(math.ceil(6 * deviation / width)) + 1
    steps = np.arange(-reach, reach + 1)
    home = np.floor((mean + offset) / width)
    cells = home[:, None] + steps
    edge = (cells * width - (offset + mean)[:, None]) / deviation
    chance = normal_cdf(edge + width / deviation) - normal_cdf(edge)
    order = np.argsort(-chance, axis=1, kind="stable")
    cells, chance = np.take_along_axis(cells, order, 1), np.take_along_axis(chance, order, 1)
    ahead = np.append(np.cumprod(chance[::-1, 0])[::-1], 1.0)    # best that the remaining values can give
    least = ahead[0] / 3
    while True:
        p, found = np.ones(1), np.zeros((1, 0))
        for i in range(len(mean)):
            joint = p[:, None] * chance[i]
            at, cell = np.nonzero(joint * ahead[i + 1] >= least)
            p, found = joint[at, cell], np.column_stack([found[at], cells[i][cell]])
        if p.sum() >= enough or least < 1e-15:
            break
        least /= 3
    order = np.argsort(-p, kind="stable")
    most = int(np.searchsorted(np.cumsum(p[order]), enough)) + 1
    return found[order[:most]]


def _best(who: np.ndarray, cid: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each visitor; equal finds count once."""
    order = np.lexsort((cid, dist, who))
    who, cid, dist = who[order], cid[order], dist[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (cid[1:] != cid[:-1]) | (dist[1:] != dist[:-1])
    who, cid, dist = who[new], cid[new], dist[new]
    first = np.searchsorted(who, who)
    keep = np.arange(len(who)) - first < k
    return who[keep], cid[keep], dist[keep]


def near_in_block(queries: np.ndarray, base: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, base row, distance) of what can be among each query's k nearest."""
    norms = (base * base).sum(axis=1)
    square = (queries * queries).sum(axis=1)[:, None] + norms - 2 * (queries @ base.T)
    if len(base) > k:
        margin = 1e-10 * ((queries * queries).sum(axis=1) + norms.max())
        bound = np.partition(square, k - 1, axis=1)[:, k - 1] + margin
        q, b = np.nonzero(square <= bound[:, None])
    else:
        q, b = np.nonzero(np.ones(square.shape, bool))
    dist = np.empty(len(q))
    for at in range(0, len(q), 65_536):
        part = slice(at, at + 65_536)
        diff = queries[q[part]] - base[b[part]]
        dist[part] = np.sqrt((diff * diff).sum(axis=1))
    return q, b, dist


_KEY = "tab int, bucket bigint, salt int"
_FOUND = "qid bigint, cid bigint, dist double"


def _search(base: DataFrame, visitors: DataFrame, d: int, k: int) -> DataFrame:
    """(qid, cid, dist): the k nearest classes of each visitor in the blocks it
    goes to, reduced within tasks; base (tab, bucket, salt, id, vec) and visitors
    (the same) meet block by block."""
    ship(base.sparkSession)
    both = base.withColumn("visits", F.lit(False)).unionByName(visitors.withColumn("visits", F.lit(True)))
    dealt = both.repartition("tab", "bucket", "salt").sortWithinPartitions("tab", "bucket", "salt", "visits")

    def run(batches):
        block, rows, ids = None, [], []
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0
        for batch in batches:
            key = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            visits = batch.column(5).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1) | (visits[1:] != visits[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if tuple(key[a]) != block:
                    block, rows, ids = tuple(key[a]), [], []
                who = batch.column(3).slice(a, b - a).to_numpy(zero_copy_only=False)
                vecs = matrix(batch.column(4).slice(a, b - a), d).astype(float)
                if not visits[a]:
                    rows.append(vecs)
                    ids.append(who)
                    continue
                if not rows:
                    continue
                if len(rows) > 1:
                    rows, ids = [np.concatenate(rows)], [np.concatenate(ids)]
                for at in range(0, len(who), _VISITORS):
                    q, c, dist = near_in_block(vecs[at:at + _VISITORS], rows[0], k)
                    held.append(_best(who[at:at + _VISITORS][q], ids[0][c], dist, k))
                    n_held += len(held[-1][0])
                if n_held > _HELD:
                    held = [_best(*(np.concatenate(x) for x in zip(*held, strict=True)), k)]
                    n_held = len(held[0][0])
                    if n_held > _HELD // 2:
                        yield _rows(held[0])
                        held, n_held = [], 0
        if held:
            yield _rows(_best(*(np.concatenate(x) for x in zip(*held, strict=True)), k))

    def _rows(found):
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(found[2])],
                                          names=["qid", "cid", "dist"])

    return dealt.mapInArrow(run, _FOUND)


def _exact(classes: DataFrame, n: int, queries: DataFrame, d: int, k: int) -> DataFrame:
    """(qid, cid, dist) against all classes: every block of queries meets every
    block of classes."""
    salts = -(-n // BLOCK)
    groups = -(-queries.count() // BLOCK)
    base = classes.select(F.lit(-1).alias("tab"),
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("bucket"),
                          F.pmod(F.xxhash64("cid"), F.lit(salts)).cast("int").alias("salt"), F.col("cid").alias("id"), "vec")
    visitors = queries.select(F.lit(-1).alias("tab"), F.pmod(F.xxhash64("cid"), F.lit(groups)).alias("bucket"),
                              F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.col("cid").alias("id"), "vec")
    return _search(base, visitors, d, k)


def _nearest_found(found: DataFrame, k: int) -> DataFrame:
    """The k nearest classes of each query, over all tasks' finds."""
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "cid"))
    return found.distinct().withColumn("place", rank).where(F.col("place") <= k).drop("place")


def _fit(classes: DataFrame, n: int, d: int, k: int) -> Tables:
    """Mean and spread over all classes, radii from a sample's exact neighbours."""
    def add_sums(batches):
        total = None
        for batch in batches:
            v = matrix(batch.column(0), d).astype(float)
            got = v.sum(axis=0, keepdims=True)
            total = got if total is None else total + got
        return total

    mean = summed(classes.select("vec"), add_sums)[0] / n

    def add_squares(batches):
        total = None
        for batch in batches:
            off = matrix(batch.column(0), d).astype(float) - mean
            got = np.array([[(off * off).sum()]])
            total = got if total is None else total + got
        return total

    spread = math.sqrt(float(summed(classes.select("vec"), add_squares)[0, 0]) / n)
    sample = write_table(classes.select("cid", "vec").orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE), "knn-sample")
    near = _nearest_found(_exact(classes, n, sample, d, k + 1), k + 1).where("qid <> cid")
    # One distance a row of a bounded sample: SAMPLE * k of them.
    dists = [r[0] for r in near.select("dist").collect()]
    drop_table(sample)
    radii = tuple(float(q) for q in np.quantile(dists, RADII)) if dists else (0.0,)
    m = max(2, round(math.log2(max(n / PER_BUCKET, 1)) / BITS))
    return Tables(d, m, mean, WIDTH * (spread or 1.0), spread, radii)


def _entries(classes: DataFrame, tables: Tables, with_vec: bool) -> DataFrame:
    """(tab, bucket, id, vec) of every class in every table."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = matrix(batch.column(1), tables.d).astype(float)
            for t, names in tables.entries(vecs):
                cols = [pa.array(np.full(len(names), t, np.int32)), pa.array(names)]
                cols += [batch.column(0), batch.column(1)] if with_vec else []
                yield pa.RecordBatch.from_arrays(cols, names=["tab", "bucket", "id", "vec"][:len(cols)])

    kind = classes.schema["vec"].dataType.simpleString()
    return classes.select("cid", "vec").mapInArrow(
        run, "tab int, bucket bigint" + (f", id bigint, vec {kind}" if with_vec else ""))


def _visits(queries: DataFrame, tables: Tables) -> DataFrame:
    """(tab, bucket, id, vec): every bucket that a query visits."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = matrix(batch.column(1), tables.d).astype(float)
            for t, row, names in tables.visits(vecs):
                at = pa.array(np.full(len(names), row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), t, np.int32)), pa.array(names),
                     batch.column(0).take(at), batch.column(1).take(at)], names=["tab", "bucket", "id", "vec"])

    kind = queries.schema["vec"].dataType.simpleString()
    return queries.select("cid", "vec").mapInArrow(run, f"tab int, bucket bigint, id bigint, vec {kind}")


def nearest(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that
    ``is_query`` (a condition on the column ``id``), nearest first, ties to the
    smaller id; the score is the Euclidean distance of the original vectors."""
    spark = df.sparkSession
    ship(spark)
    rows = finite_vectors(df, id_col, vec_col, keep_type=True).where(F.exists("vec", lambda v: v != 0))
    id_kind = dict(rows.dtypes)["id"]
    empty = f"query_id {id_kind}, rank int, vec_id {id_kind}, score double"
    d = common_length(rows)
    check_bound("entries of a vector", d, MAX_DIM)
    rows = rows.where(F.size("vec") == d)
    if not d:
        return spark.createDataFrame([], empty)

    place = F.row_number().over(Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last()))
    classes = rows.withColumn("place", place).where(F.col("place") <= k + 1) \
        .groupBy("vec").agg(F.collect_list(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))).alias("ids"))
    classes = write_table(classes.select(F.monotonically_increasing_id().alias("cid"), "vec", "ids"), "knn-classes")
    asking = rows.where(is_query & F.col("id").isNotNull()).withColumnRenamed("id", "query_id")
    asking = write_table(asking.join(classes.select("vec", "cid"), "vec").select("query_id", F.col("cid").alias("qid")),
                         "knn-asking")
    visiting = write_table(classes.join(asking.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi")
                           .select("cid", "vec"), "knn-visiting")
    n = classes.count()
    tables = _fit(classes, n, d, k)

    counts = _entries(classes, tables, with_vec=False).groupBy("tab", "bucket").agg(F.count("*").alias("n"))
    large = write_table(counts.where(F.col("n") > BLOCK)
                        .select("tab", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "knn-large")
    blocks = F.coalesce("blocks", F.lit(1))
    base = _entries(classes, tables, with_vec=True).join(large, ["tab", "bucket"], "left") \
        .select("tab", "bucket", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("salt"), "id", "vec")
    visits = _visits(visiting.repartition("cid"), tables).join(large, ["tab", "bucket"], "left") \
        .select("tab", "bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("salt"), "id", "vec")
    own = visiting.select(F.col("cid").alias("qid"), "cid", F.lit(0.0).alias("dist"))
    found = write_table(_nearest_found(_search(base, visits, d, k + 1).unionAll(own), k + 1), "knn-found")

    total = rows.count()
    sizes = classes.select("cid", F.size("ids").alias("held"))
    met = found.join(sizes, "cid").groupBy("qid").agg(F.sum("held").alias("held"))
    # A class that holds k + 1 ids may have more rows, and then there are enough.
    short = write_table(visiting.join(met.where(F.col("held") < min(k + 1, total)).select(F.col("qid").alias("cid")), "cid",
                                      "left_semi"), "knn-short")
    if not short.isEmpty():
        again = _nearest_found(_exact(classes, n, short, d, k + 1), k + 1)
        found = found.join(short.select(F.col("cid").alias("qid")), "qid", "left_anti").unionByName(again)

    near = found.join(classes.select("cid", "ids"), "cid") \
        .select("qid", "dist", F.inline("ids")).withColumnRenamed("id", "vec_id")
    best = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "none", "vec_id"))
    lists = near.withColumn("place", best).where(F.col("place") <= k + 1) \
        .groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "dist", "vec_id"))).alias("near"))
    # The query's own row is the first of its class with its id, if it is among them.
    mine = F.array_position(F.transform("near", lambda e: (e["dist"] == 0) & e["vec_id"].eqNullSafe(F.col("query_id"))), True)
    others = F.when(mine > 0, F.concat(F.slice("near", 1, mine - 1), F.slice("near", mine + 1, k + 1))) \
        .otherwise(F.slice("near", 1, k))
    out = asking.join(lists, "qid").select("query_id", F.posexplode(others).alias("rank", "e"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"),
                      F.col("e.dist").alias("score"))
