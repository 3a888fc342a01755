"""MinHash near-deduplication with sequential Bayesian verification.

Documents are linked when the Jaccard similarity of their sets of word shingles
is at least a threshold; groups are the connected components.

1. One pass over the texts gives each row its set's size, a 128-bit key of the
   set, a MinHash signature and band keys. Rows with the same set are one class
   from here on, so copies cost one row each and no pair.
2. Classes that share a band key are a bucket; buckets of the same members are
   one. In a bucket, signatures are compared in batches: after each batch a
   pair goes on only if the posterior probability that its similarity reaches
   the threshold is above ``MISS``. Buckets are compared in blocks of bounded
   size, inside tasks; what comes out is not pairs but which members hang
   together, a row per member.
3. Members that hang together over all buckets form a cluster. Their full
   shingle sets are computed again from the texts and every pair that passes
   the same sequential test is verified exactly, in blocks of bounded bytes;
   pairs that are already in one component of the block are skipped. Out comes
   a row per member again.

A pair at the threshold is missed with a probability below (1 - t^rows)^bands
for the bands (6e-7 here) plus ``MISS`` for each batch. Similar pairs only cost
comparisons: a bucket is compared in blocks that Spark deals over the cluster, and
in a block only members that don't hang together yet are compared, so that g texts
that are all alike cost g signature comparisons a block and not g^2/2.

Results for special inputs: a text without words (or null) has an empty set, is
linked with nothing and stays; with fewer words than a shingle has, the whole
sequence is the one shingle; the group's id is its smallest id (null ids never
name a group that has another); repeated rows are in the same group; an empty
table gives an empty result; other columns are ignored, whatever their names;
texts of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.common import runs_by_key, ship, single_rows, slices_by_bytes, without_rows
from sparkfit.llm.components import connected_components
from sparkfit.llm.words import shingle_sets
from sparkfit.session import drop_table, write_table

SHINGLE = 5
PERCENT = 80                # least 100 * intersection / union of a link
BANDS, ROWS = 36, 5
HASHES = BANDS * ROWS
BATCH = 36                  # signature positions compared at a time
MISS = 1e-6                 # posterior below which a pair is given up
BLOCK_ROWS = 1024           # signatures of a block
BLOCK_BYTES = 2 << 20       # shingle hashes of a block
COLUMNS = 4096              # shingles hashed at a time

_seed = np.random.default_rng(20240229)
_MULTIPLY = (_seed.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) + np.uint32(1)
_ADD = _seed.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), COLUMNS):
        low = np.minimum(low, (x[None, a:a + COLUMNS] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1))
    return low


def least_matches(threshold: float, n: int, miss: float) -> int:
    """Fewest equal positions of ``n`` that leave the similarity a posterior
    probability of ``miss`` to be at least ``threshold`` (uniform prior: the
    posterior is Beta(m + 1, n - m + 1), whose tail is a binomial sum)."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def features(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, text_hash, n, cid, sig) of every row; cid and sig are null for an
    empty set. ``sig`` holds 16 bits of each signature position."""
    ship(docs.sparkSession)
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t", 1 << 20):
                sets = shingle_sets([(t or "").encode() for t in part.column(2).to_pylist()], shingle)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], type=pa.binary()),
                    pa.array([signature(s).astype("<u2").tobytes() if len(s) else None for s in sets],
                             type=pa.binary())], names=["id", "text_hash", "n", "cid", "sig"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {id_type}, text_hash bigint, n bigint, cid binary, sig binary")


class Groups:
    """Components of the numbers 0..n-1, the smallest number naming each."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        names = np.unique(self.of[members])
        self.of[np.isin(self.of, names[1:])] = names[0]

    def apart(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that aren't in the component of ``x``."""
        return others[self.of[others] != self.of[x]]


class Sequential:
    """The sequential test: which pairs of signatures may be similar enough."""

    def __init__(self, threshold: float, miss: float):
        self.steps = [(a, min(a + BATCH, HASHES)) for a in range(0, HASHES, BATCH)]
        self.least = [least_matches(threshold, b, miss) for _, b in self.steps]

    def survivors(self, one: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Rows of ``others`` that stay in question against one signature."""
        at = np.arange(len(others))
        found = np.zeros(len(others), dtype=np.int32)
        for (a, b), least in zip(self.steps, self.least, strict=True):
            found = found + (others[at, a:b] == one[a:b]).sum(axis=1, dtype=np.int32)
            go_on = found >= least
            at, found = at[go_on], found[go_on]
            if not len(at):
                break
        return at


def _blocks(rows: DataFrame, group: str, member: str, n_blocks: Column) -> DataFrame:
    """Rows of each group dealt over ``n_blocks`` blocks by a hash of their
    member, and a row copied to every pair of blocks that holds its own:
    ``work`` numbers the pair, ``side`` is 0 for the first block, 1 for the
    second, 2 if the pair is one block with itself."""
    dealt = rows.withColumn("nb", n_blocks).withColumn("b", F.pmod(F.xxhash64(F.lit(3), member), F.col("nb")))
    pairs = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)))
    low, high = F.least("b", "o"), F.greatest("b", "o")
    return pairs.withColumn("work", F.xxhash64(group, low, high)) \
        .withColumn("side", F.when(F.col("b") == F.col("o"), 2).when(F.col("b") < F.col("o"), 0).otherwise(1)) \
        .drop("nb", "b", "o")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), HASHES)


def _members(cids: list[bytes], groups: Groups) -> pa.RecordBatch | None:
    """(src, dst): each member that hangs together with another, and the first."""
    roots = groups.of
    at = np.flatnonzero(roots != np.arange(len(roots)))
    if not len(at):
        return None
    return pa.RecordBatch.from_arrays([pa.array([cids[i] for i in at], type=pa.binary()),
                                       pa.array([cids[i] for i in roots[at]], type=pa.binary())],
                                      names=["src", "dst"])


def _others(side: np.ndarray, x: int) -> np.ndarray:
    """The rows that row ``x`` of a pair of blocks is compared with."""
    if side[x] == 2:
        return np.arange(x + 1, len(side))
    return np.flatnonzero(side == 1) if side[x] == 0 else np.empty(0, dtype=np.int64)


def _sorted_work(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.col("work")).sortWithinPartitions("work", "side", "cid")


def candidate_edges(classes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """(src, dst): classes that hang together by signatures in some bucket."""
    # A class goes by a 64-bit hash here: should two share one, a bucket only
    # has a member too many. A band key is a hash of the band and its positions.
    own = F.xxhash64("cid").alias("c")
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    rows = classes.select(own, band, "sig").select(
        "c", F.xxhash64("band", F.substring(F.col("sig"), F.col("band") * 2 * ROWS + 1, F.lit(2 * ROWS))).alias("key"))
    # Written, so that Spark can split the join's partitions of a frequent key.
    sizes = write_table(rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "bucket-sizes")
    members = write_table(rows.join(sizes, "key"), "bucket-members")
    drop_table(sizes)
    # One bucket of each membership, told by two hashes of its members.
    single = write_table(
        members.groupBy("key", "m").agg(F.bit_xor("c").alias("x"), F.bit_xor(F.xxhash64("c")).alias("y"))
        .groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key"), "bucket-keys")
    work = _blocks(members.join(single, "key"), "key", "c", F.ceil(F.col("m") / BLOCK_ROWS).cast("bigint"))
    work = _sorted_work(work.join(classes.select(own, "cid", "sig"), "c").select("work", "side", "cid", "sig"))
    test = Sequential(threshold, miss)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_by_key(batches, 0):
            side = group.column(1).to_numpy()
            sigs = _signatures(group.column(3))
            groups = Groups(len(side))
            for x in range(len(side)):
                others = groups.apart(x, _others(side, x))
                alike = others[test.survivors(sigs[x], sigs[others])]
                if len(alike):
                    groups.join(np.append(alike, x))
            out = _members(group.column(2).to_pylist(), groups)
            if out is not None:
                yield out

    return work.mapInArrow(run, "src binary, dst binary").distinct()


def class_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(cid, shingles) from the texts of the ``wanted`` (cid, id, text_hash)."""
    rows = docs.select(F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("t"))
    texts = rows.join(wanted, F.col("i").eqNullSafe(F.col("id")) & (F.col("th") == F.col("text_hash"))) \
        .select("cid", "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "t", 1 << 20):
                sets = shingle_sets([t.encode() for t in part.column(1).to_pylist()], shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in sets], type=pa.binary())], names=["cid", "shingles"])

    return texts.mapInArrow(run, "cid binary, shingles binary").dropDuplicates(["cid"])


def verified_edges(clusters: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, miss: float) -> DataFrame:
    """(src, dst): classes in one component of exactly verified links. The
    ``clusters`` are (cid, cluster)."""
    sizes = write_table(clusters.join(classes.select("cid", "n"), "cid")
                        .groupBy("cluster").agg(F.sum(F.col("n") * 8).alias("bytes"), F.count("*").alias("members")),
                        "cluster-sizes")
    full = sets.join(clusters, "cid").join(classes.select("cid", "sig"), "cid").join(sizes, "cluster")
    # No more blocks than members: a long set is a block, and is copied once for each other one.
    work = _blocks(full, "cluster", "cid", F.least(F.ceil(F.col("bytes") / BLOCK_BYTES).cast("bigint"), F.col("members")))
    work = _sorted_work(work.select("work", "side", "cid", "sig", "shingles"))
    test = Sequential(percent / 100, miss)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_by_key(batches, 0):
            side = group.column(1).to_numpy()
            sigs = _signatures(group.column(3))
            sets = [np.frombuffer(s, dtype="<u8") for s in group.column(4).to_pylist()]
            n = np.array([len(s) for s in sets])
            groups = Groups(len(side))
            for x in range(len(side)):
                others = groups.apart(x, _others(side, x))
                others = others[100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others])]
                others = others[test.survivors(sigs[x], sigs[others])]
                for y in others.tolist():
                    if groups.of[x] == groups.of[y]:
                        continue
                    small, large = (sets[x], sets[y]) if n[x] <= n[y] else (sets[y], sets[x])
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[at] == small).sum())
                    if 100 * both >= percent * int(n[x] + n[y] - both):
                        groups.join(np.array([x, y]))
            out = _members(group.column(2).to_pylist(), groups)
            if out is not None:
                yield out

    return work.mapInArrow(run, "src binary, dst binary").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, kept) of every row."""
    rows = write_table(features(docs, id_col, text_col, shingle), "near-features")
    # A class is given by its smallest row.
    classes = write_table(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min(F.struct("id", "text_hash", "n", "sig")).alias("r")).select("cid", "r.*"), "near-classes")
    hanging = write_table(candidate_edges(classes, percent / 100, miss), "near-candidates")
    clusters = connected_components(hanging).select(F.col("node").alias("cid"), F.col("label").alias("cluster"))
    inside = classes.join(clusters, "cid")
    sets = class_sets(docs, inside.select("cid", "id", "text_hash"), id_col, text_col, shingle)
    links = write_table(verified_edges(clusters, sets, classes, percent, miss), "near-links")
    labels = connected_components(links).select(F.col("node").alias("cid"), "label")

    own = write_table(
        rows.select("id", "text_hash", F.col("n").alias("n_shingles"), "cid").join(labels, "cid", "left")
        .withColumn("label", F.coalesce("label", "cid")).drop("cid"), "near-labels")
    named = write_table(own.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("component_id")),
                        "near-names")
    found = own.join(named, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")))
    out = write_table(found.select(
        F.col("id").alias(id_col), "text_hash", "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept")), "near-groups")
    for t in (hanging, links, own, named, rows, classes):
        drop_table(t)
    return out


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    groups = near_duplicates(docs, id_col, text_col, **options).withColumnRenamed(id_col, "id")
    losers = groups.where("NOT kept").select("id", "text_hash")
    repeats = groups.where("kept").groupBy("id", "text_hash").agg(F.count("*").alias("n")) \
        .where("n > 1").select("id", "text_hash")
    return single_rows(without_rows(docs, losers, id_col, text_col), repeats, id_col, text_col)
