"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Every source's documents are dealt by hash into blocks, and the blocks put in a
seeded random order. A source's target number of words is so many whole passes
over its blocks plus a permuted prefix of one more pass; the block at the end
of the prefix is drawn document by document, the last document in part, so the
words taken meet the target exactly. These block draws are the source's exact
quota. A binary tree over the output shards splits the quotas of all sources
together: a node's left half gets a multivariate-hypergeometric draw of its
blocks, so each shard is a random sample of the mix and no block is drawn
twice. A shard takes its blocks as the next run of each source's permuted
draws, and orders its documents by a seeded hash.

The tree works on sources x shards numbers on the driver (a checked bound);
blocks and documents stay in DataFrames. Every order comes from seeded hashes
of row contents, so reruns agree whatever the partitioning.

Results for special inputs: a null text has size 0; a null source is a source,
last in the order of weights; ids may be null or repeat; rows that agree in id
and text are one place in the order of their block and stand for each other: in
the mix of whole documents each draw of any of them is a row with the other
columns of one of them. Sources of size 0 have target 0; ties of hashes are
broken by id; texts of any length are counted whole and never moved for it; an
empty table gives an empty mix; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfit.llm.common import check_bound, fresh, single_rows
from sparkfit.session import write_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3             # no target above this many times the source's size
BLOCKS = 1024               # of a source, at least
BLOCK_DOCUMENTS = 100_000   # that a block holds about, in larger tables
SHARDS = 16
SEED = 20240501
MAX_SOURCES = 100_000


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST_PASSES) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; a share stops at ``most`` times
    its source's size, and the excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards x sources) block counts: the quotas split over the shards by a
    binary tree of multivariate-hypergeometric draws. Sums over shards are the
    quotas; shard totals differ by one block at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def draw(have: np.ndarray, n: int, path: str) -> np.ndarray:
        digest = hashlib.sha256(f"{seed}:{path}".encode()).digest()
        rng = np.random.default_rng(int.from_bytes(digest[:8], "little"))
        got, rest = np.zeros_like(have), int(have.sum())
        for i, h in enumerate(have.tolist()):       # the marginals, source by source
            if n == 0:
                break
            got[i] = rng.hypergeometric(h, rest - h, n) if 0 < h < rest else min(h, n)
            n, rest = n - int(got[i]), rest - h
        return got

    def node(low: int, high: int, have: np.ndarray, path: str) -> None:
        if high - low == 1:
            out[low] = have
            return
        middle, total = (low + high) // 2, int(have.sum())
        left = draw(have, total * (middle - low) // (high - low), path)
        node(low, middle, left, path + "l")
        node(middle, high, have - left, path + "r")

    if shards:
        node(0, shards, np.asarray(quotas, dtype=np.int64), "")
    return out


@dataclass
class Plan:
    """A source's numbers, in the order of the sources (code points, null last)."""

    source: str | None
    size: int
    target: float
    passes: int         # whole passes over all its blocks
    rest: int           # words of one more pass


def plan_sources(totals: list[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS,
                 most: float = MOST_PASSES) -> list[Plan]:
    ordered = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [n for _, n in ordered]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    out = []
    for (source, size), target in zip(ordered, goal, strict=True):
        words = min(round(target), int(most * size))
        passes, rest = divmod(words, size) if size else (0, 0)
        out.append(Plan(source, size, target, passes, rest))
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, most: float = MOST_PASSES, shards: int = SHARDS,
        blocks: int | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: (id, text_hash, source, size, source_size, target,
    draws), where draws is an array of (shard, pass, words, place): the document
    is put into that shard at that place (a sort key) with its first ``words``
    words. A document that isn't taken has no draws."""
    spark = docs.sparkSession
    blocks = blocks or max(BLOCKS, -(-docs.count() // BLOCK_DOCUMENTS))
    keyed = write_table(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
        .withColumn("h", F.xxhash64(F.lit(seed), "id", "text_hash"))
        .withColumn("block", F.pmod("h", F.lit(blocks)).cast("int")), "mix-keys")

    totals = keyed.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    check_bound("sources", len(totals), MAX_SOURCES)
    plans = plan_sources([(r["source"], int(r["n"])) for r in totals], weights, most)
    schema = "s int, source string, source_size bigint, target double, passes bigint, rest bigint"
    sources = spark.createDataFrame([(i, p.source, p.size, p.target, p.passes, p.rest)
                                     for i, p in enumerate(plans)], schema)
    # One row per source, a checked number of them.
    numbered = keyed.withColumnRenamed("source", "own") \
        .join(F.broadcast(sources), F.col("own").eqNullSafe(F.col("source"))).drop("own")

    # Blocks of a source in their order of the partial pass, with the words before.
    in_order = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed), "s", "block"), "block")
    sums = numbered.groupBy("s", "block", "passes", "rest").agg(F.sum("size").alias("words")) \
        .withColumn("until", F.sum("words").over(in_order)) \
        .withColumn("copies", F.col("passes") + F.when(
            (F.col("until") <= F.col("rest")) & (F.col("rest") > 0), 1).otherwise(0)) \
        .withColumn("part", F.when(
            (F.col("until") > F.col("rest")) & (F.col("until") - F.col("words") < F.col("rest")),
            F.col("rest") - F.col("until") + F.col("words")).otherwise(0))
    # A draw of a block: pass number, and whether only a part of it is taken.
    pass_at = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed + 1), "s", "block", "pass"), "block", "pass")
    draws = sums.where("copies + if(part > 0, 1, 0) > 0") \
        .select("s", "block", "part", "copies", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("copies") + F.when(F.col("part") > 0, 1).otherwise(0) - 1)).alias("pass")) \
        .withColumn("part", F.when(F.col("pass") == F.col("copies"), F.col("part")).otherwise(F.lit(0))) \
        .withColumn("at", F.row_number().over(pass_at) - 1)
    draws = write_table(draws.select("s", "block", "pass", "part", "at"), "mix-draws")

    counted = {r["s"]: int(r["n"]) for r in draws.groupBy("s").agg(F.count("*").alias("n")).collect()}
    quotas = split_quotas([counted.get(i, 0) for i in range(len(plans))], shards, seed)
    ends = np.cumsum(quotas, axis=0)
    runs = [(s, shard, int(ends[shard, s] - quotas[shard, s]), int(ends[shard, s]))
            for shard in range(shards) for s in range(len(plans)) if quotas[shard, s]]
    places = spark.createDataFrame(runs, "s int, shard int, low bigint, high bigint") \
        .select("s", "shard", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("at"))
    dealt = draws.join(places, ["s", "at"])
    by_block = dealt.groupBy("s", "block").agg(
        F.collect_list(F.struct("shard", "pass", "part")).alias("taken"), F.max("part").alias("part"))

    # Documents of the block that a source draws in part, in order, until its
    # words are reached: one block a source, the only one whose rows are moved.
    so_far = Window.partitionBy("s", "block").orderBy("h", "id", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    some = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("until") + F.col("size")))
    # Written: a row per block of a source, joined by its measured size.
    by_block = write_table(by_block, "mix-blocks")
    placed = numbered.join(by_block, ["s", "block"], "left")
    drawn = placed.where("coalesce(part, 0) = 0").withColumn("some", F.lit(0).cast("bigint")).unionByName(
        placed.where("part > 0").withColumn("until", F.sum("size").over(so_far)).withColumn("some", some).drop("until"))
    draws_of = F.transform(F.coalesce("taken", F.array()), lambda d: F.struct(
        d["shard"].alias("shard"), d["pass"].alias("pass"),
        F.when(d["part"] > 0, F.col("some")).otherwise(F.col("size")).alias("words"),
        F.xxhash64(F.lit(seed + 2), d["shard"], d["pass"], F.col("h")).alias("place")))
    return drawn.select("id", "text_hash", "source", "size", "source_size", "target",
                        F.filter(draws_of, lambda d: d["words"] > 0).alias("draws")) \
                .withColumnRenamed("id", id_col)


def words_taken(draws: str = "draws") -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return F.aggregate(draws, F.lit(0).cast("bigint"), lambda n, d: n + d["words"])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **options) -> DataFrame:
    """The mix as whole documents with the columns of ``docs``: a row for each
    draw of a row, in the order of shards and shuffled within each; a large
    shard goes over several partitions. The one document that a source draws in
    part is there if at least half of it is drawn."""
    shard, place, key, own, other, of = fresh(docs, "shard", "place", "mix_hash", "own_hash", "mix_id", "mix_source")
    found = write_table(mix(docs, id_col, text_col, source_col, **options).select(
        F.col(id_col).alias("id"), "text_hash", "source", "size", "draws"), "mix-found")
    # Draws of equal rows are theirs together, so one of these rows is enough.
    repeats = found.groupBy("id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("id", "text_hash")
    rows = found.select(F.col("id").alias(other), F.col("text_hash").alias(key), F.col("source").alias(of), "size",
                        F.explode("draws").alias("d")) \
        .where(F.col("d.words") * 2 >= F.col("size")) \
        .select(other, key, of, F.col("d.shard").alias(shard), F.col("d.place").alias(place))
    hashed = single_rows(docs, repeats, id_col, text_col).withColumn(own, F.xxhash64(F.col(text_col)))
    return hashed.join(rows, hashed[id_col].eqNullSafe(rows[other]) & (hashed[own] == rows[key]), "inner") \
        .select(*[rows[of].alias(c) if c == source_col else hashed[c] for c in docs.columns], shard, place) \
        .repartitionByRange(shard, place).sortWithinPartitions(shard, place).drop(shard, place)
