"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf: the digest of its fields. The leaves of a group, in the
order of their key, are the lowest nodes of a tree; every ``fanout`` consecutive
nodes are hashed to their parent until one is left, the group's subroot, and the
subroots in the order of their groups have a tree of their own, whose top is the
root of the dataset.

A node's label is (level, place). Nodes are worked off in the order of their
labels, and what a node sends waits in a priority queue until the sweep comes to
its receiver: digests go up to parents, then, in the reversed order, proof
suffixes (the siblings on the way from a node to the root) go down to children.
The queue has two parts. Messages between nodes of one segment (at most
``SEGMENT`` consecutive nodes and all above them) wait in a heap of the task that
works on the segment. Messages that leave a segment are rows of a written table,
dealt by segment and sorted by label by Spark's external sort; a round of
segments makes the lowest level of the next, so n rows need log(n) / log(SEGMENT)
rounds, and no group, level or proof has to fit in one task. A leaf's siblings
are never shuffled: a segment gets the suffix of its top once and hands it down.

Defined results. Fields that are null are hashed as ``-``, empty ones as ``0:``.
Rows without a key come first in their group, rows without a group make the
group that comes first. Rows of one key are in the order of their digests; equal
rows are all kept, as leaves side by side. A group of one row has its leaf as its
subroot. An empty table has no rows and no root. Texts of any length are hashed
whole, in the JVM. Other columns of the table aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkfit.llm.common import ship
from sparkfit.operators.keys import row_positions
from sparkfit.session import drop_table, write_table

# Most nodes that one task climbs from at a time.
SEGMENT = 4096
# Rows of a result batch, each with its whole proof.
OUT_ROWS = 1024

PROOF = "array<struct<before: string, after: string>>"
_NODE = "grp bigint, pos bigint, n bigint, digest string"
_SUFFIX = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def field_digest(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the fields, each ``-`` if null, else its UTF-8
    byte count, ``:`` and its value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-"))
                             .otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Labelled:
    """Messages to nodes, given out in the order of the nodes' labels."""

    def __init__(self) -> None:
        self._heap: list[tuple] = []

    def send(self, label: tuple[int, int], order: int, message) -> None:
        heapq.heappush(self._heap, (label, order, message))

    def next(self) -> tuple[tuple[int, int], list]:
        """The first label that has messages, and all of them."""
        label, _, message = heapq.heappop(self._heap)
        got = [message]
        while self._heap and self._heap[0][0] == label:
            got.append(heapq.heappop(self._heap)[2])
        return label, got

    def __len__(self) -> int:
        return len(self._heap)


def climb(digests: list[str], height: int, fanout: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """Digest of the node ``height`` levels above consecutive nodes, and the
    children's digests of every node passed on the way."""
    queue = Labelled()
    for place, d in enumerate(digests):
        queue.send((0, place), 0, d)
    family: dict[tuple[int, int], list[str]] = {}
    while True:
        label, got = queue.next()
        level, place = label
        if level:
            family[label] = got
            digest = digest_of(got)
        else:
            digest = got[0]
        if level == height:
            return digest, family
        queue.send((level + 1, place // fanout), place, digest)


def descend(family: dict[tuple[int, int], list[str]], height: int, fanout: int, suffix: tuple | None,
            n: int) -> list[tuple | None]:
    """The proof suffix of each of the n lowest nodes: linked entries (before,
    after, rest), from the node's own siblings up to those above the segment."""
    queue = Labelled()
    queue.send((-height, 0), 0, suffix)
    out: list[tuple | None] = [None] * n
    while len(queue):
        (level, place), (rest,) = queue.next()
        if level == 0:
            out[-place] = rest
            continue
        kids = family[(-level, -place)]
        for i in range(len(kids)):
            child = -place * fanout + i
            queue.send((level + 1, -child), 0, ("".join(kids[:i]), "".join(kids[i + 1:]), rest))
    return out


def _height(n: int, fanout: int) -> int:
    """Levels above n nodes until one is left."""
    height = 0
    while n > 1:
        n = -(-n // fanout)
        height += 1
    return height


def _span(fanout: int) -> tuple[int, int]:
    """Nodes of a whole segment and the levels above them."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    height = 1
    while fanout ** (height + 1) <= SEGMENT:
        height += 1
    return fanout ** height, height


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """(group, segment, rows) over rows sorted by group, segment and place."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["grp"], row["seg"])
            if key != now:
                if held:
                    yield *now, held
                now, held = key, []
            held.append(row)
    if held:
        yield *now, held


def _by_segment(df: DataFrame) -> DataFrame:
    return df.repartition("grp", "seg").sortWithinPartitions("grp", "seg", "pos")


def _round_up(nodes: DataFrame, fanout: int, name: str) -> DataFrame:
    """The nodes above whole segments, written: the next round's lowest level."""
    span, height = _span(fanout)

    def run(batches):
        done = []
        for grp, seg, rows in _segments(batches):
            n = rows[0]["n"]
            top = _height(n, fanout) if n <= span else height
            digest, _ = climb([r["digest"] for r in rows], top, fanout)
            done.append((grp, seg, -(-n // span), digest))
            if len(done) == OUT_ROWS:
                yield _batch(done)
                done = []
        if done:
            yield _batch(done)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64())
                                           for i, c in enumerate(zip(*rows, strict=True))],
                                          names=["grp", "pos", "n", "digest"])

    placed = nodes.select("grp", F.expr(f"pos DIV {span}").alias("seg"), "pos", "n", "digest")
    return write_table(_by_segment(placed).mapInArrow(run, _NODE), name)


def _round_down(nodes: DataFrame, above: DataFrame, fanout: int, extra: list[str]) -> DataFrame:
    """(grp, pos, extra..., proof, over) of the nodes: each segment takes the
    proof of the node above it and hands it down. ``over`` is what that node
    carries for all below it."""
    span, height = _span(fanout)
    kinds = dict(nodes.dtypes)
    placed = nodes.select("grp", F.expr(f"pos DIV {span}").alias("seg"), "pos", "n", "digest", *extra,
                          F.lit(None).cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("over"))
    heads = above.select("grp", F.col("pos").alias("seg"), F.lit(-1).cast("bigint").alias("pos"),
                         F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("string").alias("digest"),
                         *[F.lit(None).cast(kinds[c]).alias(c) for c in extra], "proof", "over")
    schema = ", ".join(["grp bigint, pos bigint", *[f"`{c}` {kinds[c]}" for c in extra], f"proof {PROOF}, over string"])
    ship(nodes.sparkSession)

    def run(batches):
        for grp, _seg, (head, *rows) in _segments(batches):
            n = rows[0]["n"]
            top = _height(n, fanout) if n <= span else height
            suffix = None
            for entry in reversed(head["proof"]):
                suffix = (entry["before"], entry["after"], suffix)
            _, family = climb([r["digest"] for r in rows], top, fanout)
            ends = descend(family, top, fanout, suffix, len(rows))
            for at in range(0, len(rows), OUT_ROWS):
                part = rows[at:at + OUT_ROWS]
                proofs = []
                for link in ends[at:at + OUT_ROWS]:
                    proof = []
                    while link is not None:
                        proof.append({"before": link[0], "after": link[1]})
                        link = link[2]
                    proofs.append(proof)
                cols = [pa.array([grp] * len(part), pa.int64()), pa.array([r["pos"] for r in part], pa.int64())]
                cols += [pa.array([r[c] for r in part], types[c]) for c in extra]
                cols += [pa.array(proofs, _SUFFIX), pa.array([head["over"]] * len(part), pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["grp", "pos", *extra, "proof", "over"])

    types = {c: to_arrow_type(nodes.schema[c].dataType) for c in extra}
    return _by_segment(placed.unionByName(heads)).mapInArrow(run, schema)


def _climb_all(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The written levels between rounds, from the given nodes to one node a group."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    span, _ = _span(fanout)
    while most > 1:
        levels.append(_round_up(levels[-1], fanout, f"{name}-{len(levels)}"))
        most = -(-most // span)
    return levels


def manifest(rows: DataFrame, fields: list[str], group: str, key: str, fanout: int = 2,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of the table: (key, carry..., leaf, subroot, root, proof).

    ``fields`` are the columns that a leaf is the digest of; ``carry`` names
    further expressions over the table to be kept with each leaf. ``proof`` has
    an entry for every level from the leaf to the root: the siblings' digests,
    joined, before and after the node (both empty where it has none).
    """
    spark = rows.sparkSession
    ship(spark)
    carry = carry or {}
    kept = {f"carry_{i}": c for i, c in enumerate(carry)}
    leaves = rows.select(F.col(group).alias("grp_key"), F.col(key).alias("row_key"),
                         field_digest([F.col(c) for c in fields]).alias("digest"),
                         *[carry[c].alias(k) for k, c in kept.items()],
                         F.monotonically_increasing_id().alias("row_no"))
    placed = write_table(row_positions(
        leaves, [F.col("grp_key").asc_nulls_first(), F.col("row_key").asc_nulls_first(), F.col("digest").asc()],
        pos_col="at").drop("row_no"), "merkle-leaves")
    sizes = placed.groupBy("grp_key").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    groups = write_table(row_positions(sizes, [F.col("grp_key").asc_nulls_first()], pos_col="grp"), "merkle-groups")
    found = groups.select(F.col("grp_key").alias("own_key"), "grp", "first", "n")
    nodes = placed.join(found, F.col("grp_key").eqNullSafe(F.col("own_key"))) \
        .select("grp", (F.col("at") - F.col("first")).alias("pos"), "n", "digest", "row_key", *kept)
    nodes = write_table(nodes, "merkle-nodes")
    drop_table(placed)
    levels = _climb_all(nodes, fanout, "merkle-up")
    subroots = levels[-1]

    count = groups.count()
    tops = write_table(subroots.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("pos"),
                                       F.lit(count).cast("bigint").alias("n"), "digest"), "merkle-tops")
    over = _climb_all(tops, fanout, "merkle-root")
    # One node is left: the root, with an empty proof.
    down = over[-1].select("grp", "pos", F.array().cast(PROOF).alias("proof"), F.col("digest").alias("over"))
    for level in reversed(over[:-1]):
        down = _round_down(level, down, fanout, [])
    root = over[-1].select(F.col("digest")).scalar() if count else F.lit(None).cast("string")
    # What the tree of subroots says of group g is the head of that group's tree.
    heads = down.select(F.col("pos").alias("grp"), "proof") \
        .join(subroots.select("grp", F.col("digest").alias("over")), "grp") \
        .select("grp", F.lit(0).cast("bigint").alias("pos"), "proof", "over")
    down = write_table(heads, "merkle-heads")
    for level in reversed(levels[1:-1]):
        down = write_table(_round_down(level, down, fanout, []), "merkle-down")
    extra = ["digest_", "row_key", *kept]
    if len(levels) > 1:
        done = _round_down(nodes.withColumn("digest_", F.col("digest")), down, fanout, extra)
    else:
        done = nodes.withColumn("digest_", F.col("digest")) \
            .join(down.select(F.col("grp").alias("own"), "proof", "over"), F.col("grp") == F.col("own"))
    drop_table(groups)
    return done.select(F.col("row_key").alias(key), *[F.col(k).alias(c) for k, c in kept.items()],
                       F.col("digest_").alias("leaf"), F.col("over").alias("subroot"), root.alias("root"), "proof")


def proof_digest(proof: Column | str = "proof") -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    col = F.col(proof) if isinstance(proof, str) else proof
    return F.sha2(F.array_join(F.transform(col, lambda e: F.concat(e["before"], e["after"])), ""), 256)


def folded(leaf: Column | str, proof: Column | str = "proof") -> Column:
    """The root that a leaf and its proof give."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    col = F.col(proof) if isinstance(proof, str) else proof
    return F.aggregate(col, start, lambda d, e: F.sha2(F.concat(e["before"], d, e["after"]), 256))
