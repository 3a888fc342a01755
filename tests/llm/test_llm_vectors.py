"""Nearest neighbours and whitening against brute force."""

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from sparkfit.llm import neighbours, queries, whitening
from sparkfit.llm.vectors import finite_vectors

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vec string, cid string, qid string, x string"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0, *["clash"] * 5) for i, v in rows], SCHEMA).repartition(partitions)


def given(sf_dir):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{sf_dir}/embeddings.parquet", columns=["vec_id", "embedding"])
    return list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))


def plain_nearest(rows, wants, k):
    """{query row: [(distance, id)...]} over all other rows; nulls last in ties."""
    kept = [(i, np.float32(v).astype(float)) for i, v in rows]
    out = {}
    for at, (q, v) in enumerate(kept):
        if q is not None and wants(q):
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i is None, i or 0)
                          for n, (i, w) in enumerate(kept) if n != at)
            out[at] = (q, [(d, None if none else i) for d, none, i in near[:k]])
    return out


def spark_nearest(df, k, every=100):
    got = {}
    for r in neighbours.nearest(df, "vec_id", "embedding", F.col("id") % every == 0, k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(d, i) for _, d, i in sorted(v, key=lambda e: (e[0], e[1]))] for q, v in got.items()}


def test_neighbours_recall_and_scores(spark):
    rows = given(SF_ORACLE)
    want = {q: near for q, near in plain_nearest(rows, lambda i: i % 20 == 0, 10).values()}
    got = spark_nearest(frame(spark, rows), 10, 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    by_id = {i: np.float32(v).astype(float) for i, v in rows}
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near)
        for d, i in near:
            assert d == pytest.approx(float(np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())), rel=1e-14)


def test_neighbours_recall_with_clusters_and_copies(spark):
    """Near copies, far rows and a vector that a third of all rows share."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 24)) * 3
    rows = [(i, (centres[i % 12] + rng.standard_normal(24) * (0.02 if i % 5 else 1)).tolist()) for i in range(2600)]
    hot = rows[7][1]
    rows = [(i, hot if i % 3 == 0 else v) for i, v in rows] + [(9001, (centres[0] * 40).tolist())]
    want = {q: near for q, near in plain_nearest(rows, lambda i: i % 50 == 0, 10).values()}
    got = spark_nearest(frame(spark, rows), 10, 50)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * 10 * len(want)
    for q in want:
        if q % 3 == 0:                  # its copies of smallest id, all at 0
            assert got[q] == want[q]


def test_neighbours_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [1.0, 2.0]), (100, [1.0, 2.5]), (7, [0.0, -0.0]), (8, None), (9, []),
            (10, [1.0, None]), (11, [NAN, 1.0]), (12, [INF, 1.0]), (200, [3.0]), (None, [1.0, 2.5]), (6, [-1.0, 0.0]),
            (4, [1.0, 3.0])]
    valid = [(i, v) for i, v in rows if i in (0, 5, 100, None, 6, 4) and v]
    for k in (2, 3, 10):
        want = plain_nearest(valid, lambda i: i % 100 == 0, k).values()
        got = neighbours.nearest(frame(spark, rows), "vec_id", "embedding", F.col("id") % 100 == 0, k).collect()
        flat = [(q, rank + 1, i, round(d, 12)) for q, near in want for rank, (d, i) in enumerate(near)]
        assert sorted(((*r[:3], round(r[3], 12)) for r in got), key=repr) == sorted(flat, key=repr)
    assert spark_nearest(frame(spark, []), 3) == {}
    assert spark_nearest(frame(spark, [(1, [1.0, 1.0])]), 3) == {}
    assert spark_nearest(frame(spark, [(100, [1.0, 1.0])]), 3) == {}


def test_neighbours_few_found_are_searched_exactly(spark, monkeypatch):
    """With visits that find next to nothing, the exact way still gives all."""
    monkeypatch.setattr(neighbours, "SUCCESS", 1e-9)
    monkeypatch.setattr(neighbours, "PER_BUCKET", 1)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(300)]
    want = {q: near for q, near in plain_nearest(rows, lambda i: i % 50 == 0, 10).values()}
    got = spark_nearest(frame(spark, rows), 10, 50)
    assert {q: [i for _, i in n] for q, n in got.items()} == {q: [i for _, i in n] for q, n in want.items()}


def test_cells_are_visited_in_the_order_of_their_chance():
    rng = np.random.default_rng(8)
    mean, offset = rng.standard_normal(3), rng.uniform(0, 0.8, 3)
    cells = neighbours.best_cells(mean, 0.7, offset, 0.8, 0.7)
    points = np.floor((mean + rng.standard_normal((200_000, 3)) * 0.7 + offset) / 0.8)
    seen = {}
    for c in map(tuple, points):
        seen[c] = seen.get(c, 0) + 1
    share = [seen.get(tuple(c), 0) / len(points) for c in cells]
    assert 0.69 < sum(share) < 0.75
    assert all(a > b - 0.004 for a, b in zip(share, share[1:], strict=False))


def plain_whitening(x, wanted):
    u = np.unique(x, axis=0)
    n, sums = len(u), [int(s) for s in u.astype(object).sum(axis=0)]
    mean = np.array([s / n for s in sums])
    v = (u - mean).T @ (u - mean) / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = int((e > len(e) * np.finfo(float).eps * np.trace(v)).sum())
    k = min(k, wanted)
    dev = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return n, e[:k], (x - mean) @ q[:, :k] / np.sqrt(e[:k]), dev, e[:k] / np.trace(v)


def check_whitening(rows, x, wanted):
    """Rows (id = row number) against the plain version."""
    n, e, w, dev, share = plain_whitening(x, wanted)
    k = len(e)
    rows = sorted(rows, key=lambda r: (r["id"], r["component"]))
    assert [(r["id"], r["component"]) for r in rows] == [(i, c + 1) for i in range(len(x)) for c in range(k)]
    got = np.array([r["whitened"] for r in rows]).reshape(len(x), k)
    sign = np.sign((got * w).sum(axis=0))
    assert np.abs(got * sign - w).max() < 1e-7
    assert [r["deviation"] for r in rows[::k]] == dev
    assert {r["n"] for r in rows} == {n}
    assert [r["explained"] for r in rows[:k]] == pytest.approx(share.tolist(), rel=1e-9)
    assert all(0 <= r["identity_error"] < 1e-9 for r in rows)
    return k


def whole(spark, x):
    return spark.createDataFrame([(i, [int(a) for a in v], "clash") for i, v in enumerate(x)],
                                 "row bigint, x array<bigint>, n string").repartition(3)


def test_whitening_of_the_given_table(spark):
    rows = sorted(given(SF_SMALL))
    x = np.floor(64 * np.array([v for _, v in rows], dtype=float)).astype(np.int64) + 1_000_000
    got = queries.op12_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [i for i, _ in rows] == list(range(len(rows)))
    assert check_whitening(got.withColumnRenamed("vec_id", "id").collect(), x, 16) == 16


def test_whitening_edges(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (60, 5)) + 1_000_000
    x[:, 4] = x[:, 0] + x[:, 1]                     # a direction that is not spanned
    x[20:40] = x[3]                                 # a third of the rows are copies
    assert check_whitening(whitening.whiten(whole(spark, x), "row", "x", 16).collect(), x, 16) == 4
    # Equal eigenvalues: any basis will do, so the whitened rows only have to agree in their products.
    corners = np.array([[a, b, c] for a in (0, 2) for b in (0, 2) for c in (0, 2)]) + 10
    rows = sorted(whitening.whiten(whole(spark, corners), "row", "x", 16).collect(), key=lambda r: (r["id"], r["component"]))
    w = np.array([r["whitened"] for r in rows]).reshape(8, 3)
    assert np.allclose(w.T @ w / 8, np.eye(3), atol=1e-12)
    assert np.allclose(w @ w.T, (corners - 11.0) @ (corners - 11.0).T, atol=1e-12)
    for few in ([], [[3, 4]], [[3, 4]] * 3):
        assert whitening.whiten(whole(spark, few), "row", "x", 16).collect() == []
    mixed = spark.createDataFrame([(0, [1, 2]), (1, [3, 5]), (2, [4, 1]), (3, None), (4, []), (5, [1]), (6, [1, None]),
                                   (None, [1, 2])], "row bigint, x array<bigint>")
    assert {r["id"] for r in whitening.whiten(mixed, "row", "x", 1).collect()} == {0, 1, 2, None}


def test_whitening_of_large_numbers_is_exact(spark):
    x = np.array([[2 ** 45 + 3, 1], [2 ** 45 - 9, 7], [5, 2 ** 40], [-2 ** 44, 0]])
    n, _, _, dev, _ = plain_whitening(x, 2)
    rows = whitening.whiten(whole(spark, x), "row", "x", 2).collect()
    want = [d if d < 2 ** 63 else None for d in dev]
    assert {(r["id"], r["deviation"]) for r in rows} == set(enumerate(want)) and None in want


def test_whitening_query_leaves_out_unusable_vectors(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.1, -0.3]), (2, [0.0, 0.0]), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, None), (6, [1.0, None])]
    left = finite_vectors(frame(spark, rows), "vec_id", "embedding")
    assert {r["id"] for r in left.collect()} == {0, 1, 2}


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_inertia_and_intervals(d):
    rng = np.random.default_rng(d)
    for case in range(4):
        a = rng.standard_normal((d, d))
        v = a @ a.T if case % 2 else np.diag(np.repeat(rng.integers(1, 4, d), 1).astype(float))
        e = np.linalg.eigvalsh(v)
        for s in rng.uniform(0, e[-1] * 1.1, 6):
            assert whitening.above(v - 0 * s, s) == (e > s).sum()
        for wanted in (1, 5, d):
            parts = whitening.intervals(v, wanted)
            assert sum(n for _, _, n in parts) >= min(wanted, d)
            found = np.sort(np.concatenate([whitening.interval_pairs(v, *p)[0] for p in parts]))[::-1]
            assert np.allclose(found[:wanted], e[::-1][:min(wanted, d)], rtol=1e-10, atol=1e-12)
