"""A key holding a third of all rows: results stay exact and whole."""

from collections import Counter

from pyspark.sql import functions as F

from sparkfit.operators import entity_features, join_fanout, key_index, row_positions


def hot_rows(spark, n=3000):
    rows = [("HOT" if i % 3 == 0 else f"k{i % 97}", i, float(i % 5), float(i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "app STRING, uid BIGINT, a DOUBLE, b DOUBLE"), rows


def test_positions_split_a_hot_leading_key(spark):
    df, rows = hot_rows(spark)
    got = row_positions(df, [F.col("app").asc(), F.col("uid").asc()], num_partitions=8).collect()
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    assert sorted((r["pos"], r["app"], r["uid"]) for r in got) == \
        [(i, r[0], r[1]) for i, r in enumerate(want)]


def test_last_position_per_key_with_hot_key(spark):
    df, rows = hot_rows(spark)
    got = {r["app"]: r["id"] for r in key_index(df, "app", ["uid"]).collect()}
    last = {}
    for pos, r in enumerate(sorted(rows, key=lambda r: r[1])):
        last[r[0]] = pos
    assert got == last


def test_rollup_and_fanout_with_hot_key(spark):
    df, rows = hot_rows(spark)
    feats = entity_features(df.select("app", F.col("a").alias("rating"), F.col("b").alias("rating_count"),
                                      F.col("a").alias("min_install"), F.col("b").alias("max_install"),
                                      F.col("a").alias("price")))
    hot = feats.where("app = 'HOT'").collect()[0]
    hot_a = [r[2] for r in rows if r[0] == "HOT"]
    assert hot["rating"] == sum(hot_a) / len(hot_a)
    assert hot["min_install"] == sum(1 for v in hot_a if v != 0)
    counts = Counter(r[0] for r in rows)
    fan = {r["app"]: r["n_pairs"] for r in join_fanout(df, df, "app").collect()}
    assert fan == {k: c * c for k, c in counts.items()}
