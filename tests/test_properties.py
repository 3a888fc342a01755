"""Properties checked against brute force on small inputs."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sparkfit.functions import is_float, strict_double
from sparkfit.operators import (build_examples, confusion_metrics, descent_trace, entity_features,
                                fit_logistic, independent_descent_trace, join_fanout, moments,
                                multiclass_metrics, ols_fit, predict_logistic, row_positions, start_weights)
from sparkfit.operators.text import doc_tokens, term_frequency, top_words, vocabulary, word_count
from sparkfit.sources import hash_split, sample_exact


def step_by_step_descent(x, y, rate, steps, start):
    """Gradient descent without intercept, one explicit pass per step."""
    beta, out = start, []
    for i in range(steps):
        r = y - x * beta
        out.append((i, beta, float(np.sum(r * r))))
        beta = beta - rate * (-1.0 / len(y)) * float(np.sum(x * r))
    return out


def test_moment_descent_equals_step_loop(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 30, 200)
    y = 3.0 * x + rng.normal(0, 5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x DOUBLE, y DOUBLE")
    got = descent_trace(df, "y", "x", rate=1e-4, steps=50, start=0.1).orderBy("iteration").collect()
    want = step_by_step_descent(x, y, 1e-4, 50, 0.1)
    for g, w in zip(got, want):
        assert g["iteration"] == w[0]
        assert g["beta"] == pytest.approx(w[1], rel=1e-10)
        assert g["cost"] == pytest.approx(w[2], rel=1e-9)


def test_independent_descent_is_per_feature(spark):
    rng = np.random.default_rng(5)
    xs = rng.uniform(0, 5, (100, 2))
    y = xs @ np.array([1.5, -0.5]) + rng.normal(0, 0.1, 100)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(xs, y)],
                               "a DOUBLE, b DOUBLE, y DOUBLE")
    got = independent_descent_trace(df, "y", ["a", "b"], rate=1e-3, steps=20, start=0.1) \
        .orderBy("iteration").collect()
    ta = step_by_step_descent(xs[:, 0], y, 1e-3, 20, 0.1)
    tb = step_by_step_descent(xs[:, 1], y, 1e-3, 20, 0.1)
    for g, a, b in zip(got, ta, tb):
        assert g["beta_a"] == pytest.approx(a[1], rel=1e-10)
        assert g["beta_b"] == pytest.approx(b[1], rel=1e-10)
        assert g["cost"] == pytest.approx(a[2] + b[2], rel=1e-9)


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 50, 300)
    y = 2.5 * x + 7 + rng.normal(0, 1, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x DOUBLE, y DOUBLE")
    r = ols_fit(df, "y", "x").collect()[0]
    slope, intercept = np.polyfit(x, y, 1)
    assert r["slope"] == pytest.approx(slope, rel=1e-9)
    assert r["intercept"] == pytest.approx(intercept, rel=1e-9)
    assert r["n"] == 300


def mean_loss(weights, rows, y):
    """Mean log-loss of rows given as {index: count}."""
    total = 0.0
    for row, label in zip(rows, y, strict=True):
        p = 1.0 / (1.0 + math.exp(-sum(c * weights[j] for j, c in row.items())))
        total += -math.log(p + 1e-12) if label else -math.log(1 - p + 1e-12)
    return total / len(y)


def random_rows(spark, n, k, seed):
    rng = np.random.default_rng(seed)
    rows = [{j: int(c) for j, c in enumerate(rng.poisson(0.8, k)) if c} if i >= 5 else {} for i in range(n)]
    y = [int(v) for v in rng.uniform(size=n) < 0.4]
    tf = spark.createDataFrame([(i, j, float(c)) for i, r in enumerate(rows) for j, c in r.items()],
                               "id BIGINT, idx INT, tf DOUBLE")
    labels = spark.createDataFrame(list(enumerate(y)), "id BIGINT, y INT")
    return rows, y, build_examples(tf, labels)


def words_upto(spark, k):
    return spark.createDataFrame([(j,) for j in range(k)], "idx INT")


def by_index(fit):
    return [r["w"] for r in fit.weights.orderBy("idx").collect()]


def test_logistic_step_is_the_slope_of_the_loss(spark):
    # One step without shrinking moves each weight by the rate times the slope,
    # measured by central differences of the loss.
    k, rate, start = 8, 0.05, 0.2
    rows, y, ex = random_rows(spark, 60, k, 11)
    fit = fit_logistic(ex, words_upto(spark, k), rate=rate, steps=1, l2=0.0, init=start)
    w0, h = [start] * k, 1e-5
    slopes = []
    for j in range(k):
        up, down = list(w0), list(w0)
        up[j] += h
        down[j] -= h
        slopes.append((mean_loss(up, rows, y) - mean_loss(down, rows, y)) / (2 * h))
    assert by_index(fit) == pytest.approx([start - rate * s for s in slopes], rel=1e-8)
    t = fit.trace.collect()[0]
    assert t["loss"] == pytest.approx(mean_loss(w0, rows, y), rel=1e-12)
    assert t["grad_norm"] == pytest.approx(math.hypot(*slopes), rel=1e-6)


def test_logistic_history_goes_on_from_the_shrunk_weights(spark):
    k = 8
    rows, y, ex = random_rows(spark, 60, k, 12)
    one = fit_logistic(ex, words_upto(spark, k), rate=0.05, steps=1, l2=0.01, init=0.2)
    bare = fit_logistic(ex, words_upto(spark, k), rate=0.05, steps=1, l2=0.0, init=0.2)
    assert by_index(one) == pytest.approx([0.98 * w for w in by_index(bare)], rel=1e-12)
    two = fit_logistic(ex, words_upto(spark, k), rate=0.05, steps=2, l2=0.01, init=0.2)
    assert two.trace.where("iteration = 1").first()["loss"] == pytest.approx(
        mean_loss(by_index(one), rows, y), rel=1e-12)
    pred = predict_logistic(ex, two.weights).orderBy("id").collect()
    w = by_index(two)
    assert [r["p"] for r in pred] == pytest.approx(
        [1 / (1 + math.exp(-sum(c * w[j] for j, c in row.items()))) for row in rows], rel=1e-12)
    m = confusion_metrics(predict_logistic(ex, two.weights), "y", "pred").collect()[0]
    assert m["tp"] + m["fp"] + m["fn"] + m["tn"] == len(y)


def test_logistic_two_rows_by_hand(spark):
    # Words 0 and 1, one document each, labels 1 and 0, weights 0: both score
    # 1/2, so the gradient is (-1/2, 1/2) / 2 and a step of rate 0.4 gives
    # 0.1 and -0.1; shrinking by 2 * 0.05 leaves 0.09 and -0.09.
    tf = spark.createDataFrame([(0, 0, 1.0), (1, 1, 1.0)], "id BIGINT, idx INT, tf DOUBLE")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "id BIGINT, y INT")
    fit = fit_logistic(build_examples(tf, labels), words_upto(spark, 2), rate=0.4, steps=1, l2=0.05, init=0.0)
    assert by_index(fit) == pytest.approx([0.09, -0.09], rel=1e-12)
    t = fit.trace.collect()[0]
    assert (t["loss"], t["acc"]) == (pytest.approx(math.log(2), abs=1e-11), 0.5)
    assert t["grad_norm"] == pytest.approx(math.sqrt(2) / 4, rel=1e-12)


def test_logistic_weights_are_those_of_the_vocabulary(spark):
    # Asking for more words than there are changes nothing.
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b d"), (3, "zz a")], "id BIGINT, t STRING")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "id BIGINT, y INT")
    toks = doc_tokens(docs, "id", "t", with_pos=False)
    found = []
    for k in (5, 20000):
        vocab = vocabulary(word_count(toks), k)
        fit = fit_logistic(build_examples(term_frequency(toks, vocab), labels), vocab, init=0.1, rate=0.1)
        found.append((by_index(fit), [tuple(r) for r in fit.trace.orderBy("iteration").collect()]))
    assert found[0] == found[1] and len(found[0][0]) == 5


def test_random_start_is_repeatable_and_normal(spark):
    vocab = words_upto(spark, 5000)
    one = [r["w"] for r in start_weights(vocab, seed=3).orderBy("idx").collect()]
    again = [r["w"] for r in start_weights(vocab.repartition(7), seed=3).orderBy("idx").collect()]
    other = [r["w"] for r in start_weights(vocab, seed=4).orderBy("idx").collect()]
    assert one == again and one != other
    assert abs(np.mean(one)) < 0.006 and abs(np.std(one) - 0.1) < 0.005
    assert abs(np.mean([abs(w) < 0.1 for w in one]) - 0.683) < 0.03


def test_logistic_early_stop_leaves_step_out(spark):
    tf = spark.createDataFrame([(0, 0, 1.0)], "id BIGINT, idx INT, tf DOUBLE")
    labels = spark.createDataFrame([(0, 1)], "id BIGINT, y INT")
    fit = fit_logistic(build_examples(tf, labels), words_upto(spark, 1), rate=1e-12, steps=3, l2=0.0, init=0.0, tol=1.0)
    assert fit.stopped_early
    assert fit.trace.count() == 0


def test_near_perfect_fit_keeps_its_small_cost(spark):
    rows = [(float(x), 1e6 * x + (0.001 if x % 2 else -0.001)) for x in range(1, 400)]
    df = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE").repartition(3)
    best = sum(x * y for x, y in rows) / sum(x * x for x, _ in rows)
    for t in descent_trace(df, "y", "x", rate=1e-5, steps=3, start=best).collect():
        direct = math.fsum((y - t["beta"] * x) ** 2 for x, y in rows)
        assert t["cost"] == pytest.approx(direct, rel=1e-6)


def test_missing_values_count_in_complete_pairs_only(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.5, None), (None, 7.0, 2.0), (3.0, None, 1.0)],
                               "x DOUBLE, y DOUBLE, z DOUBLE")
    m = moments(df, "y", ["x", "z"]).first()
    assert (m["n_x"], m["Sxx_x"], m["Sxy_x"]) == (2, 5.0, 11.0)
    assert (m["n_z"], m["Sxx_z"], m["Sxy_z"]) == (2, 5.0, 16.0)
    assert ols_fit(df, "y", "x").first()["n"] == m["n_x"]
    whole = descent_trace(df.where("x IS NOT NULL AND y IS NOT NULL"), "y", "x").collect()
    assert descent_trace(df, "y", "x").collect() == whole


def test_descent_without_usable_rows_stays_at_the_start(spark):
    df = spark.createDataFrame([(None, 1.0), (0.0, None)], "x DOUBLE, y DOUBLE")
    assert {(t["beta"], t["cost"]) for t in descent_trace(df, "y", "x").collect()} == {(0.1, 0.0)}


def test_f1_null_when_nothing_positive(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y INT, pred INT")
    r = confusion_metrics(df).collect()[0]
    assert r["f1"] is None and r["tn"] == 2 and r["acc"] == 1.0


def test_multiclass_metrics_equal_mllib(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 3, 400), rng.integers(0, 4, 400))]
    df = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE")
    ours = multiclass_metrics(df).collect()[0]
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert ours["accuracy"] == pytest.approx(ev.evaluate(df, {ev.metricName: "accuracy"}), rel=1e-12)
    assert ours["weighted_f1"] == pytest.approx(ev.evaluate(df, {ev.metricName: "f1"}), rel=1e-12)


def test_sample_exact_is_subset_of_size_min(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    s = sample_exact(df, 40, ["k"], seed=1).collect()
    assert len(s) == 40 and len({r["k"] for r in s}) == 40
    assert sample_exact(df, 1000, ["k"]).count() == 500
    again = sample_exact(df.repartition(7), 40, ["k"], seed=1).collect()
    assert {r["k"] for r in again} == {r["k"] for r in s}


def test_hash_split_partitions_rows(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    a, b = hash_split(df, ["k"], 0.3)
    ka, kb = {r["k"] for r in a.collect()}, {r["k"] for r in b.collect()}
    assert ka.isdisjoint(kb) and len(ka | kb) == 1000
    assert 200 < len(ka) < 400


def test_row_positions_follow_order(spark):
    rng = np.random.default_rng(4)
    vals = rng.permutation(3000)
    df = spark.createDataFrame([(int(v), f"r{v}") for v in vals], "k BIGINT, s STRING").repartition(5)
    got = row_positions(df, [F.col("k").desc()], num_partitions=6).collect()
    assert sorted((r["pos"], r["k"]) for r in got) == [(i, 2999 - i) for i in range(3000)]


def test_row_positions_of_repeated_keys_agree_in_any_partitioning(spark):
    rng = np.random.default_rng(6)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 5, 800), rng.integers(0, 40, 800), strict=True)]
    df = spark.createDataFrame(rows, "k BIGINT, v BIGINT")
    one = sorted(map(tuple, row_positions(df.repartition(2), [F.col("k").desc()], num_partitions=3).collect()))
    two = sorted(map(tuple, row_positions(df.repartition(7), [F.col("k").desc()], num_partitions=8).collect()))
    assert one == two and [r[2] for r in sorted(one, key=lambda r: r[2])] == list(range(800))


def test_top_words_with_ties_at_the_cut(spark):
    counts = [(f"w{i:03}", 5 if i % 10 == 0 else 2) for i in range(200)]
    df = spark.createDataFrame(counts, "word STRING, cnt BIGINT").repartition(6)
    want = sorted(counts, key=lambda t: (-t[1], t[0]))
    for k in (1, 20, 21, 200, 500):
        got = sorted(map(tuple, top_words(df, k).collect()), key=lambda t: (-t[1], t[0]))
        assert got == want[:k]


def test_join_fanout_equals_pairs(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k INT")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (4,)], "k INT")
    got = sorted(tuple(r) for r in join_fanout(left, right, "k").collect())
    pairs = left.join(right, "k").groupBy("k").count().collect()
    assert got == [(1, 2, 3, 6), (3, 1, 1, 1)]
    assert sorted((r["k"], r["count"]) for r in pairs) == [(g[0], g[3]) for g in got]


def test_term_frequency_sums_equal_known_word_counts(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b d"), (3, "zz")], "id INT, t STRING")
    toks = doc_tokens(docs, "id", "t", with_pos=False)
    vocab = vocabulary(word_count(toks), 2)          # a, b
    tf = term_frequency(toks, vocab)
    total = tf.agg(F.sum("tf")).collect()[0][0]
    known = toks.where(F.col("token").isin("a", "b")).count()
    assert total == known == 4


def test_entity_features_invariant_under_repartition(spark):
    rng = np.random.default_rng(8)
    rows = [(f"k{int(k)}", float(a), float(b), float(c), float(d), float(e))
            for k, a, b, c, d, e in zip(rng.integers(0, 20, 500), *rng.integers(0, 3, (5, 500)))]
    df = spark.createDataFrame(rows, "app STRING, rating DOUBLE, rating_count DOUBLE, "
                                     "min_install DOUBLE, max_install DOUBLE, price DOUBLE")
    a = sorted(tuple(r) for r in entity_features(df).collect())
    b = sorted(tuple(r) for r in entity_features(df.repartition(9, "rating")).collect())
    assert a == b


FLOAT_ALPHABET = st.sampled_from(list("0123456789_.eE+- \tnaifNAIFtyxd٣١२\u3000"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(FLOAT_ALPHABET, max_size=8), min_size=1, max_size=30))
def test_strict_double_equals_float_on_random_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s STRING")
    rows = df.select(strict_double("s").alias("d"), is_float("s").alias("ok")).collect()
    got = [r["d"] for r in rows]
    for t, g, ok in zip(texts, got, [r["ok"] for r in rows]):
        try:
            want = float(t)
        except ValueError:
            want = None
        assert ok == (want is not None), t
        if want is None:
            assert g is None, t
        elif math.isnan(want):
            assert g is not None and math.isnan(g), t
        else:
            assert g == want, t
