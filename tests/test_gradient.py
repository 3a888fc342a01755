"""Counting in the row, and batch fits from dense partial gradients."""

from collections import Counter

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from pyspark import StorageLevel
from pyspark.sql import functions as F

from sparkfit.operators import gradient, logistic, svm, text
from sparkfit.plans import queries as Q
from sparkfit.sources import hash_split

DOCS = [(1, ["a", "b", "a", "zz"]), (2, []), (3, None), (4, ["zz", "yy"]), (5, ["c"] * 40 + ["b"])]
WORDS = ["b", "a", "c", "unused"]


def docs(spark):
    return spark.createDataFrame(DOCS, "id int, tokens array<string>").repartition(2)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_counts_are_counted_in_the_row(spark):
    got = text.term_counts(docs(spark), "id", F.col("tokens"), WORDS)
    want = {(i, WORDS.index(w), n) for i, ts in DOCS for w, n in Counter(ts or []).items() if w in WORDS}
    assert {tuple(r) for r in got.collect()} == want
    assert text.term_counts(docs(spark), "id", F.col("tokens"), []).collect() == []
    rows = {r["id"]: r for r in text.counted_words(docs(spark), ["id"], F.col("tokens"), WORDS).collect()}
    assert rows.keys() == {1, 2, 3, 4, 5} and rows[3]["idx"] == [] and rows[5]["tf"] == [1.0, 40.0]


def test_counting_plans_have_no_exchange(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    from sparkfit.functions.strings import letter_token_array
    for df in (text.term_counts(d, "doc_id", letter_token_array("text"), WORDS),
               text.char_frequency(d, "doc_id", "text"),
               text.char_frequency(d, "doc_id", "text", spark.createDataFrame([("a", 0), ("bc", 1)], "word string, idx int"))):
        plan = plan_of(df)
        assert "Exchange" not in plan and plan.count("regexp_replace") <= 1, plan


@pytest.mark.parametrize("s", ["", "aabA", "日本日", "👍a👍", "a\nb\n", None])
def test_characters_in_the_row(spark, s):
    got = text.char_frequency(spark.createDataFrame([(1, s)], "id int, s string"), "id", "s").collect()
    assert {(r["ch"], r["tf"]) for r in got} == set(Counter(s or "").items())


@pytest.fixture(scope="module")
def labelled(spark):
    rows, vocab = Q._logit_rows(spark, SF_SMALL)
    yield rows, vocab
    rows.unpersist()


def test_rows_fit_equals_the_long_form_fit(spark, labelled):
    rows, vocab = labelled
    ex, vocab2, lab = Q._logit_inputs(spark, SF_SMALL)
    try:
        long = logistic.fit_logistic(ex, vocab2, seed=5)
        short = gradient.fit_logistic_rows(rows, vocab.count(), seed=5)
        a, b = gradient.vector_of(long.weights), gradient.vector_of(short.weights)
        assert np.allclose(a, b, rtol=1e-9, atol=1e-12) and long.size == short.size
        assert np.allclose(np.array(long.trace.collect()), np.array(short.trace.collect()), rtol=1e-9)
        p = {r["id"]: (r["y"], r["p"], r["pred"]) for r in logistic.predict_logistic(ex, long.weights).collect()}
        q = {r["id"]: (r["y"], r["p"], r["pred"]) for r in gradient.predict_logistic_rows(rows, short.weights).collect()}
        assert p.keys() == q.keys() and all(p[k] == pytest.approx(q[k]) for k in p)
    finally:
        lab.unpersist()


def test_summed_vector_over_any_partitioning(spark, labelled):
    rows, vocab = labelled
    k = vocab.count()
    want = np.zeros(k)
    for r in rows.collect():
        want[r["idx"]] += np.array(r["tf"]) * r["y"]
    for n in (1, 3, 40):
        got = gradient.summed_vector(rows.repartition(n), lambda b: b.by_word(b.y, k), k)
        assert np.array_equal(got, want)
    assert np.array_equal(gradient.summed_vector(rows.where("id < 0"), lambda b: b.by_word(b.y, k), k), np.zeros(k))


def test_early_stop_leaves_the_step_out(labelled):
    rows, vocab = labelled
    fit = gradient.fit_logistic_rows(rows, vocab.count(), init=0.01, tol=0.0225)
    assert fit.stopped_early and fit.trace.count() == 3


def test_no_examples(spark):
    none = spark.createDataFrame([], "id bigint, y double, idx array<int>, tf array<double>")
    for fit in (gradient.fit_logistic_rows, gradient.fit_svm_rows):
        with pytest.raises(ValueError):
            fit(none, 3)


def hinge(rows, w, b):
    total = 0.0
    for r in rows:
        side = 1.0 if r["y"] > 0.5 else -1.0
        total += max(0.0, 1 - side * (float(np.dot(r["tf"], w[r["idx"]])) + b))
    return total / len(rows)


def test_svm_loss_is_near_that_of_mllib(spark):
    """On the train half: our loss within 0.01 of MLlib's, the trace's loss that of the weights."""
    lab, train, _, k = Q._svm_rows(spark, SF_ORACLE)
    try:
        fit = gradient.fit_svm_rows(train, k, steps=40)
        rows = train.collect()
        words = svm.vocab_words(text.vocabulary(text.word_count(Q.explode_items(
            hash_split(lab, ["doc_id"], Q.SPLIT_FRACTION, Q.SPLIT_SEED)[0], ["doc_id"], F.col("tokens"), "token")), text.VOCAB_SIZE))
        model = svm.fit_svm(svm.tf_vectors(hash_split(lab, ["doc_id"], Q.SPLIT_FRACTION, Q.SPLIT_SEED)[0], words))
        theirs = hinge(rows, model.coefficients.toArray(), model.intercept)
        ours = hinge(rows, gradient.vector_of(fit.weights), fit.intercept)
        trace = fit.trace.collect()
        assert ours <= theirs + 0.01
        assert ours == pytest.approx(min(r["loss"] for r in trace), abs=1e-8)
        assert ours == pytest.approx(trace[fit.best]["loss"], abs=1e-8)
    finally:
        train.unpersist()
        lab.unpersist()


def test_svm_words_without_spread_get_no_weight(spark):
    rows = spark.createDataFrame([(i, float(i % 2), [0, 1], [1.0, float(i % 2 + 1)]) for i in range(20)],
                                 "id int, y double, idx array<int>, tf array<double>").persist(StorageLevel.MEMORY_ONLY)
    fit = gradient.fit_svm_rows(rows, 3, steps=150)
    w = gradient.vector_of(fit.weights)
    assert w[0] == 0 and w[2] == 0 and w[1] > 0
    assert all(r["y"] == r["pred"] for r in gradient.predict_svm_rows(rows, fit).collect())
    rows.unpersist()


def test_svm_scores_rows_of_a_session_with_an_observation(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import Observation
    session, seen = spark.newSession(), Observation("rows")
    session.range(7).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 7}
    rows = session.createDataFrame([(Vectors.dense(float(i - 10)), float(i > 10)) for i in range(20)], ["features", "labels"])
    found = svm.evaluate_svm(svm.fit_svm(rows, maxIter=20), rows).first()
    assert found["n"] == 20 and found["accuracy"] >= 0.9
