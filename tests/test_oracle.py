"""Every query key against its DuckDB oracle (row count, columns, value hash)."""

import pytest

import oracle_util as U
from conftest import SF_ORACLE, SF_SMALL
from sparkfit.plans.oracle import ORACLE_SQL
from sparkfit.plans.queries import QUERIES

# Keys also run at sf0.01 (the driver's correctness scale); the rest of that
# scale is covered by the driver's own check.
AT_SF001 = ["split_clean", "entity_features", "gd_independent_trace", "term_frequency",
            "doc_tag_parse", "key_index", "logit_trace", "multiclass_metrics"]


@pytest.fixture(scope="module")
def duck_small():
    return U.duck(SF_SMALL)


@pytest.fixture(scope="module")
def duck_oracle():
    return U.duck(SF_ORACLE)


def test_every_key_has_oracle_or_is_iterative():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE_SQL) == {"svm_eval"}


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_key_matches_oracle_sf0001(spark, duck_small, key):
    r = U.compare(spark, duck_small, key, SF_SMALL, QUERIES, ORACLE_SQL)
    assert r["rows"][0] == r["rows"][1], r
    assert r["cols_match"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("key", AT_SF001)
def test_key_matches_oracle_sf001(spark, duck_oracle, key):
    r = U.compare(spark, duck_oracle, key, SF_ORACLE, QUERIES, ORACLE_SQL)
    assert r["rows"][0] == r["rows"][1] and r["cols_match"] and r["hash_match"], r


def test_svm_metrics_are_mllib_s_and_the_fit_beats_the_majority(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.sql import functions as F

    from sparkfit.operators import svm
    from sparkfit.plans import queries as Q
    lab, train, test = Q._svm_halves(spark, SF_ORACLE)
    try:
        model = svm.fit_svm(train, label="labels", maxIter=40)
        ours = svm.evaluate_svm(model, test, label="labels").first()
        pred = model.transform(test.withColumn("labels", F.col("labels").cast("double"))).persist()
        ev = MulticlassClassificationEvaluator(labelCol="labels", predictionCol="prediction")
        assert ours["accuracy"] == pytest.approx(ev.evaluate(pred, {ev.metricName: "accuracy"}), rel=1e-12)
        assert ours["weighted_f1"] == pytest.approx(ev.evaluate(pred, {ev.metricName: "f1"}), rel=1e-12)
        pred.unpersist()
        # On the rows it was fitted to it must do better than the larger class.
        counts = [r["count"] for r in train.groupBy("labels").count().collect()]
        fitted = svm.evaluate_svm(model, train, label="labels").first()
        assert fitted["n"] == sum(counts) and ours["n"] == test.count()
        assert fitted["accuracy"] > max(counts) / sum(counts)
    finally:
        lab.unpersist()


def test_svm_eval_runs(spark):
    row = QUERIES["svm_eval"](spark, SF_SMALL).collect()
    assert len(row) == 1 and row[0]["n_test"] > 0
    assert 0.0 <= row[0]["accuracy"] <= 1.0 and 0.0 <= row[0]["weighted_f1"] <= 1.0


def test_logistic_early_stop_matches_oracle(spark, duck_small):
    """A tolerance that stops the descent at step 3: history and weights agree."""
    from sparkfit.functions.numeric import rounded
    from sparkfit.operators import logistic as L
    from sparkfit.plans import oracle as O
    from sparkfit.plans import queries as Q
    from pyspark.sql import functions as F
    tol = 0.0225        # between the third and the fourth change of the norm
    ex, vocab, lab = Q._logit_inputs(spark, SF_SMALL)
    try:
        fit = L.fit_logistic(ex, vocab, init=Q.LOGIT_INIT, tol=tol)
    finally:
        lab.unpersist()
    assert fit.stopped_early and fit.trace.count() == 3
    trace = fit.trace.select("iteration", rounded(F.col("loss"), 9).alias("loss"),
                             rounded(F.col("acc"), 9).alias("acc"),
                             rounded(F.col("grad_norm"), 9).alias("grad_norm"))
    _, want = U.duck_rows(duck_small, O._logit_trace_sql(tol=tol))
    assert U.canon(*U.spark_rows(trace)) == U.canon(["iteration", "loss", "acc", "grad_norm"], want)
    w_sql = f"{O._logit_ctes(tol=tol)}\nSELECT idx, round(w, 10) + 0.0 AS w FROM w{L.LOGIT_STEPS}"
    got = fit.weights.select("idx", rounded(F.col("w"), 10).alias("w"))
    assert U.canon(*U.spark_rows(got)) == U.canon(*U.duck_rows(duck_small, w_sql))
