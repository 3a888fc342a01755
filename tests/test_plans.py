"""Physical-plan properties the design relies on (checked with explain)."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sparkfit.operators import logistic as L
from sparkfit.operators import text as T
from sparkfit.plans import queries as Q


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    txt = plan_of(Q.q_ols_fit(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", txt)
    assert schemas == ["struct<p_size:int,p_retailprice:double>"]


def test_feature_rollup_combines_map_side_with_one_shuffle(spark):
    txt = plan_of(Q.q_entity_features(spark, SF_SMALL))
    assert "partial_avg" in txt and "partial_count" in txt
    assert txt.count("Exchange hashpartitioning") == 1


def test_vocabulary_lookup_is_a_broadcast_join(spark):
    toks = Q._doc_tokens(spark, SF_SMALL)
    txt = plan_of(T.term_frequency(toks, Q._written_vocabulary(toks)))
    assert "BroadcastHashJoin [word" in txt
    assert "SortMergeJoin" not in txt


def test_float_pattern_evaluated_once_per_field(spark):
    txt = plan_of(Q.q_split_clean(spark, SF_SMALL))
    scanned = txt.count("FileScan")           # the literal header row is folded at plan time
    assert scanned >= 1
    assert txt.count("regexp_extract(") == 5 * scanned
    below = txt[txt.index("Generate"):]       # the keep test runs in (and above) the generator
    assert not re.search(r"(\+- |^)(\*\(\d+\) )?Filter ", below, re.M)


def test_tokenizer_not_pushed_below_spreading_shuffle(spark):
    txt = plan_of(Q.q_word_count(spark, SF_SMALL))
    assert "size(" not in txt
    assert txt.count("regexp_replace(") == 1


def test_logistic_step_adds_no_shuffle_or_sort_under_the_window(spark):
    ex, vocab, lab = Q._logit_inputs(spark, SF_SMALL)
    ex = ex.persist()
    try:
        ex.count()
        scored = L.score_rows(ex, L.start_weights(vocab, 0.01))
        txt = plan_of(scored.groupBy("idx").agg(F.sum("p")))
    finally:
        ex.unpersist()
        lab.unpersist()
    between = txt[txt.index("Window"):txt.index("InMemoryTableScan")]
    assert "Exchange" not in between and "Sort " not in between
    assert "BroadcastHashJoin" in between


def test_no_cartesian_or_nested_loop_joins(spark):
    for key in ["entity_features", "gd_independent_trace", "keyed_join", "doc_sort_desc",
                "multiclass_metrics", "holdout_features", "key_index", "row_counts"]:
        txt = plan_of(Q.QUERIES[key](spark, SF_SMALL))
        assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt, key


def test_join_reads_features_and_labels(spark):
    txt = plan_of(Q.q_keyed_join(spark, SF_SMALL))
    assert "p_size" in txt and "label" in txt


def test_building_labeled_docs_runs_no_job(spark):
    from sparkfit.plans.tables import labeled_docs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tracker, group = spark.sparkContext.statusTracker(), "building-labeled-docs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = labeled_docs(spark, SF_SMALL)
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
        jobs = [j for j in tracker.getJobIdsForGroup(group)]
        # Reading a table's schema from its footer is the only job: no shuffle stage.
        for j in jobs:
            assert len(tracker.getJobInfo(j).stageIds) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_rdd_and_no_forced_broadcast_of_vocabularies():
    import glob
    import os
    from conftest import ROOT
    for name in glob.glob(os.path.join(ROOT, "sparkfit", "**", "*.py"), recursive=True):
        source = open(name).read()
        assert not re.search(r"\.rdd\b|localCheckpoint", source), name


def test_svm_fit_keeps_the_input_s_partitions(spark, monkeypatch):
    from sparkfit.operators import svm
    seen = []

    class Probe:
        def __init__(self, **params):
            pass

        def fit(self, data):
            seen.append(data.select(F.spark_partition_id().alias("p")).distinct().count())

    monkeypatch.setattr(svm, "LinearSVC", Probe)
    rows = spark.range(0, 100, 1, 6).select(F.col("id").alias("features"), F.lit(1).alias("labels"))
    svm.fit_svm(rows)
    svm.fit_svm(rows, partitions=2)
    assert seen == [6, 2]
