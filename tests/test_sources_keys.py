"""Sources/sinks round trips and the key operators, on small inputs."""

import tempfile

from sparkfit.operators import key_index, keyed_join_sorted, sort_desc_positions
from sparkfit.session import scratch_path, write_table
from sparkfit.sources import read_csv, read_lines, write_csv, write_lines


def test_csv_round_trip_keeps_quoted_commas(spark):
    df = spark.createDataFrame([(1, 'Big, App', 4.5), (2, 'say "hi"', None), (3, "plain", 1.0)],
                               "id INT, app STRING, rating DOUBLE")
    path = write_csv(df, tempfile.mkdtemp(prefix="sparkfit-csv-") + "/out")
    back = read_csv(spark, path, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == \
        [(1, 'Big, App', 4.5), (2, 'say "hi"', None), (3, "plain", 1.0)]
    inferred = read_csv(spark, path)
    assert dict(inferred.dtypes)["rating"] == "double"


def test_text_round_trip_one_row_per_line(spark):
    df = spark.createDataFrame([("a,b",), ("",), ("x y",)], "value STRING")
    path = write_lines(df, tempfile.mkdtemp(prefix="sparkfit-txt-") + "/out")
    assert sorted(r["value"] for r in read_lines(spark, path).collect()) == ["", "a,b", "x y"]


def test_scratch_paths_live_under_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/sparkfit-scratch/")
    t = write_table(spark.range(3), "probe")
    assert t.count() == 3


def test_key_index_takes_last_position(spark):
    df = spark.createDataFrame([(5, "b"), (1, "a"), (9, "a"), (3, "c"), (7, "b")], "k INT, name STRING")
    got = {r["name"]: r["id"] for r in key_index(df, "name", ["k"]).collect()}
    # order by k: 1 a, 3 c, 5 b, 7 b, 9 a -> last positions a:4, b:3, c:1
    assert got == {"a": 4, "b": 3, "c": 1}


def test_keyed_join_sorted_numbers_rows_in_key_order(spark):
    left = spark.createDataFrame([(i, f"d{i}") for i in range(50, 0, -1)], "doc_id INT, t STRING")
    right = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)], "doc_id INT, y INT")
    out = keyed_join_sorted(left, right, "doc_id").orderBy("pos").collect()
    assert [r["doc_id"] for r in out] == [i for i in range(3, 51, 3)]
    assert [r["pos"] for r in out] == list(range(len(out)))


def test_sort_desc_positions_text_order(spark):
    df = spark.createDataFrame([("9",), ("10",), ("AU1",), ("b",)], "doc_id STRING")
    out = sort_desc_positions(df, "doc_id").orderBy("pos").collect()
    assert [r["doc_id"] for r in out] == sorted(["9", "10", "AU1", "b"], reverse=True)


def test_tables_are_dealt_only_where_the_session_says(spark):
    from conftest import SF_SMALL
    from sparkfit.plans.tables import INPUT_PARTITIONS, table
    whole = table(spark, SF_SMALL, "documents", "doc_id", deal_by="doc_id")
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(INPUT_PARTITIONS, "6")
    try:
        dealt = table(spark, SF_SMALL, "documents", "doc_id", deal_by="doc_id")
        assert "hashpartitioning(doc_id" in dealt._jdf.queryExecution().executedPlan().toString()
        assert sorted(dealt.collect()) == sorted(whole.collect())
    finally:
        spark.conf.unset(INPUT_PARTITIONS)


def test_csv_round_trip_is_value_for_value(spark, tmp_path):
    texts = ["  lead and trail  ", "", None, "line\nbreak", "two\r\nbreaks\n", 'a "quoted", part', "\ttab\t",
             "back\\slash", "'single'", "null", " ", "é 中 🎉", '"', ",", "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    path = write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, path, schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == list(enumerate(texts))


def test_csv_reads_fail_rather_than_lose_values(spark, tmp_path):
    import pytest
    (tmp_path / "bad.csv").write_text("id,n\n1,2\n2,text\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "bad.csv"), schema="id INT, n INT").collect()


def test_exact_sample_is_the_first_by_hash_whatever_the_cut(spark):
    from sparkfit.sources import sample_exact, sample_key
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    order = [r["k"] for r in df.orderBy(sample_key(["k"], 9)).collect()]
    for n in (0, 1, 37, 4999, 5000, 9000):
        assert {r["k"] for r in sample_exact(df.repartition(5), n, ["k"], seed=9).collect()} == set(order[:n])


def test_scratch_is_removed_through_sql(spark):
    from sparkfit.session import drop_table
    t = write_table(spark.range(5), "probe-drop")
    name = [x.name for x in spark.catalog.listTables(spark_db(spark)) if "probe_drop" in x.name]
    assert len(name) == 1 and t.count() == 5
    drop_table(t)
    assert not [x for x in spark.catalog.listTables(spark_db(spark)) if "probe_drop" in x.name]


def spark_db(spark):
    from sparkfit.session import scratch_database
    return scratch_database(spark)
