"""CSV records with line breaks in quotes, read in blocks, and type inference."""

import csv
import io
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sparkfit.sources import csv_records, read_csv, read_csv_inferred, write_csv

TEXTS = ["plain", "", "a,b", 'say "hi"', "two\nlines", '"\n"', "\n\n\n", " padded ", "x" * 300, "tab\t", "ünï\n日本",
         'ends with quote"', '"', ",", "a\rb", None]


def one_file(path, rows, header=("id", "text"), end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    w.writerow(header)
    for r in rows:
        out.write(",".join('\\N' if v is None else '"' + str(v).replace('"', '""') + '"' for v in r) + end)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(TEXTS) if rng.random() < 0.9 else "\n".join(["long"] * rng.randrange(1, 900)))
            for i in range(300)]
    one_file(tmp_path / "one.csv", rows, end="\r\n" if seed == 2 else "\n")
    assert csv_records(spark, str(tmp_path)).where("not first").select(F.spark_partition_id()).distinct().count() > 5
    got = read_csv(spark, str(tmp_path), "id int, text string", multi_line=True).collect()
    assert sorted(map(tuple, got)) == rows


def test_many_files_and_empty_ones(spark, tmp_path, small_blocks):
    rows = {n: [(100 * n + i, t) for i, t in enumerate(TEXTS * 3)] for n in range(4)}
    for n, r in rows.items():
        one_file(tmp_path / f"part{n}.csv", r if n else [])
    got = read_csv(spark, str(tmp_path), "id int, text string", multi_line=True).collect()
    assert sorted(map(tuple, got)) == sorted(r for n, part in rows.items() if n for r in part)


def test_blocks_inside_one_field(spark, tmp_path, small_blocks):
    """A text longer than many blocks, made of line breaks, quotes and commas."""
    text = '\n'.join(f'line {i}, "quoted"' for i in range(2000))
    one_file(tmp_path / "a.csv", [(1, "x"), (2, text), (3, "y\nz"), (4, text + '"')])
    got = read_csv(spark, str(tmp_path), "id int, text string", multi_line=True).collect()
    assert sorted(map(tuple, got)) == [(1, "x"), (2, text), (3, "y\nz"), (4, text + '"')]


def test_given_documents_round_trip(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = write_csv(docs.coalesce(1), str(tmp_path / "one"))
    back = read_csv(spark, path, docs.schema, multi_line=True)
    assert back.exceptAll(docs).count() == 0 and back.count() == docs.count()


def test_a_record_that_does_not_fit_fails_the_read(spark, tmp_path):
    one_file(tmp_path / "a.csv", [("x", "t")])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path), "id int, text string", multi_line=True).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_types_are_inferred_from_all_values(spark, tmp_path, multi_line):
    rows = [(i, i * 7 if i % 3 else None, f"{i}.5" if i == 999 else i, None, "1e3" if i % 2 else " -2 ",
             "text" if i == 998 else i, 10 ** 25 if i == 5 else 1) for i in range(1000)]
    one_file(tmp_path / "a.csv", rows, ["a", "b", "c", "none", "real", "mixed", "wide"])
    df = read_csv_inferred(spark, str(tmp_path), multi_line)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("a", "bigint"), ("b", "bigint"), ("c", "double"), ("none", "string"), ("real", "double"), ("mixed", "string"),
        ("wide", "double")]
    got = {r["a"]: tuple(r) for r in df.collect()}
    assert got[4] == (4, 28, 4.0, None, -2.0, "4", 1.0) and got[5][4] == 1000.0 and got[998][5] == "text" and len(got) == 1000


def test_inference_of_an_empty_file(spark, tmp_path):
    one_file(tmp_path / "a.csv", [])
    df = read_csv_inferred(spark, str(tmp_path), True)
    assert df.columns == ["id", "text"] and df.collect() == []


def test_models_score_rows_after_an_inferred_read(spark, tmp_path):
    """A session that reads inferred CSV still serializes, as a model's summary needs."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    one_file(tmp_path / "a.csv", [(i, "t") for i in range(9)])
    session = spark.newSession()
    assert read_csv_inferred(session, str(tmp_path)).count() == 9
    rows = session.createDataFrame([(Vectors.dense(float(i - 10)), float(i > 10)) for i in range(20)], ["features", "label"])
    model = LinearSVC(maxIter=5).fit(rows)
    assert model.transform(rows).count() == 20 and model.transform(rows).select("prediction").distinct().count() == 2
