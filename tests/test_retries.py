"""Failed and retried tasks leave results exact (run in a separate JVM that
allows task retries: master local[4,2])."""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, sys.argv[1])
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from sparkfit.session import build_session
    from sparkfit.operators import row_positions, entity_features

    spark = build_session("local[4,2]", 4, app_name="sparkfit-retries")

    @F.udf(T.LongType())
    def flaky(v):
        # every task fails on its first attempt, then succeeds
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return v

    n = 5000
    df = spark.range(0, n, 1, numPartitions=4).select(
        flaky(F.col("id")).alias("k"), (F.col("id") % 17).cast("string").alias("g"))
    pos = row_positions(df, [F.col("k").desc()], num_partitions=5).collect()
    assert sorted((r["pos"], r["k"]) for r in pos) == [(i, n - 1 - i) for i in range(n)]

    rows = df.select(F.col("g").alias("app"), F.col("k").cast("double").alias("rating"),
                     F.lit(1.0).alias("rating_count"), F.lit(0.0).alias("min_install"),
                     F.lit(1.0).alias("max_install"), F.lit(2.0).alias("price"))
    got = {r["app"]: r["rating_count"] for r in entity_features(rows).collect()}
    want = {}
    for i in range(n):
        want[str(i % 17)] = want.get(str(i % 17), 0.0) + 1.0
    assert got == want

    # The same fit on rows that no task fails on gives the same weights.
    from sparkfit.operators import build_examples, fit_logistic
    cells = [(i, j, float(1 + (i * j) % 3)) for i in range(40) for j in range(6) if (i + 2 * j) % 4]
    labels = spark.createDataFrame([(i, int(i % 5 < 2)) for i in range(40)], "id BIGINT, y INT")
    vocab = spark.createDataFrame([(j,) for j in range(6)], "idx INT")
    calm = spark.createDataFrame(cells, "id BIGINT, idx INT, tf DOUBLE").repartition(3)
    fits = []
    for tf in (calm, calm.select(flaky(F.col("id")).alias("id"), "idx", "tf")):
        fit = fit_logistic(build_examples(tf, labels), vocab, rate=0.05, steps=4, l2=0.01, init=0.2)
        fits.append([r["w"] for r in fit.weights.orderBy("idx").collect()])
    assert len(fits[0]) == 6 and max(abs(x - y) for x, y in zip(*fits)) < 1e-14, fits
    print("RETRIES-OK")
""")


def test_results_exact_under_task_retries(tmp_path):
    script = tmp_path / "retries.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script), ROOT], capture_output=True, text=True,
                         timeout=600, env=dict(os.environ))
    assert "RETRIES-OK" in out.stdout, out.stderr[-3000:]
    assert "injected task failure" in out.stderr      # failures really happened
