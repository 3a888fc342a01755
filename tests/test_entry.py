"""Driver contract smoke checks."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

import __spark_entry__ as entry_mod


def test_entry_runs_on_sf0001(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["app", "rating", "rating_count", "min_install", "price", "max_install"]


def test_queries_and_oracle_keys():
    from sparkfit.plans.queries import QUERIES
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(QUERIES) <= set(q) and set(o) <= set(q)
    assert set(QUERIES) - set(o) == {"svm_eval"}


def test_entry_without_the_training_data_operators(tmp_path):
    """The rest imports and answers when that subpackage is not there."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(
        "llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse"))
    code = ("import __spark_entry__ as e; from sparkfit.plans.queries import QUERIES; "
            "assert set(e.queries()) == set(QUERIES), e.queries().keys(); print('WITHOUT-OK')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True,
                         text=True, timeout=120)
    assert "WITHOUT-OK" in out.stdout, out.stderr[-2000:]
