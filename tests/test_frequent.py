"""Heavy hitters against full counts."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sparkfit.functions import letter_token_array
from sparkfit.operators import frequent
from sparkfit.operators.text import top_words, word_count


def docs_of(spark, words, partitions=4):
    rows = [(words[i:i + 50],) for i in range(0, len(words), 50)] + [(None,), ([],)]
    return spark.createDataFrame(rows, "tokens array<string>").repartition(partitions)


def plain(words, k):
    return sorted(Counter(words).items(), key=lambda e: (-e[1], e[0]))[:k]


def skewed(n=20_000, seed=0):
    rng = np.random.default_rng(seed)
    return [f"w{min(int(x), 5000)}" for x in rng.zipf(1.5, n)]


@pytest.mark.parametrize("capacity", [1, 5, 60, 5000])
@pytest.mark.parametrize("k", [1, 10, 300])
def test_equal_to_full_counts(spark, k, capacity):
    words = skewed()
    got = frequent.frequent_words(docs_of(spark, words), F.col("tokens"), k, capacity).collect()
    assert [tuple(r) for r in got] == plain(words, k)


def full_counts(monkeypatch):
    """How many times all words are counted."""
    seen = []
    count = frequent.word_count
    monkeypatch.setattr(frequent, "word_count", lambda t, word="token": seen.append(word) or count(t, word))
    return seen


def test_falls_back_where_the_bound_does_not_close(spark, monkeypatch):
    words = [f"w{i % 997:03}" for i in range(9970)]       # all words are equally frequent
    seen = full_counts(monkeypatch)
    got = frequent.frequent_words(docs_of(spark, words), F.col("tokens"), 20, 100).collect()
    assert [tuple(r) for r in got] == plain(words, 20) and seen == ["token"]


def test_counts_candidates_only_where_it_closes(spark, monkeypatch):
    words = skewed() + [f"once{i}" for i in range(20_000)]
    seen = full_counts(monkeypatch)
    df = docs_of(spark, words)
    got = frequent.frequent_words(df, F.col("tokens"), 10, 500).collect()
    assert [tuple(r) for r in got] == plain(words, 10) and seen == ["word"]
    shuffled = frequent.word_summaries(df, F.col("tokens"), 500).count()
    assert shuffled <= 4 * 501 < len(set(words)) / 5


def test_summary_bounds():
    words, true = skewed(5000, 3), Counter()
    s = frequent.MisraGries(40)
    for i in range(0, len(words), 100):
        part = Counter(words[i:i + 100])
        true += part
        s.add(pa.array(list(part)), np.array(list(part.values())))
        low = dict(zip(s.words.to_pylist(), s.counts.tolist(), strict=True))
        assert len(low) <= 40
        assert all(low.get(w, 0) <= n <= low.get(w, 0) + s.taken for w, n in true.items())


def test_edges(spark):
    for words in ([], ["a"], ["b", "a"]):
        got = frequent.frequent_words(docs_of(spark, words), F.col("tokens"), 3).collect()
        assert [tuple(r) for r in got] == plain(words, 3)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tokens = docs.select(F.explode(letter_token_array("text")).alias("token"))
    want = top_words(word_count(tokens), 200).collect()
    assert frequent.frequent_words(docs, letter_token_array("text"), 200).collect() == want
