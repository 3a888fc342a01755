"""The K most frequent words without shuffling every distinct word.

Each task keeps a Misra-Gries summary of its words: at most ``capacity`` counters,
all lowered by the same amount whenever there are more. Counters are lower bounds,
and no true count exceeds its counter (0 without one) by more than the sum of what
the tasks have taken off. So when the summaries are added up by word, the K-th
largest counter proves which words can be among the K first: only these are
counted again, exactly. Where the bound doesn't close (a word without any counter
could still be among them) all words are counted, the exact way.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.operators.rows import explode_items
from sparkfit.operators.text import lookup_vocab, top_words, word_count
from sparkfit.session import drop_table, ship_package, write_table

_SUMMARY = "word string, low bigint, taken bigint"


class MisraGries:
    """At most ``capacity`` counters of words; ``taken`` is how much too low a
    counter can be."""

    def __init__(self, capacity: int) -> None:
        if capacity < 1:
            raise ValueError("capacity must be 1 or more")
        self.capacity, self.taken = capacity, 0
        self.words, self.counts = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, words: pa.Array, counts: np.ndarray) -> None:
        """Add counts of different words."""
        both = pa.table({"w": pa.concat_arrays([self.words, words]), "n": np.concatenate([self.counts, counts])})
        total = both.group_by("w").aggregate([("n", "sum")])
        words, counts = total["w"].combine_chunks(), total["n_sum"].to_numpy()
        if len(words) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            keep = counts > cut
            self.taken += cut
            words, counts = words.filter(pa.array(keep)), counts[keep] - cut
        self.words, self.counts = words, counts


def word_summaries(docs: DataFrame, tokens: Column, capacity: int) -> DataFrame:
    """(word, low, taken): the counters of every task's summary; ``taken`` stands
    in one row of each task, without a word."""
    ship_package(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(capacity)
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            if len(found):
                summary.add(found.field("values").cast(pa.string()), found.field("counts").to_numpy(zero_copy_only=False))
        n = len(summary.words)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([summary.words, pa.array([None], pa.string())]),
             pa.array(np.append(summary.counts, 0)), pa.array([0] * n + [summary.taken], pa.int64())],
            names=["word", "low", "taken"])

    return docs.select(tokens.alias("tokens")).mapInArrow(run, _SUMMARY)


def frequent_words(docs: DataFrame, tokens: Column, k: int, capacity: int | None = None) -> DataFrame:
    """(word, cnt): as ``top_words`` over all tokens of ``docs`` (an array column),
    ties broken by the word, by summaries of ``capacity`` words a task (8 k)."""
    capacity = 8 * k if capacity is None else capacity
    low = write_table(word_summaries(docs, tokens, capacity).groupBy("word")
                      .agg(F.sum("low").alias("low"), F.sum("taken").alias("taken")), "word-summary")
    error = low.agg(F.sum("taken")).first()[0] or 0
    known = low.where(F.col("word").isNotNull()).select("word", F.col("low").alias("cnt"))
    least = top_words(known, k).agg(F.count("*").alias("n"), F.min("cnt").alias("least")).first()
    words = explode_items(docs, [], tokens, "token")
    # Without k counters, or with an error that reaches the k-th, a word that no task has kept may belong to the k first.
    if error and (least["n"] < k or error >= least["least"]):
        drop_table(low)
        return top_words(word_count(words), k)
    able = write_table(known.where(F.col("cnt") + error >= (least["least"] or 0)).select("word", F.lit(0).alias("idx")),
                       "frequent-candidates")
    drop_table(low)
    again = lookup_vocab(words.select(F.col("token").alias("word")), able)
    return top_words(word_count(again, "word"), k)
