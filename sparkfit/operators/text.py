"""Words, counts, top-K vocabulary and term frequencies, all in long form.

Tokens are exploded in the JVM (no driver hop). Counting is map-side combined.
Joins to a vocabulary carry no hint: write it as a table first (``write_table``)
and Spark broadcasts it by its measured size, or shuffles when it is larger
than ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfit.functions.strings import char_array, letter_token_array, name_word_array
from sparkfit.operators.rows import explode_items
from sparkfit.operators.svm import sparse_entries, tf_vectors

# Fixed value: the vocabulary size of both classifiers.
VOCAB_SIZE = 20000


def name_words(df: DataFrame, name: str, distinct: bool = True) -> DataFrame:
    """(name, word): each name split on blanks, non-alphanumerics stripped,
    empty pieces dropped; repeated words in a name stay repeated."""
    names = df.select(F.col(name).alias("name"))
    if distinct:
        names = names.distinct()
    return explode_items(names, ["name"], name_word_array("name"), "word")


def doc_tokens(df: DataFrame, id_col: str, text_col: str, with_pos: bool = True) -> DataFrame:
    """(id, pos, token): letters-only lower-case tokens of each text, in order."""
    toks = letter_token_array(text_col)
    return explode_items(df, [F.col(id_col).alias("id")], toks, "token",
                         "pos" if with_pos else None)


def word_count(tokens: DataFrame, word: str = "token") -> DataFrame:
    """(word, cnt) over a token column."""
    return tokens.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("cnt"))


def top_words(counts: DataFrame, k: int = VOCAB_SIZE) -> DataFrame:
    """The K most frequent words; ties broken by the word itself.

    A histogram of the counts (one row per distinct count) gives the smallest
    count that can be among the K first; only words that reach it are ordered,
    so the final order takes K rows and the ties at that count, not K rows from
    every partition.
    """
    sizes = counts.groupBy("cnt").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("cnt"))) - F.col("n")
    least = sizes.withColumn("above", above).where(F.col("above") < k).agg(F.min("cnt").alias("least"))
    return counts.where(F.col("cnt") >= least.scalar()).orderBy(F.desc("cnt"), F.asc("word")).limit(k)


def vocabulary(counts: DataFrame, k: int = VOCAB_SIZE) -> DataFrame:
    """(word, idx, cnt): rank by falling count from 0, for at most K words.

    The window runs after the limit, so it orders at most K rows.
    """
    order = Window.orderBy(F.desc("cnt"), F.asc("word"))
    return (top_words(counts, k)
            .withColumn("idx", (F.row_number().over(order) - 1).cast("int"))
            .select("word", "idx", "cnt"))


def lookup_vocab(df: DataFrame, vocab: DataFrame, on: str = "word", how: str = "inner") -> DataFrame:
    """Join to a vocabulary; Spark picks the method by the vocabulary's size."""
    return df.join(vocab.select(on, "idx"), on, how)


def term_frequency(tokens: DataFrame, vocab: DataFrame, id_col: str = "id", word: str = "token") -> DataFrame:
    """(id, idx, tf): count of each known word per row; unknown words drop.

    The vocabulary join comes first, so that the shuffle carries small integer
    indexes and already-combined counts instead of word strings. Tokens that
    are partitioned by id already aren't shuffled again.
    """
    known = lookup_vocab(tokens.select(id_col, F.col(word).alias("word")), vocab)
    return known.groupBy(id_col, "idx").agg(F.count("*").alias("tf"))


def counted_words(df: DataFrame, keep: list[str], tokens: Column, words: list[str]) -> DataFrame:
    """(keep..., idx, tf): for each row the indexes of its known words, rising,
    and their counts, as two arrays (empty where it has none).

    ``words`` is the vocabulary in idx order, at most K words. A row is counted
    where it lies: no token is exploded, and nothing is shuffled."""
    if not words:
        return df.select(*keep, F.array().cast("array<int>").alias("idx"), F.array().cast("array<double>").alias("tf"))
    rows = df.select(*keep, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens_"))
    v = F.unwrap_udt("tf_")
    return tf_vectors(rows, words, "tokens_", "tf_").select(*keep, v["indices"].alias("idx"), v["values"].alias("tf"))


def term_counts(df: DataFrame, id_col: str, tokens: Column, words: list[str]) -> DataFrame:
    """(id, idx, tf): count of each known word per row, as ``term_frequency`` gives
    from exploded tokens, but counted in the row; unknown words drop."""
    if not words:
        return counted_words(df, [id_col], tokens, words).select(id_col, F.inline(F.arrays_zip("idx", "tf"))) \
            .withColumn("tf", F.col("tf").cast("bigint"))
    rows = df.select(id_col, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens_"))
    return sparse_entries(tf_vectors(rows, words, "tokens_", "tf_"), [id_col], "tf_") \
        .withColumn("tf", F.col("tf").cast("bigint"))


def _times(text: Column, ch: Column) -> Column:
    """How often a character is in a text: what its removal takes off the length."""
    return F.char_length(text) - F.char_length(F.replace(text, ch, F.lit("")))


def char_frequency(df: DataFrame, id_col: str, text_col: str,
                   vocab: DataFrame | None = None) -> DataFrame:
    """Per-row counts of each *character*, counted in the row.

    Without ``vocab``: (id, ch, tf). With it: (id, idx, tf) for characters that
    are one-letter words of the vocabulary (only these go to the driver), which
    is what counting a string against a word list gives. An empty text has no
    rows.
    """
    text = F.col(text_col)
    if vocab is None:
        found = F.transform(F.array_distinct(char_array(text)),
                            lambda c: F.struct(c.alias("ch"), _times(text, c).cast("bigint").alias("tf")))
    else:
        letters = [(r["idx"], r["word"]) for r in vocab.where(F.char_length("word") == 1).select("idx", "word").collect()]
        found = F.array(*[F.struct(F.lit(i).alias("idx"), _times(text, F.lit(w)).cast("bigint").alias("tf"))
                          for i, w in letters]) if letters \
            else F.array().cast("array<struct<idx: int, tf: bigint>>")
    return df.select(id_col, F.inline_outer(found)).where(F.col("tf") > 0)


def corpus_counts(df: DataFrame, text_col: str) -> DataFrame:
    """One row: rows, tokens, distinct words, in one aggregation.

    ``posexplode_outer`` keeps token-less rows (pos NULL), so every input row
    contributes exactly one row with pos 0 or NULL.
    """
    toks = df.select(F.posexplode_outer(letter_token_array(text_col)).alias("pos", "token"))
    return toks.agg(
        F.count_if(F.coalesce(F.col("pos") == 0, F.lit(True))).alias("n_rows"),
        F.count("token").alias("n_tokens"),
        F.count_distinct("token").alias("n_words"),
    )
