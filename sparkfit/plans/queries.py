"""One query per operator key, on the driver's Parquet tables.

Each function takes (spark, sf_dir) and returns a DataFrame. Floating columns
whose last bits depend on summation order are rounded, so that results hash
the same across engines and partitionings; column names match
``sparkfit.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfit.functions.numeric import rounded
from sparkfit.functions.strings import letter_token_array, prefix_label
from sparkfit.operators import (aggregate, clean, combine, docs, frequent, gradient, keys, logistic, metrics,
                                regression, svm, text)
from sparkfit.operators.rows import explode_items, filter_late
from sparkfit.plans.tables import app_lines, doc_lines, labeled_docs, table
from sparkfit.session import scratch_path, write_table
from sparkfit.sources import hash_split, read_csv, read_csv_inferred, read_lines, sample_exact, write_csv, write_lines

# Fixed query parameters.
SAMPLE_N = 10_000
SAMPLE_SEED = 42
SPLIT_SEED = 42
SPLIT_FRACTION = 0.5
LABEL_PREFIX = "la"
LOGIT_INIT = 0.01
START_SEED = 7
STOP_TOL = 0.0275         # between the moves of the norm in the second and the last step
TOP_VALUES = 3
FREQUENT = 5_000
MIXED_LANG = "de"         # whose documents have a word in an otherwise numeric column
LIST_ROWS = 256
# Sums of prices are expressed in units of 10,000 in the four-feature descents,
# so that rate * mean(x^2) stays far below 2 and the descent converges.
PRICE_SUM_UNIT = 10000.0

SAMPLE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
ALL_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def q_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = app_lines(table(spark, sf_dir, "part", *ALL_PART))
    path = write_lines(lines, scratch_path(spark, "text_scan"))
    return read_lines(spark, path)


def q_split_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_rows(app_lines(table(spark, sf_dir, "part", *ALL_PART)))


def q_project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.clean_rows(app_lines(table(spark, sf_dir, "part", *ALL_PART)))
    # min_install carries the part key: it keeps rows distinct ahead of the
    # NaN-bearing rating column when results are sorted for comparison.
    return clean.project_pairs(rows, "app", ["min_install", "rating", "max_install"])


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars", deal_by="doc_id")
    path = write_csv(docs, scratch_path(spark, "csv_roundtrip"))
    return read_csv(spark, path, schema=docs.schema, multi_line=True)


def q_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, inferred types and values of the columns of written documents."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars", deal_by="doc_id")
    mixed = F.when(F.col("lang") == MIXED_LANG, F.lit("n/a")).otherwise(F.col("n_chars").cast("string"))
    path = write_csv(d.withColumn("quarter", F.col("n_chars") / 4).withColumn("mixed", mixed)
                     .withColumn("never", F.lit(None).cast("string")), scratch_path(spark, "csv_infer"))
    back = read_csv_inferred(spark, path, multi_line=True)
    counts = back.agg(*[F.count(c).alias(c) for c in back.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f.name).alias("n_values")) for i, f in enumerate(back.schema.fields)])))


def q_sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", *SAMPLE_COLUMNS)
    return sample_exact(lines, SAMPLE_N, SAMPLE_COLUMNS[:4], SAMPLE_SEED)


def q_ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_size", "p_retailprice")
    fit = regression.ols_fit(part, "p_retailprice", "p_size")
    return fit.select(F.col("n").cast("bigint").alias("n"),
                      rounded(F.col("slope"), 8).alias("slope"),
                      rounded(F.col("intercept"), 8).alias("intercept"),
                      F.format_string("y = %.4fX + %.4f", "slope", "intercept").alias("equation"))


def q_gd_univariate_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_size", "p_retailprice").select(
        F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    trace = regression.descent_trace(part, "y", "x")
    return trace.select(F.col("iteration").cast("int").alias("iteration"),
                        rounded(F.col("beta"), 9).alias("beta"),
                        rounded(F.col("cost"), 1).alias("cost"))


def _line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax")
    return aggregate.entity_features(li, key="l_partkey", rating="l_quantity",
                                     rating_count="l_extendedprice", min_install="l_discount",
                                     price="l_tax", max_install="l_tax")


def q_entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _line_features(spark, sf_dir)
    return f.select(F.col("l_partkey").alias("app"),
                    rounded(F.col("rating"), 8).alias("rating"),
                    rounded(F.col("rating_count"), 4).alias("rating_count"),
                    "min_install",
                    rounded(F.col("price"), 8).alias("price"),
                    "max_install")


def q_gd_independent_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _line_features(spark, sf_dir).select(
        F.col("rating"), (F.col("rating_count") / F.lit(PRICE_SUM_UNIT)).alias("rating_count"),
        F.col("min_install").cast("double").alias("min_install"), F.col("price"),
        F.col("max_install").cast("double").alias("y"))
    xs = ["rating", "rating_count", "min_install", "price"]
    trace = regression.independent_descent_trace(f, "y", xs)
    return trace.select(F.col("iteration").cast("int").alias("iteration"),
                        *[rounded(F.col(f"beta_{x}"), 9).alias(f"beta_{x}") for x in xs],
                        rounded(F.col("cost"), 3).alias("cost"))


def q_collect_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity")
    return aggregate.collect_by_key(li, "l_suppkey", "l_quantity")


def q_combine_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest ids of the documents of each length, by a combiner of our own."""
    def largest(values):
        return sorted(values, reverse=True)[:TOP_VALUES]

    d = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    out = combine.combine_by_key(d, "n_chars", "doc_id", lambda v: [v], lambda c, v: largest([*c, v]),
                                 lambda a, b: largest(a + b), "array<bigint>")
    return out.select(F.col("key").alias("n_chars"),
                      F.array_join(F.col("combiner").cast("array<string>"), ",").alias("largest"))


def q_lists_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lengths of each source's documents as sorted lists of bounded size."""
    d = table(spark, sf_dir, "documents", "source", "n_chars")
    out = combine.lists_by_key(d, "source", "n_chars", LIST_ROWS)
    return out.select(F.col("key").alias("source"), "part", "n",
                      F.array_join(F.col("values").cast("array<string>"), ",").alias("lengths"))


def q_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.distinct_keys(table(spark, sf_dir, "part", "p_name"), "p_name")


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.corpus_counts(table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id"),
                              "text")


def q_name_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.name_words(table(spark, sf_dir, "part", "p_name"), "p_name")


def _doc_tokens(spark: SparkSession, sf_dir: str, with_pos: bool = False) -> DataFrame:
    return text.doc_tokens(table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id"),
                           "doc_id", "text", with_pos=with_pos)


def q_doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_tokens(spark, sf_dir, with_pos=True).select(
        F.col("id").alias("doc_id"), F.col("pos").cast("bigint").alias("pos"), "token")


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(_doc_tokens(spark, sf_dir))


def q_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.top_words(text.word_count(_doc_tokens(spark, sf_dir)), text.VOCAB_SIZE)


def q_frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words, by summaries and an exact recount of candidates."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id")
    return frequent.frequent_words(d, letter_token_array("text"), FREQUENT)


def q_vocab_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.vocabulary(text.word_count(_doc_tokens(spark, sf_dir)), text.VOCAB_SIZE)


def _written_vocabulary(tokens: DataFrame) -> DataFrame:
    """The vocabulary as a table: joins to it go by its measured size."""
    return write_table(text.vocabulary(text.word_count(tokens), text.VOCAB_SIZE), "vocabulary")


def _vocabulary_words(tokens: DataFrame) -> list[str]:
    """The vocabulary's words in idx order; at most K of them."""
    return svm.vocab_words(text.vocabulary(text.word_count(tokens), text.VOCAB_SIZE))


def q_term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id")
    return text.term_counts(d, "doc_id", letter_token_array("text"), _vocabulary_words(_doc_tokens(spark, sf_dir)))


def q_char_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _written_vocabulary(_doc_tokens(spark, sf_dir))
    d = table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id")
    return text.char_frequency(d, "doc_id", "text", vocab)


def q_char_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.char_frequency(table(spark, sf_dir, "documents", "doc_id", "source"), "doc_id", "source")


def q_holdout_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", deal_by="doc_id")
    train, test = hash_split(d, ["doc_id"], SPLIT_FRACTION, SPLIT_SEED)
    words = _vocabulary_words(text.doc_tokens(train, "doc_id", "text", False))
    return text.term_counts(test, "doc_id", letter_token_array("text"), words)


def q_prefix_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return part.select("p_partkey", "p_name", prefix_label("p_name", LABEL_PREFIX).alias("label"))


def q_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return keys.key_index(part, "p_name", ["p_partkey"])


def q_keyed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    ids = keys.key_index(part, "p_name", ["p_partkey"])
    feats = part.join(ids, "p_name").select("id", "p_size")
    labels = ids.select("id", prefix_label("p_name", LABEL_PREFIX).alias("label"))
    return keys.keyed_join(feats, labels, "id")


def q_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the labelled ones, by language."""
    d = table(spark, sf_dir, "documents", "doc_id", "lang")
    labelled = d.join(table(spark, sf_dir, "labels", "doc_id"), "doc_id")
    return keys.join_fanout(d, labelled, "lang")


def q_keyed_join_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return keys.keyed_join_sorted(d, lab, "doc_id")


def q_doc_tag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = doc_lines(table(spark, sf_dir, "documents", "doc_id", "text", "lang", deal_by="doc_id"))
    return docs.parse_doc_tags(lines, keep=["src_id"])


def q_doc_sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = doc_lines(table(spark, sf_dir, "documents", "doc_id", "text", "lang", deal_by="doc_id"))
    parsed = filter_late(docs.parse_doc_tags(lines), lambda r: r["doc_id"].isNotNull())
    words = parsed.select("doc_id", F.size(letter_token_array("text")).cast("bigint").alias("n_words"))
    return docs.sort_desc_positions(words, "doc_id")


def _logit_inputs(spark: SparkSession, sf_dir: str):
    """(examples, vocabulary table, tokenized labeled docs).

    The tokenized labeled documents feed both the vocabulary and the term
    frequencies, so they are persisted (the caller releases them once the
    examples are consumed); they are partitioned by document, so nothing that
    is grouped by document is shuffled again. The vocabulary is written as a
    table, so nothing downstream depends on the text lineage.
    """
    lab = labeled_docs(spark, sf_dir).select(
        "doc_id", letter_token_array("text").alias("tokens"), F.col("quality").alias("y")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    toks = explode_items(lab, [F.col("doc_id").alias("id")], F.col("tokens"), "token")
    vocab = _written_vocabulary(toks)
    ex = logistic.build_examples(text.term_frequency(toks, vocab), lab.select(F.col("doc_id").alias("id"), "y"))
    return ex, vocab, lab


def _logit_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(example rows, to be released by the caller, vocabulary) of the labeled
    documents. Their tokens feed the vocabulary and the rows: persisted once."""
    lab = labeled_docs(spark, sf_dir).select(
        "doc_id", letter_token_array("text").alias("tokens"), F.col("quality").alias("y")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        vocab = _written_vocabulary(explode_items(lab, ["doc_id"], F.col("tokens"), "token"))
        rows = gradient.persisted(gradient.example_rows(lab, "doc_id", "y", F.col("tokens"), svm.vocab_words(vocab)))
        rows.count()
    finally:
        lab.unpersist()
    return rows, vocab


def _logit_fit(spark: SparkSession, sf_dir: str, **params):
    rows, vocab = _logit_rows(spark, sf_dir)
    try:
        fit = gradient.fit_logistic_rows(rows, vocab.count(), **({"init": LOGIT_INIT} | params))
    finally:
        rows.unpersist()
    return vocab, fit


def _rounded_trace(fit: logistic.LogisticFit) -> DataFrame:
    return fit.trace.select("iteration", rounded(F.col("loss"), 9).alias("loss"),
                            rounded(F.col("acc"), 9).alias("acc"),
                            rounded(F.col("grad_norm"), 9).alias("grad_norm"))


def q_logit_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fit = _logit_fit(spark, sf_dir)
    return _rounded_trace(fit)


def _word_weights(vocab: DataFrame, fit: logistic.LogisticFit) -> DataFrame:
    return fit.weights.join(vocab.select("word", "idx"), "idx").select(
        "idx", "word", rounded(F.col("w"), 10).alias("w"))


def q_logit_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_weights(*_logit_fit(spark, sf_dir))


def q_logit_random_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights fitted from a random start, with the step count."""
    vocab, fit = _logit_fit(spark, sf_dir, init=None, seed=START_SEED)
    return _word_weights(vocab, fit).withColumn("steps", F.lit(fit.trace.count()))


def q_logit_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of a fit whose tolerance stops it: the history ends before the
    stopping step, whose weights are moved but not shrunk."""
    vocab, fit = _logit_fit(spark, sf_dir, tol=STOP_TOL)
    return _word_weights(vocab, fit).select("*", F.lit(fit.trace.count()).alias("steps"),
                                            F.lit(fit.stopped_early).alias("stopped"))


def _logit_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document predictions of the fitted model, written to the shared
    folder while the example rows are still persisted."""
    rows, vocab = _logit_rows(spark, sf_dir)
    try:
        fit = gradient.fit_logistic_rows(rows, vocab.count(), init=LOGIT_INIT)
        return write_table(gradient.predict_logistic_rows(rows, fit.weights), "logit-pred")
    finally:
        rows.unpersist()


def q_logit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = _logit_predictions(spark, sf_dir)
    return pred.select(F.col("id").alias("doc_id"), "y", rounded(F.col("p"), 9).alias("p"), "pred")


def q_top_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab, fit = _logit_fit(spark, sf_dir)
    w = fit.weights.select("idx", rounded(F.col("w"), 10).alias("w"))
    return logistic.top_coefficients(w, vocab, 5)


def q_confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics.confusion_metrics(_logit_predictions(spark, sf_dir), "y", "pred")
    return m.select(rounded(F.col("acc"), 9).alias("acc"), "tp", "fp", "fn", "tn",
                    rounded(F.col("f1"), 9).alias("f1"))


def _finite_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App records cleaned for fits: a NaN or infinite field drops its line."""
    return clean.clean_rows(app_lines(table(spark, sf_dir, "part", *ALL_PART)), finite_only=True)


def q_line_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares (iteration -1: slope and intercept) and descent (each
    step's slope and cost) of rating by installs on cleaned lines."""
    rows = _finite_lines(spark, sf_dir)
    line = regression.ols_fit(rows, "rating", "max_install").select(
        F.lit(-1).alias("iteration"), rounded(F.col("slope"), 7).alias("slope"),
        rounded(F.col("intercept"), 7).alias("value"))
    steps = regression.descent_trace(rows, "rating", "max_install").select(
        F.col("iteration").cast("int").alias("iteration"), rounded(F.col("beta"), 7).alias("slope"),
        rounded(F.col("cost"), 1).alias("value"))
    return line.unionAll(steps)


def q_line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines rolled up per app, then the four-feature descent."""
    f = aggregate.entity_features(_finite_lines(spark, sf_dir)).select(
        "rating", (F.col("rating_count") / PRICE_SUM_UNIT).alias("rating_count"),
        F.col("min_install").cast("double").alias("min_install"), (F.col("price") / PRICE_SUM_UNIT).alias("price"),
        F.col("max_install").cast("double").alias("y"))
    xs = ["rating", "rating_count", "min_install", "price"]
    trace = regression.independent_descent_trace(f, "y", xs)
    return trace.select(F.col("iteration").cast("int").alias("iteration"),
                        *[rounded(F.col(f"beta_{x}"), 9).alias(f"beta_{x}") for x in xs],
                        rounded(F.col("cost"), 3).alias("cost"))


def q_name_logit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the cleaned lines' app names, labelled by prefix, fitted."""
    words = text.name_words(_finite_lines(spark, sf_dir), "app").select(
        F.col("name").alias("id"), F.col("word").alias("token")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        vocab = _written_vocabulary(words)
        labels = words.select("id").distinct().select("id", prefix_label("id", LABEL_PREFIX).alias("y"))
        fit = logistic.fit_logistic(logistic.build_examples(text.term_frequency(words, vocab), labels), vocab,
                                    init=LOGIT_INIT)
    finally:
        words.unpersist()
    return _rounded_trace(fit)


def q_multiclass_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels", "quality", "toxic")
    pred = lab.select(F.col("quality").alias("label"),
                      (F.col("toxic") == 0).cast("int").alias("prediction"))
    m = metrics.multiclass_metrics(pred, "label", "prediction")
    return m.select(rounded(F.col("accuracy"), 9).alias("accuracy"),
                    rounded(F.col("weighted_f1"), 9).alias("weighted_f1"))


def _svm_halves(spark: SparkSession, sf_dir: str):
    """(labeled token rows to release, train vectors, test vectors) over the
    train half's vocabulary. The rows feed the vocabulary and both halves'
    vectors: persisted once, released by the caller."""
    lab = labeled_docs(spark, sf_dir).select(
        "doc_id", letter_token_array("text").alias("tokens"), F.col("quality").alias("labels")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = hash_split(lab, ["doc_id"], SPLIT_FRACTION, SPLIT_SEED)
    toks = explode_items(train, ["doc_id"], F.col("tokens"), "token")
    words = svm.vocab_words(text.vocabulary(text.word_count(toks), text.VOCAB_SIZE))
    return lab, svm.tf_vectors(train, words), svm.tf_vectors(test, words)


def q_svm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of the vectors that the SVM is fitted and scored on."""
    lab, train, test = _svm_halves(spark, sf_dir)
    try:
        rows = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        entries = svm.sparse_entries(rows, ["doc_id", "split", F.col("labels").alias("label")])
        return write_table(entries.withColumn("tf", F.col("tf").cast("bigint")), "svm-features")
    finally:
        lab.unpersist()


def _svm_rows(spark: SparkSession, sf_dir: str):
    """(labeled token rows to release, train rows, test rows, vocabulary size)."""
    lab = labeled_docs(spark, sf_dir).select(
        "doc_id", letter_token_array("text").alias("tokens"), F.col("quality").alias("labels")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = hash_split(lab, ["doc_id"], SPLIT_FRACTION, SPLIT_SEED)
    words = _vocabulary_words(explode_items(train, ["doc_id"], F.col("tokens"), "token"))
    rows = [gradient.example_rows(half, "doc_id", "labels", F.col("tokens"), words) for half in (train, test)]
    return lab, gradient.persisted(rows[0]), rows[1], len(words)


def q_svm_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss, gradient norm and errors of each pass of the batch SVM fit."""
    lab, train, _, k = _svm_rows(spark, sf_dir)
    try:
        fit = gradient.fit_svm_rows(train, k)
    finally:
        train.unpersist()
        lab.unpersist()
    return fit.trace.select("iteration", rounded(F.col("loss"), 7).alias("loss"),
                            rounded(F.col("grad_norm"), 7).alias("grad_norm"), "errors",
                            rounded(F.col("target"), 7).alias("target"))


def q_svm_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test half scored by the batch SVM fitted on the train half."""
    lab, train, test, k = _svm_rows(spark, sf_dir)
    try:
        fit = gradient.fit_svm_rows(train, k)
        pred = write_table(gradient.predict_svm_rows(test, fit), "svm-pred")
    finally:
        train.unpersist()
        lab.unpersist()
    return pred.select(F.col("id").alias("doc_id"), F.col("y").alias("label"),
                       rounded(F.col("score"), 6).alias("score"), F.col("pred").alias("prediction"),
                       F.lit(fit.best).alias("best"))


def q_svm_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab, train, test = _svm_halves(spark, sf_dir)
    try:
        scored = svm.evaluate_svm(svm.fit_svm(train, label="labels"), test, label="labels")
        return write_table(scored.select(F.col("n").alias("n_test"),
                                         rounded(F.col("accuracy"), 9).alias("accuracy"),
                                         rounded(F.col("weighted_f1"), 9).alias("weighted_f1")),
                           "svm-metrics")
    finally:
        lab.unpersist()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "text_scan": q_text_scan,
    "split_clean": q_split_clean,
    "project_cast": q_project_cast,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_infer": q_csv_infer,
    "sample_exact": q_sample_exact,
    "ols_fit": q_ols_fit,
    "gd_univariate_trace": q_gd_univariate_trace,
    "entity_features": q_entity_features,
    "gd_independent_trace": q_gd_independent_trace,
    "collect_by_key": q_collect_by_key,
    "distinct_keys": q_distinct_keys,
    "row_counts": q_row_counts,
    "name_words": q_name_words,
    "doc_tokens": q_doc_tokens,
    "word_count": q_word_count,
    "top_words": q_top_words,
    "frequent_words": q_frequent_words,
    "vocab_index": q_vocab_index,
    "term_frequency": q_term_frequency,
    "char_frequency": q_char_frequency,
    "char_counts": q_char_counts,
    "holdout_features": q_holdout_features,
    "prefix_label": q_prefix_label,
    "key_index": q_key_index,
    "keyed_join": q_keyed_join,
    "join_fanout": q_join_fanout,
    "keyed_join_sorted": q_keyed_join_sorted,
    "doc_tag_parse": q_doc_tag_parse,
    "doc_sort_desc": q_doc_sort_desc,
    "logit_trace": q_logit_trace,
    "logit_weights": q_logit_weights,
    "logit_predict": q_logit_predict,
    "top_coefficients": q_top_coefficients,
    "confusion_metrics": q_confusion_metrics,
    "line_fit": q_line_fit,
    "line_features": q_line_features,
    "name_logit": q_name_logit,
    "multiclass_metrics": q_multiclass_metrics,
    "svm_features": q_svm_features,
    "svm_eval": q_svm_eval,
    "svm_trace": q_svm_trace,
    "svm_predict": q_svm_predict,
    "logit_random_start": q_logit_random_start,
    "logit_early_stop": q_logit_early_stop,
    "combine_by_key": q_combine_by_key,
    "lists_by_key": q_lists_by_key,
}
