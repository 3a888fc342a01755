"""DataFrame-in, DataFrame-out operators; each one's core runs on Spark."""

from sparkfit.operators.aggregate import collect_by_key, distinct_keys, entity_features
from sparkfit.operators.clean import APP_FIELDS, NUMERIC_FIELDS, clean_rows, project_pairs, split_fields
from sparkfit.operators.combine import combine_by_key, lists_by_key
from sparkfit.operators.docs import parse_doc_tags, sort_desc_positions
from sparkfit.operators.frequent import frequent_words
from sparkfit.operators.gradient import (SvmFit, example_rows, fit_logistic_rows, fit_svm_rows, predict_logistic_rows,
                                         predict_svm_rows)
from sparkfit.operators.keys import join_fanout, key_index, keyed_join, keyed_join_sorted, row_positions
from sparkfit.operators.logistic import (LogisticFit, build_examples, fit_logistic, predict_logistic,
                                         score_rows, start_weights, top_coefficients)
from sparkfit.operators.metrics import confusion_metrics, multiclass_metrics
from sparkfit.operators.rows import explode_items, filter_late
from sparkfit.operators.regression import (descent_trace, independent_descent_trace, moments,
                                           ols_fit)
from sparkfit.operators.svm import evaluate_svm, fit_svm, sparse_entries, tf_vectors, vocab_words
from sparkfit.operators.text import (char_frequency, corpus_counts, counted_words, doc_tokens, lookup_vocab,
                                     name_words, term_counts, term_frequency, top_words, vocabulary, word_count)

__all__ = [
    "APP_FIELDS", "NUMERIC_FIELDS", "split_fields", "clean_rows", "project_pairs",
    "entity_features", "collect_by_key", "distinct_keys",
    "ols_fit", "moments", "descent_trace", "independent_descent_trace",
    "name_words", "doc_tokens", "word_count", "top_words", "vocabulary", "lookup_vocab",
    "term_frequency", "char_frequency", "corpus_counts", "counted_words", "term_counts",
    "combine_by_key", "lists_by_key", "frequent_words",
    "SvmFit", "example_rows", "fit_logistic_rows", "fit_svm_rows", "predict_logistic_rows", "predict_svm_rows",
    "parse_doc_tags", "sort_desc_positions",
    "row_positions", "key_index", "keyed_join", "join_fanout", "keyed_join_sorted",
    "LogisticFit", "build_examples", "start_weights", "score_rows", "fit_logistic",
    "predict_logistic", "top_coefficients",
    "confusion_metrics", "multiclass_metrics",
    "vocab_words", "tf_vectors", "sparse_entries", "fit_svm", "evaluate_svm", "explode_items", "filter_late",
]
