"""Column expressions shared by the operators (all built-in Spark functions)."""

from sparkfit.functions.numeric import (FLOAT_PATTERN, is_float, log_loss, rounded, sigmoid,
                                        strict_double, threshold)
from sparkfit.functions.strings import (char_array, doc_tag_body, doc_tag_id, letter_token_array,
                                        name_word_array, prefix_label)

__all__ = [
    "FLOAT_PATTERN", "is_float", "strict_double", "sigmoid", "log_loss", "threshold", "rounded",
    "name_word_array", "letter_token_array", "char_array", "prefix_label", "doc_tag_id",
    "doc_tag_body",
]
