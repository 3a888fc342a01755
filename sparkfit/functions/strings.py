"""String column expressions: tokenizers, name labels and doc-tag slicing.

Each returns a ``Column`` built from code-generated functions only: no Python
UDF, and no lambda (``transform``/``filter`` are interpreted per element).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and markers that must match the reference's text
# handling exactly.
NAME_STRIP_PATTERN = "[^A-Za-z0-9]+"   # removed from each blank-separated piece of a name
NAME_STRIP_KEEP_BLANK = "[^A-Za-z0-9 ]+"  # the same, applied before splitting on the blank
NON_LETTER_PATTERN = "[^a-zA-Z]"       # turned into blanks before lower-casing doc text
DOC_ID_OPEN = 'id="'
DOC_ID_CLOSE = '" url='
DOC_BODY_OPEN = '">'
DOC_TAIL_LEN = 6                       # length of the closing "</doc>"
POSITIVE_PREFIX = "AU"                 # a name starting with these two letters is class 1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def name_word_array(col: Column | str) -> Column:
    """Split a name on single blanks, strip non-alphanumerics, drop empties.

    Stripping everything but letters, digits and the blank first, then
    splitting on the blank, gives the same pieces: the blank is never
    stripped, so the split points do not move. No lambda: the whole chain is
    built-in, code-generated functions.
    """
    kept = F.regexp_replace(_c(col), NAME_STRIP_KEEP_BLANK, "")
    return F.array_remove(F.split(kept, " ", -1), "")


def letter_token_array(col: Column | str) -> Column:
    """Non-letters to blanks, lower-case, split on runs of white space.

    After the replacement only ASCII letters and blanks are left, so
    lower-casing is ASCII-only and empty pieces are the only ones to drop.
    """
    letters = F.lower(F.regexp_replace(_c(col), NON_LETTER_PATTERN + "+", " "))
    return F.array_remove(F.split(letters, " ", -1), "")


def char_array(col: Column | str) -> Column:
    """The characters (code points) of a string, in order."""
    return F.split(_c(col), "", -1)


def prefix_label(col: Column | str, prefix: str = POSITIVE_PREFIX) -> Column:
    """1 when the value starts with ``prefix`` (case-sensitive), else 0.

    Short or empty values give 0 instead of raising.
    """
    return F.coalesce(_c(col).startswith(prefix), F.lit(False)).cast("int")


def doc_markers_missing(col: Column | str) -> Column:
    """True when any of the three markers is absent (the line cannot be cut)."""
    line = _c(col)
    return ((F.instr(line, DOC_ID_OPEN) == 0) | (F.instr(line, DOC_ID_CLOSE) == 0)
            | (F.instr(line, DOC_BODY_OPEN) == 0))


def doc_tag_id(col: Column | str) -> Column:
    """Text between ``id="`` and ``" url=``; empty if the second comes first."""
    line = _c(col)
    start = F.instr(line, DOC_ID_OPEN) + F.lit(len(DOC_ID_OPEN))
    length = F.greatest(F.instr(line, DOC_ID_CLOSE) - start, F.lit(0))
    return F.when(doc_markers_missing(line), F.lit(None).cast("string")) \
        .otherwise(F.substring(line, start, length))


def doc_tag_body(col: Column | str) -> Column:
    """Text after the first ``">`` minus the last six characters (``</doc>``)."""
    line = _c(col)
    open_at = F.instr(line, DOC_BODY_OPEN)
    start = open_at + F.lit(len(DOC_BODY_OPEN))
    length = F.greatest(F.length(line) - start + F.lit(1) - F.lit(DOC_TAIL_LEN), F.lit(0))
    return F.when(doc_markers_missing(line), F.lit(None).cast("string")) \
        .otherwise(F.substring(line, start, length))
