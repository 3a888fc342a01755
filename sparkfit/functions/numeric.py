"""Numeric column expressions: a strict float parse, the logistic link and loss.

All of these are built-in Spark expressions, so they stay inside whole-stage
code generation; none of them is a Python UDF.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _char_class(codes: list[int]) -> str:
    """Regex class for a set of code points, consecutive runs merged."""
    runs, start, prev = [], codes[0], codes[0]
    for c in codes[1:]:
        if c != prev + 1:
            runs.append((start, prev))
            start = c
        prev = c
    runs.append((start, prev))
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs]
    return "[" + "".join(parts) + "]"


# Like ``float()``, the guard first maps every character with a decimal value
# (``unicodedata.decimal``: Arabic-Indic, Devanagari, full-width, ... digits)
# to its ASCII digit, then trims ``str.strip()`` white space and reads the
# rest. Both sets are derived from Python's own rules.
_SPACES = [c for c in range(0x110000) if chr(c).isspace()]
_DECIMALS = [c for c in range(0x80, 0x110000) if unicodedata.decimal(chr(c), None) is not None]
NON_ASCII_DIGITS = "".join(chr(c) for c in _DECIMALS)
ASCII_OF_DIGITS = "".join(str(unicodedata.decimal(chr(c))) for c in _DECIMALS)
_WS = _char_class(_SPACES)
_DIGITS = "[0-9](?:_?[0-9])*"
# The body Python's float() accepts: plain decimals with optional "_" between
# digits, an exponent, or nan / inf / infinity in any case. Spark's own cast is
# looser ("1d", "0x1p3") and stricter ("1_000", "-nan"), hence this guard.
FLOAT_BODY = (
    f"[+-]?(?:(?:{_DIGITS}(?:\\.(?:{_DIGITS})?)?|\\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    "|(?i:nan|inf|infinity))"
)
FLOAT_PATTERN = f"^{_WS}*({FLOAT_BODY}){_WS}*$"


def ascii_digits(col: Column) -> Column:
    """Non-ASCII decimal digits replaced by their ASCII digit."""
    return F.translate(col, NON_ASCII_DIGITS, ASCII_OF_DIGITS)


def float_body(col: Column | str) -> Column:
    """The part of the text ``float()`` would parse, "_" removed; "" if none.

    Computing this once per field and testing ``!= ""`` runs the pattern once
    per value (see ``parse_float_body`` for the value itself).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.regexp_extract(ascii_digits(c), FLOAT_PATTERN, 1), "_", "")


def parse_float_body(body: Column) -> Column:
    """DOUBLE from a ``float_body`` result; NULL for "".

    Spark's cast already reads every body the pattern admits as ``float()``
    does (nan / inf / infinity in any case, overflow to inf), except signed
    NaN, which it refuses.
    """
    return (
        F.when(body.isNull() | (body == ""), F.lit(None).cast("double"))
        .when(F.lower(body).isin("+nan", "-nan"), F.lit(float("nan")))
        .otherwise(body.try_cast("double"))
    )


def strict_double(col: Column | str) -> Column:
    """Parse text the way Python's ``float()`` does; NULL where it would raise."""
    return parse_float_body(float_body(col))


def is_float(col: Column | str) -> Column:
    """True where ``float(value)`` would succeed in Python."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(ascii_digits(c).rlike(FLOAT_PATTERN), F.lit(False))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# Fixed value: the guard added inside both logarithms of the log-loss.
LOG_EPS = 1e-12


def log_loss(y: Column, p: Column) -> Column:
    """Binary cross-entropy with the 1e-12 guard inside both logs."""
    return -y * F.ln(p + F.lit(LOG_EPS)) - (F.lit(1.0) - y) * F.ln((F.lit(1.0) - p) + F.lit(LOG_EPS))


def threshold(p: Column, cut: float = 0.5) -> Column:
    """1 where ``p >= cut`` (inclusive), else 0."""
    return F.when(p >= F.lit(cut), F.lit(1)).otherwise(F.lit(0))


def rounded(col: Column, digits: int) -> Column:
    """Round half-up and fold ``-0.0`` into ``0.0`` (stable for hashing)."""
    return F.round(col, digits) + F.lit(0.0)
