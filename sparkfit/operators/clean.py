"""Split delimited lines and keep the rows whose numeric fields all parse.

Row-local column expressions over the scan: the split, the float guard and the
projection fuse into one whole-stage-codegen stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.functions.numeric import float_body, parse_float_body
from sparkfit.operators.rows import filter_late

# The 0-based positions of the fields of an app record that the
# pipeline reads, and which of them must parse as floats for a row to be kept.
APP_FIELDS = {
    "app": 0,
    "name_text": 1,
    "rating": 3,
    "rating_count": 4,
    "min_install": 6,
    "max_install": 7,
    "price": 9,
}
NUMERIC_FIELDS = ("rating", "rating_count", "min_install", "max_install", "price")


def split_fields(lines: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """Add ``fields``: the line split on every ``sep``; quotes are *not* honoured."""
    return lines.withColumn("fields", F.split(F.col(col), _regex_literal(sep), -1))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in sep)


def field(fields: Column, index: int) -> Column:
    """Field ``index`` (0-based), NULL when the line is too short."""
    return F.get(fields, index)


def clean_rows(lines: DataFrame, col: str = "value", sep: str = ",",
               finite_only: bool = False) -> DataFrame:
    """Typed app rows from raw lines; rows failing the float test are dropped.

    Output: ``app``, ``name_text`` (strings) and the five numeric fields as
    DOUBLE. A header of words fails the test and falls out. ``NaN`` and
    ``inf`` pass, as with Python's ``float()``, unless ``finite_only``.
    Lines with too few fields are dropped rather than raising.
    """
    fields = F.split(F.col(col), _regex_literal(sep), -1)
    f = F.col("_f")
    # The float pattern runs once per numeric field ("" = not a float); the
    # keep test runs late, so no pushed-down filter evaluates it again.
    bodies = lines.select(fields.alias("_f")).select(
        field(f, APP_FIELDS["app"]).alias("app"),
        field(f, APP_FIELDS["name_text"]).alias("name_text"),
        *[float_body(field(f, APP_FIELDS[n])).alias(f"_b_{n}") for n in NUMERIC_FIELDS],
    )

    def all_floats(r: Column) -> Column:
        ok = F.lit(True)
        for n in NUMERIC_FIELDS:
            ok = ok & F.coalesce(r[f"_b_{n}"] != "", F.lit(False))
        return ok

    out = filter_late(bodies, all_floats).select(
        "app", "name_text", *[parse_float_body(F.col(f"_b_{n}")).alias(n) for n in NUMERIC_FIELDS])
    if finite_only:
        finite = F.lit(True)
        for name in NUMERIC_FIELDS:
            finite = finite & ~F.isnan(name) & (F.abs(F.col(name)) != F.lit(float("inf")))
        out = out.where(finite)
    return out


def project_pairs(rows: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """(key, value...) pairs: the projection the later steps start from."""
    return rows.select(key, *value_cols)
