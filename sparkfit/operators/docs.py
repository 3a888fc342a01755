"""Doc-tagged lines: ``<doc id="..." url="..." ...>text</doc>``, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.functions.strings import doc_tag_body, doc_tag_id
from sparkfit.operators.keys import row_positions


def parse_doc_tags(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, text) cut out of each line; both NULL when a marker is missing.

    The id is the text between ``id="`` and ``" url=``; the body starts after
    the first ``">`` and loses its last six characters. Plain column
    expressions: fused into the scan, no shuffle.
    """
    return lines.select(*(keep or []), doc_tag_id(col).alias("doc_id"),
                        doc_tag_body(col).alias("text"))


def sort_desc_positions(df: DataFrame, key: str, pos_col: str = "pos") -> DataFrame:
    """Number rows by falling ``key`` (text order for strings), from 0.

    Range-partitioned, so the sort is spread over many tasks; rows of equal
    keys are in the order of their other columns. See ``row_positions``.
    """
    return row_positions(df, [F.col(key).desc()], pos_col)
