"""Exact deduplication by progressive refinement, in DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z. Rows are first
grouped by their text's length in bytes, those with company by a hash of a
short prefix, and only the rows that still have company have their full text
normalised and hashed. Which rows those are is looked up in the scan, in bitmaps
of the (length, prefix) keys with company: a bounded broadcast, so that no text
passes a shuffle to be looked at. A bit set by another key costs a needless hash
of one text and changes no result. All groupings count with map-side combination
and the joins back to the rows are on keys that Spark may split when skewed, so
a group of copies may hold any part of the table.

Of equal texts the row with the largest id stays. Results for special inputs: a
null text counts as empty; an id that repeats within a group leaves each of its
rows marked as the one that stays (``drop_exact_duplicates`` keeps one of
them); a null id is smaller than any other; an empty table gives an empty
result; other columns are ignored, whatever their names; texts of any length
are compared whole, by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.common import ascii_lower, fresh, single_rows, text_or_empty, without_rows
from sparkfit.session import write_table

PREFIX = 64         # characters
KEY_BITS = 16       # bits of the bitmaps for each key with company
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27    # 4 KB and 16 MB of bitmaps


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the normalised text in UTF-8."""
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def _length_and_prefix(text_col: str) -> tuple[Column, Column]:
    text = text_or_empty(text_col)
    return F.octet_length(text), F.xxhash64(ascii_lower(F.substring(text, 1, PREFIX)))


def shared_prefixes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(len, prefix): the lengths and prefix hashes that several rows have.

    Two passes, the second over rows whose length is shared only."""
    length, prefix = _length_and_prefix(text_col)
    rows = docs.select(length.alias("len"), prefix.alias("prefix"))
    # Keys with company are written, so that Spark can split the join's
    # partitions of a frequent length.
    lens = write_table(rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len"), "exact-lengths")
    return write_table(rows.join(lens, "len").groupBy("len", "prefix").agg(F.count("*").alias("n"))
                       .where("n > 1").select("len", "prefix"), "exact-prefixes")


def with_company(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` and a boolean ``name``: whether another row may have the same
    length and prefix hash. False is certain.

    The keys with company set bits of bitmaps, ``KEY_BITS`` times as many bits
    as keys and at most ``MOST_BITS``; beyond that more rows are called true."""
    keys = shared_prefixes(docs, text_col)
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))

    def place(length: Column, prefix: Column) -> Column:
        return F.pmod(F.xxhash64(length, prefix), F.lit(bits)) + 1

    segment, bitmap = fresh(docs, "segment", "bitmap")
    own = place(F.col("len"), F.col("prefix"))
    segments = write_table(keys.groupBy(F.bitmap_bucket_number(own).alias(segment))
                           .agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias(bitmap)), "exact-bitmaps")
    row = place(*_length_and_prefix(text_col))
    at = F.bitmap_bit_position(row)
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return docs.join(F.broadcast(segments), F.bitmap_bucket_number(row) == F.col(segment), "left") \
        .select(*docs.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(name))


def _refined(marked: DataFrame, company: str, id_col: str, text_col: str, digest_all: bool) -> DataFrame:
    """``refine`` over rows marked by ``with_company``."""
    full = text_digest(text_or_empty(text_col))
    rows = marked.select(F.col(id_col).alias("id"), F.when(F.col(company), F.xxhash64(F.col(text_col))).alias("text_hash"),
                         F.col(company).alias("company"), F.when(F.col(company) | F.lit(digest_all), full).alias("sha256"))
    return rows.select("id", "text_hash", F.when(F.col("company"), F.col("sha256")).alias("full"),
                       *(["sha256"] if digest_all else []))


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest_all: bool = False) -> DataFrame:
    """(id, text_hash, full) per row: a short and the full hash of the text, null
    where no other row has the same length and prefix hash (no other text can be
    equal there).

    Three passes: lengths; prefixes of the rows whose length is shared; full
    texts of the rows whose length and prefix are. ``digest_all`` adds a column
    ``sha256`` with the digest of every row, for callers that report it.
    """
    (company,) = fresh(docs, "company")
    return _refined(with_company(docs, text_col, company), company, id_col, text_col, digest_all)


def _grouped(refined: DataFrame, id_col: str) -> DataFrame:
    rows = write_table(refined, "exact-rows")
    # Written, so that Spark can split the join's partitions of a large group.
    groups = write_table(rows.where("full IS NOT NULL").groupBy("full")
                         .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
                         .where("group_size > 1"), "exact-sizes")
    # Rows without a full hash take no part in the join: as null keys they
    # would all meet in one task.
    one = F.lit(1).cast("bigint")
    lone = rows.where("full IS NULL").withColumns({"keep_id": F.col("id"), "group_size": one})
    found = rows.where("full IS NOT NULL").join(groups, "full", "left")
    alone = F.col("group_size").isNull()
    found = found.withColumn("keep_id", F.when(alone, F.col("id")).otherwise(F.col("keep_id"))) \
        .withColumn("group_size", F.coalesce("group_size", one))
    return found.unionByName(lone).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))) \
        .withColumnRenamed("id", id_col)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest_all: bool = False) -> DataFrame:
    """(id, text_hash, keep_id, group_size, kept, full) per row, dropped ones
    too, and ``sha256`` with ``digest_all``."""
    return _grouped(refine(docs, id_col, text_col, digest_all), id_col)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with
    all their columns. Rows without company stay where they are read."""
    (company,) = fresh(docs, "company")
    marked = with_company(docs, text_col, company)
    groups = write_table(_grouped(_refined(marked, company, id_col, text_col, False), id_col)
                         .where("group_size > 1").select(F.col(id_col).alias("id"), "text_hash", "kept"), "exact-groups")
    losers = groups.where("NOT kept").select("id", "text_hash")
    repeats = groups.where("kept").groupBy("id", "text_hash") \
        .agg(F.count("*").alias("n")).where("n > 1").select("id", "text_hash")
    rest = without_rows(marked.where(F.col(company)).drop(company), losers, id_col, text_col)
    return marked.where(~F.col(company)).drop(company).unionAll(single_rows(rest, repeats, id_col, text_col))
