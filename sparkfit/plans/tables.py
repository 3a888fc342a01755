"""Loading the driver's Parquet tables, and inputs derived from them.

The reference reads an app-store CSV and doc-tagged text lines; the query
keys re-point each operator at a table of like shape. The derivations below
are plain projections of every row of the source table, so their size grows
with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Setting of the session that names the partitions to deal a table's rows over
# before CPU-heavy row work; for small files in one row group, which scan as one
# task. Unset, a table keeps the partitions of its scan.
INPUT_PARTITIONS = "spark.sparkfit.inputPartitions"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str, deal_by: str | None = None) -> DataFrame:
    """One driver table; naming columns keeps the scan's ReadSchema narrow.

    ``deal_by``: the column to deal rows by if ``INPUT_PARTITIONS`` is set.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*cols) if cols else df
    partitions = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(partitions), deal_by) if deal_by and partitions else df


# The header line of the derived app-record file, and the way
# each part type writes its rating field (so that the float test meets plain
# numbers, padded numbers, NaN, an empty field, text, and "_" digit groups).
APP_HEADER = "app,name_text,category,rating,rating_count,installs,min_install,max_install,free,price"
RATING_STYLE = {
    "STANDARD": "plain",
    "ECONOMY": "padded",
    "MEDIUM": "nan",
    "LARGE": "empty",
    "PROMO": "text",
    "SMALL": "grouped",
}
QUOTED_NAME_BRAND = "Brand#7"     # name written quoted with a comma inside
SHORT_LINE_BRAND = "Brand#3"      # line cut after eight fields
INF_PRICE_BRAND = "Brand#11"      # price written as "inf"


def _s(col: str) -> Column:
    return F.col(col).cast("string")


def app_lines(part: DataFrame) -> DataFrame:
    """One comma-separated app record per part, plus a header line: ``value``."""
    size = _s("p_size")
    rating = (F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit(" "), size, F.lit(" ")))
               .when(F.col("p_type") == "MEDIUM", F.lit("NaN"))
               .when(F.col("p_type") == "LARGE", F.lit(""))
               .when(F.col("p_type") == "PROMO", F.lit("n/a"))
               .when(F.col("p_type") == "SMALL", F.concat(size, F.lit("_0")))
               .otherwise(size))
    app = F.when(F.col("p_brand") == QUOTED_NAME_BRAND,
                 F.concat(F.lit('"'), F.col("p_name"), F.lit(', deluxe"'))).otherwise(F.col("p_name"))
    price = F.when(F.col("p_brand") == INF_PRICE_BRAND, F.lit("inf")).otherwise(_s("p_retailprice"))
    head8 = [app, F.col("p_brand"), F.col("p_type"), rating, _s("p_retailprice"),
             F.col("p_type"), _s("p_partkey"), size]
    line = F.when(F.col("p_brand") == SHORT_LINE_BRAND, F.concat_ws(",", *head8)) \
        .otherwise(F.concat_ws(",", *head8, F.col("p_brand"), price))
    header = part.sparkSession.range(1).select(F.lit(APP_HEADER).alias("value"))
    return header.unionByName(part.select(line.alias("value")))


# The doc-tag line layout, and the language written without any
# markers (those lines cannot be cut and parse to NULL).
DOC_URL_PREFIX = "https://example.com/doc/"
UNTAGGED_LANG = "de"


def doc_lines(documents: DataFrame) -> DataFrame:
    """``<doc id=".." url=".." title="..">text</doc>`` per document, on one
    line (line breaks in the text become blanks): (src_id, value)."""
    text = F.regexp_replace(F.col("text"), "[\\r\\n]", " ")
    tagged = F.concat(F.lit('<doc id="'), _s("doc_id"), F.lit('" url="'), F.lit(DOC_URL_PREFIX),
                      _s("doc_id"), F.lit('" title="'), F.col("lang"), F.lit('">'), text,
                      F.lit("</doc>"))
    line = F.when(F.col("lang") == UNTAGGED_LANG, text).otherwise(tagged)
    return documents.select(F.col("doc_id").alias("src_id"), line.alias("value"))


def labeled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, quality, toxic): documents that carry labels.

    Partitioned by doc_id once, before the join: a sort-merge join uses the
    partitioning and a broadcast join keeps it, and so does all that is grouped
    by document later.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text").repartition("doc_id")
    return docs.join(table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"), "doc_id")
