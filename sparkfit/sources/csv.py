"""CSV with a header line and RFC-style quoting, value for value.

What is written reads back the same: blanks at the ends of a text stay, an
empty text and a missing value stay apart (``NULL_MARKER`` stands for the
missing one, so a text that is exactly the marker can't be told from it; pass
another), and a line break inside a text stays if ``multi_line`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from sparkfit.session import write_table
from sparkfit.sources.records import csv_records

NULL_MARKER = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_marker: str = NULL_MARKER) -> str:
    """Header line, fields with commas, quotes or line breaks quoted, no index column."""
    (df.write.mode(mode)
       .option("header", True)
       .option("quote", '"')
       .option("escape", '"')
       .option("nullValue", null_marker)
       .option("emptyValue", '""')
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return path


# How fields are read, whichever way records are found.
_FIELDS = {"quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false", "mode": "FAILFAST"}

# Lattice of column types: the join of two types is the larger.
TYPES = ["string", "bigint", "double", "string"]      # of level 0 (nulls only), 1, 2, 3
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_REAL = r"(?i)^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = False, null_marker: str = NULL_MARKER) -> DataFrame:
    """Quote-aware read; a header line per file.

    ``multi_line`` accepts line breaks inside quotes; files are still read in
    blocks by many tasks (``csv_records``). A record that doesn't fit the schema
    fails the read rather than losing values. Without a schema the types are
    inferred while the records are read, see ``read_csv_inferred``.
    """
    if schema is None:
        return read_csv_inferred(spark, path, multi_line, null_marker)
    if multi_line:
        return _parsed(csv_records(spark, path).where(~F.col("first")), _struct(spark, schema), null_marker).select("row.*")
    reader = spark.read.options(**_FIELDS).option("header", True).option("nullValue", null_marker)
    return reader.schema(schema).csv(path)


def _struct(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def _parsed(records: DataFrame, schema: StructType, null_marker: str) -> DataFrame:
    return records.select(F.from_csv("record", _ddl(schema), {**_FIELDS, "nullValue": null_marker}).alias("row"))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def type_level(value: Column) -> Column:
    """0 for null, 1 for a whole number that fits a long, 2 for another number, 3 for text."""
    return F.when(value.isNull(), 0) \
        .when(value.rlike(_WHOLE) & value.try_cast("bigint").isNotNull(), 1) \
        .when(value.rlike(_REAL), 2).otherwise(3)


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False,
                      null_marker: str = NULL_MARKER) -> DataFrame:
    """Read with names from the header and types from all values.

    A column is bigint if all of its values are whole numbers, double if all are
    numbers, else string (as is one without values). The level of each value is
    written beside the parsed texts, in a table in the shared folder, and a
    column's is their maximum: neither the files nor the texts are scanned again
    for their types, only these narrow columns. (An ``Observation`` would save
    that, but a session that has had one can't be serialized any more, which MLlib
    models with a training summary need.)
    """
    head = spark.read.options(**_FIELDS).option("header", True).option("nullValue", null_marker).csv(path)
    names = head.columns
    texts = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    if multi_line:
        rows = _parsed(csv_records(spark, path).where(~F.col("first")), texts, null_marker).select("row.*")
    else:
        rows = head.toDF(*texts.names)
    levels = [type_level(F.col(c)).cast("byte").alias(f"level_{c}") for c in texts.names]
    table = write_table(rows.select("*", *levels), "csv-texts")
    found = table.agg(*[F.max(f"level_{c}").alias(c) for c in texts.names]).first()
    return table.select(*[F.trim(F.col(c)).cast(TYPES[found[c] or 0]).alias(name) if (found[c] or 0) in (1, 2)
                          else F.col(c).alias(name) for c, name in zip(texts.names, names, strict=True)])
