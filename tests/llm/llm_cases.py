"""Small documents with every awkward case, shared by the tests here."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(30_000))
RUN = "x" * 3000 + "ab" * 700

# Names that operators use for working columns, to clash with.
CLASHES = ["id", "t", "h", "i", "part", "label", "cid", "kept", "text_hash", "lang_pred", "Score", "size", "shard",
           "place", "mix_hash", "own_hash", "mix_id", "n", "len", "key", "key_id", "c0", "p", "s", "block", "draws"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " \
    + ", ".join(f"`{c}` string" for c in CLASHES)

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "web"),
    (2, None, None, None),
    (3, "", "en", "web"),
    (4, " \t\n\x0b\x0c\r ", None, "books"),
    (5, "THE quick brown fox jumps over the LAZY dog again and again", "en", "books"),
    (5, "THE quick brown fox jumps over the LAZY dog again and again", "en", "books"),
    (6, "Die Straße führt über die Brücke und durch den Wald\nDie Straße", "de", None),
    (7, "one two", "en", "web"),
    (8, "one two", "en", "web"),
    (9, "中文字符 和 emoji 🎉👍🏽 don't we'll I'm <|endoftext|> x", None, "web"),
    (None, "a row without an id", "en", "web"),
    (11, LONG, "en", "books"),
    (12, LONG.replace("word5 ", "other "), "en", "books"),
    (13, RUN, "en", "web"),
    (14, "123 456 !!! ...", "en", "web"),
    (15, "  double  blanks \n \n and\ttabs   ends ", "en", "web"),
    (16, "É́ ǅ İ ß ﬁ Σ combining á", "fr", "web"),
]


def edge_documents(spark, partitions: int = 3):
    rows = [(*r, len(r[1] or ""), *["clash"] * len(CLASHES)) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(sf_dir: str) -> list[tuple]:
    """(doc_id, text, lang, source) of the documents table, by pyarrow."""
    import pyarrow.parquet as pq
    t = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "lang", "source"])
    return list(zip(*(t[c].to_pylist() for c in t.column_names), strict=True))
