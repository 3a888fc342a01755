"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import oracle_util as U
import pytest
from conftest import SF_ORACLE
from llm_cases import edge_documents, no_documents
from pyspark.sql import functions as F

from sparkfit.llm import merkle, queries
from sparkfit.llm.oracle import ORACLE_SQL

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(digests, fanout=2):
    """The root, and for each leaf its (before, after) entries."""
    at, paths, level = list(range(len(digests))), [[] for _ in digests], list(digests)
    while len(level) > 1:
        for leaf, place in enumerate(at):
            first = place // fanout * fanout
            paths[leaf].append(("".join(level[first:place]), "".join(level[place + 1:first + fanout])))
            at[leaf] = place // fanout
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
    return level[0], paths


def plain_manifest(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof) of rows of FIELDS."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for _, _, leaf, _ in sorted(groups[g])], fanout) for g in order}
    root, over = plain_tree([trees[g][0] for g in order], fanout) if order else (None, [])
    return [(key, leaf, trees[g][0], root, tuple(trees[g][1][i] + over[n]))
            for n, g in enumerate(order) for i, (_, _, leaf, key) in enumerate(sorted(groups[g]))]


def rows_of(df):
    return [(r[0], r["leaf"], r["subroot"], r["root"], tuple((e["before"], e["after"]) for e in r["proof"]))
            for r in df.collect()]


def by_repr(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("fanout", "segment"), [(2, 4096), (2, 4), (3, 9), (5, 8)])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, fanout, segment):
    monkeypatch.setattr(merkle, "SEGMENT", segment)
    rows = [(i // 2 if i % 9 == 0 else i, "web", [None, "de", "en", "zz"][min(i % 7, 3)] if i < 90 else f"l{i:03}",
             None if i % 5 == 0 else i, f"text {i} ä") for i in range(107)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3)
    got = rows_of(merkle.manifest(df, FIELDS, "lang", "doc_id", fanout))
    assert by_repr(got) == by_repr(plain_manifest(rows, fanout))


def test_manifest_edges(spark):
    df = edge_documents(spark)
    rows = [tuple(r[c] for c in FIELDS) for r in df.collect()]
    got = rows_of(merkle.manifest(df, FIELDS, "lang", "doc_id"))
    assert by_repr(got) == by_repr(plain_manifest(rows))
    assert merkle.manifest(no_documents(spark), FIELDS, "lang", "doc_id").collect() == []
    one = df.where("doc_id = 7")
    (only,) = rows_of(merkle.manifest(one, FIELDS, "lang", "doc_id"))
    assert only[1] == only[2] == only[3] and only[4] == ()


def test_tampered_leaves_do_not_verify(spark):
    df = edge_documents(spark)
    carry = {"changed": F.when(F.col("doc_id") % 2 == 0, F.lit(h("forged")))}
    rows = merkle.manifest(df, FIELDS, "lang", "doc_id", carry=carry)
    out = rows.select("doc_id", "changed", (merkle.folded(F.coalesce("changed", "leaf")) == F.col("root")).alias("ok"),
                      (merkle.folded("leaf") == F.col("root")).alias("was")).collect()
    assert all(r["was"] and r["ok"] == (r["changed"] is None) for r in out)
    assert any(not r["ok"] for r in out)


def test_query_against_sql_and_plain(spark):
    con = U.duck(SF_ORACLE)
    key = "op13_merkle_manifest"
    assert U.compare(spark, con, key, SF_ORACLE, queries.QUERIES, ORACLE_SQL)["hash_match"]
    rows = con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    want = {}
    for r, (doc_id, leaf, sub, root, proof) in zip(
            sorted(rows, key=lambda r: (r[2] or "", r[0])), sorted(plain_manifest(rows), key=lambda m: 0), strict=True):
        assert r[0] == doc_id
        fold = leaf
        if zlib.crc32(str(doc_id).encode()) % 7 == 0 and r[3] is not None:
            fold = plain_leaf((*r[:3], r[3] + 1, r[4]))
        for before, after in proof:
            fold = h(before, fold, after)
        want[doc_id] = (leaf, sub, root, h(*[b + a for b, a in proof]), fold, fold == root)
    got = {r[0]: tuple(r)[1:] for r in queries.op13_merkle_manifest(spark, SF_ORACLE).collect()}
    assert got == want
