"""Language ID, exact dedup, line dedup and fingerprints against brute force."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import CLASHES, ROWS, edge_documents, no_documents, texts_of
from pyspark.sql import functions as F

from sparkfit.llm import exact_dedup, fingerprints, lang_id, line_dedup, queries
from sparkfit.llm.oracle import ORACLE_SQL

UPPER_TO_LOWER = {ord(a): ord(a) + 32 for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)


# --- language ID

def plain_ngrams(text):
    """Counter of n-grams of 1 to 3 characters, words padded by blanks."""
    import unicodedata
    out, word = Counter(), []

    def close():
        if word:
            padded = " " + "".join(word) + " "
            out.update(c for c in padded if c != " ")
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
            word.clear()
    for ch in text:
        if ch.isalpha():
            word.append(ch.lower()[0])
        elif unicodedata.category(ch)[0] == "M":
            word.append(ch)
        else:
            close()
    close()
    return out


def gram_key(gram):
    points = [lang_id.ABSENT] * (3 - len(gram)) + [0 if c == " " else ord(c) for c in gram]
    return points[0] << 42 | points[1] << 21 | points[2]


def plain_top(counts, k):
    return [g for g, _ in sorted(counts.items(), key=lambda t: (-t[1], gram_key(t[0])))[:k]]


def plain_predict(text, profiles, k):
    top = plain_top(plain_ngrams(text), k)
    if not any(c.isalpha() for c in text) or not profiles:
        return "und"
    cost = {}
    for lang, profile in profiles.items():
        place = {g: i for i, g in enumerate(profile)}
        cost[lang] = sum(abs(place[g] - i) if g in place else k for i, g in enumerate(top))
    return min(sorted(cost), key=cost.get)


def test_language_profiles_and_predictions(spark):
    rows = texts_of(SF_SMALL)
    learn = [r for r in rows if r[2] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    counts = {}
    for _, text, lang, _ in learn:
        counts.setdefault(lang, Counter()).update(plain_ngrams(text))
    profiles = {lang: plain_top(c, lang_id.PROFILE) for lang, c in counts.items()}
    found = {r["doc_id"]: r for r in queries.op2_language_id(spark, SF_SMALL).collect()}
    assert len(found) == len(rows)
    for i, text, _, _ in rows:
        assert found[i]["lang_pred"] == plain_predict(text or "", profiles, lang_id.PROFILE)
        assert 0 <= found[i]["score"] <= 1
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_language_accuracy_on_held_out_documents(spark):
    found = queries.op2_language_id(spark, SF_ORACLE).join(
        spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = found.where("held_out AND lang IS NOT NULL").agg(
        F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n >= 0.97


def test_language_edge_cases(spark):
    docs = edge_documents(spark)
    profiles = lang_id.fit_profiles(docs)
    assert profiles.languages == ["de", "en", "fr"]
    found = lang_id.predict_languages(docs, profiles).collect()
    no_letter = {2, 3, 4, 14}
    assert len(found) == len(ROWS)
    for r in found:
        assert (r["lang_pred"] == "und" and r["score"] == 0) == (r["doc_id"] in no_letter)
    kept = lang_id.keep_known_languages(docs, profiles)
    assert kept.columns == docs.columns
    assert by_repr(kept.select("doc_id", "text", "Score", "lang_pred").collect()) == by_repr(
        (r[0], r[1], "clash", "clash") for r in ROWS if r[0] not in no_letter)
    nothing = lang_id.fit_profiles(docs.where("lang = 'none'"))
    assert {r["lang_pred"] for r in lang_id.predict_languages(docs, nothing).collect()} == {"und"}
    assert lang_id.keep_known_languages(docs, nothing).count() == len(ROWS)
    assert lang_id.predict_languages(no_documents(spark), profiles).collect() == []


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("abcABCéß中 .,1\ńİ")),
                                                 st.characters(exclude_categories=("Cs",))), max_size=30),
                      min_size=1, max_size=6))
def test_ngram_counts_are_the_plain_ones(texts):
    owner, gram, counts, letters = lang_id.count_ngrams(texts, np.arange(len(texts)))
    found = [Counter() for _ in texts]
    for o, g, c in zip(owner.tolist(), gram.tolist(), counts.tolist(), strict=True):
        found[o][g] = c
    for text, own, n in zip(texts, found, letters.tolist(), strict=True):
        assert own == Counter({gram_key(g): c for g, c in plain_ngrams(text).items()})
        assert n == sum(ch.isalpha() for ch in text)


# --- exact dedup

def test_exact_groups_edge_cases(spark):
    norm = [(i, (t or "").translate(UPPER_TO_LOWER)) for i, t, *_ in ROWS]
    size = Counter(t for _, t in norm)
    keep = {}
    for i, t in norm:
        keep[t] = max([x for x in (keep.get(t), i) if x is not None], default=None)
    found = exact_dedup.exact_groups(edge_documents(spark), digest_all=True) \
        .select("doc_id", "keep_id", "group_size", "kept", "sha256").collect()
    assert by_repr(found) == by_repr(
        (i, keep[t], size[t], i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)
    assert exact_dedup.exact_groups(no_documents(spark)).collect() == []


def test_exact_full_hashes_only_where_needed(spark):
    docs = spark.createDataFrame([(1, "a" * 100), (2, "A" * 100), (3, "b" * 100), (4, "a" * 99 + "c"), (5, "long"), (6, "x" * 7)],
                                 "doc_id bigint, text string")
    full = {r["id"] for r in exact_dedup.refine(docs).where("full IS NOT NULL").collect()}
    assert full == {1, 2, 4}        # 3 differs in its prefix, 5 and 6 in length


def test_exact_drop_keeps_one_row_of_each_group(spark):
    docs = edge_documents(spark)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = Counter(r["text"] and r["text"].translate(UPPER_TO_LOWER) or "" for r in left.collect())
    assert set(texts.values()) == {1}
    assert set(texts) == {(t or "").translate(UPPER_TO_LOWER) for _, t, *_ in ROWS}
    assert exact_dedup.drop_exact_duplicates(no_documents(spark)).collect() == []


def test_exact_plan_has_no_python(spark):
    plan = queries.op5_exact_dedup(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- line dedup

def plain_lines(rows, min_docs, min_chars=1):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER_TO_LOWER)
    have = Counter()
    for _, text in rows:
        have.update({key(x) for x in (text or "").split("\n")})
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(key(x)) < min_chars or have[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_lines_with_any_number_of_batches(spark, batches):
    common = [" Common Line ", "common line", "\tCOMMON LINE\r", "second", "third é"]
    rows = [(i, "\n".join([f"own {i}", common[i % 3], "", common[3] if i % 2 else "x", f"{common[4]} {i % 7}"]))
            for i in range(40)] + [(99, None), (100, ""), (101, "common line"), (101, "common line")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = line_dedup.kept_lines(docs, min_docs=10, batches=batches).collect()
    assert by_repr(found) == by_repr(plain_lines(rows, 10))


def test_lines_edge_cases(spark):
    rows = [(i, t) for i, t, *_ in ROWS]
    for least in (2, 1):
        found = line_dedup.kept_lines(edge_documents(spark), min_docs=least, batches=2).collect()
        assert by_repr(found) == by_repr(plain_lines(rows, least))
    found = line_dedup.kept_lines(edge_documents(spark), min_docs=2, min_chars=10, batches=2, digest=True).collect()
    assert by_repr(found) == by_repr((i, n, d, hashlib.sha256(t.encode()).hexdigest())
                                     for i, n, d, t in plain_lines(rows, 2, 10))
    assert line_dedup.kept_lines(no_documents(spark)).collect() == []


def test_runs_settle_compact_and_stay_exact(spark):
    rng = np.random.default_rng(5)
    runs, have = line_dedup.LineRuns(spark, min_docs=6), Counter()
    for _ in range(6):
        keys = [f"k{int(k)}".encode() for k in rng.zipf(1.4, 60) if k < 500]
        have.update(keys)
        runs.add(spark.createDataFrame([(k,) for k in keys], "h binary"))
        assert sum(r is not None for r in runs.levels) <= 3
    assert runs.settled
    found = [bytes(r["h"]) for r in runs.frequent().collect()]
    assert set(found) == {k for k, n in have.items() if n >= 6}
    names = [n for n in runs.levels if n] + runs.settled
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_runs_merge_without_an_exchange(spark):
    runs = line_dedup.LineRuns(spark)
    one, other = (runs._write(spark.createDataFrame([(b"a", 1), (b"b", 2)], "h binary, n bigint")) for _ in range(2))
    assert "Exchange" not in runs._merged(one, other)._jdf.queryExecution().executedPlan().toString()
    runs._drop([one, other])


# --- fingerprints

def true_likeness(a, b):
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum(min(x[w], y[w]) for w in x | y) / max(1, sum(max(x[w], y[w]) for w in x | y))


def test_fingerprint_likeness_is_the_weighted_jaccard():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        pool = [f"w{i}" for i in rng.integers(0, 80, 120)]
        other = pool[: int(rng.integers(10, 120))] + [f"v{i}" for i in rng.integers(0, 40, int(rng.integers(0, 80)))]
        a, b = " ".join(pool), " ".join(other)
        one, two = fingerprints.fingerprints([a, b])
        errors.append(fingerprints.likeness(one, two) - true_likeness(a, b))
    assert abs(np.mean(errors)) < 0.02          # unbiased
    assert np.sqrt(np.mean(np.square(errors))) < 0.5 / np.sqrt(fingerprints.SAMPLES) + 0.01


def test_fingerprint_basics():
    same, cased, empty, blank = fingerprints.fingerprints(["a b b c", "C b A B", "", " \n"])
    assert (same == cased).all() and fingerprints.as_text(same) == fingerprints.as_text(cased)
    assert fingerprints.as_text(empty) == "" == fingerprints.as_text(blank)
    assert fingerprints.likeness(empty, blank) == 1 and fingerprints.likeness(empty, same) == 0
    assert len(fingerprints.as_text(same)) == 4 * fingerprints.SAMPLES


def plain_edits(rows):
    """rows in order -> (id, n_chars, sha of the edited text, likenesses)."""
    out = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        own, changed, following = fingerprints.fingerprints([text, edit, after])
        out.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), fingerprints.as_text(own),
                    fingerprints.as_text(changed), fingerprints.likeness(own, changed), fingerprints.likeness(own, following)))
    return out


def test_fingerprint_query(spark):
    rows = sorted((r[0], r[1]) for r in texts_of(SF_SMALL))
    found = queries.op8_fingerprints(spark, SF_SMALL).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    assert sorted(map(tuple, found)) == plain_edits(rows)


def test_fingerprint_edge_cases(spark):
    # The order within equal ids is by a hash of the text: take it from Spark.
    docs = edge_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in
            docs.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).select("doc_id", "text").collect()]
    found = fingerprints.edited_fingerprints(docs).collect()
    assert by_repr(found) == by_repr(plain_edits(rows))
    own = {r["doc_id"]: r["fingerprint"] for r in found}
    assert by_repr(fingerprints.fingerprint_documents(docs).distinct().collect()) == by_repr(own.items())
    assert fingerprints.edited_fingerprints(no_documents(spark)).collect() == []
    one = spark.createDataFrame([(7, "only one row here")], "doc_id int, text string")
    assert by_repr(fingerprints.edited_fingerprints(one).collect()) == by_repr(plain_edits([(7, "only one row here")]))
    none = spark.createDataFrame([(None, "a b"), (None, "c d e")], "doc_id bigint, text string")
    assert fingerprints.edited_fingerprints(none).count() == 2


# --- SQL

@pytest.mark.parametrize("key", ["op5_exact_dedup", "op7_line_dedup", "op9_chat_rotation", "op4_near_dedup"])
def test_query_equals_its_sql(spark, key):
    from oracle_util import canon, duck, duck_rows, spark_rows
    con = duck(SF_SMALL)
    assert canon(*spark_rows(queries.QUERIES[key](spark, SF_SMALL))) == canon(*duck_rows(con, ORACLE_SQL[key]))


def test_queries_read_other_columns_without_clashes(spark, tmp_path):
    edge_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for key in ("op3_source_mix", "op4_near_dedup", "op5_exact_dedup", "op7_line_dedup"):
        assert queries.QUERIES[key](spark, str(tmp_path)).count() == len(ROWS), key
    assert CLASHES and duckdb
