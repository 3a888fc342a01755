"""Hand-made inputs with known outcomes (FIXTURES.md §1-§3)."""

import math

import pytest

from sparkfit.functions import strict_double
from sparkfit.operators import (clean_rows, collect_by_key, doc_tokens, entity_features,
                                name_words, parse_doc_tags)
from sparkfit.operators.text import char_frequency, vocabulary, word_count


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value STRING")


def rec(app, r="4.5", rc="10", mi="100", ma="1000", pr="0"):
    return ",".join([app, "txt", "c", r, rc, "x", mi, ma, "y", pr])


CASES = [
    ("plain numeric line", rec("Alpha"), True),
    ("header of words", "app,name_text,category,rating,rating_count,installs,min,max,free,price", False),
    ("quoted comma in field 0 shifts field 3 to text", '"Big, App",txt,c,Games,4.5,10,x,100,1000,y,0', False),
    ("quoted comma in field 5 shifts field 6 to text", 'Beta,txt,c,4.5,10,"x, y",100,1000,y,0', False),
    ("NaN kept", rec("Gamma", r="NaN"), True),
    ("inf kept", rec("Delta", pr="inf"), True),
    ("empty tested field dropped", rec("Eps", rc=""), False),
    ("blanks round a number kept", rec("Zeta", r=" 4.5 "), True),
    ("fewer than 10 fields dropped", "Eta,txt,c,4.5,10,x,100,1000", False),
    ("1d dropped (Spark's cast alone would keep it)", rec("Theta", r="1d"), False),
    ("1_000 kept, as float() reads it", rec("Iota", rc="1_000"), True),
]


@pytest.mark.parametrize("name,line,kept", CASES, ids=[c[0] for c in CASES])
def test_clean_rows_case(spark, name, line, kept):
    out = clean_rows(lines_df(spark, [line])).collect()
    assert (len(out) == 1) == kept


def test_clean_rows_values(spark):
    out = {r["app"]: r for r in clean_rows(lines_df(spark, [
        rec("Iota", rc="1_000"), rec("Gamma", r="NaN"), rec("Zeta", r=" 4.5 "), rec("Delta", pr="-inf"),
    ])).collect()}
    assert out["Iota"]["rating_count"] == 1000.0
    assert math.isnan(out["Gamma"]["rating"])
    assert out["Zeta"]["rating"] == 4.5
    assert out["Delta"]["price"] == float("-inf")


def test_same_app_on_three_lines_all_kept(spark):
    out = clean_rows(lines_df(spark, [rec("Same")] * 3)).collect()
    assert len(out) == 3


FLOATS = [" 2 ", "1_000", "1d", "NaN", "-nan", "+nan", "inf", "-Infinity", "1e3", ".5", "5.", "+3",
          "0x1p3", "1__0", "_1", "1_", "1_.5", "", " ", "abc", " 2 ", "1e1_0", "--1",
          "1.0f", "٣", "١٢.٥", "１２", "𝟏", "1e309", "infinity ", "nan1"]


def test_strict_double_matches_python_float(spark):
    df = spark.createDataFrame([(s,) for s in FLOATS], "s STRING")
    got = {r["s"]: r["d"] for r in df.select("s", strict_double("s").alias("d")).collect()}
    for s in FLOATS:
        try:
            want = float(s)
        except ValueError:
            want = None
        if want is None:
            assert got[s] is None, s
        elif math.isnan(want):
            assert got[s] is not None and math.isnan(got[s]), s
        else:
            assert got[s] == want, s


def test_entity_features_worked_case(spark):
    df = spark.createDataFrame(
        [("X", 4.0, 10.0, 0.0, 5.0, 0.0), ("X", 2.0, 30.0, 1.0, 0.0, 1.5), ("X", 3.0, 2.0, 1.0, 9.0, 0.0)],
        "app STRING, rating DOUBLE, rating_count DOUBLE, min_install DOUBLE, max_install DOUBLE, price DOUBLE")
    r = entity_features(df, vector_col="x").collect()[0]
    assert (r["rating"], r["rating_count"], r["min_install"], r["price"], r["max_install"]) == \
        (3.0, 42.0, 2, 1.5, 2)
    assert r["x"] == [3.0, 42.0, 2.0, 1.5]


def test_collect_by_key_long_form(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 1.0), ("b", 3.0)], "k STRING, v DOUBLE")
    got = sorted(tuple(r) for r in collect_by_key(df, "k", "v").collect())
    assert got == [("a", 1.0, 2), ("a", 2.0, 1), ("b", 3.0, 1)]


DOC = '<doc id="AU12" url="http://x" title="T">It\'s  A-b 9</doc>'


def test_doc_tag_parse_example(spark):
    r = parse_doc_tags(lines_df(spark, [DOC])).collect()[0]
    assert (r["doc_id"], r["text"]) == ("AU12", "It's  A-b 9")
    toks = [t["token"] for t in doc_tokens(parse_doc_tags(lines_df(spark, [DOC])),
                                           "doc_id", "text").orderBy("pos").collect()]
    assert toks == ["it", "s", "a", "b"]


@pytest.mark.parametrize("line,doc_id,text", [
    ("no markers at all", None, None),
    ('<doc id="A" url="u" title="T">body ">x</doc>', "A", 'body ">x'),
    ('<doc " url="u" id="Z">abc</doc>', "", "abc"),
    ('<doc id="A" url="u">ab', "A", ""),
])
def test_doc_tag_parse_cases(spark, line, doc_id, text):
    r = parse_doc_tags(lines_df(spark, [line])).collect()[0]
    assert (r["doc_id"], r["text"]) == (doc_id, text)


@pytest.mark.parametrize("line,doc_id,text", [
    ('<doc id="é1" url="ü" title="😀">héllo wörld 😀</doc>', "é1", "héllo wörld 😀"),
    ('" url=<doc id="q">tiny</doc>', "", "tiny"),
    ('id="x" url=">">">', "x", ""),
    ('<doc id="7" url="u">seven77</doc>', "7", "seven77"),
])
def test_doc_tag_parse_other_alphabets_and_orders(spark, line, doc_id, text):
    r = parse_doc_tags(lines_df(spark, [line])).collect()[0]
    assert (r["doc_id"], r["text"]) == (doc_id, text)


def test_name_words(spark):
    df = spark.createDataFrame([("Cool-App  Pro!",), ("a a",), ("",), ("A",)], "n STRING")
    got = sorted(tuple(r) for r in name_words(df, "n").collect())
    assert got == [("A", "A"), ("Cool-App  Pro!", "CoolApp"), ("Cool-App  Pro!", "Pro"),
                   ("a a", "a"), ("a a", "a")]


def test_vocabulary_smaller_than_k(spark):
    df = spark.createDataFrame([(1, "b a b c"), (2, "a b")], "id INT, t STRING")
    v = vocabulary(word_count(doc_tokens(df, "id", "t")), 10).orderBy("idx").collect()
    assert [(r["word"], r["idx"], r["cnt"]) for r in v] == [("b", 0, 3), ("a", 1, 2), ("c", 2, 1)]


def test_char_frequency_against_vocabulary(spark):
    df = spark.createDataFrame([(1, "abca")], "id INT, s STRING")
    vocab = spark.createDataFrame([("a", 0), ("zz", 1), ("c", 2)], "word STRING, idx INT")
    got = sorted(tuple(r) for r in char_frequency(df, "id", "s", vocab).collect())
    assert got == [(1, 0, 2), (1, 2, 1)]


def test_prefix_label_default_and_short_names(spark):
    from sparkfit.functions import prefix_label
    df = spark.createDataFrame([("AUX",), ("Aux",), ("",), ("A",), (None,), ("AU",)], "n STRING")
    got = [r["l"] for r in df.select(prefix_label("n").alias("l")).collect()]
    assert got == [1, 0, 0, 0, 0, 1]


def test_split_fields_is_naive(spark):
    from sparkfit.operators import split_fields
    df = lines_df(spark, ['a,"b,c",,d'])
    assert split_fields(df).collect()[0]["fields"] == ["a", '"b', 'c"', "", "d"]


def test_finite_only_drops_nan_and_inf(spark):
    out = clean_rows(lines_df(spark, [rec("A1"), rec("A2", r="NaN"), rec("A3", pr="-inf")]),
                     finite_only=True).collect()
    assert [r["app"] for r in out] == ["A1"]


def test_readme_flow(spark, tmp_path):
    """The README's flow on small files with a NaN line: every figure is finite."""
    import os
    import re

    from conftest import ROOT
    apps = ["app,a,b,rating,rc,x,mi,ma,y,price"]
    apps += [rec(f"{'AU' if i % 2 else 'Bo'} app{i % 7}", r=str(1 + i % 5), mi=str(i % 3), ma=str(10 * (1 + i % 5)))
             for i in range(40)] + [rec("Nan app", r="NaN")]
    docs = [f'<doc id="{"AU" if i % 2 else "Bx"}{i}" url="u" title="t">{"alpha beta" if i % 2 else "gamma beta"} w</doc>'
            for i in range(60)]
    for name, lines in (("apps.csv", apps), ("docs.txt", docs)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    code = re.search(r"```python\n(.*?)```", open(os.path.join(ROOT, "README.md")).read(), re.S)[1]
    code = code.replace('spark = build_session("local[*]")', "").replace("clear_scratch(spark)", "")
    code = code.replace('"apps.csv"', f'"{tmp_path}/apps.csv"').replace('"docs.txt"', f'"{tmp_path}/docs.txt"')
    names = {"spark": spark}
    exec(compile(code, "README", "exec"), names)
    from sparkfit.operators import descent_trace, ols_fit
    line = ols_fit(names["rows"], "rating", "max_install").first()
    assert line["n"] == 40 and math.isfinite(line["slope"])
    assert all(math.isfinite(t["cost"]) for t in descent_trace(names["rows"], "rating", "max_install").collect())
