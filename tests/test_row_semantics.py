"""Row-level operators against a plain-Python statement of the same rules,
on generated inputs (hypothesis)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkfit.operators import clean_rows, doc_tokens, name_words, parse_doc_tags
from sparkfit.operators.clean import APP_FIELDS, NUMERIC_FIELDS


def py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def py_clean(line):
    """Split on every comma; keep the row when the five numeric fields parse.
    Too-short lines are dropped (the column version's documented choice)."""
    f = line.split(",")
    idx = [APP_FIELDS[n] for n in NUMERIC_FIELDS]
    if max(idx) >= len(f):
        return None
    vals = [py_float(f[i]) for i in idx]
    if any(v is None for v in vals):
        return None
    return (f[0], f[1], *vals)


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return a == b


FIELD = st.one_of(
    st.sampled_from(["1", "2.5", " 3 ", "NaN", "-inf", "1_0", "1d", "", "x", '"a', 'b"', "7e2", ".5"]),
    st.text(st.sampled_from(list("09._eE+- aN")), max_size=5),
)
LINE = st.lists(FIELD, min_size=6, max_size=12).map(lambda fs: ",".join(fs))


@settings(max_examples=25, deadline=None)
@given(st.lists(LINE, min_size=1, max_size=20))
def test_clean_rows_equals_python_rule(spark, lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i INT, value STRING")
    got = sorted((tuple(r) for r in clean_rows(df).collect()), key=repr)
    want = sorted((w for w in map(py_clean, lines) if w is not None), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(same(a, b) for a, b in zip(g, w)), (g, w)


def scan_cut(line):
    """(id, body) by walking the line: the id is what lies between its opening
    and closing marks, the body all but six characters behind the first end
    of a tag; nothing if a mark is missing."""
    _, opened, behind_open = line.partition('id="')
    before_close, closed, _ = line.partition('" url=')
    _, tagged, body = line.partition('">')
    if not (opened and closed and tagged):
        return None, None
    length = len(before_close) - (len(line) - len(behind_open))
    return behind_open[:max(0, length)], body[:max(0, len(body) - 6)]


PIECES = st.sampled_from(['id="', '" url=', '">', "</doc>", "<doc ", "abc", "é", "😀", " ", "9"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=10).map("".join), min_size=1, max_size=20))
def test_doc_tag_cut_equals_a_walk_over_the_line(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    got = [(r["doc_id"], r["text"]) for r in parse_doc_tags(df, keep=["value"]).orderBy("value").collect()]
    want = [scan_cut(x) for x in sorted(lines)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


TEXT = st.text(st.sampled_from(list("abcXYZ 19-'é\tİ\n.")), max_size=30)


LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs_of(text, wanted):
    """Maximal runs of wanted characters."""
    out, run = [], ""
    for ch in text + "\0":
        if ch in wanted:
            run += ch
        elif run:
            out.append(run)
            run = ""
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=15))
def test_tokens_are_the_runs_of_letters(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    got = {}
    for r in doc_tokens(df, "id", "t").orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["token"])
    for i, t in enumerate(texts):
        assert got.get(i, []) == [run.lower() for run in runs_of(t, LETTERS)]


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=15, unique=True))
def test_name_words_keep_letters_and_digits_between_blanks(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = sorted(tuple(r) for r in name_words(df, "n").collect())
    want = []
    for n in names:
        everything_else = set(n) - {" "}
        for piece in runs_of(n, everything_else):
            word = "".join(runs_of(piece, LETTERS + "0123456789"))
            want += [(n, word)] if word else []
    assert got == sorted(want)
