"""DuckDB SQL for each query key: an independent statement of what it computes.

Written in the reference's own terms where that differs from the Spark plan:
tokens by replace-then-split, descent by literal recurrence (recursive CTE)
with the cost as a direct pass over the rows, logistic steps unrolled as CTEs.
Column names and rounding match ``sparkfit.plans.queries``.
"""

from __future__ import annotations

import math

from sparkfit.functions.numeric import ASCII_OF_DIGITS, FLOAT_PATTERN, NON_ASCII_DIGITS
from sparkfit.plans import queries as Q
from sparkfit.plans import tables as T
from sparkfit.operators import gradient as G
from sparkfit.operators import logistic as L
from sparkfit.operators import regression as R
from sparkfit.operators import text as TX


def _r(expr: str, digits: int) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def _tokens(col: str) -> str:
    return (f"list_filter(string_split(lower(regexp_replace({col}, '[^a-zA-Z]', ' ', 'g')), ' '), "
            f"lambda t: t <> '')")


def _ascii(x: str) -> str:
    return f"translate({x}, '{NON_ASCII_DIGITS}', '{ASCII_OF_DIGITS}')"


def _float_ok(x: str) -> str:
    return f"coalesce(regexp_matches({_ascii(x)}, '{FLOAT_PATTERN}'), false)"


def _float_val(x: str) -> str:
    b = f"replace(regexp_extract({_ascii(x)}, '{FLOAT_PATTERN}', 1), '_', '')"
    return (f"(CASE WHEN {x} IS NULL OR {b} = '' THEN NULL "
            f"WHEN lower({b}) IN ('nan', '+nan', '-nan') THEN CAST('nan' AS DOUBLE) "
            f"WHEN lower({b}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
            f"WHEN lower({b}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) "
            f"ELSE TRY_CAST({b} AS DOUBLE) END)")


def _app_lines_cte() -> str:
    style = {v: k for k, v in T.RATING_STYLE.items()}
    return f"""lines AS (
  SELECT '{T.APP_HEADER}' AS value
  UNION ALL
  SELECT CASE WHEN p_brand = '{T.SHORT_LINE_BRAND}'
              THEN concat_ws(',', app, p_brand, p_type, rating, CAST(p_retailprice AS VARCHAR), p_type,
                             CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR))
              ELSE concat_ws(',', app, p_brand, p_type, rating, CAST(p_retailprice AS VARCHAR), p_type,
                             CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR), p_brand, price) END
  FROM (SELECT *,
          CASE p_type WHEN '{style['padded']}' THEN ' ' || CAST(p_size AS VARCHAR) || ' '
                      WHEN '{style['nan']}' THEN 'NaN'
                      WHEN '{style['empty']}' THEN ''
                      WHEN '{style['text']}' THEN 'n/a'
                      WHEN '{style['grouped']}' THEN CAST(p_size AS VARCHAR) || '_0'
                      ELSE CAST(p_size AS VARCHAR) END AS rating,
          CASE WHEN p_brand = '{T.QUOTED_NAME_BRAND}' THEN '"' || p_name || ', deluxe"' ELSE p_name END AS app,
          CASE WHEN p_brand = '{T.INF_PRICE_BRAND}' THEN 'inf' ELSE CAST(p_retailprice AS VARCHAR) END AS price
        FROM part) p
)"""


def _cleaned_cte() -> str:
    return f"""{_app_lines_cte()},
fl AS (SELECT string_split(value, ',') AS f FROM lines),
fs AS (SELECT f[1] AS app, f[2] AS name_text, f[4] AS r, f[5] AS rc, f[7] AS mi, f[8] AS ma, f[10] AS pr FROM fl),
cleaned AS (
  SELECT app, name_text, {_float_val('r')} AS rating, {_float_val('rc')} AS rating_count,
         {_float_val('mi')} AS min_install, {_float_val('ma')} AS max_install, {_float_val('pr')} AS price
  FROM fs
  WHERE {_float_ok('r')} AND {_float_ok('rc')} AND {_float_ok('mi')} AND {_float_ok('ma')} AND {_float_ok('pr')}
)"""


def _finite_cte() -> str:
    """Cleaned lines without a NaN or infinite field."""
    finite = " AND ".join(f"isfinite({x})" for x in ("rating", "rating_count", "min_install", "max_install", "price"))
    return f"{_cleaned_cte()},\nfinite AS (SELECT * FROM cleaned WHERE {finite})"


def _doc_lines_cte() -> str:
    text = "regexp_replace(text, '[\\r\\n]', ' ', 'g')"
    return f"""dl AS (
  SELECT doc_id AS src_id,
         CASE WHEN lang = '{T.UNTAGGED_LANG}' THEN {text}
              ELSE '<doc id="' || CAST(doc_id AS VARCHAR) || '" url="{T.DOC_URL_PREFIX}' || CAST(doc_id AS VARCHAR)
                   || '" title="' || lang || '">' || {text} || '</doc>' END AS value
  FROM documents
),
parsed AS (
  SELECT src_id,
         CASE WHEN instr(value, 'id="') = 0 OR instr(value, '" url=') = 0 OR instr(value, '">') = 0 THEN NULL
              ELSE substring(value, instr(value, 'id="') + 4,
                             greatest(instr(value, '" url=') - (instr(value, 'id="') + 4), 0)) END AS doc_id,
         CASE WHEN instr(value, 'id="') = 0 OR instr(value, '" url=') = 0 OR instr(value, '">') = 0 THEN NULL
              ELSE substring(value, instr(value, '">') + 2,
                             greatest(length(value) - (instr(value, '">') + 2) + 1 - 6, 0)) END AS text
  FROM dl
)"""


def _descent_sql(features: str, xs: list[str], rate: float, cost_digits: int,
                 beta_names: dict[str, str]) -> str:
    start, steps = R.DESCENT_START, R.DESCENT_STEPS
    sums = ", ".join(f"sum({x} * {x}) AS sxx_{x}, sum({x} * y) AS sxy_{x}" for x in xs)
    cols = ", ".join(f"b_{x}" for x in xs)
    init = ", ".join(f"CAST({start} AS DOUBLE)" for _ in xs)
    step = ", ".join(
        f"t.b_{x} - {rate} * ((-1.0 / m.n) * (m.sxy_{x} - t.b_{x} * m.sxx_{x}))" for x in xs)
    betas = ", ".join(f"{_r(f't.b_{x}', 9)} AS {beta_names[x]}" for x in xs)
    cost = " + ".join(f"(d.y - t.b_{x} * d.{x}) * (d.y - t.b_{x} * d.{x})" for x in xs)
    return f"""WITH RECURSIVE d AS ({features}),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, {sums} FROM d),
t(iteration, {cols}) AS (
  SELECT 0, {init}
  UNION ALL
  SELECT t.iteration + 1, {step} FROM t, m WHERE t.iteration < {steps - 1}
)
SELECT CAST(t.iteration AS INTEGER) AS iteration, {betas}, {_r(f'sum({cost})', cost_digits)} AS cost
FROM t, d GROUP BY t.iteration, {', '.join(f't.b_{x}' for x in xs)}"""


def _entity_sql() -> str:
    return """SELECT l_partkey, avg(l_quantity) AS rating, sum(l_extendedprice) AS rating_count,
       count_if(l_discount <> 0) AS min_install, sum(l_tax) AS price, count_if(l_tax <> 0) AS max_install
FROM lineitem GROUP BY l_partkey"""


def _vocab_cte(name: str, counts: str, k: int) -> str:
    return (f"{name} AS (SELECT word, CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS INTEGER) AS idx, cnt "
            f"FROM (SELECT word, cnt FROM {counts} ORDER BY cnt DESC, word LIMIT {k}) v)")


def _split_cut() -> str:
    return format(int(Q.SPLIT_FRACTION * 16 ** 8), "08x")


LABELED = ["lab AS (SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS y FROM labels l JOIN documents d ON d.doc_id = l.doc_id)",
           f"tok AS (SELECT d.doc_id, unnest({_tokens('d.text')}) AS word FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"]


def _named_ctes() -> list[str]:
    """Names of the cleaned finite lines as documents, their words as tokens."""
    return [_finite_cte(), "names AS (SELECT DISTINCT app AS doc_id FROM finite)",
            "tok AS (SELECT doc_id, regexp_replace(piece, '[^A-Za-z0-9]+', '', 'g') AS word FROM "
            "(SELECT doc_id, unnest(string_split(doc_id, ' ')) AS piece FROM names) p "
            "WHERE regexp_replace(piece, '[^A-Za-z0-9]+', '', 'g') <> '')",
            f"lab AS (SELECT DISTINCT doc_id, CASE WHEN starts_with(doc_id, '{Q.LABEL_PREFIX}') THEN 1.0 ELSE 0.0 END AS y FROM tok)"]


def _logit_ctes(steps: int = L.LOGIT_STEPS, tol: float = L.LOGIT_STOP_TOL, inputs: list[str] | None = None,
                start: str | None = None) -> str:
    """The descent over the rows of ``lab`` and ``tok`` (``inputs``) unrolled: per step i, scores s{i}, gradient g{i}, history
    m{i}, stop state st{i} (norm of the moved weights, whether an earlier step
    stopped, whether this one stops) and the next weights w{i+1}: frozen after
    a stop, moved but not shrunk on the stopping step, else moved and shrunk."""
    rate, l2, k, init = L.LOGIT_RATE, L.LOGIT_L2, TX.VOCAB_SIZE, Q.LOGIT_INIT
    parts = [
        *(inputs or LABELED),
        "wc AS (SELECT word, count(*) AS cnt FROM tok GROUP BY word)",
        _vocab_cte("vocab", "wc", k),
        "tf AS (SELECT t.doc_id, v.idx, CAST(count(*) AS DOUBLE) AS tf FROM tok t JOIN vocab v ON v.word = t.word GROUP BY t.doc_id, v.idx)",
        "sz AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab)",
        start or f"w0 AS (SELECT idx, CAST({init} AS DOUBLE) AS w FROM vocab)",
    ]
    for i in range(steps + 1):
        parts.append(
            f"s{i} AS (SELECT lab.doc_id, lab.y, 1.0 / (1.0 + exp(-coalesce(sum(tf.tf * w{i}.w), 0.0))) AS p "
            f"FROM lab LEFT JOIN tf ON tf.doc_id = lab.doc_id LEFT JOIN w{i} ON w{i}.idx = tf.idx "
            f"GROUP BY lab.doc_id, lab.y)")
        if i == steps:
            break
        parts.append(
            f"g{i} AS (SELECT w{i}.idx, w{i}.w, coalesce(sum((s{i}.p - s{i}.y) * tf.tf), 0.0) / (SELECT n FROM sz) AS g "
            f"FROM w{i} LEFT JOIN tf ON tf.idx = w{i}.idx LEFT JOIN s{i} ON s{i}.doc_id = tf.doc_id "
            f"GROUP BY w{i}.idx, w{i}.w)")
        parts.append(
            f"m{i} AS (SELECT {i} AS iteration, "
            f"sum(-y * ln(p + 1e-12) - (1 - y) * ln((1 - p) + 1e-12)) / (SELECT n FROM sz) AS loss, "
            f"sum(CASE WHEN (CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1 ELSE 0 END) / (SELECT n FROM sz) AS acc, "
            f"(SELECT sqrt(sum(g * g)) FROM g{i}) AS grad_norm FROM s{i})")
        was_done = f"(SELECT done FROM st{i - 1})" if i else "false"
        prev = f"(SELECT norm FROM st{i - 1})" if i else "0.0"
        parts.append(
            f"st{i} AS (SELECT norm, was_done, (was_done OR abs(norm - prev) < {tol!r}) AS done FROM "
            f"(SELECT (SELECT sqrt(sum((w - {rate} * g) * (w - {rate} * g))) FROM g{i}) AS norm, "
            f"{was_done} AS was_done, {prev} AS prev) x)")
        parts.append(
            f"w{i + 1} AS (SELECT g{i}.idx, CASE WHEN st.was_done THEN g{i}.w "
            f"WHEN st.done THEN g{i}.w - {rate} * g{i}.g "
            f"ELSE (g{i}.w - {rate} * g{i}.g) - 2 * {l2} * (g{i}.w - {rate} * g{i}.g) END AS w "
            f"FROM g{i}, st{i} st)")
    return "WITH " + ",\n".join(parts)


def _random_start() -> str:
    """w0 by Box-Muller over the md5 digits of seed, part and index."""
    def uniform(part: int) -> str:
        return (f"((('0x' || substring(md5('{Q.START_SEED}:{part}:' || CAST(idx AS VARCHAR)), 1, 10))::BIGINT + 0.5) "
                f"/ {float(1 << 40)!r})")
    return (f"w0 AS (SELECT idx, sqrt(-2.0 * ln({uniform(0)})) * cos({2 * math.pi!r} * {uniform(1)}) "
            f"* {L.LOGIT_INIT_STD} AS w FROM vocab)")


def _steps_done(tol: float) -> str:
    steps = " + ".join(f"(SELECT CASE WHEN done THEN 0 ELSE 1 END FROM st{i})" for i in range(L.LOGIT_STEPS))
    return f"CAST({steps} AS INTEGER)"


def _svm_ctes(steps: int = G.SVM_STEPS) -> str:
    """The batch SVM over the train half, unrolled: per pass i the scores s{i},
    gradient g{i}, sums m{i}, state st{i} (best loss and pass so far, slack,
    aimed-at loss, step) and the next weights and intercept."""
    tokens = _tokens("text")
    parts = [
        f"sp AS (SELECT d.doc_id, d.text, l.quality AS label, substring(md5(concat_ws(':', '{Q.SPLIT_SEED}', "
        f"CAST(d.doc_id AS VARCHAR))), 1, 8) < '{_split_cut()}' AS is_train "
        f"FROM documents d JOIN labels l ON l.doc_id = d.doc_id)",
        f"tok AS (SELECT doc_id, is_train, unnest({tokens}) AS word FROM sp)",
        "wc AS (SELECT word, count(*) AS cnt FROM tok WHERE is_train GROUP BY word)",
        _vocab_cte("vocab", "wc", TX.VOCAB_SIZE),
        "alltf AS (SELECT t.doc_id, t.is_train, v.idx, CAST(count(*) AS DOUBLE) AS tf FROM tok t "
        "JOIN vocab v ON v.word = t.word GROUP BY t.doc_id, t.is_train, v.idx)",
        "lab AS (SELECT doc_id, CASE WHEN label > 0 THEN 1.0 ELSE -1.0 END AS side FROM sp WHERE is_train)",
        "sz AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lab)",
        "tf AS (SELECT doc_id, idx, tf FROM alltf WHERE is_train)",
        "dev AS (SELECT v.idx, sqrt(greatest(coalesce(sum(tf.tf * tf.tf), 0) - coalesce(sum(tf.tf), 0) * coalesce(sum(tf.tf), 0) "
        "/ (SELECT n FROM sz), 0) / ((SELECT n FROM sz) - 1)) AS sd FROM vocab v LEFT JOIN tf ON tf.idx = v.idx GROUP BY v.idx)",
        "x AS (SELECT tf.doc_id, tf.idx, tf.tf / dev.sd AS v FROM tf JOIN dev ON dev.idx = tf.idx WHERE dev.sd > 0)",
        "w0 AS (SELECT idx, 0.0::DOUBLE AS w FROM vocab)", "b0 AS (SELECT 0.0::DOUBLE AS b)",
    ]
    for i in range(steps):
        parts += [
            f"s{i} AS (SELECT lab.doc_id, lab.side, coalesce(sum(x.v * w{i}.w), 0.0) + (SELECT b FROM b{i}) AS z FROM lab "
            f"LEFT JOIN x ON x.doc_id = lab.doc_id LEFT JOIN w{i} ON w{i}.idx = x.idx GROUP BY lab.doc_id, lab.side)",
            f"g{i} AS (SELECT w{i}.idx, w{i}.w, coalesce(sum(CASE WHEN 1 - s{i}.side * s{i}.z > {G.SVM_EPSILON!r} THEN -s{i}.side * x.v END), 0.0) "
            f"/ (SELECT n FROM sz) AS g FROM w{i} LEFT JOIN x ON x.idx = w{i}.idx LEFT JOIN s{i} ON s{i}.doc_id = x.doc_id "
            f"GROUP BY w{i}.idx, w{i}.w)",
            f"m{i} AS (SELECT sum(CASE WHEN 1 - side * z > {G.SVM_EPSILON!r} THEN 1 - side * z ELSE 0.0 END) / (SELECT n FROM sz) AS loss, "
            f"sum(CASE WHEN 1 - side * z > {G.SVM_EPSILON!r} THEN -side ELSE 0.0 END) / (SELECT n FROM sz) AS gb, "
            f"sum(CASE WHEN (z > 0) <> (side > 0) THEN 1 ELSE 0 END) AS errors FROM s{i})",
            f"q{i} AS (SELECT m.loss, m.gb, m.errors, (SELECT sum(g * g) FROM g{i}) + m.gb * m.gb AS size, "
            + (f"CASE WHEN m.loss < p.best - {G.SVM_EPSILON!r} THEN m.loss ELSE p.best END AS best, "
               f"CASE WHEN m.loss < p.best - {G.SVM_EPSILON!r} THEN {i} ELSE p.best_at END AS best_at, "
               f"CASE WHEN m.loss >= p.best - {G.SVM_EPSILON!r} AND p.stale + 1 = {G.SVM_PATIENCE} THEN p.slack / 2 ELSE p.slack END AS slack, "
               f"CASE WHEN m.loss < p.best - {G.SVM_EPSILON!r} OR p.stale + 1 = {G.SVM_PATIENCE} THEN 0 ELSE p.stale + 1 END AS stale "
               f"FROM m{i} m, q{i - 1} p)" if i else
               f"m.loss AS best, 0 AS best_at, m.loss AS slack, 0 AS stale FROM m{i} m)"),
            f"st{i} AS (SELECT *, greatest(0.0, best - slack) AS target, "
            f"CASE WHEN size > 0 THEN (loss - greatest(0.0, best - slack)) / size ELSE 0.0 END AS step FROM q{i})",
            f"w{i + 1} AS (SELECT g.idx, g.w - st.step * g.g AS w FROM g{i} g, st{i} st)",
            f"b{i + 1} AS (SELECT b.b - st.step * st.gb AS b FROM b{i} b, st{i} st)",
        ]
    return "WITH " + ",\n".join(parts)


def _svm_trace_sql(steps: int = G.SVM_STEPS) -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT {i} AS iteration, {_r('loss', 7)} AS loss, {_r('sqrt(size)', 7)} AS grad_norm, "
        f"CAST(errors AS BIGINT) AS errors, {_r('target', 7)} AS target FROM st{i}" for i in range(steps))
    return f"{_svm_ctes(steps)}\n{rows}"


def _svm_predict_sql(steps: int = G.SVM_STEPS) -> str:
    weights = " UNION ALL ".join(f"SELECT {i} AS i, idx, w FROM w{i}" for i in range(steps))
    biases = " UNION ALL ".join(f"SELECT {i} AS i, b FROM b{i}" for i in range(steps))
    best = f"(SELECT best_at FROM q{steps - 1})"
    return (f"{_svm_ctes(steps)},\nbw AS (SELECT idx, w FROM ({weights}) a WHERE i = {best}), "
            f"bb AS (SELECT b FROM ({biases}) a WHERE i = {best}), "
            f"sc AS (SELECT sp.doc_id, sp.label, coalesce(sum(CASE WHEN dev.sd > 0 THEN t.tf / dev.sd * bw.w END), 0.0) "
            f"+ (SELECT b FROM bb) AS z FROM sp LEFT JOIN alltf t ON t.doc_id = sp.doc_id LEFT JOIN bw ON bw.idx = t.idx "
            f"LEFT JOIN dev ON dev.idx = t.idx WHERE NOT sp.is_train GROUP BY sp.doc_id, sp.label)\n"
            f"SELECT doc_id, CAST(label AS INTEGER) AS label, {_r('z', 6)} AS score, "
            f"CASE WHEN z > 0 THEN 1 ELSE 0 END AS prediction, {best} AS best FROM sc")


def _logit_trace_sql(tol: float = L.LOGIT_STOP_TOL, inputs: list[str] | None = None) -> str:
    steps = L.LOGIT_STEPS
    union = "\nUNION ALL\n".join(
        f"SELECT m{i}.* FROM m{i}, st{i} WHERE NOT st{i}.done" for i in range(steps))
    return (f"{_logit_ctes(tol=tol, inputs=inputs)}\nSELECT CAST(iteration AS INTEGER) AS iteration, {_r('loss', 9)} AS loss, "
            f"{_r('acc', 9)} AS acc, {_r('grad_norm', 9)} AS grad_norm FROM ({union}) h")


def _logit_final() -> str:
    return f"w{L.LOGIT_STEPS}"


def _sql() -> dict[str, str]:
    cleaned = _cleaned_cte()
    tokens = _tokens("text")
    s_last = f"s{L.LOGIT_STEPS}"
    w_last = _logit_final()
    return {
        "text_scan": f"WITH {_app_lines_cte()} SELECT value FROM lines",
        "split_clean": f"WITH {cleaned} SELECT * FROM cleaned",
        "project_cast": f"WITH {cleaned} SELECT app, min_install, rating, max_install FROM cleaned",
        "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "csv_infer": "\nUNION ALL\n".join(
            f"SELECT {i} AS pos, '{name}' AS name, CASE coalesce(max(CASE WHEN v IS NULL THEN 0 "
            f"WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 1 WHEN regexp_full_match(v, '[+-]?[0-9]+\\.[0-9]*') THEN 2 "
            f"ELSE 3 END), 0) WHEN 1 THEN 'bigint' WHEN 2 THEN 'double' ELSE 'string' END AS type, count(v) AS n_values "
            f"FROM (SELECT CAST({value} AS VARCHAR) AS v FROM documents) t"
            for i, (name, value) in enumerate([
                ("doc_id", "doc_id"), ("text", "text"), ("lang", "lang"), ("n_chars", "n_chars"), ("quarter", "n_chars / 4.0"),
                ("mixed", f"CASE WHEN lang = '{Q.MIXED_LANG}' THEN 'n/a' ELSE CAST(n_chars AS VARCHAR) END"),
                ("never", "NULL")])),
        "sample_exact": (f"SELECT {', '.join(Q.SAMPLE_COLUMNS)} FROM lineitem ORDER BY md5(concat_ws(':', "
                         f"'{Q.SAMPLE_SEED}', {', '.join(f'CAST({c} AS VARCHAR)' for c in Q.SAMPLE_COLUMNS[:4])})) "
                         f"LIMIT {Q.SAMPLE_N}"),
        "ols_fit": (f"SELECT CAST(count(*) AS BIGINT) AS n, {_r('regr_slope(p_retailprice, p_size)', 8)} AS slope, "
                    f"{_r('regr_intercept(p_retailprice, p_size)', 8)} AS intercept, "
                    f"printf('y = %.4fX + %.4f', regr_slope(p_retailprice, p_size), "
                    f"regr_intercept(p_retailprice, p_size)) AS equation FROM part"),
        "gd_univariate_trace": _descent_sql(
            "SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part", ["x"],
            R.UNIVARIATE_RATE, 1, {"x": "beta"}),
        "entity_features": (f"SELECT l_partkey AS app, {_r('rating', 8)} AS rating, "
                            f"{_r('rating_count', 4)} AS rating_count, CAST(min_install AS BIGINT) AS min_install, "
                            f"{_r('price', 8)} AS price, CAST(max_install AS BIGINT) AS max_install "
                            f"FROM ({_entity_sql()}) e"),
        "gd_independent_trace": _descent_sql(
            f"SELECT rating, rating_count / {Q.PRICE_SUM_UNIT} AS rating_count, "
            f"CAST(min_install AS DOUBLE) AS min_install, price, CAST(max_install AS DOUBLE) AS y "
            f"FROM ({_entity_sql()}) e",
            ["rating", "rating_count", "min_install", "price"], R.INDEPENDENT_RATE, 3,
            {x: f"beta_{x}" for x in ["rating", "rating_count", "min_install", "price"]}),
        "collect_by_key": ("SELECT l_suppkey AS key, l_quantity AS value, count(*) AS cnt "
                           "FROM lineitem GROUP BY l_suppkey, l_quantity"),
        "combine_by_key": (f"SELECT n_chars, array_to_string(list_transform(list(doc_id ORDER BY doc_id DESC)"
                           f"[1:{Q.TOP_VALUES}], lambda v: CAST(v AS VARCHAR)), ',') AS largest "
                           f"FROM documents GROUP BY n_chars"),
        "lists_by_key": (f"WITH p AS (SELECT source, n_chars, row_number() OVER "
                         f"(PARTITION BY source ORDER BY n_chars NULLS LAST) - 1 AS pos FROM documents) "
                         f"SELECT source, CAST(pos // {Q.LIST_ROWS} AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n, "
                         f"coalesce(string_agg(CAST(n_chars AS VARCHAR), ',' ORDER BY pos), '') AS lengths "
                         f"FROM p GROUP BY source, pos // {Q.LIST_ROWS}"),
        "distinct_keys": "SELECT DISTINCT p_name FROM part",
        "row_counts": (f"WITH t AS (SELECT {tokens} AS toks FROM documents) "
                       f"SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(len(toks)) AS BIGINT) AS n_tokens, "
                       f"(SELECT count(DISTINCT w) FROM (SELECT unnest(toks) AS w FROM t) u) AS n_words FROM t"),
        "name_words": ("SELECT name, regexp_replace(piece, '[^A-Za-z0-9]+', '', 'g') AS word FROM "
                       "(SELECT name, unnest(string_split(name, ' ')) AS piece FROM "
                       "(SELECT DISTINCT p_name AS name FROM part) n) p "
                       "WHERE regexp_replace(piece, '[^A-Za-z0-9]+', '', 'g') <> ''"),
        "doc_tokens": (f"SELECT doc_id, CAST(unnest(range(len(toks))) AS BIGINT) AS pos, unnest(toks) AS token "
                       f"FROM (SELECT doc_id, {tokens} AS toks FROM documents) t"),
        "word_count": (f"SELECT word, count(*) AS cnt FROM "
                       f"(SELECT unnest({tokens}) AS word FROM documents) t GROUP BY word"),
        "top_words": (f"SELECT word, count(*) AS cnt FROM (SELECT unnest({tokens}) AS word FROM documents) t "
                      f"GROUP BY word ORDER BY cnt DESC, word LIMIT {TX.VOCAB_SIZE}"),
        "frequent_words": (f"SELECT word, count(*) AS cnt FROM (SELECT unnest({tokens}) AS word FROM documents) t "
                           f"GROUP BY word ORDER BY cnt DESC, word LIMIT {Q.FREQUENT}"),
        "vocab_index": (f"WITH wc AS (SELECT word, count(*) AS cnt FROM "
                        f"(SELECT unnest({tokens}) AS word FROM documents) t GROUP BY word), "
                        f"{_vocab_cte('vocab', 'wc', TX.VOCAB_SIZE)} SELECT word, idx, cnt FROM vocab"),
        "term_frequency": (f"WITH tok AS (SELECT doc_id, unnest({tokens}) AS word FROM documents), "
                           f"wc AS (SELECT word, count(*) AS cnt FROM tok GROUP BY word), "
                           f"{_vocab_cte('vocab', 'wc', TX.VOCAB_SIZE)} "
                           f"SELECT t.doc_id, v.idx, count(*) AS tf FROM tok t JOIN vocab v ON v.word = t.word "
                           f"GROUP BY t.doc_id, v.idx"),
        "char_frequency": (f"WITH tok AS (SELECT unnest({tokens}) AS word FROM documents), "
                           f"wc AS (SELECT word, count(*) AS cnt FROM tok GROUP BY word), "
                           f"{_vocab_cte('vocab', 'wc', TX.VOCAB_SIZE)} "
                           f"SELECT c.doc_id, v.idx, count(*) AS tf FROM "
                           f"(SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) c "
                           f"JOIN vocab v ON v.word = c.ch GROUP BY c.doc_id, v.idx"),
        "char_counts": ("SELECT doc_id, ch, count(*) AS tf FROM "
                           "(SELECT doc_id, unnest(string_split(source, '')) AS ch FROM documents) c "
                           "GROUP BY doc_id, ch"),
        "holdout_features": (
            f"WITH sp AS (SELECT doc_id, text, substring(md5(concat_ws(':', '{Q.SPLIT_SEED}', "
            f"CAST(doc_id AS VARCHAR))), 1, 8) < '{_split_cut()}' AS is_train FROM documents), "
            f"tr AS (SELECT unnest({tokens}) AS word FROM sp WHERE is_train), "
            f"wc AS (SELECT word, count(*) AS cnt FROM tr GROUP BY word), "
            f"{_vocab_cte('vocab', 'wc', TX.VOCAB_SIZE)}, "
            f"te AS (SELECT doc_id, unnest({tokens}) AS word FROM sp WHERE NOT is_train) "
            f"SELECT te.doc_id, v.idx, count(*) AS tf FROM te JOIN vocab v ON v.word = te.word "
            f"GROUP BY te.doc_id, v.idx"),
        "prefix_label": (f"SELECT p_partkey, p_name, CAST(coalesce(starts_with(p_name, '{Q.LABEL_PREFIX}'), false) "
                         f"AS INTEGER) AS label FROM part"),
        "key_index": ("SELECT p_name, CAST(max(pos) AS BIGINT) AS id FROM "
                      "(SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part) p "
                      "GROUP BY p_name"),
        "keyed_join": (
            "WITH ids AS (SELECT p_name, max(pos) AS id FROM "
            "(SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part) p GROUP BY p_name), "
            f"lab AS (SELECT id, CAST(starts_with(p_name, '{Q.LABEL_PREFIX}') AS INTEGER) AS label FROM ids) "
            "SELECT CAST(ids.id AS BIGINT) AS id, part.p_size, lab.label FROM part JOIN ids USING (p_name) "
            "JOIN lab ON lab.id = ids.id"),
        "join_fanout": (
            "WITH r AS (SELECT d.lang FROM documents d JOIN labels l ON l.doc_id = d.doc_id), "
            "pairs AS (SELECT d.lang, count(*) AS n_pairs FROM documents d JOIN r ON r.lang = d.lang GROUP BY d.lang) "
            "SELECT lang, (SELECT count(*) FROM documents d WHERE d.lang = pairs.lang) AS n_left, "
            "(SELECT count(*) FROM r WHERE r.lang = pairs.lang) AS n_right, n_pairs FROM pairs"),
        "keyed_join_sorted": ("SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, "
                              "CAST(row_number() OVER (ORDER BY d.doc_id) - 1 AS BIGINT) AS pos "
                              "FROM documents d JOIN labels l ON l.doc_id = d.doc_id"),
        "doc_tag_parse": f"WITH {_doc_lines_cte()} SELECT src_id, doc_id, text FROM parsed",
        "doc_sort_desc": (f"WITH {_doc_lines_cte()} SELECT doc_id, CAST(len({_tokens('text')}) AS BIGINT) AS n_words, "
                          f"CAST(row_number() OVER (ORDER BY doc_id DESC) - 1 AS BIGINT) AS pos "
                          f"FROM parsed WHERE doc_id IS NOT NULL"),
        "logit_trace": _logit_trace_sql(),
        "logit_weights": (f"{_logit_ctes()}\nSELECT {w_last}.idx, vocab.word, {_r(f'{w_last}.w', 10)} AS w "
                          f"FROM {w_last} JOIN vocab ON vocab.idx = {w_last}.idx"),
        "logit_predict": (f"{_logit_ctes()}\nSELECT doc_id, CAST(y AS INTEGER) AS y, {_r('p', 9)} AS p, "
                          f"CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM {s_last}"),
        "logit_random_start": (f"{_logit_ctes(start=_random_start())}\nSELECT {w_last}.idx, vocab.word, {_r(f'{w_last}.w', 10)} AS w, "
                               f"{_steps_done(L.LOGIT_STOP_TOL)} AS steps FROM {w_last} JOIN vocab ON vocab.idx = {w_last}.idx"),
        "logit_early_stop": (f"{_logit_ctes(tol=Q.STOP_TOL)}\nSELECT {w_last}.idx, vocab.word, {_r(f'{w_last}.w', 10)} AS w, "
                             f"{_steps_done(Q.STOP_TOL)} AS steps, (SELECT done FROM st{L.LOGIT_STEPS - 1}) AS stopped "
                             f"FROM {w_last} JOIN vocab ON vocab.idx = {w_last}.idx"),
        "svm_trace": _svm_trace_sql(),
        "svm_predict": _svm_predict_sql(),
        "top_coefficients": (
            f"{_logit_ctes()}\nSELECT CAST(row_number() OVER (ORDER BY w ASC, word DESC) - 1 AS INTEGER) AS rank, "
            f"word, idx, w FROM (SELECT vocab.word, {w_last}.idx, {_r(f'{w_last}.w', 10)} AS w FROM {w_last} "
            f"JOIN vocab ON vocab.idx = {w_last}.idx ORDER BY w DESC, word ASC LIMIT 5) b"),
        "confusion_metrics": (
            f"{_logit_ctes()},\nc AS (SELECT CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pr, CAST(y AS INTEGER) AS yy "
            f"FROM {s_last})\n"
            f"SELECT {_r('CAST(count_if(pr = yy) AS DOUBLE) / (SELECT n FROM sz)', 9)} AS acc, "
            f"CAST(count_if(pr = 1 AND yy = 1) AS BIGINT) AS tp, CAST(count_if(pr = 1 AND yy <> 1) AS BIGINT) AS fp, "
            f"CAST(count_if(pr <> 1 AND yy = 1) AS BIGINT) AS fn, CAST(count_if(pr <> 1 AND yy <> 1) AS BIGINT) AS tn, "
            f"CASE WHEN 2 * count_if(pr = 1 AND yy = 1) + count_if(pr <> 1 AND yy = 1) + count_if(pr = 1 AND yy <> 1) = 0 "
            f"THEN NULL ELSE {_r('2.0 * count_if(pr = 1 AND yy = 1) / (2 * count_if(pr = 1 AND yy = 1) + count_if(pr <> 1 AND yy = 1) + count_if(pr = 1 AND yy <> 1))', 9)} END AS f1 "
            f"FROM c"),
        "line_fit": (
            f"SELECT -1 AS iteration, {_r('regr_slope(rating, max_install)', 7)} AS slope, "
            f"{_r('regr_intercept(rating, max_install)', 7)} AS value FROM (WITH {_finite_cte()} SELECT * FROM finite) o "
            f"UNION ALL SELECT iteration, {_r('beta', 7)}, cost FROM ("
            + _descent_sql(f"WITH {_finite_cte()} SELECT max_install AS x, rating AS y FROM finite", ["x"],
                           R.UNIVARIATE_RATE, 1, {"x": "beta"}) + ") t"),
        "line_features": _descent_sql(
            f"WITH {_finite_cte()} SELECT avg(rating) AS rating, sum(rating_count) / {Q.PRICE_SUM_UNIT} AS rating_count, "
            f"CAST(count_if(min_install <> 0) AS DOUBLE) AS min_install, sum(price) / {Q.PRICE_SUM_UNIT} AS price, "
            f"CAST(count_if(max_install <> 0) AS DOUBLE) AS y FROM finite GROUP BY app",
            ["rating", "rating_count", "min_install", "price"], R.INDEPENDENT_RATE, 3,
            {x: f"beta_{x}" for x in ["rating", "rating_count", "min_install", "price"]}),
        "name_logit": _logit_trace_sql(inputs=_named_ctes()),
        "svm_features": (
            f"WITH sp AS (SELECT d.doc_id, d.text, l.quality AS label, substring(md5(concat_ws(':', '{Q.SPLIT_SEED}', "
            f"CAST(d.doc_id AS VARCHAR))), 1, 8) < '{_split_cut()}' AS is_train "
            f"FROM documents d JOIN labels l ON l.doc_id = d.doc_id), "
            f"tok AS (SELECT doc_id, label, is_train, unnest({tokens}) AS word FROM sp), "
            f"wc AS (SELECT word, count(*) AS cnt FROM tok WHERE is_train GROUP BY word), "
            f"{_vocab_cte('vocab', 'wc', TX.VOCAB_SIZE)} "
            f"SELECT t.doc_id, CASE WHEN t.is_train THEN 'train' ELSE 'test' END AS split, t.label, v.idx, "
            f"count(*) AS tf FROM tok t JOIN vocab v ON v.word = t.word GROUP BY t.doc_id, t.is_train, t.label, v.idx"),
        "multiclass_metrics": (
            "WITH pr AS (SELECT CAST(quality AS DOUBLE) AS l, CAST(CASE WHEN toxic = 0 THEN 1 ELSE 0 END AS DOUBLE) AS p "
            "FROM labels), "
            "cm AS (SELECT l, p, count(*) AS c FROM pr GROUP BY l, p), "
            "pl AS (SELECT l AS cls, sum(c) AS n_true, sum(CASE WHEN l = p THEN c ELSE 0 END) AS tp FROM cm GROUP BY l), "
            "pp AS (SELECT p AS cls, sum(c) AS n_pred FROM cm GROUP BY p), "
            "m AS (SELECT pl.n_true, pl.tp, CASE WHEN coalesce(pp.n_pred, 0) = 0 THEN 0.0 "
            "ELSE CAST(pl.tp AS DOUBLE) / pp.n_pred END AS prec, CAST(pl.tp AS DOUBLE) / pl.n_true AS rec "
            "FROM pl LEFT JOIN pp ON pp.cls = pl.cls) "
            f"SELECT {_r('CAST(sum(tp) AS DOUBLE) / sum(n_true)', 9)} AS accuracy, "
            f"{_r('sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END * n_true) / sum(n_true)', 9)} "
            "AS weighted_f1 FROM m"),
    }


ORACLE_SQL: dict[str, str] = _sql()
