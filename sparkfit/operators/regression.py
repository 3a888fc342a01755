"""Straight-line fits: least squares, and batch gradient descent by moments.

Descent without intercept on y ~ b*x has a gradient that depends on the data
only through three sums, so one aggregation replaces a pass per step:

    sum(x*r) = Sxy - b*Sxx             with r = y - b*x
    b' = b + rate/n * (Sxy - b*Sxx)  =>  b_i = b* + (b_0 - b*) * q^i,
    b* = Sxy/Sxx,  q = 1 - rate*Sxx/n

The cost of a step is the best slope's cost, summed directly from residuals in
a second pass, plus (b_i - b*)^2 * Sxx: no large sums are subtracted from one
another. The trace is generated from the single row of sums by ``explode``,
with no join. Pairs with a missing value count nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The step sizes, step counts and start of the two descents.
UNIVARIATE_RATE = 0.00001
INDEPENDENT_RATE = 0.000001
DESCENT_STEPS = 100
DESCENT_START = 0.1


def ols_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least squares with intercept: one row (n, slope, intercept, equation)."""
    fit = df.agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )
    return fit.withColumn(
        "equation", F.format_string("y = %.6fX + %.6f", F.col("slope"), F.col("intercept")))


def moments(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """One row with, per feature over the rows where it and y are present:
    n_<x>, Sxx_<x> and Sxy_<x>."""
    aggs = []
    for x in xs:
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggs += [F.count_if(both).cast("double").alias(f"n_{x}"),
                 F.sum(F.when(both, F.col(x) * F.col(x))).alias(f"Sxx_{x}"),
                 F.sum(F.when(both, F.col(x) * F.col(y))).alias(f"Sxy_{x}")]
    return df.agg(*aggs)


def descent_trace(df: DataFrame, y: str, x: str, rate: float = UNIVARIATE_RATE,
                  steps: int = DESCENT_STEPS, start: float = DESCENT_START) -> DataFrame:
    """(iteration, beta, cost) for ``steps`` steps; beta and cost are taken
    *before* each step, cost is the plain sum of squared residuals."""
    return independent_descent_trace(df, y, [x], rate, steps, start, beta_names={x: "beta"})


def independent_descent_trace(df: DataFrame, y: str, xs: list[str],
                              rate: float = INDEPENDENT_RATE, steps: int = DESCENT_STEPS,
                              start: float = DESCENT_START,
                              beta_names: dict[str, str] | None = None) -> DataFrame:
    """Element-wise descent: each feature is fitted alone, as ``x*beta`` is a
    product per component. Cost per step is the sum over features of each
    feature's sum of squared residuals. Columns: iteration, beta_<x>..., cost.
    A feature without a row or with all values 0 stays at the start.
    """
    names = beta_names or {x: f"beta_{x}" for x in xs}
    m = moments(df, y, xs)
    best = {x: F.when(F.col(f"Sxx_{x}") > 0, F.col(f"Sxy_{x}") / F.col(f"Sxx_{x}")).otherwise(F.lit(start))
            for x in xs}
    # Second pass: residuals at the best slopes, read from the first pass's one row.
    slopes = m.select(F.struct(*[best[x].alias(x) for x in xs]).alias("b")).scalar()
    left = df.select(F.col(y).alias("_y"), *[F.col(x).alias(f"_x{i}") for i, x in enumerate(xs)],
                     slopes.alias("_best"))
    residuals = left.agg(*[F.sum(F.pow(F.col("_y") - F.col("_best")[x] * F.col(f"_x{i}"), 2)).alias(f"sse_{x}")
                           for i, x in enumerate(xs)])
    sums = residuals.select(F.struct(*[F.coalesce(f"sse_{x}", F.lit(0.0)).alias(x) for x in xs]).alias("s")).scalar()
    one = m.select("*", *[best[x].alias(f"best_{x}") for x in xs], sums.alias("_s"))
    it = one.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("iteration"))
    cost, betas = None, []
    for x in xs:
        sxx, top = F.coalesce(f"Sxx_{x}", F.lit(0.0)), F.col(f"best_{x}")
        shrink = F.when(F.col(f"n_{x}") > 0, F.lit(1.0) - F.lit(rate) * sxx / F.col(f"n_{x}")).otherwise(F.lit(1.0))
        off = (F.lit(start) - top) * F.pow(shrink, F.col("iteration").cast("double"))
        betas.append((top + off).alias(names[x]))
        term = F.col("_s")[x] + off * off * sxx
        cost = term if cost is None else cost + term
    return it.select("iteration", *betas, cost.alias("cost"))
