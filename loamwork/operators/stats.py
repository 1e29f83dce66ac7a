"""Hypothesis tests, regression and correlation, each from one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.distributions import f_cdf, t_cdf, t_ppf


def describe_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean and sample variance per group."""
    return df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))


def ttest_one_sample(df: DataFrame, value: str, mu: float, alpha: float = 0.10) -> DataFrame:
    """t statistic (sample deviation), upper-tail critical value and decision."""
    a = df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    t = F.try_divide(F.col("mean") - mu, F.col("sd") / F.sqrt("n"))
    tested = a.withColumn("t", t).withColumn("t_crit", t_ppf(F.lit(1 - alpha), F.col("n") - 1))
    return tested.withColumn("reject", F.col("t") > F.col("t_crit"))


def two_groups(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """One row with n, mean and sample variance of both groups."""
    sides = []
    for side, name in (("1", first), ("2", second)):
        x = F.when(F.col(group) == name, F.col(value))
        sides += [F.count(x).alias(f"n{side}"), F.avg(x).alias(f"mean{side}"), F.var_samp(x).alias(f"var{side}")]
    return df.filter(F.col(group).isin(first, second)).agg(*sides)


def ftest_variance(sides: DataFrame) -> DataFrame:
    """F = larger / smaller variance with its degrees of freedom and p = 2 (1 - CDF)."""
    first_larger = F.col("var1") >= F.col("var2")
    larger, smaller = F.greatest("var1", "var2"), F.least("var1", "var2")
    tested = sides.withColumns(
        {
            "f": F.try_divide(larger, smaller),
            "f_df1": F.when(first_larger, F.col("n1")).otherwise(F.col("n2")) - 1,
            "f_df2": F.when(first_larger, F.col("n2")).otherwise(F.col("n1")) - 1,
        }
    )
    return tested.withColumn("f_p", 2 * (1 - f_cdf(F.col("f"), F.col("f_df1"), F.col("f_df2"))))


def ttest_two_sample(sides: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Pooled test when the variances may be equal (F test), Welch's otherwise; two-sided p."""
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "var1", "var2"))
    difference = F.col("mean1") - F.col("mean2")
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    share1, share2 = v1 / n1, v2 / n2
    welch_df = F.try_divide((share1 + share2) * (share1 + share2), share1 * share1 / (n1 - 1) + share2 * share2 / (n2 - 1))
    tested = ftest_variance(sides).withColumn("equal_variance", F.col("f_p") >= alpha).withColumns(
        {
            "t_pooled": F.try_divide(difference, F.sqrt(pooled * (1 / n1 + 1 / n2))),
            "df_pooled": (n1 + n2 - 2).cast("double"),
            "t_welch": F.try_divide(difference, F.sqrt(share1 + share2)),
            "df_welch": welch_df,
        }
    )
    chosen = tested.withColumns(
        {
            "t": F.when(F.col("equal_variance"), F.col("t_pooled")).otherwise(F.col("t_welch")),
            "df": F.when(F.col("equal_variance"), F.col("df_pooled")).otherwise(F.col("df_welch")),
        }
    )
    return chosen.withColumn("p", 2 * (1 - t_cdf(F.abs("t"), F.col("df"))))


def ols_simple(df: DataFrame, x: str, y: str, x_new: float) -> DataFrame:
    """Straight line y = a + b x: r, a, b, errors, t, two-sided p and the prediction at x_new."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    a = both.agg(
        F.count("*").alias("n"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
        F.avg(x).alias("mx"), F.avg(y).alias("my"),
    )
    fitted = (
        a.withColumn("slope", F.try_divide("sxy", "sxx"))
        .withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
        .withColumn("r", F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))))
        .withColumn("sse", F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)))
        .withColumn("mse", F.try_divide(F.col("sse"), (F.col("n") - 2).cast("double")))
        .withColumn("se_slope", F.sqrt(F.try_divide("mse", "sxx")))
        .withColumn("t", F.try_divide("slope", "se_slope"))
        .withColumn("y_new", F.col("intercept") + F.col("slope") * x_new)
    )
    return fitted.withColumn("p", 2 * (1 - t_cdf(F.abs("t"), (F.col("n") - 2).cast("double"))))


def next_in_series(df: DataFrame, series: str, place: Column, value: str) -> DataFrame:
    """Line through (0, y0), (1, y1), ... per series, read at the next place. ``place`` is 0-based."""
    line = df.select(F.col(series), place.alias("_x"), F.col(value).alias("_y"))
    agg = line.groupBy(series).agg(
        F.count("*").alias("n"), F.regr_slope("_y", "_x").alias("b"), F.avg("_x").alias("mx"), F.avg("_y").alias("my")
    )
    return agg.select(series, "n", (F.col("my") + F.coalesce("b", F.lit(0.0)) * (F.col("n") - F.col("mx"))).alias("next_value"))


def indicator_correlation(n: Column, s: Column, k: Column, ky: Column) -> Column:
    """Pearson correlation of two 0/1 columns from the rows, the ones of each and those of both; NULL where one is constant.

    Differences of products are exact decimals: with 100 million rows they are beyond a double, and a category and its
    complement would no longer be equal but for their sign.
    """
    n, s, k, ky = (c.cast("decimal(18,0)") for c in (n, s, k, ky))
    spread = (n * k - k * k).cast("double") * (n * s - s * s).cast("double")
    return F.when(spread > 0, (n * ky - k * s).cast("double") / F.sqrt(spread))


def correlation_with_target(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(feature, n, correlation) of numeric columns and of every category value with a 0/1 target.

    Numeric columns share one aggregate row. A 0/1 category feature needs only counts, so no wide
    0/1 matrix exists: its Pearson correlation follows from n, hits and target sums. Constant
    features drop out.
    """
    y = F.col(target).cast("double")
    parts = []
    for c in numeric:
        x = F.when(F.col(c).isNotNull() & y.isNotNull(), F.col(c).cast("double"))
        yy = F.when(x.isNotNull(), y)
        n, cov = F.count(x), F.covar_pop(x, yy)
        parts.append(
            F.struct(F.lit(c).alias("feature"), n.alias("n"), F.try_divide(cov, F.stddev_pop(x) * F.stddev_pop(yy)).alias("correlation"))
        )
    from_numbers = df.agg(F.array(*parts).alias("a")).select(F.inline("a"))
    rows = df.filter(y.isNotNull())
    totals = rows.agg(F.struct(F.count("*").cast("double").alias("n"), F.sum(y).alias("s")).alias("t")).scalar()
    names = [c for c in categorical]
    long = rows.select(y.alias("_y"), *[F.coalesce(F.col(c).cast("string"), F.lit("__MISSING__")).alias(c) for c in names])
    counts = long.unpivot(["_y"], names, "column", "value").groupBy("column", "value").agg(F.count("*").alias("k"), F.sum("_y").alias("ky"))
    n, closed = totals["n"], indicator_correlation(totals["n"], totals["s"], F.col("k"), F.col("ky"))
    from_values = counts.select(
        F.concat_ws("_", "column", "value").alias("feature"), n.cast("bigint").alias("n"), closed.alias("correlation")
    )
    return from_numbers.union(from_values).filter("correlation is not null")


def top_abs_correlation(correlations: DataFrame, n: int = 20) -> DataFrame:
    return correlations.orderBy(F.desc(F.abs("correlation")), "feature").limit(n)
