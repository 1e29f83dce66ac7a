"""Group reports, KPIs, imputation and scaling. All combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.values import clamp, percent_parse, round_scaled, week_start, within_last
from loamwork.operators.ordered import exact_median


def group_rate_stats(df: DataFrame, keys: Sequence[str], flags: dict[str, Column], scores: dict[str, Column], min_rows: int = 2) -> DataFrame:
    """Head count, rates of 0/1 flags and means of whole-number scores; only groups above ``min_rows``."""
    rates = [F.avg(flag.cast("double")).alias(name) for name, flag in flags.items()]
    means = [F.avg(score.cast("bigint")).alias(name) for name, score in scores.items()]
    return df.groupBy(*keys).agg(F.count("*").alias("headcount"), *rates, *means).filter(F.col("headcount") > min_rows)


def weekly_counts(df: DataFrame, ts: str, reference: Column, groups: Sequence[str] = (), weeks: int = 12, value: Column | None = None) -> DataFrame:
    """Count (or another aggregate) per week and group over the last weeks before ``reference``."""
    recent = df.filter(within_last(F.col(ts), reference, 7 * weeks))
    measure = (F.count("*") if value is None else value).alias("value")
    return recent.groupBy(week_start(F.col(ts)).alias("week_start"), *groups).agg(measure)


def weekly_active_users(df: DataFrame, ts: str, user: str, reference: Column, active: Column, weeks: int = 12) -> DataFrame:
    """Distinct active users per week. Repeats are removed before users are counted."""
    return weekly_counts(df.filter(active), ts, reference, weeks=weeks, value=F.count_distinct(user))


def label_kpis(df: DataFrame, label: str, percent: str) -> DataFrame:
    """Total, count per risk label, mean of a percent text (bad texts are left out)."""
    counts = [F.count_if(F.col(label) == name).alias(f"n_{name.lower()}") for name in ("High", "Medium", "Low")]
    return df.agg(F.count("*").alias("n_total"), *counts, F.avg(percent_parse(F.col(percent))).alias("mean_percent"))


def anomaly_kpis(df: DataFrame, flag: str, score: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(flag)).alias("n_anomalies"),
        F.coalesce(F.round(F.max(score), 4), F.lit(0.0)).alias("max_score"),
        F.coalesce(F.round(F.avg(score), 4), F.lit(0.0)).alias("mean_score"),
    )


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, share): share of every value per column, one scan for all columns."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "total")
    return counts.join(totals, "column").select("column", "value", (F.col("n") / F.col("total")).alias("share"))


def next_id(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column) + 1, F.lit(1)).alias("next_id"))


def median_impute(train: DataFrame, df: DataFrame, columns: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Fill NULLs with the training median; columns in ``zero`` get 0 instead."""
    fills = {c: F.coalesce(F.col(c).cast("double"), exact_median(train, c).scalar()) for c in columns}
    fills.update({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in zero})
    return df.withColumns(fills)


def standard_scale(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation of the training rows; a deviation of 0 counts as 1."""
    fitted = train.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("fit"))
    fit = fitted.scalar()
    scaled = {}
    for c in columns:
        deviation = F.coalesce(F.nullif(fit[c]["s"], F.lit(0.0)), F.lit(1.0))
        scaled[c] = (F.col(c) - fit[c]["m"]) / deviation
    return df.withColumns(scaled)


def weighted_score(df: DataFrame, key: str, weight: str, score: str) -> DataFrame:
    """Weighted mean of scores clamped to 0..100 per key; rows without numbers are left out."""
    w, s = F.col(weight).try_cast("double"), F.col(score).try_cast("double")
    usable = w.isNotNull() & s.isNotNull()
    heavy = F.when(usable, F.greatest(w, F.lit(0.01)))
    total = F.try_divide(F.sum(clamp(s, 0.0, 100.0) * heavy), F.sum(heavy))
    return df.groupBy(key).agg(F.coalesce(round_scaled(total, 2), F.lit(0.0)).alias("weighted_score"))


def resource_summary(df: DataFrame, label: str, ts: str, metrics: Sequence[str]) -> DataFrame:
    """Duration, sample count, mean and peak of every metric per label."""
    pairs = [x for m in metrics for x in (F.round(F.avg(m), 4).alias(f"{m}_avg"), F.round(F.max(m), 4).alias(f"{m}_peak"))]
    seconds = F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / 1e6
    return df.groupBy(label).agg(F.round(seconds, 4).alias("duration_sec"), F.count("*").alias("samples"), *pairs)
