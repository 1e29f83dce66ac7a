"""Daily series: regular filling, trailing medians, forecasts. Rows are first reduced to one per
item and day, so a very active item is as short as any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions.text import bind
from loamwork.functions.values import round_scaled
from loamwork.session import hold


def steady_mean(v: str) -> Column:
    """Mean whose sum does not depend on the order of the rows: of the parts above and below 2^-20, the first adds up exactly."""
    x = F.col(v).cast("double")
    high = F.rint(x * 1048576.0) / 1048576.0
    finite = F.abs(x) < 1e300
    return F.try_divide(F.sum(F.when(finite, high).otherwise(x)) + F.sum(F.when(finite, x - high).otherwise(0.0)), F.count(v))


def daily_means(df: DataFrame, item: str, ts: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(item, F.to_date(ts).alias("day")).agg(*[steady_mean(v).alias(v) for v in values])


def regular_daily_fill(daily: DataFrame, item: str, values: Sequence[str]) -> DataFrame:
    """Every day between the first and the last of an item; gaps filled forward, then backward."""
    spans = daily.groupBy(item).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = spans.select(item, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    full = calendar.join(daily, [item, "day"], "left")
    so_far = Window.partitionBy(item).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(item).orderBy("day").rowsBetween(0, Window.unboundedFollowing)
    return full.select(
        item, "day", *[F.coalesce(F.last(v, True).over(so_far), F.first(v, True).over(onward)).alias(v) for v in values]
    )


def trailing_median(daily: DataFrame, item: str, values: Sequence[str], n: int = 14, digits: int = 1) -> DataFrame:
    """Median of the last n days per item, rounded, then cut to a whole number."""
    newest = Window.partitionBy(item).orderBy(F.desc("day"))
    last = daily.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= n)
    sorted_values = last.groupBy(item).agg(*[F.sort_array(F.collect_list(F.col(v).cast("double"))).alias(v) for v in values])
    return sorted_values.select(item, *[round_scaled(middle(F.col(v)), digits).cast("bigint").alias(v) for v in values])


def middle(s: Column) -> Column:
    """Median of a sorted array, as the lower middle value plus half the step to the upper one; NULL of an empty one."""
    low, high = F.get(s, F.floor((F.size(s) - 1) / 2).cast("int")), F.get(s, F.floor(F.size(s) / 2).cast("int"))
    return low + (high - low) * 0.5


def future_days(daily: DataFrame, item: str, horizon: int) -> DataFrame:
    """(item, step, day) for the days behind the last one of each item."""
    last = daily.groupBy(item).agg(F.max("day").alias("_last"))
    return last.select(item, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")).select(
        item, "step", F.date_add("_last", F.col("step")).alias("day")
    )


def forecast_covariates(daily: DataFrame, item: str, values: Sequence[str], horizon: int = 14, n: int = 14) -> DataFrame:
    """Future days with every covariate at its trailing median."""
    return future_days(daily, item, horizon).join(trailing_median(daily, item, values, n), item)


def forecast_seasonal_drift(daily: DataFrame, item: str, value: str, horizon: int = 14, season: int = 7) -> DataFrame:
    """Seasonal-naive forecast plus drift per item on a regular daily series.

    The value of the same weekday in the last season is moved by the slope of the item's line.
    """
    spans = Window.partitionBy(item).orderBy("day")
    placed = daily.select(item, "day", value, (F.row_number().over(spans) - 1).alias("_x"), F.count("*").over(Window.partitionBy(item)).alias("_n"))
    slope = placed.groupBy(item).agg(F.coalesce(F.regr_slope(value, "_x"), F.lit(0.0)).alias("_b"))
    season_rows = placed.filter(F.col("_x") >= F.col("_n") - season).select(
        item, (F.col("_x") - F.col("_n") + F.least("_n", F.lit(season))).alias("_slot"), F.col(value).alias("_base"),
        F.least("_n", F.lit(season)).alias("_season"),
    )
    lengths = season_rows.select(item, "_season").distinct()
    ahead = future_days(daily, item, horizon).join(lengths, item)
    slotted = ahead.withColumn("_slot", (F.col("step") - 1) % F.col("_season"))
    rounds = F.floor((F.col("step") - 1) / F.col("_season")) + 1
    return (
        slotted.join(season_rows.drop("_season"), [item, "_slot"]).join(slope, item)
        .select(item, "step", "day", (F.col("_base") + F.col("_b") * F.col("_season") * rounds).alias(value))
    )


def forecast_targets(daily: DataFrame, item: str, values: Sequence[str], horizon: int = 14, season: int = 7) -> DataFrame:
    """(item, step, day, values...): every target forecast on its own and joined on the item and day."""
    first, *rest = [forecast_seasonal_drift(daily, item, v, horizon, season) for v in values]
    for other in rest:
        first = first.join(other, [item, "step", "day"])
    return first


def residual_anomaly(df: DataFrame, actual: str, predicted: Column, sigmas: float = 2.0) -> DataFrame:
    """Residual per group and a flag above mean + 2 population deviations of all residuals."""
    scored = df.withColumn("residual", F.col(actual) - predicted)
    limit = scored.agg((F.avg("residual") + sigmas * F.stddev_pop("residual")).alias("l")).scalar()
    return scored.withColumn("is_anomaly", F.col("residual") > limit)


def fit_two_regressors(df: DataFrame, y: str, x1: str, x2: str) -> Column:
    """Prediction column of y ~ 1 + x1 + x2 by the normal equations of one aggregate row.

    Without a unique solution the mean of y is predicted.
    """
    moments = df.agg(
        F.struct(
            F.avg(y).alias("my"), F.avg(x1).alias("m1"), F.avg(x2).alias("m2"), F.var_pop(x1).alias("v1"), F.var_pop(x2).alias("v2"),
            F.covar_pop(x1, x2).alias("c12"), F.covar_pop(x1, y).alias("c1"), F.covar_pop(x2, y).alias("c2"),
        ).alias("m")
    ).scalar()
    det = moments["v1"] * moments["v2"] - moments["c12"] * moments["c12"]
    b1 = F.try_divide(moments["c1"] * moments["v2"] - moments["c2"] * moments["c12"], det)
    b2 = F.try_divide(moments["c2"] * moments["v1"] - moments["c1"] * moments["c12"], det)
    line = moments["my"] + b1 * (F.col(x1) - moments["m1"]) + b2 * (F.col(x2) - moments["m2"])
    return F.coalesce(line, moments["my"])


# --- smoothing and backtests ------------------------------------------------------------------------

#: Weights of the newest value for level, trend and season of each smoothing method.
SMOOTHERS: dict[str, tuple[float, float, float]] = {"level": (0.3, 0.0, 0.0), "trend": (0.3, 0.1, 0.0), "season": (0.3, 0.1, 0.2)}


def smoothed(y: Column, weights: tuple[float, float, float], season: int) -> Column:
    """Struct (level, trend, season, t) behind the last value of an array: one fold, a value at a time.

    The first value is the level, without trend or season. Every value then moves the level towards itself without its
    season, the trend towards the step of the level, and its day's season towards what the level leaves.
    """
    a, b, g = (F.lit(float(w)) for w in weights)
    start = F.struct(
        F.get(y, F.lit(0)).cast("double").alias("level"), F.lit(0.0).alias("trend"),
        F.array_repeat(F.lit(0.0), season).alias("season"), F.lit(1).alias("t"),
    )

    def step(s: Column, v: Column) -> Column:
        slot = s["t"] % season
        own = F.get(s["season"], slot)
        level = a * (v - own) + (1 - a) * (s["level"] + s["trend"])
        return bind(level, lambda l: F.struct(
            l.alias("level"), (b * (l - s["level"]) + (1 - b) * s["trend"]).alias("trend"),
            F.transform(s["season"], lambda x, i: F.when(i == slot, g * (v - l) + (1 - g) * x).otherwise(x)).alias("season"), (s["t"] + 1).alias("t"),
        ))

    return F.aggregate(F.slice(y, 2, F.greatest(F.size(y) - 1, F.lit(0))), start, step)


def ahead(y: Column, method: str, weights: tuple[float, float, float] | None, horizon: int, season: int) -> Column:
    """Array of the next ``horizon`` values: smoothed, or without weights those of the last season again."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    if weights is None:
        length = F.least(F.size(y), F.lit(season))
        return F.transform(steps, lambda h: F.get(y, F.size(y) - length + (h - 1) % length))
    return bind(smoothed(y, weights, season), lambda s: F.transform(steps, lambda h: s["level"] + h * s["trend"] + F.get(s["season"], (s["t"] - 1 + h) % season)))


def forecast_backtest(
    daily: DataFrame, item: str, value: str, horizon: int = 7, windows: int = 3, season: int = 7, smoothers: dict[str, tuple[float, float, float]] = SMOOTHERS, least: int | None = None
) -> DataFrame:
    """(item, step, day, value, method, error_<method>...): every item forecast by the method with the least backtest error.

    Methods are the last season again (``naive``) and the smoothers. In the backtest the last 1, 2, ... ``windows`` horizons
    are left out in turn, wherever ``least`` days (two seasons) remain before them, and forecast from what is before
    them; a method's error is the root of its mean squared error over all of these days. Equal errors go to the earlier
    method. An item that is too short for any window has NULL errors and is forecast naively. Days are given without
    gaps (see ``regular_daily_fill``).

    A series is one row with an array of days, as long as its days are many, not its events; folds and backtests stay
    in the row.
    """
    shortest = 2 * season if least is None else least
    point = F.struct("day", F.col(value).cast("double").alias("v"))
    rows = daily.groupBy(item).agg(F.sort_array(F.collect_list(point)).alias("_d"))
    held = hold(rows.select(item, F.transform("_d", lambda d: d["v"]).alias("_y0"), F.array_max(F.transform("_d", lambda d: d["day"])).alias("_last")), _y=F.col("_y0")).select(item, "_y", "_last")
    methods: dict[str, tuple[float, float, float] | None] = {"naive": None, **smoothers}
    y = F.col("_y")

    def error(method: str) -> Column:
        def window(c: Column) -> Column:
            cut = F.size(y) - c * horizon
            off = F.zip_with(ahead(F.slice(y, 1, F.greatest(cut, F.lit(1))), method, methods[method], horizon, season), F.slice(y, F.greatest(cut, F.lit(1)) + 1, horizon), lambda f, v: (f - v) * (f - v))
            return F.when(cut >= shortest, off).otherwise(F.array().cast("array<double>"))

        squares = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(windows)), window))
        return bind(squares, lambda q: F.when(F.size(q) > 0, F.round(F.sqrt(F.aggregate(q, F.lit(0.0), lambda s, x: s + x) / F.size(q)), 6)))

    judged = hold(held, **{f"error_{m}": error(m) for m in methods})
    ranked = F.array_min(F.array(*[F.struct(F.coalesce(f"error_{m}", F.lit(0.0)).alias("e"), F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(methods)]))
    chosen = hold(judged, method=ranked["m"])
    values = F.coalesce(*[F.when(F.col("method") == m, ahead(y, m, w, horizon, season)) for m, w in methods.items()])
    steps = hold(chosen, _f=values).select(item, "_last", F.posexplode("_f").alias("_i", value), "method", *[f"error_{m}" for m in methods])
    return steps.select(item, (F.col("_i") + 1).alias("step"), F.date_add("_last", F.col("_i") + 1).alias("day"), value, "method", *[f"error_{m}" for m in methods])
