"""Aggregations, statistics and model evaluation, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.functions import distributions as DI
from loamwork.functions import values as V
from loamwork.operators import aggregates as A
from loamwork.operators import evaluation as E
from loamwork.operators import joins as J
from loamwork.operators import ordered as O
from loamwork.operators import series as S
from loamwork.operators import stats
from loamwork.plans.registry import query
from loamwork.session import table

REFERENCE = "2024-01-29 12:00:00"
WEEK_SQL = "strftime(CAST(date_trunc('week', CAST(ts AS DATE) + 1) AS DATE), '%Y-%m-%d')"


def reference():
    return F.lit(REFERENCE).cast("timestamp_ntz")


def rounded(df, digits=6, names=None):
    wanted = names or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in wanted})


def brand_rows(spark, sf):
    line = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return line.join(part, "l_partkey")


def brand_rates(spark, sf):
    return A.group_rate_stats(
        brand_rows(spark, sf), ["p_brand", "p_type"],
        {"rate": F.col("l_returnflag") == "R", "overtime": F.col("l_linestatus") == "O"}, {"balance": F.col("l_quantity")},
    )


RATES_SQL = """SELECT p_brand, p_type, CAST(count(*) AS BIGINT) AS headcount, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS rate,
 avg(CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0 END) AS overtime, avg(CAST(trunc(l_quantity) AS BIGINT)) AS balance
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING count(*) > 2"""


@query("group_rate_stats", f"SELECT p_brand, p_type, headcount, round(rate, 6) AS rate, round(overtime, 6) AS overtime, round(balance, 6) AS balance FROM ({RATES_SQL})")
def group_rate_stats(spark, sf):
    return rounded(brand_rates(spark, sf))


@query(
    "weekly_counts",
    f"""SELECT {WEEK_SQL} AS week_start, event_type, CAST(count(*) AS BIGINT) AS value FROM events
        WHERE ts >= TIMESTAMP '{REFERENCE}' - INTERVAL 84 DAY GROUP BY 1, 2 ORDER BY 1, 2""",
)
def weekly_counts(spark, sf):
    return A.weekly_counts(table(spark, sf, "events"), "ts", reference(), ["event_type"]).withColumn("week_start", F.col("week_start").cast("string")).orderBy("week_start", "event_type")


@query(
    "weekly_active_users",
    f"""SELECT {WEEK_SQL} AS week_start, CAST(count(DISTINCT user_id) AS BIGINT) AS value FROM events
        WHERE ts >= TIMESTAMP '{REFERENCE}' - INTERVAL 84 DAY AND event_type <> 'error' GROUP BY 1 ORDER BY 1""",
)
def weekly_active_users(spark, sf):
    df = A.weekly_active_users(table(spark, sf, "events"), "ts", "user_id", reference(), F.col("event_type") != "error")
    return df.withColumn("week_start", F.col("week_start").cast("string")).orderBy("week_start")


@query("week_start", f"SELECT event_id, {WEEK_SQL} AS week FROM events")
def week_start(spark, sf):
    return table(spark, sf, "events").select("event_id", V.week_start(F.col("ts")).cast("string").alias("week"))


RISK_SQL = "SELECT l_orderkey, least(l_discount * 7 + l_tax, 1.0) AS p FROM lineitem"


@query(
    "simple_counts_kpi",
    f"""WITH r AS ({RISK_SQL}), t AS (SELECT p, CASE WHEN p <= 0.25 THEN 'Low' WHEN p <= 0.34 THEN 'Medium' ELSE 'High' END AS label FROM r)
        SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) FILTER (WHERE label = 'High') AS BIGINT) AS n_high,
               CAST(count(*) FILTER (WHERE label = 'Medium') AS BIGINT) AS n_medium, CAST(count(*) FILTER (WHERE label = 'Low') AS BIGINT) AS n_low,
               round(avg(CASE WHEN label <> 'Low' THEN round(p * 100, 2) END), 4) AS mean_percent FROM t""",
)
def simple_counts_kpi(spark, sf):
    rows = risk_rows(spark, sf).withColumn("label", V.risk_bucket(F.col("p")))
    texts = rows.withColumn("percent", F.when(F.col("label") == "Low", "n/a").otherwise(F.translate(V.percent_format(F.col("p")), ".", ",")))
    return rounded(A.label_kpis(texts, "label", "percent"), 4)


def risk_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.least(F.col("l_discount") * 7 + F.col("l_tax"), F.lit(1.0)).alias("p"), (F.col("l_returnflag") == "R").cast("int").alias("y")
    )


@query("risk_bucket", f"WITH r AS ({RISK_SQL}) SELECT CASE WHEN p <= 0.25 THEN 'Low' WHEN p <= 0.34 THEN 'Medium' ELSE 'High' END AS label, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY 1")
def risk_bucket(spark, sf):
    return risk_rows(spark, sf).groupBy(V.risk_bucket(F.col("p")).alias("label")).agg(F.count("*").alias("n"))


FLAGGED_SQL = f"""WITH g AS ({RATES_SQL}), m AS (SELECT regr_slope(rate, overtime) AS b, avg(rate) AS my, avg(overtime) AS mx FROM g),
 r AS (SELECT p_brand, p_type, rate, rate - (my + b * (overtime - mx)) AS residual FROM g, m),
 f AS (SELECT *, residual > (SELECT avg(residual) + 2 * stddev_pop(residual) FROM r) AS is_anomaly FROM r)"""


def flagged(spark, sf):
    rates = brand_rates(spark, sf)
    line = rates.agg(F.struct(F.regr_slope("rate", "overtime").alias("b"), F.avg("rate").alias("my"), F.avg("overtime").alias("mx")).alias("l")).scalar()
    predicted = line["my"] + line["b"] * (F.col("overtime") - line["mx"])
    return S.residual_anomaly(rates, "rate", predicted)


@query("residual_anomaly", FLAGGED_SQL + " SELECT p_brand, p_type, round(residual, 6) AS residual, is_anomaly FROM f ORDER BY residual DESC, p_brand, p_type")
def residual_anomaly(spark, sf):
    return rounded(flagged(spark, sf).select("p_brand", "p_type", "residual", "is_anomaly")).orderBy(F.desc("residual"), "p_brand", "p_type")


@query(
    "anomaly_kpi",
    FLAGGED_SQL + " SELECT CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS n_anomalies, round(coalesce(max(abs(residual)), 0), 4) AS max_score, round(coalesce(avg(abs(residual)), 0), 4) AS mean_score FROM f",
)
def anomaly_kpi(spark, sf):
    return A.anomaly_kpis(flagged(spark, sf).withColumn("size", F.abs("residual")), "is_anomaly", "size")


@query(
    "regress_group_rate",
    f"""WITH g AS ({RATES_SQL}), m AS (SELECT avg(rate) AS my, avg(overtime) AS m1, avg(balance) AS m2, var_pop(overtime) AS v1, var_pop(balance) AS v2,
             covar_pop(overtime, balance) AS c12, covar_pop(overtime, rate) AS c1, covar_pop(balance, rate) AS c2 FROM g)
        SELECT p_brand, p_type, round(my + (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) * (overtime - m1) + (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) * (balance - m2), 6) AS predicted
        FROM g, m""",
)
def regress_group_rate(spark, sf):
    rates = brand_rates(spark, sf)
    return rates.select("p_brand", "p_type", F.round(S.fit_two_regressors(rates, "rate", "overtime", "balance"), 6).alias("predicted"))


@query(
    "value_distribution",
    """SELECT 'p_brand' AS "column", p_brand AS value, round(count(*) / (SELECT count(*) FROM part), 9) AS share FROM part GROUP BY p_brand
       UNION ALL SELECT 'p_type', p_type, round(count(*) / (SELECT count(*) FROM part), 9) FROM part GROUP BY p_type""",
)
def value_distribution(spark, sf):
    return rounded(A.value_distribution(table(spark, sf, "part"), ["p_brand", "p_type"]), 9)


@query("distinct_values", "SELECT p_type, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_brands FROM part GROUP BY p_type ORDER BY p_type")
def distinct_values(spark, sf):
    return table(spark, sf, "part").groupBy("p_type").agg(F.count_distinct("p_brand").alias("n_brands")).orderBy("p_type")


@query("next_id", "SELECT coalesce(max(o_orderkey) + 1, 1) AS next_id FROM orders")
def next_id(spark, sf):
    return A.next_id(table(spark, sf, "orders"), "o_orderkey")


HOLES_SQL = "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS rain FROM events"


def holed_events(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"), F.when(F.col("event_type") != "view", F.col("value")).alias("rain"))


@query("median_impute", f"WITH h AS ({HOLES_SQL}) SELECT event_id, coalesce(v, (SELECT median(v) FROM h)) AS v, coalesce(rain, 0) AS rain FROM h")
def median_impute(spark, sf):
    df = holed_events(spark, sf)
    return A.median_impute(df, df, ["v"], ["rain"])


@query(
    "standard_scale",
    """WITH f AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1, avg(l_tax) AS m2, stddev_pop(l_tax) AS s2 FROM lineitem WHERE l_linestatus = 'O')
       SELECT l_orderkey, l_linenumber, round((l_quantity - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) AS l_quantity, round((l_tax - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END, 6) AS l_tax FROM lineitem, f""",
)
def standard_scale(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_linestatus")
    scaled = A.standard_scale(df.filter("l_linestatus = 'O'"), df, ["l_quantity", "l_tax"])
    return rounded(scaled.drop("l_linestatus"))


@query("minmax_clip", "SELECT o_orderkey, least(greatest(o_totalprice / 100000, 0.5), 5.0) AS weight, least(greatest(o_totalprice / 4000, 0), 100.0) AS score FROM orders")
def minmax_clip(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", V.clamp(p / 100000, 0.5, 5.0).alias("weight"), V.clamp(p / 4000, 0.0, 100.0).alias("score"))


@query(
    "weighted_score",
    """SELECT l_suppkey, round(sum(least(greatest(s, 0), 100) * greatest(w, 0.01)) / sum(greatest(w, 0.01)), 2) AS weighted_score
       FROM (SELECT l_suppkey, l_discount * 50 AS w, l_extendedprice / 500 - 10 AS s FROM lineitem) GROUP BY l_suppkey""",
)
def weighted_score(spark, sf):
    df = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_discount") * 50).alias("w"), (F.col("l_extendedprice") / 500 - 10).alias("s"))
    return A.weighted_score(df, "l_suppkey", "w", "s")


CORR_SQL = """WITH t AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END AS y, * FROM lineitem),
 c AS (SELECT 'l_quantity' AS feature, count(*) AS n, corr(l_quantity, y) AS correlation FROM t
 UNION ALL SELECT 'l_extendedprice', count(*), corr(l_extendedprice, y) FROM t UNION ALL SELECT 'l_discount', count(*), corr(l_discount, y) FROM t
 UNION ALL SELECT 'l_linestatus_' || v, count(*), corr(CASE WHEN l_linestatus = v THEN 1.0::DOUBLE ELSE 0 END, y) FROM t, (SELECT DISTINCT l_linestatus AS v FROM lineitem) GROUP BY v
 UNION ALL SELECT 'l_linenumber_' || v, count(*), corr(CASE WHEN l_linenumber = v THEN 1.0::DOUBLE ELSE 0 END, y) FROM t, (SELECT DISTINCT l_linenumber AS v FROM lineitem) GROUP BY v)"""


def correlations(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int")).withColumn("fixed", F.lit(1.0))
    return stats.correlation_with_target(df, "y", ["l_quantity", "l_extendedprice", "l_discount", "fixed"], ["l_linestatus", "l_linenumber"])


@query("correlation_with_target", CORR_SQL + " SELECT feature, CAST(n AS BIGINT) AS n, round(correlation, 6) AS correlation FROM c")
def correlation_with_target(spark, sf):
    return rounded(correlations(spark, sf))


@query("top_abs_correlation", CORR_SQL + " SELECT feature, CAST(n AS BIGINT) AS n, round(correlation, 6) AS correlation FROM c ORDER BY abs(correlation) DESC, feature LIMIT 5")
def top_abs_correlation(spark, sf):
    return rounded(stats.top_abs_correlation(correlations(spark, sf), 5))


@query("describe_group_mean_var", "SELECT event_type, CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance FROM events GROUP BY 1")
def describe_group_mean_var(spark, sf):
    return rounded(stats.describe_groups(table(spark, sf, "events"), "event_type", "value"))


@query("ttest_one_sample", "SELECT CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round((avg(value) - 10) / (stddev_samp(value) / sqrt(count(value))), 6) AS t FROM events")
def ttest_one_sample(spark, sf):
    return rounded(stats.ttest_one_sample(table(spark, sf, "events"), "value", 10.0).select("n", "mean", "sd", "t"))


@query(
    "udf_stat_cdf",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 10.0::DOUBLE AS x FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.5 + atan(x) / pi(), 6) AS t1, round(0.5 + x / (2 * sqrt(2 + x * x)), 6) AS t2, round(1 - power(1 + 2 * x / 7, -3.5), 6) AS f27 FROM x""",
)
def udf_stat_cdf(spark, sf):
    """t with one and two, F with two and seven degrees of freedom, where closed forms exist."""
    x = F.col("l_quantity").cast("double") / 10
    df = lambda n: F.lit(float(n))
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x.alias("x"))
    rows = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", DI.t_cdf("x", df(1)).alias("t1"), DI.t_cdf("x", df(2)).alias("t2"), DI.f_cdf("x", df(2), df(7)).alias("f27"))
    return rounded(rows, names=["t1", "t2", "f27"])


SIDES_SQL = """WITH s AS (SELECT count(value) FILTER (WHERE event_type = 'click') AS n1, avg(value) FILTER (WHERE event_type = 'click') AS m1, var_samp(value) FILTER (WHERE event_type = 'click') AS v1,
 count(value) FILTER (WHERE event_type = 'view') AS n2, avg(value) FILTER (WHERE event_type = 'view') AS m2, var_samp(value) FILTER (WHERE event_type = 'view') AS v2 FROM events)"""


@query("ftest_variance", SIDES_SQL + " SELECT round(greatest(v1, v2) / least(v1, v2), 6) AS f, CAST(CASE WHEN v1 >= v2 THEN n1 ELSE n2 END - 1 AS BIGINT) AS f_df1, CAST(CASE WHEN v1 >= v2 THEN n2 ELSE n1 END - 1 AS BIGINT) AS f_df2 FROM s")
def ftest_variance(spark, sf):
    sides = stats.two_groups(table(spark, sf, "events"), "event_type", "value", "click", "view")
    return rounded(stats.ftest_variance(sides).select("f", "f_df1", "f_df2"))


@query(
    "ttest_two_sample",
    SIDES_SQL + """ SELECT round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t_pooled, CAST(n1 + n2 - 2 AS DOUBLE) AS df_pooled,
      round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t_welch, round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS df_welch FROM s""",
)
def ttest_two_sample(spark, sf):
    sides = stats.two_groups(table(spark, sf, "events"), "event_type", "value", "click", "view")
    tested = stats.ttest_two_sample(sides).select("t_pooled", "df_pooled", "t_welch", "df_welch")
    return rounded(rounded(tested, 6, ["t_pooled", "t_welch"]), 4, ["df_welch"])


@query(
    "ols_simple",
    """WITH a AS (SELECT count(*) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy,
                  avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
         b AS (SELECT *, sxy / sxx AS slope, (syy - sxy / sxx * sxy) AS sse FROM a)
       SELECT CAST(n AS BIGINT) AS n, round(sxy / sqrt(sxx * syy), 6) AS r, round(slope, 4) AS slope, round(my - slope * mx, 3) AS intercept, round(slope / sqrt(sse / (n - 2) / sxx), 4) AS t,
              round(my - slope * mx + slope * 17, 3) AS y_new FROM b""",
)
def ols_simple(spark, sf):
    fit = stats.ols_simple(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 17.0)
    return fit.select("n", F.round("r", 6).alias("r"), F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("t", 4).alias("t"), F.round("y_new", 3).alias("y_new"))


@query(
    "next_in_series",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1, 2),
            p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS x, v FROM d)
       SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(avg(v) + coalesce(CASE WHEN count(*) > 1 THEN regr_slope(v, x) END, 0) * (count(*) - avg(x)), 6) AS next_value FROM p GROUP BY 1""",
)
def next_in_series(spark, sf):
    from pyspark.sql import Window

    daily = S.daily_means(table(spark, sf, "events"), "user_id", "ts", ["value"])
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("day")) - 1
    return rounded(stats.next_in_series(daily, "user_id", place, "value"))


@query(
    "resource_summary",
    """SELECT event_type, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 4) AS duration_sec, CAST(count(*) AS BIGINT) AS samples, round(avg(value), 4) AS value_avg, round(max(value), 4) AS value_peak,
              CAST(NULL AS DOUBLE) AS gpu_avg, CAST(NULL AS DOUBLE) AS gpu_peak FROM events GROUP BY 1""",
)
def resource_summary(spark, sf):
    df = table(spark, sf, "events").withColumn("gpu", F.lit(None).cast("double"))
    return A.resource_summary(df, "event_type", "ts", ["value", "gpu"])


# --- evaluation of scored rows -------------------------------------------------------------------

SCORED_SQL = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, least(l_discount * 10, 1.0) AS score FROM lineitem"


def scored(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.least(F.col("l_discount") * 10, F.lit(1.0)).alias("score"))


COUNTS_SQL = """CAST(count(*) FILTER (WHERE y = 1 AND score >= {t}) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND score < {t}) AS BIGINT) AS tn,
 CAST(count(*) FILTER (WHERE y = 0 AND score >= {t}) AS BIGINT) AS fp, CAST(count(*) FILTER (WHERE y = 1 AND score < {t}) AS BIGINT) AS fn"""


@query("confusion_counts", f"SELECT {COUNTS_SQL.format(t=0.66)} FROM ({SCORED_SQL})")
def confusion_counts(spark, sf):
    return E.confusion_counts(scored(spark, sf), "y", "score", 0.66)


METRICS_SQL = f"""SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
 coalesce(tp / nullif(tp + fn, 0), 0) AS recall, log_loss FROM (SELECT {COUNTS_SQL.format(t=0.66)},
 -avg(CASE WHEN y = 1 THEN ln(greatest(least(score, 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END) AS log_loss FROM ({{src}}))"""


@query("binary_metrics", f"SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall, round(log_loss, 6) AS log_loss FROM ({METRICS_SQL.format(src=SCORED_SQL)})")
def binary_metrics(spark, sf):
    return rounded(E.binary_metrics(scored(spark, sf), "y", "score", 0.66))


AUC_SQL = """(SELECT (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc
 FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM ({src})))"""


@query("roc_auc", f"SELECT round(auc, 6) AS roc_auc FROM {AUC_SQL.format(src=SCORED_SQL)}")
def roc_auc(spark, sf):
    return rounded(E.roc_auc(scored(spark, sf), "y", "score"))


FINE_SQL = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, (l_extendedprice + l_quantity * 100) / 200000 AS score FROM lineitem"


def fine_scored(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), ((F.col("l_extendedprice") + F.col("l_quantity") * 100) / 200000).alias("score"))


GAIN_SQL = """SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, pos, neg FROM
 (SELECT score, CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS pos, CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS neg FROM ({src}) GROUP BY score) WINDOW w AS (ORDER BY score DESC)"""


@query("cumulative_gain", f"SELECT score, pos, neg, tp, fp FROM ({GAIN_SQL.format(src=FINE_SQL)})")
def cumulative_gain(spark, sf):
    return E.cumulative_gain(fine_scored(spark, sf), "y", "score")


@query("average_precision", f"SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS average_precision FROM ({GAIN_SQL.format(src=FINE_SQL)})")
def average_precision(spark, sf):
    return rounded(E.average_precision(fine_scored(spark, sf), "y", "score"))


SWEEP_SQL = """SELECT threshold, tp, tn, fp, fn, (tp + fn) / n AS positive_rate, (tp + fp) / n AS predicted_positive_rate, (tp + tn) / n AS accuracy,
 coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
 coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
 coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0) - 1 AS youden_j
 FROM (SELECT threshold, count(*) AS n, {counts} FROM ({src}), (SELECT (50 + g) / 100 AS threshold FROM range(46) t(g)) GROUP BY threshold)"""
SWEEP = SWEEP_SQL.format(counts=COUNTS_SQL.format(t="threshold"), src=SCORED_SQL)
RATE_NAMES = ["positive_rate", "predicted_positive_rate", "accuracy", "precision", "recall", "f1", "specificity", "balanced_accuracy", "youden_j"]


@query("threshold_sweep", "SELECT threshold, tp, tn, fp, fn, " + ", ".join(f"round({c}, 6) AS {c}" for c in RATE_NAMES) + f" FROM ({SWEEP})")
def threshold_sweep(spark, sf):
    return rounded(E.threshold_sweep(scored(spark, sf), "y", "score"), names=RATE_NAMES)


@query("select_threshold", f"SELECT threshold, round(f1, 6) AS f1, round(recall, 6) AS recall FROM ({SWEEP}) ORDER BY round(f1, 12) DESC, recall DESC, precision DESC, threshold LIMIT 1")
def select_threshold(spark, sf):
    return rounded(E.select_threshold(E.threshold_sweep(scored(spark, sf), "y", "score"), "f1"), names=["f1", "recall"]).select("threshold", "f1", "recall")


def model_sql(name, src):
    sweep = SWEEP_SQL.format(counts=COUNTS_SQL.format(t="threshold"), src=src)
    return f"""SELECT '{name}' AS model, m.accuracy AS fixed_accuracy, m.f1 AS fixed_f1, m.precision AS fixed_precision, m.recall AS fixed_recall, m.log_loss,
      s.threshold AS selected_threshold, s.accuracy AS selected_accuracy, s.f1 AS selected_f1, s.precision AS selected_precision, s.recall AS selected_recall, a.auc AS roc_auc
      FROM ({METRICS_SQL.format(src=src)}) m, (SELECT * FROM ({sweep}) ORDER BY f1 DESC, recall DESC, precision DESC, threshold LIMIT 1) s, {AUC_SQL.format(src=src)} a"""


MODEL_COLUMNS = [f"{k}_{m}" for k in ("fixed", "selected") for m in ("accuracy", "f1", "precision", "recall")] + ["log_loss", "roc_auc"]


@query(
    "model_comparison",
    "SELECT model, selected_threshold, " + ", ".join(f"round({c}, 6) AS {c}" for c in MODEL_COLUMNS)
    + f" FROM (({model_sql('coarse', SCORED_SQL)}) UNION ALL ({model_sql('fine', FINE_SQL)})) ORDER BY roc_auc DESC, model",
)
def model_comparison(spark, sf):
    df = E.model_comparison({"coarse": scored(spark, sf), "fine": fine_scored(spark, sf)}, "y", "score", 0.66, "f1")
    return rounded(df, names=MODEL_COLUMNS)


REPORT_SQL = """WITH c AS (SELECT l_returnflag AS y, CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' WHEN l_discount < 0.1 THEN 'R' ELSE 'X' END AS p FROM lineitem),
 l AS (SELECT DISTINCT y AS label FROM c UNION SELECT DISTINCT p FROM c),
 k AS (SELECT label, count(*) FILTER (WHERE y = label AND p = label) AS h, count(*) FILTER (WHERE p = label) AS np, count(*) FILTER (WHERE y = label) AS ny FROM l, c GROUP BY label),
 r AS (SELECT label, coalesce(h / nullif(np, 0), 0) AS precision, coalesce(h / nullif(ny, 0), 0) AS recall, coalesce(2 * h / nullif(np + ny, 0), 0) AS f1, ny AS support FROM k),
 a AS (SELECT label, precision, recall, f1, support FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM r)
 SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM a"""


@query("classification_report", REPORT_SQL)
def classification_report(spark, sf):
    d = F.col("l_discount")
    guess = F.when(d < 0.03, "A").when(d < 0.07, "N").when(d < 0.1, "R").otherwise("X")
    df = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("y"), guess.alias("p"))
    return rounded(E.classification_report(df, "y", "p"))


@query(
    "tool_fold",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN (l_quantity + l_discount) + l_tax WHEN 'N' THEN (l_quantity - l_discount) - l_tax
              ELSE (l_quantity * l_discount) * l_tax END AS folded FROM lineitem""",
)
def tool_fold(spark, sf):
    operation = V.map_strict(F.col("l_returnflag"), {"A": "add", "N": "subtract", "R": "multiply"}, "error")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", V.tool_fold(operation, F.array("l_quantity", "l_discount", "l_tax")).alias("folded"))


# --- order-dependent operators ---------------------------------------------------------------------


@query("running_best", "SELECT event_id, value, max(value) OVER (ORDER BY event_id) AS best FROM events")
def running_best(spark, sf):
    return O.running_best(table(spark, sf, "events").select("event_id", "value"), "event_id", "value", "best")


@query("seconds_from_start", "SELECT event_id, round((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY event_type))) / 1e6, 6) AS seconds FROM events")
def seconds_from_start(spark, sf):
    df = O.seconds_from_start(table(spark, sf, "events"), "event_type", "ts", "seconds")
    return df.select("event_id", F.round("seconds", 6).alias("seconds"))


DAILY_SQL = "SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS value FROM events GROUP BY 1, 2"
FILLED_SQL = f"""WITH d AS ({DAILY_SQL}), s AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY 1),
 j AS (SELECT s.user_id, s.day, d.value FROM s LEFT JOIN d ON s.user_id = d.user_id AND s.day = d.day),
 f AS (SELECT user_id, day, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day), first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM j)"""


def filled(spark, sf):
    return S.regular_daily_fill(S.daily_means(table(spark, sf, "events"), "user_id", "ts", ["value"]), "user_id", ["value"])


@query("regular_daily_fill", FILLED_SQL + " SELECT user_id, strftime(day, '%Y-%m-%d') AS day, round(value, 6) AS value FROM f")
def regular_daily_fill(spark, sf):
    return rounded(filled(spark, sf)).withColumn("day", F.col("day").cast("string"))


MEDIAN_SQL = "m AS (SELECT user_id, CAST(trunc(round(median(value), 1)) AS BIGINT) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS r FROM f) WHERE r <= 14 GROUP BY 1)"


@query("trailing_median", FILLED_SQL + ", " + MEDIAN_SQL + " SELECT user_id, value FROM m")
def trailing_median(spark, sf):
    return S.trailing_median(filled(spark, sf), "user_id", ["value"])


@query(
    "forecast_covariates",
    FILLED_SQL + ", " + MEDIAN_SQL + ", e AS (SELECT user_id, max(day) AS last FROM f GROUP BY 1) "
    "SELECT user_id, CAST(step AS INTEGER) AS step, strftime(last + CAST(step AS INTEGER), '%Y-%m-%d') AS day, value FROM m JOIN e USING (user_id), range(1, 15) t(step)",
)
def forecast_covariates(spark, sf):
    return S.forecast_covariates(filled(spark, sf), "user_id", ["value"]).withColumn("day", F.col("day").cast("string"))


@query(
    "forecast_grouped",
    FILLED_SQL + """, p AS (SELECT user_id, day, value, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS x, count(*) OVER (PARTITION BY user_id) AS n FROM f),
     b AS (SELECT user_id, max(n) AS n, max(day) AS last, CASE WHEN max(n) > 1 THEN regr_slope(value, x) ELSE 0 END AS b FROM p GROUP BY 1),
     h AS (SELECT user_id, n, last, b, step, least(n, 7) AS season FROM b, range(1, 15) t(step))
    SELECT h.user_id, CAST(h.step AS INTEGER) AS step, strftime(h.last + CAST(h.step AS INTEGER), '%Y-%m-%d') AS day,
           round(p.value + h.b * h.season * ((h.step - 1) // h.season + 1), 5) AS value
    FROM h JOIN p ON p.user_id = h.user_id AND p.x = h.n - h.season + (h.step - 1) % h.season""",
)
def forecast_grouped(spark, sf):
    df = S.forecast_seasonal_drift(filled(spark, sf), "user_id", "value")
    return rounded(df, 5).withColumn("day", F.col("day").cast("string"))


BACKTEST_SQL = """, series AS (SELECT user_id, list(value ORDER BY day) AS y, CAST(count(*) AS INTEGER) AS n, max(day) AS last FROM f GROUP BY 1),
 cuts AS (SELECT user_id, CAST(c AS INTEGER) AS c, n - 7 * c AS n, y[1 : n - 7 * c] AS y FROM series, range(0, 4) t(c) WHERE c = 0 OR n - 7 * c >= 14),
 weights AS (SELECT * FROM (VALUES ('level', 0.3::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), ('trend', 0.3, 0.1, 0.0), ('season', 0.3, 0.1, 0.2)) w(method, a, b, g)),
 fold AS (
   SELECT user_id, c, method, a, b, g, 1 AS t, n, y, y[1]::DOUBLE AS level, 0.0::DOUBLE AS trend, [0.0::DOUBLE, 0, 0, 0, 0, 0, 0] AS season FROM cuts, weights
   UNION ALL
   SELECT user_id, c, method, a, b, g, t + 1, n, y, l, b * (l - level) + (1 - b) * trend, list_transform(season, lambda x, i: CASE WHEN i = t % 7 + 1 THEN g * (y[t + 1] - l) + (1 - g) * x ELSE x END)
   FROM (SELECT *, a * (y[t + 1] - season[t % 7 + 1]) + (1 - a) * (level + trend) AS l FROM fold WHERE t < n)),
 ahead AS (
   SELECT user_id, c, method, CAST(h AS INTEGER) AS h, level + h * trend + season[(n - 1 + h) % 7 + 1] AS v FROM fold, range(1, 8) r(h) WHERE t = n
   UNION ALL SELECT user_id, c, 'naive', CAST(h AS INTEGER), y[n - least(n, 7) + (h - 1) % least(n, 7) + 1] FROM cuts, range(1, 8) r(h)),
 errors AS (SELECT user_id, method, round(sqrt(avg((v - s.y[s.n - 7 * c + h]) ** 2)), 6) AS e FROM ahead JOIN series s USING (user_id) WHERE c > 0 GROUP BY 1, 2),
 wide AS (SELECT user_id, any_value(e) FILTER (WHERE method = 'naive') AS error_naive, any_value(e) FILTER (WHERE method = 'level') AS error_level, any_value(e) FILTER (WHERE method = 'trend') AS error_trend,
    any_value(e) FILTER (WHERE method = 'season') AS error_season FROM series LEFT JOIN errors USING (user_id) GROUP BY 1),
 chosen AS (SELECT *, CASE WHEN error_naive IS NULL OR error_naive <= least(error_level, error_trend, error_season) THEN 'naive' WHEN error_level <= least(error_trend, error_season) THEN 'level'
    WHEN error_trend <= error_season THEN 'trend' ELSE 'season' END AS method FROM wide)"""


@query(
    "forecast_backtest",
    FILLED_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + BACKTEST_SQL + """
    SELECT user_id, h AS step, strftime(last + h, '%Y-%m-%d') AS day, round(v, 5) AS value, method, error_naive, error_level, error_trend, error_season
    FROM ahead JOIN chosen USING (user_id, method) JOIN series USING (user_id) WHERE c = 0""",
)
def forecast_backtest(spark, sf):
    df = S.forecast_backtest(filled(spark, sf), "user_id", "value")
    return rounded(df, 5, ["value"]).withColumn("day", F.col("day").cast("string"))


@query("rank_ids", "SELECT o_orderkey, 'R' || row_number() OVER (ORDER BY o_orderkey) AS rank_id FROM orders")
def rank_ids(spark, sf):
    numbered = O.global_row_number(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "n")
    return numbered.select("o_orderkey", F.concat(F.lit("R"), "n").alias("rank_id"))


@query("latest_by_event_time", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_by_event_time(spark, sf):
    return O.latest_by_time(table(spark, sf, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("sort_multi", "SELECT p_brand, p_size, p_retailprice, p_partkey FROM part ORDER BY p_brand, p_size DESC, p_retailprice DESC, p_partkey")
def sort_multi(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_size", "p_retailprice", "p_partkey").orderBy("p_brand", F.desc("p_size"), F.desc("p_retailprice"), "p_partkey")


@query("top_n", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def top_n(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25)


@query("first_n_bar", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 20")
def first_n_bar(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_partkey").limit(20)
