"""Evaluation of scored rows: counts at a threshold, AUC, average precision, sweeps, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.operators.ordered import running_totals
from loamwork.session import cut_lineage


def confusion(y: Column, hit: Column) -> list[Column]:
    return [
        F.count_if((y == 1) & hit).alias("tp"), F.count_if((y == 0) & ~hit).alias("tn"),
        F.count_if((y == 0) & hit).alias("fp"), F.count_if((y == 1) & ~hit).alias("fn"),
    ]


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def rate_columns() -> dict[str, Column]:
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return {
        "positive_rate": ratio(tp + fn, n), "predicted_positive_rate": ratio(tp + fp, n), "accuracy": ratio(tp + tn, n),
        "precision": ratio(tp, tp + fp), "recall": recall, "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": specificity, "balanced_accuracy": (recall + specificity) / 2, "youden_j": recall + specificity - 1,
    }


def confusion_counts(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    return df.agg(*confusion(F.col(y), F.col(score) >= threshold))


def binary_metrics(df: DataFrame, y: str, score: str, threshold: float, eps: float = 1e-15) -> DataFrame:
    """Accuracy, F1, precision, recall and log loss in one aggregate."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    loss = -F.avg(F.when(F.col(y) == 1, F.ln(p)).otherwise(F.ln(1 - p)))
    counts = df.agg(*confusion(F.col(y), F.col(score) >= threshold), loss.alias("log_loss"))
    rates = rate_columns()
    return counts.select(*[rates[c].alias(c) for c in ("accuracy", "f1", "precision", "recall")], "log_loss")


def cumulative_gain(df: DataFrame, y: str, score: str) -> DataFrame:
    """(score, pos, neg, tp, fp): running hits by falling score, one row per distinct score.

    Grouping by score comes first, so many equal scores combine before any ordering.
    """
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    falling = cut_lineage(per_score).withColumn("_fall", -F.col("score"))
    return running_totals(falling, "_fall", {"tp": F.col("pos"), "fp": F.col("neg")}).drop("_fall")


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Rank-based area under the curve, ties at their mean rank; NULL for one class."""
    gain = cumulative_gain(df, y, score)
    lost = F.sum((F.col("fp") - F.col("neg") / 2) * F.col("pos"))
    lost_share = F.try_divide(lost.cast("double"), F.sum("pos").cast("double") * F.sum("neg").cast("double"))
    return gain.agg((1 - lost_share).alias("roc_auc"))


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """Sum of recall steps times precision over distinct scores; 0 without positives."""
    gain = cumulative_gain(df, y, score)
    weighted = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return gain.agg(ratio(weighted, F.sum("pos")).alias("average_precision"))


def threshold_grid(low: int = 50, high: int = 95) -> list[float]:
    """Thresholds in steps of one hundredth."""
    return [step / 100 for step in range(low, high + 1)]


def marks_passed(score: Column, marks: Sequence[float]) -> Column:
    """How many of the rising marks are no greater than a score.

    On an even grid the place follows from the score; rounding can put it one off, which the marks themselves
    tell. NULL passes none, NaN all.
    """
    n, known = len(marks), F.array(*[F.lit(t) for t in marks])
    step = (marks[-1] - marks[0]) / (n - 1) if n > 1 else 0.0
    if step <= 0 or any(abs(m - marks[0] - i * step) > step / 4 for i, m in enumerate(marks)):
        return F.size(F.filter(known, lambda t: t <= score))
    inside = F.least(F.greatest(score.cast("double"), F.lit(marks[0] - step)), F.lit(marks[-1] + step))
    near = F.least(F.greatest(F.floor((inside - marks[0]) / step).cast("int") + 1, F.lit(0)), F.lit(n))
    more = F.coalesce(F.get(known, near) <= score, F.lit(False)).cast("int")
    less = F.coalesce(F.get(known, near - 1) > score, F.lit(False)).cast("int")
    return F.when(score.isNull(), 0).otherwise(near + more - less)


def threshold_sweep(df: DataFrame, y: str, score: str, grid: Sequence[float] | None = None) -> DataFrame:
    """Counts and rates at every threshold in one pass.

    Each row is counted once, at the highest threshold it passes, and found in its own row, so only as many
    groups as thresholds are shuffled; a running sum over them gives the rest.
    """
    known = sorted(grid or threshold_grid())
    marks = F.array(*[F.lit(t) for t in known])
    bucket = marks_passed(F.col(score), known)
    counts = df.groupBy(bucket.alias("_b")).agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("q"))
    per_mark = (
        df.sparkSession.range(1).select(F.posexplode(marks).alias("_i", "threshold"))
        .select((F.col("_i") + 1).alias("_b"), "threshold")
        .unionByName(df.sparkSession.range(1).select(F.lit(0).alias("_b"), F.lit(None).cast("double").alias("threshold")))
        .join(counts, "_b", "left").na.fill(0, ["p", "q"])
    )
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tp, fp = F.sum("p").over(above), F.sum("q").over(above)
    swept = per_mark.select(
        "threshold", tp.alias("tp"), (F.sum("q").over(everything) - fp).alias("tn"), fp.alias("fp"),
        (F.sum("p").over(everything) - tp).alias("fn"),
    ).filter("threshold is not null")
    return swept.withColumns(rate_columns())


def select_threshold(sweep: DataFrame, metric: str) -> DataFrame:
    """Best threshold by metric, then recall, precision and the lowest threshold."""
    return sweep.orderBy(F.desc(metric), F.desc("recall"), F.desc("precision"), F.asc("threshold")).limit(1)


def model_comparison(scored: dict[str, DataFrame], y: str, score: str, fixed: float, metric: str) -> DataFrame:
    """One row per model: metrics at the fixed and at the selected threshold, best AUC first."""
    names = ["accuracy", "f1", "precision", "recall"]
    rows = []
    for name, df in scored.items():
        best = select_threshold(threshold_sweep(df, y, score), metric)
        chosen = best.select(F.struct("threshold", *names).alias("best")).scalar()
        rows.append(
            binary_metrics(df, y, score, fixed).select(
                F.lit(name).alias("model"), *[F.col(c).alias(f"fixed_{c}") for c in names], "log_loss",
                chosen["threshold"].alias("selected_threshold"), *[chosen[c].alias(f"selected_{c}") for c in names],
                roc_auc(df, y, score).scalar().alias("roc_auc"),
            )
        )
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("roc_auc"), "model")


def classification_report(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted averages."""
    pairs = df.groupBy(F.col(y).cast("string").alias("y"), F.col(predicted).cast("string").alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).alias("predicted"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
                F.struct(F.col("p").alias("label"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0).alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    per_class = sums.select(
        "label", ratio(F.col("hits"), F.col("predicted")).alias("precision"), ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"), "support",
    )
    names = ["precision", "recall", "f1"]
    macro = per_class.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per_class.agg(
        F.lit("weighted avg").alias("label"), *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)
