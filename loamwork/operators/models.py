"""Model training on MLlib. Fits are the only actions; scoring is a plain transformation."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.functions.values import hash_unit
from loamwork.operators.forests import PART, bin_edges, binned
from loamwork.operators.forests import forest_importance as segment_importance
from loamwork.operators.forests import segment_forest
from loamwork.operators.ordered import running_best
from loamwork.operators.search import Range, adaptive_search
from loamwork.operators.trees import fitted_nodes, mean_attribution, tree_attribution
from loamwork.session import cut_lineage


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def balance_weights(cells: DataFrame, label: str, n: str, name: str = "weight") -> DataFrame:
    """Weight of cells of ``n`` rows: a row counts negatives / positives in positive cells, 1 in negative ones."""
    negatives, positives = (F.sum(F.when(F.col(label) == k, F.col(n)).otherwise(0.0)) for k in (0, 1))
    ratio = cells.agg(F.try_divide(negatives, positives).alias("r")).scalar()
    return cells.withColumn(name, F.col(n) * F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(1.0))


def bin_stage(df: DataFrame, features: Sequence[str], bins: int) -> Bucketizer:
    """Numbers of about equally full bins as columns ``_bin_<feature>``. A limit belongs to the bin below it; NaN has a bin above all."""
    splits = []
    for edges in bin_edges(df, features, bins):
        inner = sorted({math.nextafter(e, math.inf) + 0.0 for e in edges if e < sys.float_info.max}) or [0.0]
        splits.append([-math.inf, *inner, math.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"_bin_{f}" for f in features], handleInvalid="keep")


def train_binary_gbt(
    df: DataFrame, features: Sequence[str], label: str, key: str, validation: float = 0.2, rounds: int = 50, depth: int = 4, seed: int = 42, bins: int = 32
) -> PipelineModel:
    """Boosted trees with class weights; boosting stops when the validation rows stop improving.

    All rows are binned and counted once: rows of equal bins and label are one weighted row of the fit, so that its time and
    its cached rows are bounded by the bins. Limits of the bins come from the training rows; the model bins what it scores.
    """
    held_out = hash_unit(F.col(key), seed=seed) < validation
    rows = df.select(*features, F.col(label).cast("double").alias(label), held_out.alias("validation"))
    binning = bin_stage(rows.filter(~F.col("validation")), features, bins)
    names, last = binning.getOutputCols(), [float(len(s) - 1) for s in binning.getSplitsArray()]  # NULL is binned as NaN
    placed = binning.transform(rows).select("validation", label, *[F.coalesce(F.col(c), F.lit(k)).alias(c) for c, k in zip(names, last, strict=True)])
    cells = cut_lineage(placed.groupBy("validation", label, *names).agg(F.count("*").cast("double").alias("n")))
    weighted = balance_weights(cells, label, "n").repartition(cells.count() // PART + 1)
    booster = GBTClassifier(
        labelCol=label, weightCol="weight", validationIndicatorCol="validation", maxIter=rounds, maxDepth=depth, maxBins=bins + 1, stepSize=0.1, seed=seed
    )
    ready = assembler(names)
    return PipelineModel(stages=[binning, ready, booster.fit(ready.transform(weighted))])


def positive_score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Probability of class 1 for every row."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.drop(*[c for c in scored.columns if c != name and c not in df.columns])


def forest_importance(df: DataFrame, features: Sequence[str], label: str, trees: int = 300, depth: int = 5, seed: int = 42) -> DataFrame:
    """(feature, importance) of a class-balanced forest over all rows, largest first.

    Rows of equal bins are one cell, so after one pass over the rows a level of all trees costs as much as there are cells.
    """
    splits = segment_forest(df.withColumn("_all", F.lit("all")), "_all", features, label, trees, depth, least=1, seed=seed, balanced=True)
    found = segment_importance(splits, features, "_all", digits=12).select("feature", "importance")
    every = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(found, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")



def importance_by_segment(
    df: DataFrame, segment: str, features: Sequence[str], label: str, trees: int = 900, depth: int = 4, least: int = 10, seed: int = 42
) -> DataFrame:
    """(segment, feature, importance) of a forest for every segment with enough rows and both classes; all segments in the same jobs."""
    splits = segment_forest(df, segment, features, label, trees, depth, least=least, seed=seed)
    return segment_importance(splits, features, segment)


def attribution_mean_abs(df: DataFrame, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, attribution): mean absolute exact contribution of every feature to a tree model's raw score, over all rows."""
    return mean_attribution(tree_attribution(df, fitted_nodes(model), features), features)


def linear_attribution(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, attribution) of a logistic model: mean absolute coefficient * (x - mean), over all rows."""
    rows = df.withColumn(label, F.col(label).cast("double"))
    fitted = Pipeline(stages=[assembler(features), LogisticRegression(labelCol=label, maxIter=50)]).fit(rows)
    weights = dict(zip(features, fitted.stages[-1].coefficients.toArray()))
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in features]).alias("m")).scalar()
    sizes = df.agg(*[F.avg(F.abs((F.col(f) - means[f]) * float(weights[f]))).alias(f) for f in features])
    return sizes.unpivot([], list(features), "feature", "attribution").orderBy(F.desc("attribution"), "feature")


#: What the tuned boosters choose from: depth of a tree, number of trees, step.
BOOSTER_SPACE = {"depth": Range(2, 6, whole=True), "rounds": Range(5, 40, whole=True), "step": Range(0.02, 0.3, log=True)}


def booster_cells(df: DataFrame, features: Sequence[str], label: str, key: str, mean: bool, bins: int = 32, seed: int = 42) -> DataFrame:
    """(held_out, features, label, weight, spread): training and held-out rows with equal bins as one weighted row.

    Limits of the bins come from the training rows, as in a booster of that many bins, and features are numbers of bins.
    Rows of a cell have the same label, or with ``mean`` their mean label; ``spread`` is their squared error around it. Trees on
    squared errors are the same for a mean with its weight as for the rows.
    """
    held_out = hash_unit(F.col(key), seed=seed) >= 0.8
    rows = df.select(*features, F.col(label).cast("double").alias(label), held_out.alias("held_out"))
    edges = bin_edges(rows.filter(~F.col("held_out")), features, bins)
    placed = rows.select("held_out", label, *[binned(F.col(f), e).cast("double").alias(f) for f, e in zip(features, edges, strict=True)])
    keys = ["held_out", *features] + ([] if mean else [label])
    n = F.count("*").cast("double")
    own = [F.avg(label).alias(label), (F.var_pop(label) * n).alias("spread")] if mean else [F.lit(0.0).alias("spread")]
    return cut_lineage(placed.groupBy(*keys).agg(n.alias("weight"), *own))


def tune_booster(booster, judge, df: DataFrame, features: Sequence[str], label: str, key: str, trials: int, seed: int, parallel: int, space: Mapping[str, Range], larger: bool) -> DataFrame:
    """Trials of a booster by an adaptive search, judged on held-out rows.

    All rows are binned and counted once (see ``booster_cells``); ``judge`` is an evaluator of weighted rows, or None for the
    root of the mean squared error of a regression. Every trial is fitted with a quarter of its trees first, and with all of
    them only if the quarter is not worse than the median of the trials before. (trial, depth, rounds, step, metric, pruned):
    the metric of a pruned trial is that of its quarter.
    """
    cells = assembler(features).transform(booster_cells(df, features, label, key, judge is None, seed=seed)).select("features", label, "weight", "spread", "held_out")
    train = cells.filter(~F.col("held_out")).persist()
    valid = cells.filter("held_out").persist()
    sign = 1 if larger else -1
    off = F.col("prediction") - F.col(label)
    rmse = F.sqrt(F.sum(F.col("weight") * off * off + F.col("spread")) / F.sum("weight"))

    def objective(params: dict, report) -> float:
        def judged(rounds: int) -> float:
            model = booster(labelCol=label, weightCol="weight", maxDepth=int(params["depth"]), maxIter=rounds, stepSize=params["step"], seed=seed).fit(train)
            scored = model.transform(valid)
            return sign * float(scored.agg(rmse).first()[0] if judge is None else judge.evaluate(scored))

        report(judged(max(1, int(params["rounds"]) // 4)))
        return judged(int(params["rounds"]))

    found = adaptive_search(objective, space, trials, seed, parallel)
    train.unpersist()
    valid.unpersist()
    rows = [(t.number, int(t.params["depth"]), int(t.params["rounds"]), float(t.params["step"]), sign * (t.steps[-1] if t.pruned else t.metric), t.pruned) for t in found]
    return df.sparkSession.createDataFrame(rows, "trial int, depth int, rounds int, step double, metric double, pruned boolean")


def tune_gbt(df: DataFrame, features: Sequence[str], label: str, key: str, trials: int = 40, seed: int = 42, parallel: int = 4, space: Mapping[str, Range] = BOOSTER_SPACE) -> DataFrame:
    """(trial, depth, rounds, step, metric, pruned, best_so_far): adaptive trials by validation AUC; pruned ones are no best."""
    table = tune_booster(GBTClassifier, BinaryClassificationEvaluator(labelCol=label, weightCol="weight"), df, features, label, key, trials, seed, parallel, space, True)
    return running_best(table.withColumn("_own", F.when(~F.col("pruned"), F.col("metric")).otherwise(0.0)), "trial", "_own", "best_so_far").drop("_own")


def tune_regression(df: DataFrame, features: Sequence[str], label: str, key: str, trials: int = 40, seed: int = 42, parallel: int = 4, space: Mapping[str, Range] = BOOSTER_SPACE) -> DataFrame:
    """(trial, depth, rounds, step, rmse, pruned, best_so_far): adaptive trials of boosted regression trees, least error best."""
    table = tune_booster(GBTRegressor, None, df, features, label, key, trials, seed, parallel, space, False)
    gains = table.withColumn("_gain", F.when(~F.col("pruned"), -F.col("metric")).otherwise(F.lit(float("-inf"))))
    return running_best(gains, "trial", "_gain", "_best").withColumn("best_so_far", -F.col("_best")).withColumnRenamed("metric", "rmse").drop("_gain", "_best")


@dataclass
class EarlyStop:
    """Validation losses of the rounds of a fit, and the round whose weights it has."""

    model: PipelineModel
    losses: list[float]
    best: int


def train_mlp(
    df: DataFrame, vector: str, label: str, key: str, hidden: Sequence[int] = (32,), rounds: int = 20, steps: int = 10, patience: int = 3, validation: float = 0.2, seed: int = 42
) -> EarlyStop:
    """Standardised array features, hidden layers, softmax. Labels are 0..k-1.

    Rows held out by their key judge every round of ``steps`` iterations, which goes on from the weights of the one before.
    After ``patience`` rounds without a smaller log loss the fit ends, with the weights of its best round. Without held-out
    rows the fit judges itself.
    """
    shape = df.agg(F.max(F.size(vector)).alias("d"), (F.max(label) + 1).alias("k")).first()
    rows = mlp_rows(df, vector).withColumn(label, F.col(label).cast("double"))
    held_out = hash_unit(F.col(key), seed=seed + 1) < validation
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(rows.filter(~held_out))
    train, judged = (scaler.transform(rows.filter(c)).select(label, "features").persist() for c in (~held_out, held_out))
    if judged.isEmpty():
        judged = train
    own = vector_to_array("probability")[F.col(label).cast("int")]
    net = MultilayerPerceptronClassifier(labelCol=label, layers=[shape["d"], *hidden, shape["k"]], maxIter=steps, seed=seed)
    losses, best, kept = [], 0, None
    while len(losses) < rounds and len(losses) - best <= patience:
        fitted = net.fit(train)
        net = net.setInitialWeights(fitted.weights)
        losses.append(float(fitted.transform(judged).agg(F.avg(-F.ln(F.greatest(own, F.lit(1e-15))))).first()[0]))
        if kept is None or losses[-1] < losses[best]:
            best, kept = len(losses) - 1, fitted
    train.unpersist()
    judged.unpersist()
    return EarlyStop(PipelineModel(stages=[scaler, kept]), losses, best)


def mlp_rows(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("raw", array_to_vector(F.col(vector).cast("array<double>")))


def mlp_predict(model: PipelineModel, df: DataFrame, vector: str) -> DataFrame:
    """Predicted class and its confidence."""
    scored = model.transform(mlp_rows(df, vector))
    return scored.withColumn("confidence", F.array_max(vector_to_array("probability"))).withColumn(
        "predicted", F.col("prediction").cast("int")
    ).drop("raw", "features", "rawPrediction", "probability", "prediction")


def load_or_train(spark: SparkSession, path: str, train) -> PipelineModel:
    """Saved pipeline, or a new one that is saved; ``train`` is called only where nothing is saved.

    A model that is there but cannot be read raises and stays.
    """
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        model = train()
        model.write().save(path)
        return model
    return PipelineModel.load(path)
