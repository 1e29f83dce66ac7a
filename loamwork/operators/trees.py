"""Node tables of tree ensembles: exact additive attribution."""

from __future__ import annotations

import math
from collections.abc import Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamwork.session import scratch_folder

#: A node: number in its tree (0 is the root), children (-1 in a leaf), split, weight of the rows of the fit, value of a leaf times the tree's weight.
NODES = "tree int, node int, left int, right int, feature int, threshold double, categories array<double>, cover double, value double"


def fitted_nodes(model: PipelineModel) -> DataFrame:
    """Node table of the tree ensemble at the end of a fitted pipeline, read from what it saves.

    Values add up to the score of boosted trees, the prediction of a regression forest, the probability of class 1 of a
    classification forest. Splits of a model that bins its features first are given back as limits of the features.
    """
    spark, fitted = SparkSession.active(), model.stages[-1]
    path = scratch_folder(spark, "trees")
    fitted.write().save(path)
    forest = isinstance(fitted, (RandomForestRegressionModel, RandomForestClassificationModel))
    share = 1 / len(fitted.treeWeights) if forest else 1.0
    weights = spark.createDataFrame([(i, float(w) * share) for i, w in enumerate(fitted.treeWeights)], "tree int, weight double")
    split, n = F.col("nodeData.split"), F.col("nodeData")
    counts = n["impurityStats"]
    leaf = F.get(counts, F.lit(1)) / F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) if isinstance(fitted, RandomForestClassificationModel) else n["prediction"]
    cover = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) if isinstance(fitted, RandomForestClassificationModel) else F.get(counts, F.lit(0))
    threshold = F.get(split["leftCategoriesOrThreshold"], F.lit(0))
    for stage in model.stages:
        if isinstance(stage, Bucketizer):  # bins up to b hold what is below the limit behind b; the last one all but NaN
            limits = [[math.nextafter(s, -math.inf) for s in own[1:-1]] + [math.inf] for own in stage.getSplitsArray()]
            known = F.array(*[F.array(*[F.lit(x) for x in own]) for own in limits])
            threshold = F.get(F.get(known, split["featureIndex"]), F.floor(threshold).cast("int"))
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"), split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] < 0, threshold).alias("threshold"),
        F.when(split["numCategories"] >= 0, split["leftCategoriesOrThreshold"]).alias("categories"),
        cover.alias("cover"), leaf.alias("p"),
    )
    return rows.join(F.broadcast(weights), "tree").withColumn("value", F.col("p") * F.col("weight")).select(*[f.name for f in T.StructType.fromDDL(NODES)])  # a row per tree


class Leaf:
    """A leaf and the conditions on its path, by feature."""

    def __init__(self, value: float, path: list[tuple[int, int, bool, float]]) -> None:
        """path: (feature, node of the split, whether it goes left, share of the node's rows that go there)."""
        self.value = value
        self.features = sorted({f for f, *_ in path})
        self.tests = [[(node, left) for f, node, left, _ in path if f == g] for g in self.features]
        self.shares = [float(np.prod([s for f, _, _, s in path if f == g])) for g in self.features]
        self.mean = value * float(np.prod(self.shares))
        self.known: dict[int, np.ndarray] = {}

    def contributions(self, pattern: int) -> np.ndarray:
        """Shapley values of the features of the path for rows that meet the conditions whose bits are set.

        A leaf alone is a game whose value for a set of known features is the product of their conditions (0 or 1) and of
        the shares of the unknown ones. ``sums[k]`` adds up these products over all sets of k other features.
        """
        if pattern not in self.known:
            d = len(self.features)
            met = [float(pattern >> i & 1) for i in range(d)]
            out = np.empty(d)
            for i in range(d):
                sums = np.zeros(d)
                sums[0] = 1.0
                for j in range(d):
                    if j != i:
                        sums[1:] = sums[1:] * self.shares[j] + sums[:-1] * met[j]
                        sums[0] *= self.shares[j]
                weights = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
                out[i] = self.value * (met[i] - self.shares[i]) * float(np.dot(sums, weights))
            self.known[pattern] = out
        return self.known[pattern]


class Ensemble:
    """Trees from rows of a node table."""

    def __init__(self, rows: Sequence[dict]) -> None:
        self.splits: list[list[tuple]] = []
        self.leaves: list[list[Leaf]] = []
        for tree in sorted({r["tree"] for r in rows}):
            nodes = {r["node"]: r for r in rows if r["tree"] == tree}
            splits, leaves, numbers = [], [], {}
            todo: list[tuple[int, list]] = [(0, [])]
            while todo:
                node, path = todo.pop()
                r = nodes[node]
                if r["left"] < 0:
                    leaves.append(Leaf(r["value"], path))
                    continue
                numbers[node] = len(splits)
                splits.append((r["feature"], r["threshold"], r["categories"]))
                for child, left in ((r["left"], True), (r["right"], False)):
                    todo.append((child, [*path, (r["feature"], numbers[node], left, nodes[child]["cover"] / r["cover"])]))
            self.splits.append(splits)
            self.leaves.append(leaves)
        self.base = sum(leaf.mean for leaves in self.leaves for leaf in leaves)

    def attribute(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions and contributions of rows."""
        raw, out = np.zeros(len(x)), np.zeros(x.shape)
        for splits, leaves in zip(self.splits, self.leaves, strict=True):
            goes_left = [np.isin(x[:, f], c) if c is not None else x[:, f] <= t for f, t, c in splits]
            for leaf in leaves:
                pattern = np.zeros(len(x), np.int64)
                for i, tests in enumerate(leaf.tests):
                    met = np.ones(len(x), bool)
                    for node, left in tests:
                        met &= goes_left[node] if left else ~goes_left[node]
                    pattern |= met.astype(np.int64) << i
                raw[pattern == (1 << len(leaf.features)) - 1] += leaf.value
                kinds, place = np.unique(pattern, return_inverse=True)
                shares = np.array([leaf.contributions(int(k)) for k in kinds]).reshape(len(kinds), -1)
                out[:, leaf.features] += shares[place]
        return raw, out


def tree_attribution(df: DataFrame, nodes: DataFrame, features: Sequence[str], prefix: str = "by_") -> DataFrame:
    """All rows with ``base``, ``raw`` and a column ``by_<feature>`` each: base + contributions = raw, the sum of the leaves.

    Contributions are the Shapley values of the ensemble's expectation along its paths: where a feature is unknown, a
    split sends a row both ways, in the shares of the weight of the rows of the fit. They are exact, for every row, from the node table
    alone (NODES; ``fitted_nodes`` gives it for a fitted model). NaN and NULL go right, as in the fit. A node table has as many
    rows as the model has nodes, whatever the data; it is sent to the tasks, which work batch by batch.
    """
    rows = [r.asDict() for r in nodes.collect()]  # the nodes of one model
    shared = df.sparkSession.sparkContext.broadcast(rows)
    schema = T.StructType([*df.schema, *[T.StructField(c, T.DoubleType()) for c in ("base", "raw", *(prefix + f for f in features))]])
    names = list(features)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        ensemble, arrow = Ensemble(shared.value), to_arrow_schema(schema)
        for batch in batches:
            x = np.stack([pa.compute.cast(batch.column(f), pa.float64()).to_numpy(zero_copy_only=False) for f in names], 1) if batch.num_rows else np.empty((0, len(names)))
            raw, out = ensemble.attribute(x)
            made = [np.full(len(x), ensemble.base), raw, *out.T]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m, pa.float64()) for m in made]], schema=arrow)

    return df.mapInArrow(run, schema)


def mean_attribution(attributed: DataFrame, features: Sequence[str], prefix: str = "by_") -> DataFrame:
    """(feature, attribution): mean absolute contribution over all rows, largest first."""
    sizes = attributed.agg(*[F.avg(F.abs(prefix + f)).alias(f) for f in features])
    return sizes.unpivot([], list(features), "feature", "attribution").orderBy(F.desc("attribution"), "feature")
