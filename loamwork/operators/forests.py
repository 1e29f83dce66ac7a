"""Forests for all segments of a table at once, grown level by level."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loamwork.session import cut_lineage

#: Cells that one task holds of a segment, about; larger segments are dealt to several.
PART = 1 << 16


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Inner limits of about equally full bins for every feature, by one approximate pass."""
    found = df.approxQuantile(list(features), [i / bins for i in range(1, bins)], 0.0005)
    return [sorted({x for x in own}) for own in found]


def binned(c: Column, edges: Sequence[float]) -> Column:
    """Number of limits below a value; NULL and NaN stand above all."""
    x = c.cast("double")
    if not edges:
        return F.lit(0)
    return F.when(x.isNull() | F.isnan(x), len(edges)).otherwise(F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < x)))


def segment_cells(df: DataFrame, segment: str, features: Sequence[str], label: str, bins: int, least: int) -> DataFrame:
    """(segment, part, bins, n0, n1): rows of equal bins as one cell, of the segments with enough rows and both classes."""
    edges = bin_edges(df, features, bins)
    places = F.array(*[binned(F.col(f), e).cast("int") for f, e in zip(features, edges, strict=True)])
    cells = cut_lineage(df.filter(F.col(segment).isNotNull()).groupBy(F.col(segment).cast("string").alias("segment"), places.alias("bins")).agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")))
    sizes = cells.groupBy("segment").agg(F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.count("*").alias("cells"))
    good = sizes.filter((F.col("s0") + F.col("s1") >= least) & (F.col("s0") > 0) & (F.col("s1") > 0)).select("segment", F.ceil(F.col("cells") / PART).cast("int").alias("parts"))
    dealt = cells.join(good, "segment")
    return cut_lineage(dealt.select("segment", F.pmod(F.xxhash64("bins"), "parts").cast("int").alias("part"), "parts", "bins", "n0", "n1"))


class Growing:
    """One level of all trees over the cells of one part of a segment."""

    def __init__(self, bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, width: int, chosen: int, seed: Sequence[int]) -> None:
        order = np.lexsort(bins.T[::-1])
        self.bins, self.n0, self.n1 = bins[order], n0[order], n1[order]
        self.width, self.chosen, self.seed = width, chosen, list(seed)

    def weights(self, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Bootstrap of the rows: a Poisson number for each, summed over a cell; the same in every level."""
        draw = np.random.default_rng([*self.seed, tree])
        return draw.poisson(self.n0), draw.poisson(self.n1)

    def nodes(self, splits: dict[int, tuple[int, int]], level: int) -> np.ndarray:
        """Node of every cell at a level; -1 where its path has ended."""
        at = np.ones(len(self.bins), np.int64)
        for k in range(level):
            feature, limit = np.full(1 << (k + 1), -1), np.zeros(1 << (k + 1), np.int64)
            for node, (f, b) in splits.items():
                if node >> k == 1:
                    feature[node], limit[node] = f, b
            own = np.where(at > 0, feature[at], -1)
            right = self.bins[np.arange(len(at)), np.maximum(own, 0)] > limit[at]
            at = np.where(own >= 0, 2 * at + right, -1)
        return at

    def histogram(self, tree: int, splits: dict[int, tuple[int, int]], level: int, seed: int) -> tuple[np.ndarray, ...]:
        """(node, feature, bin, weight, weight of class 1) of the cells, for the features that are drawn for each node."""
        at = self.nodes(splits, level)
        w0, w1 = self.weights(tree)
        live = np.flatnonzero((at > 0) & (w0 + w1 > 0))
        if not len(live):
            return tuple(np.empty(0, np.int64) for _ in range(5))
        places, total, ones = at[live] - (1 << level), (w0 + w1)[live], w1[live]
        n_features = self.bins.shape[1]
        drawn = np.zeros((1 << level, n_features), bool)
        for p in np.unique(places):
            drawn[p, np.random.default_rng([seed, tree, level, int(p)]).permutation(n_features)[: self.chosen]] = True
        codes, weights, positive = [], [], []
        for f in range(n_features):
            own = drawn[places, f]
            codes.append((places[own] * n_features + f) * self.width + self.bins[live[own], f])
            weights.append(total[own])
            positive.append(ones[own])
        code, size = np.concatenate(codes), (n_features * self.width) << level
        if size <= 4 * len(code):
            kinds = np.flatnonzero(np.bincount(code, minlength=size))
            w, p = (np.bincount(code, np.concatenate(x), size)[kinds].astype(np.int64) for x in (weights, positive))
        else:
            kinds, place = np.unique(code, return_inverse=True)
            w, p = (np.bincount(place, np.concatenate(x), len(kinds)).astype(np.int64) for x in (weights, positive))
        return kinds // self.width // n_features + (1 << level), kinds // self.width % n_features, kinds % self.width, w, p


def level_histograms(cells: DataFrame, splits: DataFrame, level: int, trees: int, width: int, chosen: int, seed: int) -> DataFrame:
    """(segment, tree, node, feature, bin, w, p) partial sums of every part; splits: those of the levels before, of each part."""
    ddl = "segment string, tree int, node int, feature int, bin int, w long, p long"
    arrow = to_arrow_schema(T.StructType.fromDDL(ddl))
    names = arrow.names

    def run(key, left, right):
        if not left.num_rows:
            return pa.Table.from_pydict({n: [] for n in names}, schema=arrow)
        segment, part = key[0].as_py(), key[1].as_py()
        growing = Growing(np.array(left.column("bins").to_pylist(), np.int64), left.column("n0").to_numpy(), left.column("n1").to_numpy(), width, chosen, [seed, part, *segment.encode()])
        own: dict[int, dict[int, tuple[int, int]]] = {}
        for tree, node, feature, limit in zip(*(right.column(c).to_pylist() for c in ("tree", "node", "feature", "bin")), strict=True):
            own.setdefault(tree, {})[node] = (feature, limit)
        found = [(t, growing.histogram(t, own.get(t, {}), level, seed)) for t in range(trees) if not level or t in own]
        columns = [np.concatenate([h[i] for _, h in found]) if found else np.empty(0, np.int64) for i in range(5)]
        tree = np.repeat(np.array([t for t, _ in found], np.int64), [len(h[0]) for _, h in found])
        return pa.Table.from_pydict(dict(zip(names, [[segment] * len(tree), tree, *columns], strict=True)), schema=arrow)

    return cells.groupBy("segment", "part").cogroup(splits.groupBy("segment", "part")).applyInArrow(run, ddl)


def best_splits(histograms: DataFrame, ratios: DataFrame | None = None) -> DataFrame:
    """(segment, tree, node, feature, bin, gain): the split of every node with the greatest fall of the Gini impurity, times its weight.

    ``ratios`` (segment, ratio): weight of a row of class 1 in each segment; 1 without them.
    """
    sums = histograms.groupBy("segment", "tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("p").alias("p"))
    if ratios is not None:
        heavy = F.col("p") * F.col("ratio")
        sums = sums.join(ratios, "segment").select("segment", "tree", "node", "feature", "bin", (F.col("w") - F.col("p") + heavy).alias("w"), heavy.alias("p"))
    along = Window.partitionBy("segment", "tree", "node", "feature").orderBy("bin")
    every = Window.partitionBy("segment", "tree", "node", "feature")
    cut = sums.select("segment", "tree", "node", "feature", "bin", F.sum("w").over(along).alias("lw"), F.sum("p").over(along).alias("lp"), F.sum("w").over(every).alias("tw"), F.sum("p").over(every).alias("tp"))

    def impurity(w: Column, p: Column) -> Column:
        return 2 * p * (w - p) / w

    inner = cut.filter("lw < tw")
    gain = impurity(F.col("tw"), F.col("tp")) - impurity(F.col("lw"), F.col("lp")) - impurity(F.col("tw") - F.col("lw"), F.col("tp") - F.col("lp"))
    judged = inner.select("segment", "tree", "node", F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")).alias("s")).filter("s.gain > 0")
    best = judged.groupBy("segment", "tree", "node").agg(F.max("s").alias("s"))
    return best.select("segment", "tree", "node", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), "s.gain")


def segment_forest(df: DataFrame, segment: str, features: Sequence[str], label: str, trees: int = 900, depth: int = 4, bins: int = 32, least: int = 10, seed: int = 42, balanced: bool = False) -> DataFrame:
    """(segment, tree, node, feature, bin, gain): the splits of a forest for every segment.

    Nodes are numbered 1, 2 and 3 below it, and so on. Every tree sees a bootstrap of its segment's rows, every node
    the square root of the features. Rows of equal bins are one cell, so a frequent combination costs as much as a rare one.
    A level of all trees of all segments is one job: parts of segments meet their splits so far in a cogroup, send
    partial histograms, and the best splits come from their sums. So there are as many rounds as levels, however many
    segments there are, and a hot segment is many parts. ``balanced`` gives both classes of a segment the same weight.
    """
    cells = segment_cells(df, segment, features, label, bins, least)
    ratios = cut_lineage(cells.groupBy("segment").agg((F.sum("n0") / F.sum("n1")).alias("ratio"))) if balanced else None
    parts = cells.select("segment", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).distinct()
    chosen = max(1, math.ceil(math.sqrt(len(features))))
    levels: list[DataFrame] = []
    for level in range(depth):
        if levels:
            known = reduce(DataFrame.unionByName, levels).join(parts, "segment").select("segment", "part", "tree", "node", "feature", "bin")
        else:
            known = df.sparkSession.createDataFrame([], "segment string, part int, tree int, node int, feature int, bin int")
        levels.append(cut_lineage(best_splits(level_histograms(cells, known, level, trees, bins, chosen, seed), ratios)))
    return reduce(DataFrame.unionByName, levels)


def forest_importance(splits: DataFrame, features: Sequence[str], segment: str = "segment", digits: int = 3) -> DataFrame:
    """(segment, feature, importance): gains of a feature's splits as shares of their tree, meaned over the trees that split, all features of every segment."""
    shares = splits.groupBy("segment", "tree", "feature").agg(F.sum("gain").alias("g"))
    per_tree = shares.withColumn("share", F.col("g") / F.sum("g").over(Window.partitionBy("segment", "tree")))
    grown = splits.groupBy("segment").agg(F.count_distinct("tree").alias("trees"))
    sums = per_tree.groupBy("segment", "feature").agg(F.sum("share").alias("share"))
    names = F.posexplode(F.array(*[F.lit(f) for f in features])).alias("feature", "name")
    every = grown.select("segment", "trees", names)
    return every.join(sums, ["segment", "feature"], "left").select(F.col("segment").alias(segment), F.col("name").alias("feature"), F.round(F.coalesce("share", F.lit(0.0)) / F.col("trees"), digits).alias("importance"))
