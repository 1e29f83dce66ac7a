"""Attribution of tree ensembles against brute force over all subsets of features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.operators import models as ML
from loamwork.operators import trees as TR

FEATURES = ["a", "b", "c", "d"]


def rows_of(spark, n=600, seed=3):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(n, 4)), 2)
    y = ((x[:, 0] * x[:, 1] + x[:, 2] > 0.2) ^ (draw.random(n) < 0.1)).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "id int, a double, b double, c double, d double, y int").cache()


def expected_value(nodes, node, row, known):
    """Mean of the leaves that a row may reach: known features decide, others go both ways by the shares of the fit."""
    r = nodes[node]
    if r["left"] < 0:
        return r["value"]
    left, right = (expected_value(nodes, r[c], row, known) for c in ("left", "right"))
    if r["feature"] in known:
        x = row[r["feature"]]
        return left if (x in r["categories"] if r["categories"] is not None else x <= r["threshold"]) else right
    share = nodes[r["left"]]["cover"] / r["cover"]
    return share * left + (1 - share) * right


def shapley(trees, row, n):
    def value(known):
        return sum(expected_value(nodes, 0, row, known) for nodes in trees)

    out = []
    for f in range(n):
        others = [g for g in range(n) if g != f]
        out.append(sum(factorial(k) * factorial(n - 1 - k) / factorial(n) * (value({*s, f}) - value(set(s))) for k in range(n) for s in combinations(others, k)))
    return value(set()), value(set(range(n))), out


@pytest.mark.parametrize("kind", ["boosted", "forest", "classes"])
def test_every_row_against_all_subsets(spark, kind):
    rows = rows_of(spark)
    if kind == "boosted":
        model = ML.train_binary_gbt(rows, FEATURES, "y", "id", rounds=6, depth=4)
    else:
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.regression import RandomForestRegressor

        forest = RandomForestRegressor if kind == "forest" else RandomForestClassifier
        model = Pipeline(stages=[ML.assembler(FEATURES), forest(labelCol="y", numTrees=5, maxDepth=5, seed=1)]).fit(rows.withColumn("y", F.col("y").cast("double")))
    nodes = TR.fitted_nodes(model)
    table = [r.asDict() for r in nodes.collect()]
    trees = [{r["node"]: r for r in table if r["tree"] == t} for t in sorted({r["tree"] for r in table})]
    found = TR.tree_attribution(rows, nodes, FEATURES)
    assert found.columns == [*rows.columns, "base", "raw", "by_a", "by_b", "by_c", "by_d"] and found.count() == 600
    for r in found.limit(40).collect():
        base, raw, shares = shapley(trees, [r[f] for f in FEATURES], 4)
        assert (r.base, r.raw) == pytest.approx((base, raw)) and [r[f"by_{f}"] for f in FEATURES] == pytest.approx(shares)
    off = F.abs(F.col("base") + sum(F.col(f"by_{f}") for f in FEATURES) - F.col("raw"))
    assert found.agg(F.max(off)).first()[0] < 1e-9
    scored = model.transform(rows)
    raw = F.col("prediction") if kind == "forest" else F.get("r", F.lit(1))
    if kind != "forest":
        from pyspark.ml.functions import vector_to_array

        scored = scored.withColumn("r", vector_to_array("rawPrediction" if kind == "boosted" else "probability"))
    both = scored.select("id", raw.alias("score")).join(found, "id")
    assert both.agg(F.max(F.abs(F.col("score") - F.col("raw")))).first()[0] < 1e-9


def test_a_boosted_fit_sees_cells_not_rows(spark, monkeypatch):
    """Its rows are bounded by bins and labels; they weigh what the rows weigh."""
    seen = []

    class Booster(ML.GBTClassifier):
        def fit(self, df, *more):
            seen.append(df.count())
            return super().fit(df, *more)

    monkeypatch.setattr(ML, "GBTClassifier", Booster)
    draw = np.random.default_rng(4)
    x = draw.integers(0, 3, (3000, 2))
    y = (x[:, 0] + draw.random(3000) > 1.4).astype(int)
    rows = spark.createDataFrame([(i, float(a), int(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))], "id int, a double, b int, y int").cache()
    nodes = TR.fitted_nodes(ML.train_binary_gbt(rows, ["a", "b"], "y", "id", rounds=2)).filter("node = 0 and tree = 0").collect()
    assert seen and seen[0] <= 3 * 3 * 2 * 2
    train = [r.y for r in rows.filter(ML.hash_unit(F.col("id"), seed=42) >= 0.2).collect()]
    assert nodes[0].cover == pytest.approx(len(train) - sum(train) + sum(train) * (3000 - y.sum()) / y.sum())


def test_a_saved_model_is_fitted_once_on_cells_and_scores_every_row(spark, tmp_path, monkeypatch):
    """Four times the rows give the fit no more rows than the bins allow; the second call loads what the first one saved."""
    from loamwork.plans import QUERIES

    seen = []

    class Booster(ML.GBTClassifier):
        def fit(self, df, *more):
            seen.append(df.count())
            self.setMaxIter(2)
            return super().fit(df, *more)

    monkeypatch.setattr(ML, "GBTClassifier", Booster)
    k = F.col("id")
    for n in (1000, 4000):
        spark.range(n).select(
            k.alias("l_orderkey"), F.when(k % 3 == 0, "A").otherwise("N").alias("l_returnflag"), (k % 4 * 12.0).alias("l_quantity"), F.lit(9.5).alias("l_extendedprice"),
            (k % 5 * 0.02).alias("l_discount"), F.lit(0.0).alias("l_tax"), (k % 2).cast("int").alias("l_linenumber"),
        ).write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
        found = {r.l_returnflag: (r.n, r.equal) for r in QUERIES["score_and_save"](spark, f"{tmp_path}/{n}").collect()}
        assert found == {"A": ((n + 2) // 3, True), "N": (n - (n + 2) // 3, True)}
    assert len(seen) == 2 and max(seen) <= 4 * 5 * 2 * 2 * 2


def test_a_binned_model_scores_gaps_and_limits_as_its_node_table(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    nan, inf = float("nan"), float("inf")
    draw = np.random.default_rng(6)
    given = [(i, None if i % 11 == 0 else nan if i % 13 == 0 else float(v), int(k), None) for i, (v, k) in enumerate(zip(np.round(draw.normal(size=1500), 1), draw.integers(0, 4, 1500), strict=True))]
    rows = spark.createDataFrame([(*r, int((r[1] is None or r[1] != r[1] or r[1] > 0.3) ^ (r[2] == 2))) for r in given], "id int, a double, k int, none double, y int").cache()
    model = ML.train_binary_gbt(rows, ["a", "k", "none"], "y", "id", rounds=5)
    model.write().save(str(tmp_path / "m"))
    odd = spark.createDataFrame([(-1, v, k, None, 0) for v in (inf, -inf, 0.0, -0.0, 0.30000000000000004, 1e308, None, nan) for k in (0, 2, 9, None)], rows.schema)
    every = rows.union(odd)
    found = TR.tree_attribution(every, TR.fitted_nodes(model), ["a", "k", "none"])
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        scored = m.transform(found).select(F.abs(vector_to_array("rawPrediction")[1] - F.col("raw")).alias("off"))
        assert scored.agg(F.max("off")).first()[0] < 1e-9
    scored = ML.positive_score(model, rows)
    assert scored.columns == [*rows.columns, "score"]
    assert scored.filter((F.col("score") > 0.5) != (F.col("y") == 1)).count() < 15


def test_given_trees_with_categories_repeated_features_and_missing_values(spark):
    nodes = [
        (0, 0, 1, 2, 0, 0.5, None, 10.0, 0.0), (0, 1, 3, 4, 0, -0.5, None, 6.0, 0.0), (0, 2, -1, -1, -1, None, None, 4.0, 3.0),
        (0, 3, -1, -1, -1, None, None, 2.0, -1.0), (0, 4, 5, 6, 1, None, [1.0, 3.0], 4.0, 0.0), (0, 5, -1, -1, -1, None, None, 1.0, 7.0), (0, 6, -1, -1, -1, None, None, 3.0, 2.0),
        (1, 0, -1, -1, -1, None, None, 10.0, 0.25),
    ]
    table = spark.createDataFrame(nodes, TR.NODES)
    trees = [{n[1]: dict(zip(table.columns, n, strict=True)) for n in nodes if n[0] == t} for t in (0, 1)]
    rows = [(0.0, 1.0), (0.0, 2.0), (-1.0, 3.0), (0.6, 1.0), (float("nan"), 3.0), (None, None)]
    found = TR.tree_attribution(spark.createDataFrame(rows, "a double, b double"), table, ["a", "b"]).collect()
    for (a, b), r in zip(rows, found, strict=True):
        base, raw, shares = shapley(trees, [float("nan") if a is None else a, float("nan") if b is None else b], 2)
        assert (r.base, r.raw, r.by_a, r.by_b) == pytest.approx((base, raw, *shares))
    assert TR.tree_attribution(spark.createDataFrame([], "a double, b double"), table, ["a", "b"]).count() == 0
    mean = {r.feature: r.attribution for r in TR.mean_attribution(TR.tree_attribution(spark.createDataFrame(rows, "a double, b double"), table, ["a", "b"]), ["a", "b"]).collect()}
    assert mean == pytest.approx({f: sum(abs(r[f"by_{f}"]) for r in found) / 6 for f in "ab"})


def test_a_network_stops_early_and_keeps_its_best_round(spark):
    """Noisy labels: the loss on held-out rows rises again; the model is the one of its least loss."""
    from pyspark.ml.functions import vector_to_array

    draw = np.random.default_rng(8)
    x = draw.normal(size=(700, 6))
    y = np.where(draw.random(700) < 0.25, draw.integers(0, 3, 700), np.digitize(x[:, 0], [-0.4, 0.4]))
    rows = spark.createDataFrame([(i, list(map(float, r)), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "id int, v array<double>, y int").cache()
    fit = ML.train_mlp(rows, "v", "y", "id", rounds=30, steps=10, patience=2)
    assert len(fit.losses) < 30 and fit.best == len(fit.losses) - 3 and fit.losses[fit.best] == min(fit.losses)
    held_out = rows.filter(ML.hash_unit(F.col("id"), seed=43) < 0.2)
    scored = fit.model.transform(ML.mlp_rows(held_out, "v"))
    loss = scored.agg(F.avg(-F.ln(vector_to_array("probability")[F.col("y")]))).first()[0]
    assert loss == pytest.approx(fit.losses[fit.best])
    assert ML.mlp_predict(fit.model, rows, "v").filter("predicted = y").count() > 400
    few = ML.train_mlp(rows.filter("id < 60"), "v", "y", "id", rounds=2, validation=0.0)
    assert len(few.losses) == 2


# --- forests of all segments --------------------------------------------------------------------------


def test_one_tree_level_by_level_against_a_plain_search():
    """Splits of a level are the best of all limits, over the cells that a node holds."""
    from loamwork.operators.forests import Growing

    draw = np.random.default_rng(2)
    bins = draw.permutation(np.unique(draw.integers(0, 6, (120, 3)), axis=0))[:80]
    n0, n1 = draw.integers(0, 4, 80), draw.integers(0, 4, 80)
    growing = Growing(bins, n0, n1, 8, 3, [1])
    again = Growing(bins[::-1], n0[::-1], n1[::-1], 8, 3, [1])
    splits = {1: (0, 2), 2: (1, 3)}
    at = growing.nodes(splits, 2)
    for b, node in zip(growing.bins, at, strict=True):
        assert node == (-1 if b[0] > 2 else 4 + (b[1] > 3))
    for level in range(3):
        assert all((x == y).all() for x, y in zip(growing.histogram(5, splits, level, 42), again.histogram(5, splits, level, 42), strict=True))
    w0, w1 = growing.weights(5)
    node, feature, limit, w, p = growing.histogram(5, splits, 1, 42)
    for k, f, b, total, ones in zip(node, feature, limit, w, p, strict=True):
        own = (growing.nodes(splits, 1) == k) & (growing.bins[:, f] == b)
        assert (total, ones) == ((w0 + w1)[own].sum(), w1[own].sum())
    assert abs(np.mean([sum(x.sum() for x in growing.weights(t)) for t in range(300)]) / (n0.sum() + n1.sum()) - 1) < 0.02


def test_best_splits_against_all_limits(spark):
    from loamwork.operators.forests import best_splits

    draw = np.random.default_rng(3)
    rows = [("s", t, n, f, b, int(w), int(draw.integers(0, w + 1))) for t in range(3) for n in (1, 2) for f in range(2) for b, w in enumerate(draw.integers(1, 9, 5))]
    found = {(r.tree, r.node): r for r in best_splits(spark.createDataFrame(rows, "segment string, tree int, node int, feature int, bin int, w long, p long")).collect()}

    def impurity(w, p):
        return 2 * p * (w - p) / w if w else 0.0

    for t in range(3):
        for n in (1, 2):
            options = []
            for f in range(2):
                own = [(b, w, p) for _, a, m, g, b, w, p in rows if (a, m, g) == (t, n, f)]
                tw, tp = sum(w for _, w, _ in own), sum(p for *_, p in own)
                for b in range(4):
                    lw, lp = sum(w for c, w, _ in own if c <= b), sum(p for c, _, p in own if c <= b)
                    options.append((round(impurity(tw, tp) - impurity(lw, lp) - impurity(tw - lw, tp - lp), 9), -f, -b))
            gain, f, b = max(options)
            assert gain <= 0 and (t, n) not in found or (found[t, n].gain, found[t, n].feature, found[t, n].bin) == (pytest.approx(gain), -f, -b)


def test_jobs_do_not_depend_on_the_number_of_segments(spark):
    """Two and forty segments take as many jobs; each finds its own feature; a large segment in several parts gives importances too."""
    from loamwork.operators import forests

    draw = np.random.default_rng(6)
    sc = spark.sparkContext

    def table(segments, n):
        rows = []
        for s in range(segments):
            x = draw.random((n, 3))
            rows += [(f"s{s}", *map(float, r), int(r[s % 3] > 0.5)) for r in x]
        return spark.createDataFrame(rows, "seg string, a double, b double, c double, y int")

    jobs = []
    for segments in (2, 40):
        rows = table(segments, 120).cache()
        rows.count()
        sc.setJobGroup(f"segments-{segments}", "")
        found = {(r.seg, r.feature): r.importance for r in ML.importance_by_segment(rows, "seg", ["a", "b", "c"], "y", trees=40).collect()}
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"segments-{segments}")))
        assert len(found) == 3 * segments and all(max("abc", key=lambda f: found[f"s{s}", f]) == "abc"[s % 3] for s in range(segments))
        assert all(sum(found[f"s{s}", f] for f in "abc") == pytest.approx(1, abs=0.002) for s in range(segments))
    sc.setJobGroup("", "")
    assert jobs[1] <= jobs[0] * 1.5  # adaptive execution may add a stage's job
    small = spark.createDataFrame([("x", 1.0, 1)] * 9 + [("y", float(i), 1) for i in range(30)] + [(None, 1.0, 0)] * 30, "seg string, a double, y int")
    assert ML.importance_by_segment(small, "seg", ["a"], "y", trees=5).count() == 0
    part, forests.PART = forests.PART, 16
    try:
        found = {r.feature: r.importance for r in ML.importance_by_segment(table(1, 400), "seg", ["a", "b", "c"], "y", trees=40).collect()}
    finally:
        forests.PART = part
    assert found["a"] > 0.6


def test_balanced_splits_weigh_classes_alike(spark):
    """Gains of a node by hand: 30 rows of class 0, 3 of class 1, each of which counts for ten."""
    from loamwork.operators.forests import best_splits

    rows = [("s", 0, 1, 0, b, n0 + n1, n1) for b, (n0, n1) in enumerate([(10, 0), (5, 1), (15, 2)])]
    sums = spark.createDataFrame(rows, "segment string, tree int, node int, feature int, bin int, w long, p long")
    ratios = spark.createDataFrame([("s", 10.0)], "segment string, ratio double")
    impurity = lambda n0, p: 2 * p * n0 / (n0 + p)
    gains = [impurity(30, 30) - impurity(l0, 10 * l1) - impurity(30 - l0, 30 - 10 * l1) for l0, l1 in ((10, 0), (15, 1))]
    got = best_splits(sums, ratios).first()
    assert (got.bin, got.gain) == (gains.index(max(gains)), pytest.approx(max(gains)))


def test_forest_of_one_class_has_no_weights(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("a"), F.lit(1.0).alias("b"), F.lit(1).alias("y"))
    assert [tuple(r) for r in ML.forest_importance(df, ["b", "a"], "y", trees=3).collect()] == [("a", 0.0), ("b", 0.0)]


def test_forest_finds_the_rare_class(spark):
    df = spark.range(4000).select((F.col("id") % 50).alias("a"), (F.col("id") * 7 % 11).alias("b")).withColumn("y", (F.col("a") == 3).cast("int"))
    got = {r.feature: r.importance for r in ML.forest_importance(df, ["a", "b"], "y", trees=10).collect()}
    assert got["a"] > 0.9 and sum(got.values()) == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("mean", [True, False])
def test_boosters_on_cells_are_those_on_rows(spark, mean):
    """Few values a feature: the weighted cells give the trees and the error of all rows, and no row is left out."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    rows = spark.range(3000).select("id", (F.col("id") % 13).cast("double").alias("a"), (F.col("id") * 7 % 5).cast("double").alias("b"), (F.col("id") % 13 * 3 + F.col("id") % 4).cast("double").alias("y"))
    rows = rows if mean else rows.withColumn("y", (F.col("y") > 20).cast("double"))
    cells = ML.booster_cells(rows, ["a", "b"], "y", "id", mean)
    assert cells.agg(F.sum("weight")).first()[0] == 3000 and cells.count() <= 2 * 13 * 5 * (1 if mean else 2)
    booster = GBTRegressor if mean else GBTClassifier
    make = lambda **k: booster(labelCol="y", maxDepth=3, maxIter=4, seed=1, **k)
    held = ML.hash_unit(F.col("id"), seed=42) >= 0.8
    plain = make().fit(ML.assembler(["a", "b"]).transform(rows.filter(~held)).select("features", "y"))
    weighted = make(weightCol="weight").fit(ML.assembler(["a", "b"]).transform(cells.filter("not held_out")))
    want = plain.transform(ML.assembler(["a", "b"]).transform(rows.filter(held))).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    off = F.col("prediction") - F.col("y")
    got = weighted.transform(ML.assembler(["a", "b"]).transform(cells.filter("held_out"))).agg(F.sqrt(F.sum(F.col("weight") * off * off + F.col("spread")) / F.sum("weight"))).first()[0]
    assert got == pytest.approx(want, rel=1e-6)
