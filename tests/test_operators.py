"""Operators on small fixtures: brute force, skewed groups, empty inputs and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.operators import aggregates as A
from loamwork.operators import conversations as CV
from loamwork.operators import documents as D
from loamwork.operators import evaluation as E
from loamwork.operators import features as FE
from loamwork.operators import joins as J
from loamwork.operators import ordered as O
from loamwork.operators import requirements as RQ
from loamwork.operators import sampling as SP
from loamwork.operators import series as S
from loamwork.operators import similar as SI
from loamwork.operators import similarity as SM
from loamwork.operators import stats
from loamwork.operators import terms as M


def test_running_totals_any_ranges(spark):
    draw = random.Random(3)
    keys = draw.sample(range(-5000, 5000), 700)
    df = spark.createDataFrame([(k, draw.randint(0, 9)) for k in keys], "k bigint, v bigint").repartition(5)
    for ranges in (2, 7, 40):
        got = {r.k: r.t for r in O.running_totals(df, "k", {"t": F.col("v")}, ranges).collect()}
        total, want = 0, {}
        for r in sorted(df.collect()):
            total += r.v
            want[r.k] = total
        assert got == want


def test_running_totals_one_row_and_none(spark):
    df = spark.createDataFrame([(1, 2)], "k bigint, v bigint")
    assert O.running_totals(df, "k", {"t": F.col("v")}).first().t == 2
    assert O.running_totals(df.limit(0), "k", {"t": F.col("v")}).count() == 0


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 1.0], [2.0, 2.0, 9.0, 9.0], [None, 4.0, 6.0, 8.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert O.exact_median(df, "v").first().median == pytest.approx(float(np.median([v for v in values if v is not None])))


def test_median_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert O.exact_median(df, "v").first().median is None


def test_number_distinct_with_hot_value(spark):
    df = spark.createDataFrame([("hot",)] * 500 + [(f"v{i:03d}",) for i in range(60)], "s string")
    got = {r.s: r.n for r in O.number_distinct(df, "s", "n").collect()}
    assert got == {s: i for i, s in enumerate(sorted(set(got)))} and len(got) == 61


def brute_auc(rows):
    wins = pairs = 0
    for y, s in rows:
        for z, t in rows:
            if y == 1 and z == 0:
                pairs += 1
                wins += (s > t) + 0.5 * (s == t)
    return wins / pairs if pairs else None


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_with_ties(spark, seed):
    draw = random.Random(seed)
    rows = [(draw.randint(0, 1), draw.randint(0, 12) / 12) for _ in range(150)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert E.roc_auc(df, "y", "s").first().roc_auc == pytest.approx(brute_auc(rows))
    bent = df.withColumn("s", F.col("s") * F.col("s"))  # a monotone change of the scores
    assert E.roc_auc(bent, "y", "s").first().roc_auc == pytest.approx(brute_auc(rows))


def test_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert E.roc_auc(df, "y", "s").first().roc_auc is None
    assert E.average_precision(df, "y", "s").first().average_precision == 1.0
    assert E.binary_metrics(df, "y", "s", 0.95).first().precision == 0.0


def test_sweep_equals_counting(spark):
    draw = random.Random(5)
    rows = [(draw.randint(0, 1), round(draw.random(), 2)) for _ in range(300)]
    got = {r.threshold: (r.tp, r.fp, r.tn, r.fn) for r in E.threshold_sweep(spark.createDataFrame(rows, "y int, s double"), "y", "s").collect()}
    assert len(got) == 46
    for t, counts in got.items():
        want = [sum(1 for y, s in rows if y == a and (s >= t) == b) for a, b in ((1, True), (0, True), (0, False), (1, False))]
        assert list(counts) == want


def test_weighted_score(spark):
    rows = [("a", "5", "96"), ("a", "3", "70"), ("a", "2", "8"), ("a", "x", "50"), ("b", None, None)]
    got = {r.k: r.weighted_score for r in A.weighted_score(spark.createDataFrame(rows, "k string, w string, s string"), "k", "w", "s").collect()}
    assert got == {"a": 70.6, "b": 0.0}


def test_tests_and_regression(spark):
    x = [43, 44, 45, 46, 47, 48, 50, 52]
    rows = [("a", float(v)) for v in x] + [("b", float(v) * 1.5 + i) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "g string, v double")
    r = stats.ttest_two_sample(stats.two_groups(df, "g", "v", "a", "b")).first()
    a, b = np.array(x, float), np.array([v for g, v in rows if g == "b"])
    welch = (a.mean() - b.mean()) / np.sqrt(a.var(ddof=1) / 8 + b.var(ddof=1) / 8)
    assert r.t_welch == pytest.approx(welch) and 0 <= r.p < 0.001
    line = spark.createDataFrame([(float(i), v) for i, v in enumerate([1.0, 3.0, 5.0, 7.0, 11.0])], "x double, y double")
    fit = stats.ols_simple(line, "x", "y", 5.0).first()
    assert (fit.slope, fit.y_new) == (pytest.approx(2.4), pytest.approx(12.6))
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert stats.ols_simple(flat, "x", "y", 5.0).first().slope is None


def test_correlation_drops_constants(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0, "u"), (0, 2.0, 3.0, "v"), (1, 0.5, 3.0, None)], "y int, a double, c double, k string")
    got = {r.feature: r.correlation for r in stats.correlation_with_target(df, "y", ["a", "c"], ["k"]).collect()}
    assert "c" not in got and set(got) == {"a", "k_u", "k_v", "k___MISSING__"}
    assert got["k_v"] == pytest.approx(-1.0)


def test_fill_and_forecast(spark):
    rows = [("i", "2024-01-01", 1.0), ("i", "2024-01-04", 4.0), ("j", "2024-01-02", None), ("j", "2024-01-03", 7.0)]
    daily = spark.createDataFrame(rows, "item string, day string, v double").withColumn("day", F.to_date("day"))
    filled = S.regular_daily_fill(daily, "item", ["v"])
    got = sorted((r["item"], str(r.day), r.v) for r in filled.collect())
    assert got == [("i", "2024-01-01", 1.0), ("i", "2024-01-02", 1.0), ("i", "2024-01-03", 1.0), ("i", "2024-01-04", 4.0), ("j", "2024-01-02", 7.0), ("j", "2024-01-03", 7.0)]
    assert S.forecast_seasonal_drift(filled, "item", "v", horizon=3).count() == 6


def test_stratified_shares_and_stability(spark):
    rows = [(i, "hot" if i % 3 else ("rare" if i % 2 else "mid")) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, g string")
    a = SP.stratified_split(df.repartition(3), ["id"], "g", ["train", "valid", "test"], [0.3, 0.6], per_bucket=15)
    b = SP.stratified_split(df.repartition(11), ["id"], "g", ["train", "valid", "test"], [0.3, 0.6], per_bucket=200)
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {(r.g, r.split): r["count"] for r in a.groupBy("g", "split").count().collect()}
    assert [counts["hot", s] for s in ("train", "valid", "test")] == [180, 180, 240]
    assert sum(counts.values()) == 900


def test_split_with_one_row_per_label(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, g string")
    got = SP.stratified_split(df, ["id"], "g", ["train", "test"], [0.8])
    assert [r.split for r in got.collect()] == ["train", "train"]


def test_draws_follow_the_distribution(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b", float(i % 10)) for i in range(400)], "id bigint, c string, x double")
    made = SP.synthesize_marginals(df, "id", ["c"], ["x"], 10)
    row = made.agg(F.count("*").alias("n"), F.avg((F.col("c") == "a").cast("int")).alias("a"), F.avg("x").alias("x")).first()
    assert row.n == 4000 and row.a == pytest.approx(0.75, abs=0.03) and row.x == pytest.approx(4.5, abs=0.25)


def test_drawn_columns_keep_their_values(spark):
    df = spark.createDataFrame([(i, f"c{i % 8}") for i in range(200)], "id bigint, c string")
    made = SP.synthesize_marginals(df, "id", ["c"], [], 5)
    assert made.count() == 1000 and made.select("c").distinct().count() == 8


def alike(a, b):
    """Equal; or one within the other, 18 characters or more and 72 % of it; or 72 % of all tokens in common."""
    lengths, tokens = sorted(map(len, (a, b))), (set(a.split(" ")), set(b.split(" ")))
    within = (a in b or b in a) and lengths[0] >= max(18, 0.72 * lengths[1])
    return bool(a and b) and (a == b or within or len(tokens[0] & tokens[1]) >= 0.72 * len(tokens[0] | tokens[1]))


def brute_fold(rows):
    kept = []
    for r in rows:
        twin = next((i for i, k in enumerate(kept) if alike(r["key"], k["key"])), None)
        if twin is None:
            kept.append(dict(r))
        elif r["score"] > kept[twin]["score"]:
            kept[twin] = dict(r)
    return sorted(kept, key=lambda r: (-r["score"], r["pos"]))


def test_job_requirements_against_brute_force(spark):
    from loamwork.functions.text import normalize_key

    ad = "\n".join(
        ["Senior Data Engineer", "Requirements", "- Python and SQL, 3+ years of experience", "* Python and SQL, 3+ years of experience!",
         "English B2 or better is needed", "Nice to have", "Docker and Kubernetes in production", "Team player with communication skills", "short", ""]
    )
    docs = spark.createDataFrame([(1, ad), (2, ""), (3, "nothing here")], "d bigint, t string")
    candidates = [c for r in RQ.candidate_lists(docs, "d", "t").orderBy("d").collect() for c in r.candidates]
    want = [r["text"] for r in brute_fold([c.asDict() for c in candidates])]
    got = RQ.job_requirements(docs, "d", "t").orderBy("id").collect()
    assert [r.text for r in got] == want and {r.d for r in got} == {1}
    assert len(want) == len(candidates) - 1  # the two Python lines are one
    assert got[0].weight == 5.0
    titles = {r.d: (r.job_title, r.seniority) for r in RQ.guess_title(docs, "d", "t").collect()}
    assert titles[1] == ("Senior Data Engineer", "senior") and titles[2] == ("unknown", "unknown")


ITEM = "array<struct<text: string, category: string, priority: string, weight: double>>"


def test_merge_fills_and_keeps_order(spark):
    first = {1: [("Python programming", "other", "unknown", 1.0), ("Docker", "hard_skill", "must", 2.0)], 2: [("Git", "hard_skill", "must", 1.0)], 3: None}
    second = {1: [("python Programming!", "hard_skill", "must", 5.0), ("English", "language", "nice", 2.0)], 2: [("Linux", None, None, None), (" ", "x", "x", 1.0)], 3: []}
    lists = spark.createDataFrame([(d, first[d], second[d], d == 2) for d in first], f"d bigint, p {ITEM}, s {ITEM}, weak boolean")
    got = [tuple(r) for r in RQ.merge_requirement_lists(lists, "d", "p", "s", F.col("weak")).orderBy("d", "id").collect()]
    assert got == [
        (1, "R1", "Python programming", "hard_skill", "must", 5.0), (1, "R2", "Docker", "hard_skill", "must", 2.0),
        (1, "R3", "English", "language", "nice", 2.0), (2, "R1", "Linux", "other", "unknown", 1.0),
    ]


def test_cleaned_lists_keep_every_key(spark):
    rows = spark.range(1000).select(F.lit("one list").alias("d"), F.col("id").alias("pos"), F.concat(F.lit("need "), F.col("id") % 700).alias("text"),
                                    F.lit("x").alias("category"), F.lit("must").alias("priority"), F.lit("9").alias("weight"))
    got = RQ.clean_requirements(rows, "d", "pos").collect()
    assert {r.id for r in got} == {f"R{i}" for i in range(1, 701)} and {(r.weight, r.category) for r in got} == {(5.0, "other")}
    assert "WindowGroupLimit" in RQ.clean_requirements(rows, "d", "pos", 5)._jdf.queryExecution().executedPlan().toString()
    fields = ["pos", "text", "category", "priority", "weight"]
    lists = rows.groupBy("d").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("l"))
    assert RQ.numbered(RQ.clean_requirement_lists(lists, "d", F.col("l")), "d", "cleaned").orderBy("id").collect() == sorted(got, key=lambda r: r.id)


def test_sections_of_a_document(spark):
    text = "a\nRequirements\nb\n\nc\nNice to have\nrequired\nd"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, "Requirements")], "d int, t string")
    assert [tuple(r) for r in RQ.section_state(docs, "d", "t").orderBy("d", "pos").collect()] == [(1, 0, "a", None), (1, 2, "b", "must"), (1, 4, "c", "must"), (1, 7, "d", "must")]


def test_terms_against_regular_expressions(spark):
    import re

    texts = ["The small ring, a SMALL ring; smaller rings", "šmall ring small", "", "ring-fenced ring's ring_x ring"]
    terms = ["small ring", "ring", "a", "small", "ring's"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "d int, t string")
    got = {(r.d, r.term): r.n for r in M.match_terms(docs, "d", "t", spark.createDataFrame([(t,) for t in terms], "term string"), "term").collect()}
    want = {}
    for i, text in enumerate(texts):
        for term in terms:
            n = len(re.findall(rf"\b{re.escape(term)}\b", text, re.IGNORECASE))
            if n:
                want[i, term] = n
    assert got == want


def python_ahead(y, weights, horizon, season):
    if weights is None:
        last = y[-season:]
        return [last[h % len(last)] for h in range(horizon)]
    a, b, g = weights
    level, trend, seasons = y[0], 0.0, [0.0] * season
    for t, v in enumerate(y[1:], 1):
        own = seasons[t % season]
        before, level = level, a * (v - own) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        seasons[t % season] = g * (v - level) + (1 - g) * own
    return [level + h * trend + seasons[(len(y) - 1 + h) % season] for h in range(1, horizon + 1)]


def test_backtest_against_plain_loops(spark):
    """Seasonal, rising, flat, short and one-day items: errors, choice and values."""
    import datetime as dt

    draw = random.Random(7)
    items = {
        "weekly": [10 * (i % 7 == 5) + draw.random() for i in range(70)], "rising": [2.0 * i + draw.random() for i in range(60)], "flat": [4.0] * 40,
        "noise": [draw.gauss(0, 5) for _ in range(50)], "short": [1.0, 5.0, 2.0], "one": [3.0], "edge": [float(i % 3) for i in range(21)],
    }
    first = dt.date(2024, 1, 1)
    rows = [(k, first + dt.timedelta(i), v) for k, y in items.items() for i, v in enumerate(y)]
    draw.shuffle(rows)
    found = {}
    for r in S.forecast_backtest(spark.createDataFrame(rows, "k string, day date, v double"), "k", "v").collect():
        found.setdefault(r.k, []).append(r)
    methods = {"naive": None, **S.SMOOTHERS}
    for k, y in items.items():
        own = sorted(found[k], key=lambda r: r.step)
        assert [r.step for r in own] == list(range(1, 8)) and own[0].day == first + dt.timedelta(len(y))
        cuts = [len(y) - 7 * c for c in (1, 2, 3) if len(y) - 7 * c >= 14]
        errors = {m: [(f - v) ** 2 for n in cuts for f, v in zip(python_ahead(y[:n], w, 7, 7), y[n : n + 7], strict=True)] for m, w in methods.items()}
        errors = {m: round((sum(e) / len(e)) ** 0.5, 6) if e else None for m, e in errors.items()}
        for m in methods:
            assert own[0][f"error_{m}"] == (None if errors[m] is None else pytest.approx(errors[m], abs=2e-6))
        assert own[0].method == (min(methods, key=lambda m: errors[m]) if cuts else "naive")
        assert [r.v for r in own] == pytest.approx(python_ahead(y, methods[own[0].method], 7, 7))
    assert found["rising"][0].method == "trend" and found["flat"][0].method == "naive"
    assert S.forecast_backtest(spark.createDataFrame([], "k string, day date, v double"), "k", "v").count() == 0


def say_the_same(a, b):
    shorter, longer = sorted((len(a), len(b)))
    x, y = set(a.split()), set(b.split())
    return bool(a and b) and (a == b or ((a in b or b in a) and shorter >= 18 and shorter / longer >= 0.72) or len(x & y) / len(x | y) >= 0.72)


def folded(keys, scores=None):
    """Brute force: every entry against the holders of all places."""
    places = []
    for i, key in enumerate(keys):
        at = next((p for p in places if say_the_same(keys[p[-1]], key)), None)
        if at is None:
            places.append([i])
        elif scores is None:
            at.insert(len(at) - 1, i)
        elif scores[i] > scores[at[-1]]:
            at.append(i)
        else:
            at.insert(len(at) - 1, i)
    return places


def key_list(draw, n):
    words = [f"{draw.choice('abcdefgh')}{draw.choice('xyz') * draw.randint(0, 6)}" for _ in range(40)]
    out = []
    for _ in range(n):
        kind = draw.random()
        if out and kind < 0.35:
            base = draw.choice(out).split()
            if base:
                base[draw.randrange(len(base))] = draw.choice(words)
            out.append(" ".join(base))
        elif out and kind < 0.6:
            base = draw.choice(out)
            cut = draw.randint(0, max(1, len(base) // 4))
            out.append((base[cut:] if draw.random() < 0.5 else "q" * cut + base).strip())
        else:
            out.append(" ".join(draw.choice(words) for _ in range(draw.choice([0, 1, 2, 4, 9, 25]))))
    return out


@pytest.mark.parametrize("small", [0, 64])
def test_similar_pairs_and_places_against_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(SI, "SMALL", small)
    draw = random.Random(12)
    rows = []
    for i in range(60):
        keys = key_list(draw, draw.choice([0, 1, 2, 12, 60]))
        rows.append((i, keys, [draw.choice([1.0, 2.0, 3.0]) for _ in keys]))
    df = spark.createDataFrame(rows, "d int, k array<string>, s array<double>")
    pairs = {r.d: r.p for r in SI.similar_pairs(df, "k", "p").collect()}
    plain = {r.d: r.p for r in SI.similar_places(df, "k", "p").collect()}
    scored = {r.d: r.p for r in SI.similar_places(df, "k", "p", "s").collect()}
    for d, keys, scores in rows:
        assert pairs[d] == sorted(j * SI.PAIR + i for j in range(len(keys)) for i in range(j) if say_the_same(keys[i], keys[j]))
        for got, own in ((plain[d], None), (scored[d], scores)):
            want = folded(keys, own)
            first = [min(p) for p in want]
            assert [p for p in got if p >= 0] and sorted(p for p in got if p >= 0) == first or not keys
            for p, members in zip(first, want, strict=True):
                assert sorted(i for i, q in enumerate(got) if (q if q >= 0 else -1 - q) == p) == sorted(members)
                assert got[members[-1] if own else p] == p


def test_a_list_of_twenty_thousand_items_ends_in_seconds(spark):
    """Mostly different lines, some of them close to earlier ones, with frequent words in all of them."""
    import time

    draw = random.Random(4)
    words = [f"word{i}" for i in range(6000)]
    keys = []
    for i in range(20_000):
        if i % 10 == 9:
            keys.append(keys[draw.randrange(i)] + " x")
        else:
            keys.append("znalost a " + " ".join(draw.sample(words, 7)))
    df = spark.createDataFrame([(1, keys, [float(len(k) % 5) for k in keys])], "d int, k array<string>, s array<double>").repartition(1)
    SI.similar_places(df.select("d", F.slice("k", 1, 50).alias("k"), "s"), "k", "p", "s").collect()  # code is compiled
    start = time.time()
    places = SI.similar_places(df, "k", "p", "s").first().p
    assert time.time() - start < 45
    assert sum(p < 0 for p in places) >= 2000 and len(places) == 20_000


def runs_of_parts(texts, terms):
    """Brute force: every run of parts of every text from every word on."""
    import re
    from collections import Counter

    found = Counter()
    for i, text in texts:
        parts = re.findall(r"\w+|\W+", (text or "").lower())
        for a in range(len(parts)):
            if re.match(r"\w", parts[a]):
                run = ""
                for b in range(a, len(parts)):
                    run += parts[b]
                    found.update((i, t) for t in terms if t.lower() == run)
    return found


@pytest.mark.parametrize("block", [4 << 20, 200])
def test_terms_against_all_runs(spark, monkeypatch, block):
    """Terms that begin alike, repeat themselves, overlap, share a form or hold signs; with one block and with several."""
    monkeypatch.setattr(M, "TRIE_BYTES", block)
    draw = random.Random(6)
    terms = ["a", "a b", "a b a", "b a", "A", "a-b", "a  b", "b_a", "é a", "a b a b", ".a", "c++", "c", "ab"] + [f"a {draw.choice('abc')} {draw.choice('abc')}" for _ in range(12)]
    texts = [(i, "".join(draw.choice(["a", "b", "c", " ", " ", "-", "_", "é", "++", "\n"]) for _ in range(draw.choice([0, 5, 60])))) for i in range(120)] + [(500, None), (501, "a " * 3000)]
    docs = spark.createDataFrame(texts, "d int, t string")
    words = spark.createDataFrame([(t,) for t in terms], "term string")
    want = dict(runs_of_parts(texts[:-1], set(terms)))
    got = {(r.d, r.term): r.n for r in M.match_terms(docs.filter("d <> 501"), "d", "t", words, "term").collect()}
    assert got == want
    ranked = {r.d: r.terms for r in M.ranked_terms(M.term_counts(docs, "d", "t", words, "term"), "d", lambda f: [-f["n"], f["term"]], 2).collect()}
    assert ranked[501] == "A, a" and 500 not in ranked
    for d in {d for d, _ in want}:
        assert ranked[d] == ", ".join(t for _, t in sorted((-n, t) for (e, t), n in want.items() if e == d)[:2])


def test_long_terms_and_no_terms(spark):
    docs = spark.createDataFrame([(1, "w " * 4000), (2, "x")], "d int, t string")
    term = ("w " * 1500).strip()
    assert [tuple(r) for r in M.match_terms(docs, "d", "t", spark.createDataFrame([(term,)], "term string"), "term").collect()] == [(1, term, 2501)]
    assert M.match_terms(docs, "d", "t", spark.createDataFrame([], "term string"), "term").count() == 0


def test_contained_pairs_against_all_pairs(spark):
    draw = random.Random(8)
    short = sorted({"".join(draw.choice("ab") for _ in range(draw.randint(1, 5))) for _ in range(25)})
    long = sorted({"".join(draw.choice("ab") for _ in range(draw.randint(1, 9))) for _ in range(40)})
    s = spark.createDataFrame([(t, t) for t in short], "short_id string, short_text string")
    g = spark.createDataFrame([(t, t) for t in long], "long_id string, long_text string")
    assert {tuple(r) for r in J.contained_pairs(s, g).collect()} == {(a, b) for a in short for b in long if a in b}


def test_cells_of_a_product_follow_its_size(spark, monkeypatch):
    assert [J.product_cells(n, m) for n, m in ((0, 5), (3, 0), (10, 10), (1 << 20, 1), (1 << 20, 64), (5, 1 << 30))] == [1, 1, 1, 1, 64, 5]
    left, right = spark.range(40).select(F.col("id").alias("a")), spark.range(30).select(F.col("id").alias("b"))
    for pairs in (1 << 20, 100):
        monkeypatch.setattr(J, "CELL_PAIRS", pairs)
        found = J.every_pair(left, right)
        assert sorted(map(tuple, found.collect())) == [(a, b) for a in range(40) for b in range(30)]
        assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    assert J.every_pair(left.limit(0), right).count() == 0


def test_dictionary_join_beyond_the_limit(spark, monkeypatch):
    left, right = spark.range(50).select((F.col("id") % 7).alias("k"), "id"), spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    want = sorted(J.dictionary_join(left, right, "k").collect())
    monkeypatch.setattr(J, "BROADCAST_BYTES", 2)
    assert sorted(J.dictionary_join(left, right, "k").collect()) == want


@pytest.mark.parametrize("block", [1, 3, 100])
def test_topk_against_numpy(spark, block):
    draw = np.random.default_rng(4)
    vectors, queries = draw.normal(size=(80, 6)), draw.normal(size=(7, 6))
    vectors[11] = vectors[10]  # a tie
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(vectors)], "id bigint, v array<double>").repartition(4)
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(queries)], "q bigint, v array<double>")
    got = sorted((r.query_id, r.place, r.chunk_id) for r in SM.topk_similarity(v, "id", "v", q, "q", "v", k=4, floor=0.1, block=block).collect())
    want = []
    for i, row in enumerate(queries @ vectors.T):
        best = sorted((-s, j) for j, s in enumerate(row) if s >= 0.1)[:4]
        want += [(i, n + 1, j) for n, (_, j) in enumerate(best)]
    assert got == sorted(want)


def test_char_chunks_cover_the_text():
    draw = random.Random(2)
    for _ in range(60):
        words = [f"{i}" + "w" * draw.randint(1, 30) for i in range(draw.randint(0, 120))]
        text = "".join(w + draw.choice([" ", ". ", "\n", "\n\n"]) for w in words)
        chunks = D.split_chars(text, 100, 20, D.SEPARATORS)
        assert all(0 < len(c) <= 100 for c in chunks)
        place = 0
        for c in chunks:  # chunks come in order, overlap by a bounded part and leave only white space out
            at = text.find(c, max(0, place - 100))
            assert at >= 0 and text[place:at].strip(" .\n") == ""
            place = max(place, at + len(c))
        assert text[place:].strip() == ""


def test_long_word_is_cut():
    assert [len(c) for c in D.split_chars("x" * 250, 100, 20, D.SEPARATORS)] == [100, 100, 90]


def test_sections(spark):
    text = "intro line here with many small words in it\n1.2 Scope\nbody one\nSTRANA 3\nPage 2/3\nGENERAL RULES AND CONDITIONS OF USE NOW\nbody two\nbody three\n2 Empty"
    got = D.heading_sections(spark.createDataFrame([(1, text), (2, "")], "d int, t string"), "d", "t").orderBy("d", "idx").collect()
    assert [(r.d, r.header, r.body) for r in got] == [
        (1, "__DOCUMENT__", "intro line here with many small words in it\nbody one\nbody two\nbody three"),
        (1, "1.2 Scope", "body one"), (1, "GENERAL RULES AND CONDITIONS OF USE NOW", "body two\nbody three"), (2, "__DOCUMENT__", ""),
    ]


def test_word_chunks(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(400))), (2, "a b"), (3, "  ")], "d int, t string")
    got = [(r.d, r.chunk, len(r.text.split())) for r in D.chunk_words(docs, "d", "t").orderBy("d", "chunk").collect()]
    assert got == [(1, 0, 220), (1, 1, 220), (1, 2, 70), (2, 0, 2)]


def test_reasoning_only_after_the_last_question(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "<think>\na\n</think>\n\nold"), (1, 2, "user", "q2"), (1, 3, "tool", "r"), (1, 4, "tool", "s"), (1, 5, "assistant", "<think>\nb\n</think>\n\nnew")]
    rows = [(c, 10 * turn + 5, role, text) for c, turn, role, text in rows]  # turn numbers with gaps
    blocks = CV.render_turns(spark.createDataFrame(rows, "c int, turn bigint, role string, text string"), "c", "turn", "role", "text")
    got = "".join(r.rendered for r in blocks.orderBy("turn").collect())
    assert got == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nold<|im_end|>\n<|im_start|>user\nq2<|im_end|>\n"
        "<|im_start|>user\n<tool_response>\nr\n</tool_response>\n<tool_response>\ns\n</tool_response><|im_end|>\n"
        "<|im_start|>assistant\n<think>\nb\n</think>\n\nnew<|im_end|>\n"
    )


def test_tool_calls_behind_an_answer(spark):
    """JSON text or a map as arguments, with and without an answer before them, in the last turn and in an earlier one."""
    rows = [(1, "user", "q", None), (2, "assistant", "so", [("a", '{"x": 1}'), ("b", None)]), (3, "tool", "r", None), (4, "assistant", "<think>t</think>\n\n", [("c", "[]")]), (5, "assistant", "end", [])]
    df = spark.createDataFrame([(1, *r) for r in rows], "c int, turn bigint, role string, text string, calls array<struct<name:string,arguments:string>>")
    got = [r.rendered for r in CV.render_turns(df, "c", "turn", "role", "text", "calls").orderBy("turn").collect()]
    assert got[1] == '<|im_start|>assistant\nso\n<tool_call>\n{"name": "a", "arguments": {"x": 1}}\n</tool_call>\n<tool_call>\n{"name": "b", "arguments": {}}\n</tool_call><|im_end|>\n'
    assert got[3] == '<|im_start|>assistant\n<think>\nt\n</think>\n\n<tool_call>\n{"name": "c", "arguments": []}\n</tool_call><|im_end|>\n'
    assert got[4] == "<|im_start|>assistant\n<think>\n\n</think>\n\nend<|im_end|>\n"
    mapped = df.withColumn("calls", F.transform("calls", lambda c: F.struct(c["name"].alias("name"), F.create_map(F.lit("k"), F.lit(2)).alias("arguments"))))
    assert '{"name": "a", "arguments": {"k":2}}' in CV.render_turns(mapped, "c", "turn", "role", "text", "calls").filter("turn = 2").first().rendered


def test_hybrid_extraction_of_weak_missing_and_strong_lists(spark):
    item = "array<struct<text:string,category:string,priority:string,weight:double,canonical_key:string,generic_flag:boolean>>"
    strong = [(f"requirement number {i} with words", "hard_skill" if i % 2 else "language", "must", 1.0, f"k{i}", False) for i in range(6)]
    found = [("requirement number 1 with words", "hard_skill", "nice", 4.0, None, None), ("something else entirely", "other", "unknown", 1.5, None, None)]
    rows = [(1, strong, found, "Lead", "unknown", "found", "junior"), (2, strong[:2], found, "", None, "found", "unknown"), (3, None, None, None, "senior", None, None)]
    df = spark.createDataFrame(rows, f"d int, p {item}, s {item}, t string, l string, ft string, fl string")
    one, two, three = RQ.hybrid_extraction(df, "d", "p", "s", "t", "l", "ft", "fl").orderBy("d").collect()
    assert (one.job_title, one.seniority, one.weak, one.primary_count, one.secondary_count, one.merged_count, one.source) == ("Lead", "junior", False, 6, 2, 7, "llm_json_plus_fallback_merge")
    assert one.requirements[1].weight == 4.0 and [r.id for r in one.requirements] == [f"R{i}" for i in range(1, 8)]
    assert (two.job_title, two.seniority, two.weak, two.merged_count, two.source) == ("found", "unknown", True, 2, "fallback_dynamic_rules_only")
    assert (three.job_title, three.seniority, three.primary_count, three.merged_count, three.requirements) == ("unknown", "senior", 0, 0, [])
    assert RQ.hybrid_extraction(df, "d", "p", "s", "t", "l", "ft", "fl", most=3).filter("d = 1").first().merged_count == 3


def test_distinct_texts_are_scored_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def load():
        def model(texts):
            with open(log, "a") as out:
                out.write("".join(t + "\n" for t in texts))
            return [float(len(t)) for t in texts]

        return model

    docs = spark.createDataFrame([(i, "same text" if i % 3 else f"text {i}") for i in range(30)], "d bigint, t string")
    got = {r.d: r.score for r in D.score_distinct(docs, "d", "t", load).collect()}
    assert len(got) == 30 and got[1] == 9.0
    calls = open(log).read().split("\n")
    assert calls.count("same text") == 1


def test_encoding_of_unseen_and_missing(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    codes = FE.label_dictionary(train, "c", "code", start=1)
    test = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, c string")
    got = {r.id: r.code for r in FE.label_encode(test, codes, "c", "code", unseen=0).collect()}
    assert got == {1: 2, 2: 0, 3: 1}
    assert FE.category_values(train, "c") == ["__MISSING__", "a", "b"]
    assert {tuple(r) for r in FE.one_hot_long(train, "id", ["c"]).collect()} == {(1, "c", "b", 1), (2, "c", "a", 1), (3, "c", "__MISSING__", 1)}


def test_preprocessor_constant_column(spark):
    df = spark.createDataFrame([(5.0, "u"), (5.0, "v"), (None, "u")], "x double, c string")
    assert {r.x for r in FE.Preprocessor(["x"], ["c"]).fit(df).apply(df).collect()} == {0.0}


@pytest.mark.parametrize("few", [0, 100])
def test_terms_of_any_form_against_all_positions(monkeypatch, few):
    """Words, phrases, overlaps, signs and letters beyond Latin-1, with phrases looked for one by one or in one walk."""
    import random

    monkeypatch.setattr(M, "FEW", few)
    draw = random.Random(2)
    pieces = ["a", "b", "ab", "é", "ž", "x_1", "½", "a", " ", " ", ", ", "-", "+", "\u00a0", "\n", "—", "\x85"]
    made = lambda n: "".join(draw.choices(pieces, k=n))
    terms = sorted({made(draw.randrange(1, 6)) for _ in range(400)} | {"a a", "a+", "ab-ab"})
    trie = M.TermTrie([(t.upper(), t) for t in terms] + [("again", "a a")])
    for text in [made(draw.randrange(0, 60)) for _ in range(300)] + ["", "a a a", "a+ a+", "a+b", "ab-ab-ab"]:
        parts, want = M.PARTS.findall(text), {}
        for t in terms:
            own = M.PARTS.findall(t)
            n = sum(parts[i : i + len(own)] == own for i in range(len(parts))) if M.PARTS.fullmatch("a" + own[0]) else 0
            want |= {t.upper(): n} | ({"again": n} if t == "a a" else {}) if n else {}
        assert trie.counts(text) == want


@pytest.mark.parametrize("size", [1 << 20, 20])
def test_kept_columns_stay_with_their_text(spark, monkeypatch, size):
    """In the row, or by document where the terms fill several blocks."""
    monkeypatch.setattr(M, "TRIE_BYTES", size)
    docs = spark.createDataFrame([(1, "big data, big plan", "u"), (2, "none", None), (3, None, "w"), (4, "Plan", None)], "d int, t string, k string")
    words = spark.createDataFrame([("big data",), ("plan",), ("big",)], "term string")
    got = M.ranked_terms(M.term_counts(docs, "d", "t", words, "term", ["t", "k"]), "d", lambda f: [-f["n"], f["term"]], sep=None, keep=["k", "t"])
    assert sorted(map(tuple, got.collect())) == [(1, "u", "big data, big plan", ["big", "big data", "plan"]), (4, None, "Plan", ["plan"])]
