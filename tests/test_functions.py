"""Scalar functions on hand-made values, with nulls, edges and accents."""

import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.functions import jsons, text as T
from loamwork.functions import requirements as R
from loamwork.functions import values as V
from loamwork.functions import wordlists as W
from loamwork.functions.distributions import f_cdf_value, t_cdf_value, t_ppf_value
from loamwork.operators import evaluation as E


def apply(spark, kind, values, function):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_risk_bands_at_their_edges(spark):
    got = apply(spark, "double", [-0.2, 0.25, 0.2501, 0.34, 0.3401, 1.2, None], V.risk_bucket)
    assert got == [None, "Low", "Medium", "Medium", "High", None, None]


def test_bool_float_and_ratio(spark):
    assert apply(spark, "string", [None, "", " ANO ", "no", "1"], V.parse_bool) == [True, True, True, False, True]
    assert apply(spark, "string", ["1.5", "x", None], V.safe_float) == [1.5, 0.0, 0.0]
    assert apply(spark, "double", [0.0, 8.0, None], lambda c: V.ratio_guarded(F.lit(2.0), c)) == [None, 25.0, None]


def test_strict_map_raises(spark):
    with pytest.raises(Exception, match="no code for value"):
        apply(spark, "string", ["a", "b"], lambda c: V.map_strict(c, {"a": 1}, "error"))


def test_unknown_tool_raises_and_folds(spark):
    assert apply(spark, "array<double>", [[8.0, 2.0, 2.0]], lambda c: V.tool_fold(F.lit("multiply"), c)) == [32.0]
    assert apply(spark, "array<double>", [[5.0, 3.0]], lambda c: V.tool_fold(F.lit("divide"), c)) == [5 / 3]
    with pytest.raises(Exception, match="unknown operation"):
        apply(spark, "array<double>", [[5.0, 3.0]], lambda c: V.tool_fold(F.lit("power"), c))


def test_sunday_belongs_to_next_week(spark):
    days = ["2024-03-09 10:00:00", "2024-03-10 10:00:00", "2024-03-11 10:00:00"]  # Saturday, Sunday, Monday
    got = apply(spark, "string", days, lambda c: V.week_start(c.cast("timestamp_ntz")).cast("string"))
    assert got == ["2024-03-04", "2024-03-11", "2024-03-11"]


def test_refund_edges(spark):
    days = [10, 45, 5, 30, 31, -3, None]
    made = lambda c: F.lit("2024-05-01 12:00:00").cast("timestamp_ntz") - F.make_dt_interval(c)
    got = apply(spark, "int", days, lambda c: V.refund_eligible(made(c), F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")))
    assert got == [True, False, True, True, False, True, False]


def test_period_labels(spark):
    got = apply(spark, "string", ["2007", "2007-03", "2007-Q2", "x", "2007-13"], lambda c: V.period_parse(c).cast("string"))
    assert got == ["2007-01-01", "2007-03-01", "2007-04-01", None, None]


def test_space_and_accents(spark):
    raw = ["a  b\x00c\r\n d ", "Žltý kôň ďalší ÀÇß ł", "éa", None]
    assert apply(spark, "string", raw[:1], T.normalize_space) == ["a b c d"]
    plain = apply(spark, "string", raw, T.strip_accents)
    assert plain == ["a  b\x00c\r\n d ", "Zlty kon dalsi ACß ł", "ea", None]
    full = apply(spark, "string", ["Ǆ ﬁ é", None], T.strip_accents_full)
    assert full == ["".join(c for c in unicodedata.normalize("NFKD", "Ǆ ﬁ é") if not unicodedata.combining(c)), None]


def test_select_extraction(spark):
    raw = ["```sql\nSELECT a,\n b FROM t;\n```", "use select 1 ; select 2", "drop table t", "preselected rows", ""]
    assert apply(spark, "string", raw, T.extract_select) == ["SELECT a, b FROM t", "select 1", None, None, None]


def test_thinking_fence_title(spark):
    assert apply(spark, "string", ["<THINK>a\nb</THINK> c", "x</think> y"], T.strip_thinking) == ["c", "y"]
    assert apply(spark, "string", ["```json\n{}\n```", "plain"], T.strip_code_fence) == ["{}", "plain"]
    assert apply(spark, "string", ['\n "NADPIS: Zákon o dani"\nx', ""], T.clean_title_line) == ["Zákon o dani", ""]


def test_lenient_json(spark):
    texts = ['{"a":1}', 'x {"a":2} y [3]', "```json\n[1]\n```", "none", "", "{bad {\"b\": 4}", '{"b":1,"a":2}', 'x {"b":1,"a":2}', "[" * 60000, "x " + "[" * 60000 + "]" * 60000, 'x {"k": "a[b"} y', "[[q], [[q]]]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.j for r in jsons.parse_lenient(df, "t", "j").orderBy("i").collect()]
    assert got == ['{"a":1}', "[3]", "[1]", "null", "null", '{"b":4}', '{"a":2,"b":1}', '{"a":2,"b":1}', "null", "[]", '{"k":"a[b"}', "null"]


def test_genericness_examples(spark):
    keys = ["komunikacne schopnosti", "python 3 roky minimalne b2", "dobra spolupraca"]
    got = apply(spark, "string", keys, R.genericness)
    assert [(g.score, g.is_generic) for g in got] == [(0.94, True), (0.0, False), (0.62, True)]


def test_lists_are_parameters(spark):
    assert apply(spark, "string", ["Wanted: rust", "required"], lambda c: R.detect_section(c, must=["wanted"], nice=[])) == ["must", None]
    assert apply(spark, "string", ["rust", "b2"], lambda c: R.classify_category(c, {"metal": ["rust"]})) == ["metal", "other"]
    assert apply(spark, "string", ["the big Rust"], lambda c: R.requirement_key(c, {"x": "y"}, ["big"], {"the rust": "rust"})) == ["rust"]


def test_requirement_keys(spark):
    raw = ["Znalosť SQL", "  MS   Excel ", "Prax v Linux", "REST APIs", "English language", "R&D"]
    assert apply(spark, "string", raw, R.requirement_key) == ["sql", "microsoft excel", "linux", "rest api", "anglictina", "r and d"]


def test_boundary_patterns(spark):
    hard = lambda c: F.lower(c).rlike(W.any_pattern(W.HARD_SKILL_PATTERNS))
    assert apply(spark, "string", ["SQL, python", "pythonic", "čsql", "ci/cd"], hard) == [True, False, False, True]


def test_distributions_against_tables():
    assert t_ppf_value(0.95, 10) == pytest.approx(1.812461, abs=1e-5)
    assert t_ppf_value(0.90, 5) == pytest.approx(1.475884, abs=1e-5)
    assert t_cdf_value(2.228139, 10) == pytest.approx(0.975, abs=1e-6)
    assert f_cdf_value(3.3258, 5, 10) == pytest.approx(0.95, abs=1e-4)
    assert f_cdf_value(4.7571, 3, 6) == pytest.approx(0.95, abs=1e-4)


def test_patterns_with_a_look_ahead_match_the_same(spark):
    """Every category pattern, at the ends of lines, inside words, behind signs and accents."""
    draw = random.Random(9)
    words = ["python", "pythonic", "c++", "c++x", "xc++", "sql", "mysql", "3 years", "12+ roky", "bachelor", "bachelors", "é", "sql_", "team", "steam", "ci/cd", "b2", "ab2", "on-site", "٣ years", "master's", "scaled agile"]
    lines = [draw.choice(["", " ", "-", "_", "é"]) + draw.choice([" ", ", ", "", "-"]).join(draw.choice(words) for _ in range(draw.randint(0, 4))) for _ in range(1500)]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    for patterns in (W.HARD_SKILL_PATTERNS, W.EDUCATION_PATTERNS, W.LANGUAGE_PATTERNS, W.LOCATION_PATTERNS, W.SOFT_SKILL_PATTERNS, W.YEARS_PATTERNS):
        same = F.col("x").rlike(W.java_pattern(patterns)) == F.col("x").rlike(W.any_pattern(patterns))
        assert df.filter(~same).count() == 0
    for parts in (W.MUST_CUES, W.GENERIC_PARTS, ["2.x", "b"], ["•", "a"]):
        got = [r[0] for r in df.select(R.contains_any(F.col("x"), parts)).collect()]
        assert got == [any(p in x for p in parts) for x in lines]


def test_fillers_in_few_passes_as_one_by_one(spark):
    draw = random.Random(5)
    lists = [W.STOP_PHRASES, ["a b", "b c", "c", "x c", "q a b z", "zz"], ["s", "prax s", "s s"], ["a", "a b", "b"], ["a.b", "b", "+c"], []]
    for phrases in lists:
        words = sorted({w for p in phrases for w in p.split()} | {"k", "ss", "s-s", "a.b"})
        texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 9))) for _ in range(400)]
        want = []
        for t in texts:
            for p in phrases:
                t = re.sub(rf"\b{re.escape(p)}\b", " ", t)
            want.append(" ".join(t.split()))
        c = F.col("x")
        for p in R.filler_passes(phrases):
            c = F.regexp_replace(c, p, " ")
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        assert [" ".join(r[0].split()) for r in df.select(c).collect()] == want
    assert len(R.filler_passes(W.STOP_PHRASES)) == 1


def test_marks_passed_on_and_beside_the_marks(spark):
    draw = random.Random(3)
    for marks in ([i / 100 for i in range(50, 96)], [0.1, 0.2, 0.30000000000000004, 0.4], [0.5], [0.1, 0.5, 0.6], [-3.0, 0.0, 3.0]):
        scores = [None, float("nan"), float("inf"), float("-inf"), *marks, *[math.nextafter(m, d) for m in marks for d in (-9, 9)], *[draw.uniform(-1, 2) for _ in range(300)]]
        df = spark.createDataFrame([(x,) for x in scores], "x double")
        got = [r[0] for r in df.select(E.marks_passed(F.col("x"), marks)).collect()]
        assert got == [0 if x is None else len(marks) if x != x else sum(m <= x for m in marks) for x in scores]


def test_cdfs_of_whole_batches_match_closed_forms(spark):
    """Distinct rows of a batch are computed together; a missing value gives none."""
    from loamwork.functions import distributions as DI

    x = np.concatenate([np.linspace(-6, 6, 401), [0.0]])
    one, two, seven = (np.full(x.size, float(n)) for n in (1, 2, 7))
    assert np.abs(DI.t_cdf_values(x, one) - (0.5 + np.arctan(x) / np.pi)).max() < 1e-12
    assert np.abs(DI.t_cdf_values(x, two) - (0.5 + x / (2 * np.sqrt(2 + x * x)))).max() < 1e-12
    assert np.abs(DI.f_cdf_values(x, two, seven) - np.where(x > 0, 1 - (1 + 2 * np.abs(x) / 7) ** -3.5, 0)).max() < 1e-12
    df = spark.createDataFrame([(0.0, 2.0), (None, 2.0), (1.0, None), (0.0, 2.0)], "t double, df double")
    assert [r[0] for r in df.select(DI.t_cdf("t", "df")).collect()] == [0.5, None, None, 0.5]


def test_parts_between_edges_of_words(spark):
    """The fast patterns of a key match exactly where the plain ones, which begin and end with an edge, do."""
    edge = "(?:^|[^a-z0-9_]){}(?:$|[^a-z0-9_])"
    cases = [("am", r"aspon|min\.?|minimalne"), ("abc", "[abc][12]"), ("0-9", "[0-9]+")]
    keys = ["", "min", "min.", "min.x", "min_", "xmin", "min minimalne", "minimalnex aspon", "b2", "ab2", "b22", "c1/b2", "b2_", "3", "3 roky", "x3", "3x", "a1.2", "č3č", "min.3", "+4", "4+", "10 b2"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for first, core in cases:
        fast, plain = F.col("k").rlike(R.whole_part(first, core)), F.col("k").rlike(edge.format(f"({core})"))
        assert [(r.k, r.a) for r in df.select("k", fast.alias("a")).collect()] == [(r.k, r.b) for r in df.select("k", plain.alias("b")).collect()]


def test_signs_outside_of_keys(spark):
    """One class instead of ranges, which four tasks at once read several times slower."""
    text = "".join(chr(c) for c in range(1, 0x250)) + "–€\U0001F600ж٣"
    df = spark.createDataFrame([(text,)], "t string")
    one, two = df.select(F.regexp_replace("t", R.NO_KEY_SIGN, "~"), F.regexp_replace("t", r"[^a-zA-Z0-9+.#/ ]", "~")).first()
    assert one == two


def test_white_space_is_told_like_by_its_ranges(spark):
    """The class of single signs and one property holds the very characters that the ranges left out."""
    ranges = r"[^\x21-\x{84}\x01-\x08\x0E-\x1B\x{86}-\x{9F}\x{A1}-\x{167F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]"
    text = "".join(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000) + "﻿\U0001F600"
    assert "IsWhite_Space" in T.SPACE_CLASS
    df = spark.createDataFrame([(text,)], "t string")
    one, two = df.select(F.regexp_replace("t", T.SPACE_CLASS, "~"), F.regexp_replace("t", ranges, "~")).first()
    assert one == two


def test_texts_are_found_by_their_rare_letters(spark):
    """Any characters, texts that overlap or hold others, with and without edges of words."""
    draw = random.Random(17)
    lists = [W.MUST_HEADERS, W.STOP_PHRASES, W.CONCRETE_PARTS, ["ab", "b", "a b", "c++", "+", "é-a", "]^", "\\d", "x.", "•"], ["a"], ["aaa", "aab"], ["q^q", "[q", "-"]]
    for parts in lists:
        letters = sorted(set("".join(parts)) | set("ab é_"))
        lines = ["".join(draw.choice([draw.choice(parts), draw.choice(letters), draw.choice(letters)]) for _ in range(draw.randint(0, 6))) for _ in range(400)]
        df = spark.createDataFrame([(x,) for x in lines], "x string")
        edges = [(p, r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])") for p in parts]
        got = df.select(F.col("x").rlike(W.any_text([(p, "", "") for p in parts])), F.col("x").rlike(W.any_text(edges))).collect()
        whole = [any(re.search(rf"(?<!\w){re.escape(p)}(?!\w)", x) for p in parts) for x in lines]
        assert [tuple(r) for r in got] == list(zip([any(p in x for p in parts) for x in lines], whole, strict=True))


def test_lines_that_say_nothing_have_no_signal(spark):
    """One scan for all phrases and patterns tells what each of them tells."""
    draw = random.Random(23)
    words = [*W.MUST_HEADERS, *W.NICE_CUES, "python", "c++", "b2", "3 years", "12+ roky", "degree", "mysql", "x", "some", "surplus", "é", "-", ":", "(sql)"]
    lines = [draw.choice(["", "- ", "• "]) + " ".join(draw.choice(words) if draw.random() < 0.3 else "word" for _ in range(draw.randint(0, 9))) for _ in range(800)]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    plain = R.says_nothing(F.lower("x"))
    cues = R.contains_any(F.lower("x"), [*W.MUST_HEADERS, *W.NICE_HEADERS, *W.MUST_CUES, *W.NICE_CUES])
    rows = df.select(plain, ~(cues | (R.classify_category(F.col("x")) != "other")), R.line_score(F.col("x"), F.lit(None).cast("string")), R.line_score(F.col("x"), F.lit(None).cast("string"), plain=plain)).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows) and {r[0] for r in rows} == {True, False}
