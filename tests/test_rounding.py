"""Rounded doubles, their signs and means over many rows are those of the SQL."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loamwork.functions import vectors
from loamwork.functions.values import round_scaled
from loamwork.operators import series as S
from loamwork.operators import stats
from loamwork.operators.aggregates import weighted_score
from loamwork.plans import ORACLES, QUERIES


def written(spark, folder, name, con):
    path = f"{folder}/{name}.parquet"
    con.execute(f"copy {name} to '{path}' (format parquet)")
    return path


def test_halves_of_doubles_and_signed_zeros(spark):
    numbers = [1.005, 12.075, 8.345, -1.005, -0.001, 0.0, 2.5, 1e300, float("inf")] + [random.Random(5).randrange(10**6) / 8000 for _ in range(300)]
    got = [r.x for r in spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double").select("i", round_scaled(F.col("x"), 2).alias("x")).orderBy("i").collect()]
    want = [duckdb.execute("select round(?::double, 2)", [x]).fetchone()[0] for x in numbers]
    assert [(x, math.copysign(1, x)) for x in got] == [(x, math.copysign(1, x)) for x in want]


def test_vectors_with_zeros_and_gaps(spark, tmp_path):
    con = duckdb.connect()
    con.execute("create table embeddings as select * from (values (1, [0.0, 0.0]::FLOAT[]), (2, [1.0, NULL, 2.0]::FLOAT[]), (3, NULL), (4, []::FLOAT[]), (5, [NULL]::FLOAT[]), (6, [1.0, -0.0000001]::FLOAT[])) t(vec_id, embedding)")
    written(spark, tmp_path, "embeddings", con)
    got = {r.vec_id: r.unit for r in QUERIES["vector_normalize"](spark, str(tmp_path)).collect()}
    assert str(got) == str(dict(con.execute(ORACLES["vector_normalize"]).fetchall()))
    df = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    assert df.select(vectors.normalize(F.col("v")).alias("u")).first().u == [0.0, 0.0]


def test_score_of_a_report_at_a_half(spark):
    rows = spark.createDataFrame([("a", 1.0, 0.0)] * 199 + [("a", 1.0, 1.0)] * 1 + [("b", 1.0, 100.0)] * 2 + [("b", 1.0, 1.0)] * 1 + [("b", 1.0, 0.0)] * 197, "k string, w double, s double")
    got = {r.k: r.weighted_score for r in weighted_score(rows, "k", "w", "s").collect()}
    assert got == {"a": 0.01, "b": duckdb.execute("select round(201 / 200, 2)").fetchone()[0]} and got["b"] == 1.0


@pytest.mark.parametrize("name", ["trailing_median", "forecast_covariates"])
def test_medians_of_many_rows_a_day(spark, tmp_path, name):
    """Sixty equal rows a day give what one gives: a plain sum is off by its last bits, and so are medians at x.95."""
    con = duckdb.connect()
    make = "create or replace table events as select u * 100000 + i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (d) DAY + INTERVAL (i) SECOND AS ts, u AS user_id, 'view' AS event_type, u + 0.95::DOUBLE - d * 0.1::DOUBLE * (u % 2) AS value, '{{}}' AS props from range(0, 200) a(u), range(0, 4) b(d), range(0, {}) c(i)"
    con.execute(make.format(1))
    want = sorted(con.execute(ORACLES[name]).fetchall())
    for n in (1, 60):
        con.execute(make.format(n))
        folder = tmp_path / str(n)
        folder.mkdir()
        written(spark, folder, "events", con)
        assert sorted(map(tuple, QUERIES[name](spark, str(folder)).collect())) == want


def test_mean_of_days_without_values(spark):
    df = spark.sql("select * from values (1, timestamp_ntz '2024-01-01 00:00:00', cast(null as double)), (2, timestamp_ntz '2024-01-01 00:00:00', 0.1D), (2, timestamp_ntz '2024-01-01 00:00:00', cast('inf' as double)) t(u, ts, v)")
    assert {r.u: r.v for r in S.daily_means(df, "u", "ts", ["v"]).collect()} == {1: None, 2: float("inf")}


def test_a_category_and_its_complement_correlate_alike_at_any_size(spark):
    """Counts of 216 million rows and more: the two are a tie, which goes by name."""
    draw = random.Random(9)
    rows = []
    for n in [216_000_000, 2_160_000_001] * 20:
        s, k = draw.randrange(n // 4, n // 2), draw.randrange(n // 4, n // 2)
        ky = s * k // n + draw.randrange(100_000)
        rows.append((float(n), float(s), k, float(ky)))
    df = spark.createDataFrame(rows, "n double, s double, k bigint, ky double")
    n, s, k, ky = (F.col(c) for c in df.columns)
    got = df.select(*df.columns, stats.indicator_correlation(n, s, k, ky).alias("a"), stats.indicator_correlation(n, s, n - k, s - ky).alias("b")).collect()
    for r in got:
        n, s, k, ky = map(int, (r.n, r.s, r.k, r.ky))
        assert r.a == -r.b and r.a == pytest.approx((n * ky - k * s) / math.sqrt((n * k - k * k) * (n * s - s * s)), rel=1e-14)
