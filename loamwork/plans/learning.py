"""Model training, evaluation reports and streaming jobs, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamwork.functions.values import hash_unit, literal_map
from loamwork.operators import evaluation as E
from loamwork.operators import models as ML
from loamwork.operators import reports as RP
from loamwork.operators import trees as TR
from loamwork.operators.search import Range
from loamwork.plans.registry import query
from loamwork.session import scratch_folder, table
from loamwork.streaming import samples as ST
from loamwork.streaming import silence as SL

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def model_rows(spark, sf):
    """Line items with a target that depends on quantity and discount."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", *FEATURES)
    noise = hash_unit(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice"), seed=1)
    return df.withColumn("y", (F.col("l_quantity") / 50 + F.col("l_discount") * 5 + noise > 1.4).cast("int"))


# Fits have no SQL counterpart; the queries give what must hold for them, as rows that SQL can state.


@query("train_binary_gbt", "SELECT true AS auc_above")
def train_binary_gbt(spark, sf):
    """The area under the curve on rows that neither the fit nor its early stopping has seen."""
    rows = model_rows(spark, sf)
    unseen = hash_unit(F.col("l_orderkey"), seed=7) < 0.2
    model = ML.train_binary_gbt(rows.filter(~unseen), FEATURES, "y", "l_orderkey")
    return E.roc_auc(ML.positive_score(model, rows.filter(unseen)), "y", "score").select((F.col("roc_auc") > 0.75).alias("auc_above"))


MAIN_SQL = "SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linenumber']) AS feature, unnest([true, false, true, false, false]) AS main"


@query("train_forest_importance", MAIN_SQL)
def train_forest_importance(spark, sf):
    """The two features that the target depends on have the weight."""
    return ML.forest_importance(model_rows(spark, sf), FEATURES, "y").select("feature", (F.col("importance") > 0.05).alias("main"))


@query("importance_by_segment", "SELECT p_type, feature, feature = 'p_size' AS leads FROM (SELECT DISTINCT p_type FROM part), (SELECT unnest(['p_size', 'p_retailprice', 'name_length']) AS feature)")
def importance_by_segment(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice", (F.length("p_name")).alias("name_length"))
    rows = part.withColumn("y", (F.col("p_size") + F.col("name_length") > 35).cast("int"))
    found = ML.importance_by_segment(rows, "p_type", ["p_size", "p_retailprice", "name_length"], "y")
    return found.select("p_type", "feature", (F.col("importance") > 0.5).alias("leads"))


@query("attribution_mean_abs", MAIN_SQL)
def attribution_mean_abs(spark, sf):
    """Boosted trees: the two features that the target depends on move the scores; contributions add up to every row's score."""
    rows = model_rows(spark, sf)
    found = TR.tree_attribution(rows, TR.fitted_nodes(ML.train_binary_gbt(rows, FEATURES, "y", "l_orderkey")), FEATURES)
    off = F.abs(F.col("base") + sum(F.col(f"by_{f}") for f in FEATURES) - F.col("raw")) > 1e-9
    exact = F.when(off, F.raise_error(F.lit("contributions do not add up"))).otherwise(F.col("base"))
    return TR.mean_attribution(found.withColumn("base", exact).filter("base is not null"), FEATURES).select("feature", (F.col("attribution") > 0.1).alias("main"))


@query("attribution_linear", MAIN_SQL)
def attribution_linear(spark, sf):
    return ML.linear_attribution(model_rows(spark, sf), FEATURES, "y").select("feature", (F.col("attribution") > 0.1).alias("main"))


# a tree of two levels whose shares and leaf values are measured on the table
PATHS = "count(*) AS n, count(*) FILTER (WHERE l_quantity <= 25) AS nl, count(*) FILTER (WHERE l_quantity <= 25 AND l_discount <= 0.05) AS nll, count(*) FILTER (WHERE l_quantity > 25 AND l_discount <= 0.03) AS nrl"
LEAVES = """avg(l_tax) FILTER (WHERE l_quantity <= 25 AND l_discount <= 0.05) AS ll, avg(l_tax) FILTER (WHERE l_quantity <= 25 AND l_discount > 0.05) AS lr,
 avg(l_tax) FILTER (WHERE l_quantity > 25 AND l_discount <= 0.03) AS rl, avg(l_tax) FILTER (WHERE l_quantity > 25 AND l_discount > 0.03) AS rr"""


@query(
    "attribution_rows",
    f"""WITH m AS (SELECT {PATHS}, {LEAVES} FROM lineitem),
     s AS (SELECT *, nl / n AS pl, nll / nl AS pll, nrl / (n - nl) AS prl FROM m),
     g AS (SELECT l_orderkey, l_linenumber, l_quantity <= 25 AS q, l_discount <= 0.05 AS d5, l_discount <= 0.03 AS d3, s.* FROM lineitem, s),
     v AS (SELECT *, pl * (pll * ll + (1 - pll) * lr) + (1 - pl) * (prl * rl + (1 - prl) * rr) AS v0,
             CASE WHEN q THEN pll * ll + (1 - pll) * lr ELSE prl * rl + (1 - prl) * rr END AS vq,
             pl * (CASE WHEN d5 THEN ll ELSE lr END) + (1 - pl) * (CASE WHEN d3 THEN rl ELSE rr END) AS vd,
             CASE WHEN q THEN (CASE WHEN d5 THEN ll ELSE lr END) ELSE (CASE WHEN d3 THEN rl ELSE rr END) END AS vqd FROM g)
    SELECT l_orderkey, l_linenumber, round(v0, 9) AS base, round(vqd, 9) AS raw, round((vq - v0 + vqd - vd) / 2, 9) AS by_l_quantity, round((vd - v0 + vqd - vq) / 2, 9) AS by_l_discount FROM v""",
)
def attribution_rows(spark, sf):
    """Contributions of a given tree for every line item."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    low = F.col("l_quantity") <= 25
    low_left, low_right = low & (F.col("l_discount") <= 0.05), ~low & (F.col("l_discount") <= 0.03)
    parts = {3: low_left, 4: low & ~(F.col("l_discount") <= 0.05), 5: low_right, 6: ~low & ~(F.col("l_discount") <= 0.03)}
    m = rows.agg(F.count("*").alias("n0"), F.count_if(low).alias("n1"), F.count_if(~low).alias("n2"), *[F.count_if(c).alias(f"n{k}") for k, c in parts.items()], *[F.avg(F.when(c, F.col("l_tax"))).alias(f"v{k}") for k, c in parts.items()]).first()
    inner = [(0, 1, 2, 0, 25.0), (1, 3, 4, 1, 0.05), (2, 5, 6, 1, 0.03)]
    nodes = [(0, k, a, b, f, t, None, float(m[f"n{k}"]), 0.0) for k, a, b, f, t in inner] + [(0, k, -1, -1, -1, None, None, float(m[f"n{k}"]), m[f"v{k}"]) for k in parts]
    found = TR.tree_attribution(rows.drop("l_tax"), spark.createDataFrame(nodes, TR.NODES), ["l_quantity", "l_discount"])
    return found.select("l_orderkey", "l_linenumber", *[F.round(c, 9).alias(c) for c in ("base", "raw", "by_l_quantity", "by_l_discount")])


#: Small boosters, so that the forty trials of a query end in a minute or two.
SMALL_BOOSTERS = {"depth": Range(2, 4, whole=True), "rounds": Range(4, 16, whole=True), "step": Range(0.02, 0.3, log=True)}


@query("tune_params", "SELECT CAST(range AS INTEGER) AS trial, true AS rising, true AS useful FROM range(40)")
def tune_params(spark, sf):
    """Every trial's best so far is no worse than its own metric and the best before; a trial that ends early was behind the median."""
    tried = ML.tune_gbt(model_rows(spark, sf), FEATURES, "y", "l_orderkey", space=SMALL_BOOSTERS)
    best, before = F.col("best_so_far"), F.coalesce(F.lag("best_so_far").over(Window.orderBy("trial")), F.lit(0.0))
    rising = (F.col("pruned") | (best >= F.col("metric"))) & (best >= before)
    return tried.select("trial", rising.alias("rising"), (F.col("metric") > 0.5).alias("useful"))


@query("tune_regression", "SELECT CAST(range AS INTEGER) AS trial, true AS falling, true AS useful FROM range(40)")
def tune_regression(spark, sf):
    """Errors of a price model: every trial's best is no worse than its own and the best before, and below the spread of prices."""
    tried = ML.tune_regression(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "l_orderkey", space=SMALL_BOOSTERS)
    best, before = F.col("best_so_far"), F.coalesce(F.lag("best_so_far").over(Window.orderBy("trial")), F.col("best_so_far"))
    spread = table(spark, sf, "lineitem").agg(F.stddev_pop("l_extendedprice")).scalar()
    falling = (F.col("pruned") | (best <= F.col("rmse"))) & (best <= before)
    return tried.select("trial", falling.alias("falling"), (F.col("rmse") < spread * 1.2).alias("useful"))


QUARTER_SQL = "CAST(embedding[1] > 0 AS INTEGER) + 2 * CAST(embedding[2] > 0 AS INTEGER)"


@query(
    "train_mlp_multiclass",
    f"""WITH u AS (SELECT {QUARTER_SQL} AS label FROM embeddings WHERE CAST('0x' || substr(md5(concat_ws('|', '42', vec_id)), 1, 12) AS BIGINT) / 281474976710656.0 < 0.2)
       SELECT CAST(label AS VARCHAR) AS label, count(*) AS support, true AS better FROM u GROUP BY 1 UNION ALL SELECT unnest(['macro avg', 'weighted avg']), count(*), true FROM u""",
)
def train_mlp_multiclass(spark, sf):
    """The quarter in which a vector's first two components lie, on rows that neither the fit nor its early stop has seen: twice as good as a guess."""
    first, second = F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))
    rows = table(spark, sf, "embeddings").withColumn("label", (first > 0).cast("int") + 2 * (second > 0).cast("int"))
    unseen = hash_unit(F.col("vec_id"), seed=42) < 0.2
    model = ML.train_mlp(rows.filter(~unseen), "embedding", "label", "vec_id").model
    report = E.classification_report(ML.mlp_predict(model, rows.filter(unseen), "embedding"), "label", "predicted")
    return report.filter("support > 0").select("label", F.col("support").cast("long").alias("support"), (F.col("f1") > 0.5).alias("better"))


@query("score_and_save", "SELECT l_returnflag, count(*) AS n, true AS equal FROM lineitem GROUP BY 1")
def score_and_save(spark, sf):
    """The second call loads what the first one saved; both give the same scores."""
    rows, path = model_rows(spark, sf), scratch_folder(spark, "model")
    first, second = (ML.load_or_train(spark, path, lambda: ML.train_binary_gbt(rows, FEATURES, "y", "l_orderkey")) for _ in range(2))
    scored = ML.positive_score(second, ML.positive_score(first, rows, "first"), "second")
    return scored.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.bool_and((F.col("first") == F.col("second")) & F.col("first").between(0, 1)).alias("equal"))


# --- report -----------------------------------------------------------------------------------------

STATUS = {"click": "splnene", "view": "ciastocne_splnene", "error": "nesplnene", "signup": "nejasne", "purchase": "nejasne"}
ICON_SQL = "CASE event_type WHEN 'click' THEN '✅ splnene' WHEN 'view' THEN '🟡 ciastocne_splnene' WHEN 'error' THEN '❌ nesplnene' ELSE '⚪ nejasne' END"


@query(
    "sink_report_md",
    f"""WITH e AS (SELECT user_id, event_id, event_type, 'R' || event_id AS rid, 'need ' || event_type || '|' || user_id AS req, floor(value) AS score, CASE WHEN event_type = 'click' THEN 5 ELSE 1 END AS w FROM events),
        s AS (SELECT user_id, round(sum(least(score, 100) * w) / sum(w), 2) AS s, arg_min(event_type, event_id) AS job FROM e GROUP BY 1)
        SELECT user_id, 0 AS section, CAST(0 AS BIGINT) AS place, '# Evaluation report' || chr(10) || chr(10) || '**Pozicia:** ' || job || chr(10) || '**Celkove skore:** ' || format('{{:.2f}}', s) || ' / 100' || chr(10) || '**Odporucanie:** '
          || CASE WHEN s >= 80 THEN 'Vhodny kandidat' WHEN s >= 60 THEN 'Skor vhodny kandidat' WHEN s >= 40 THEN 'Ciastocne vhodny / vyzaduje manualne posudenie' ELSE 'Slaba zhoda s poziciou' END
          || chr(10) || chr(10) || '> Vystup je odporucanie pre cloveka, nie automaticke rozhodnutie o kandidatovi.' || chr(10) || chr(10) || '## Vyhodnotenie poziadaviek' || chr(10) || chr(10)
          || '| Stav | Poziadavka | Skore | Priorita | Vysvetlenie |' || chr(10) || '|---|---|---:|---|---|' AS text FROM s
        UNION ALL SELECT user_id, 1, event_id, '| ' || {ICON_SQL} || ' | ' || replace(req, '|', '/') || ' | ' || format('{{:.0f}}', score) || ' | must / w=' || CASE WHEN w = 5 THEN '5.0' ELSE '1.0' END || ' | a/b |' FROM e
        UNION ALL SELECT user_id, 2, event_id, '### ' || left({ICON_SQL}, 1) || ' ' || rid || ': ' || req || CASE WHEN event_type = 'error' THEN chr(10) || '**Riziko/neistota:** check' ELSE '' END
          || CASE WHEN event_type = 'view' THEN '' ELSE chr(10) || '**Pouzite odkazy:**' || chr(10) || '- one' || chr(10) || '- two ' || user_id || chr(10) || '- three' || chr(10) || '- four' END FROM e""",
)
def sink_report_md(spark, sf):
    t = F.col("event_type")
    evals = table(spark, sf, "events").select(
        "user_id", "event_id", t.alias("job_title"), F.concat(F.lit("R"), "event_id").alias("requirement_id"),
        F.concat(F.lit("need "), t, F.lit("|"), "user_id").alias("requirement"), F.try_element_at(literal_map(STATUS), t).alias("status"),
        F.floor("value").cast("double").alias("score"), F.when(t == "click", 5.0).otherwise(1.0).alias("weight"), F.lit("must").alias("priority"),
        F.lit("a|b").alias("explanation"), F.when(t == "error", "check").alias("risk_note"),
        F.when(t != "view", F.array(F.lit("one"), F.concat(F.lit("two   "), "user_id"), F.lit(" three"), F.lit("four"))).alias("evidence_used"),
    )
    return RP.report_blocks(evals, "user_id", "event_id")


# --- streams ---------------------------------------------------------------------------------------

METRICS = ["value", "k"]
SAMPLE_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS cycle, event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""


def sample_table(spark, sf):
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("cycle"), "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def landed_events(spark, sf, files=4):
    """The events as several landed files, in no particular order."""
    folder = scratch_folder(spark, "landed")
    events = table(spark, sf, "events")
    events.repartition(files, "event_id").write.parquet(folder)
    return folder, events.schema


@query("scan_stream_samples", "SELECT event_id, user_id, value FROM events")
def scan_stream_samples(spark, sf):
    folder, schema = landed_events(spark, sf)
    stream = ST.read_samples(spark, folder, schema, files_per_batch=2).select("event_id", "user_id", "value")
    out = scratch_folder(spark, "scanned")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_folder(spark, "ckpt"))
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query(
    "stream_sample_transform",
    f"""SELECT cycle, event_id, user_id, coalesce(CAST(value AS VARCHAR), 'NO_DATA') AS value, CAST(k AS VARCHAR) AS k, CASE WHEN k > 0 THEN round(value / k * 100, 6) END AS free_percent FROM ({SAMPLE_SQL})""",
)
def stream_sample_transform(spark, sf):
    return ST.sample_rows(sample_table(spark, sf), ["cycle", "event_id", "user_id"], METRICS, "k", "value", "free_percent", 6)


@query(
    "stream_dead_row",
    f"""WITH s AS (SELECT cycle, user_id, max(k) AS k FROM ({SAMPLE_SQL}) GROUP BY 1, 2), g AS (SELECT cycle, user_id FROM (SELECT DISTINCT cycle FROM s), (SELECT DISTINCT user_id FROM events))
        SELECT cycle, user_id, coalesce(CAST(k AS VARCHAR), 'NO_DATA') AS k, CASE WHEN k IS NULL THEN 'unreachable' END AS error FROM g LEFT JOIN s USING (cycle, user_id)""",
)
def stream_dead_row(spark, sf):
    polled = sample_table(spark, sf).groupBy("cycle", "user_id").agg(F.max("k").alias("k"))
    return ST.with_dead_rows(polled, table(spark, sf, "events").select("user_id"), "user_id", "cycle", ["k"])


@query(
    "stream_dead_timer",
    """WITH seen AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), ends AS (SELECT max(ts) AS newest FROM events),
        days AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, (SELECT newest FROM ends) - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day FROM seen GROUP BY 1)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS cycle, 'NO_DATA' AS value, 'unreachable' AS error FROM days ANTI JOIN seen USING (user_id, day)""",
)
def stream_dead_timer(spark, sf):
    """Users as hosts, days as cycles: the events land in three parts by time, each read by a restarted stream with the same state."""
    events, own = table(spark, sf, "events"), SL.timed_session(spark)
    folder, out, checkpoint = (scratch_folder(spark, name) for name in ("polled", "silent", "ckpt"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    for k in range(3):
        lower, upper = (first + (last - first) * i / 3 for i in (k, k + 1))
        part = events.filter((F.col("ts") >= lower) & ((F.col("ts") < upper) if k < 2 else F.lit(True)))
        part.select("user_id", "ts", "value").write.mode("append").parquet(folder)
        silent = SL.dead_rows(ST.read_samples(own, folder, spark.read.parquet(folder).schema), "user_id", "ts", 86_400, ["value"])
        ST.start_flush(silent, ST.append_flush(out), checkpoint, every=None).awaitTermination()
    return spark.read.parquet(out).select("user_id", F.date_format("cycle", "yyyy-MM-dd").alias("cycle"), "value", "error")


@query("stream_append_flush", "SELECT event_id, coalesce(CAST(CASE WHEN event_type = 'error' THEN NULL ELSE value END AS VARCHAR), 'NO_DATA') AS value FROM events")
def stream_append_flush(spark, sf):
    folder, schema = landed_events(spark, sf)
    stream = ST.read_samples(spark, folder, schema, files_per_batch=1).withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    rows = ST.sample_rows(stream.withColumn("k", F.lit(1)), ["event_id"], ["value"], "k", "value", "free_percent").select("event_id", "value")
    out, checkpoint = scratch_folder(spark, "flushed"), scratch_folder(spark, "ckpt")
    for _ in range(2):  # the restart finds nothing new
        ST.start_flush(rows, ST.append_flush(out), checkpoint, every=None).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query("stream_latest_upsert", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def stream_latest_upsert(spark, sf):
    folder, schema = landed_events(spark, sf)
    stream = ST.read_samples(spark, folder, schema, files_per_batch=2)
    offline, online = scratch_folder(spark, "offline"), scratch_folder(spark, "online")
    write = ST.upsert_flush(offline, online, "user_id", "ts", "event_id")
    ST.start_flush(stream, write, scratch_folder(spark, "ckpt"), every=None).awaitTermination()
    return ST.online_view(spark, online, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")
