"""Joins and set operations, bound to the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.functions import text as T
from loamwork.operators import joins as J
from loamwork.operators import ordered as O
from loamwork.operators import terms as M
from loamwork.plans.registry import query
from loamwork.session import table

METRICS = ["click", "error", "purchase", "signup", "view"]
DAILY_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 6) AS {0} FROM events WHERE event_type = '{0}' GROUP BY 1"


@query(
    "join_natural_inner_chain",
    "SELECT * FROM " + " JOIN ".join(f"({DAILY_SQL.format(m)}) t_{m}" + ("" if i == 0 else " USING (day)") for i, m in enumerate(METRICS)),
)
def join_natural_inner_chain(spark, sf):
    events = table(spark, sf, "events")
    frames = [
        events.filter(F.col("event_type") == m).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(F.avg("value"), 6).alias(m))
        for m in METRICS
    ]
    return J.join_all(frames, "day")


@query(
    "join_fk_customer_orders",
    """WITH claims AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_custkey FROM orders)
       SELECT c.o_orderkey, c.o_custkey, cu.c_name FROM claims c JOIN orders o ON c.o_orderkey = o.o_orderkey AND c.o_custkey = o.o_custkey
       JOIN customer cu ON cu.c_custkey = c.o_custkey""",
)
def join_fk_customer_orders(spark, sf):
    orders = table(spark, sf, "orders")
    claims = orders.select("o_orderkey", (F.col("o_custkey") + F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("o_custkey"))
    valid = J.owned_orders(claims, orders, "o_orderkey", "o_custkey")
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return valid.join(names, "o_custkey")


@query(
    "join_role_fallback",
    """WITH own AS (SELECT p_brand, p_type AS feature, round(avg(p_retailprice), 6) AS score FROM part GROUP BY 1, 2 HAVING max(p_size) < 50),
            everyone AS (SELECT p_type AS feature, round(avg(p_retailprice), 6) AS score FROM part GROUP BY 1),
            roles AS (SELECT DISTINCT p_brand FROM part UNION SELECT n_name FROM nation)
       SELECT p_brand, feature, score FROM own
       UNION ALL SELECT p_brand, feature, score FROM roles JOIN everyone ON p_brand NOT IN (SELECT p_brand FROM own)""",
)
def join_role_fallback(spark, sf):
    part = table(spark, sf, "part")
    own = part.groupBy("p_brand", F.col("p_type").alias("feature")).agg(
        F.round(F.avg("p_retailprice"), 6).alias("score"), F.max("p_size").alias("top")
    ).filter("top < 50").drop("top")
    everyone = part.groupBy(F.col("p_type").alias("feature")).agg(F.round(F.avg("p_retailprice"), 6).alias("score"))
    roles = part.select("p_brand").union(table(spark, sf, "nation").select("n_name")).distinct()
    return J.role_or_global(roles, own, everyone, "p_brand")


@query(
    "join_recode_broadcast",
    """WITH codes AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'ECONOMY'))
       SELECT p_partkey, coalesce(code, 0) AS code FROM part LEFT JOIN codes USING (p_type)""",
)
def join_recode_broadcast(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    codes = O.number_distinct(part.filter("p_type <> 'ECONOMY'"), "p_type", "code", start=1)
    return J.recode_join(part, codes, "p_type", "code").select("p_partkey", "code")


TERM_LIST = ["the", "and", "with", "schen", "que", "de la", "of the", "by the", "Die", "ein", "Und der", "é", "für"]
TERMS_VALUES = ", ".join(f"('{t}')" for t in TERM_LIST)
# Separators are doubled so that neighbouring matches do not share one.
TERM_COUNT_SQL = rf"""
WITH terms AS (SELECT DISTINCT lower(w) AS term FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w FROM benchmark)
               WHERE length(w) >= 6 UNION SELECT * FROM (VALUES {TERMS_VALUES}) t(term)),
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w FROM documents),
docs AS (SELECT doc_id, regexp_replace(lower(text), '([^\p{{L}}\p{{N}}_])', '\1\1', 'g') AS t FROM documents),
hits AS (SELECT doc_id, term, count(*) AS n FROM words JOIN terms ON w = lower(term) GROUP BY ALL
         UNION ALL
         SELECT doc_id, term, len(regexp_extract_all(t, '(^|[^\p{{L}}\p{{N}}_])' || replace(lower(term), ' ', '  ') || '($|[^\p{{L}}\p{{N}}_])')) AS n
         FROM docs JOIN terms ON contains(term, ' ') AND contains(t, replace(lower(term), ' ', '  ')))
"""


def term_table(spark, sf):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    long_words = table(spark, sf, "benchmark").select(words.alias("term")).filter(F.length("term") >= 6)
    given = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in TERM_LIST])).alias("term"))
    return long_words.union(given).distinct()


def matched_terms(spark, sf, keep=()):
    """(doc_id, found): the terms of every document with their counts."""
    return M.term_counts(table(spark, sf, "documents"), "doc_id", "text", term_table(spark, sf), "term", keep)


def by_count(f):
    return [-f["n"], -F.length(f["term"]), f["term"]]


@query("join_terms_in_text", TERM_COUNT_SQL + "SELECT doc_id, term FROM hits WHERE n > 0")
def join_terms_in_text(spark, sf):
    return M.match_terms(table(spark, sf, "documents"), "doc_id", "text", term_table(spark, sf), "term").select("doc_id", "term")


@query(
    "match_terms_presence",
    TERM_COUNT_SQL + """, r AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY length(term) DESC, term) AS place FROM hits WHERE n > 0)
    SELECT doc_id, string_agg(term, ', ' ORDER BY place) AS terms FROM r GROUP BY doc_id""",
)
def match_terms_presence(spark, sf):
    return M.ranked_terms(matched_terms(spark, sf), "doc_id", lambda f: [-F.length(f["term"]), f["term"]])


@query(
    "match_terms_count",
    TERM_COUNT_SQL + """, r AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(term) DESC, term) AS place FROM hits WHERE n > 0)
    SELECT doc_id, string_agg(term, ', ' ORDER BY place) AS terms FROM r GROUP BY doc_id""",
)
def match_terms_count(spark, sf):
    return M.ranked_terms(matched_terms(spark, sf), "doc_id", by_count)


@query(
    "join_fuzzy_position",
    """WITH rows_ AS (SELECT CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS k, p_name AS t, p_partkey,
                             CASE WHEN p_brand = 'Brand#1' THEN p_name ELSE p_brand END AS n FROM part),
            g AS (SELECT n, lower(arg_min(k, p_partkey)) AS k, lower(arg_min(t, p_partkey)) AS t, lower(n) AS ln, min(p_partkey) AS first_row FROM rows_ GROUP BY n),
            q AS (SELECT DISTINCT p_name AS query FROM part UNION SELECT DISTINCT 'senior ' || p_name || ' lead' FROM part UNION SELECT DISTINCT upper(p_brand) FROM part
                  UNION SELECT DISTINCT p_type FROM part UNION SELECT DISTINCT right(p_brand, 2) FROM part),
            s AS (SELECT query, n, first_row, CASE WHEN lq = k THEN 100 WHEN lq = t THEN 98 WHEN lq = ln THEN 96
                     WHEN k <> '' AND contains(k, lq) THEN 90 WHEN t <> '' AND contains(t, lq) THEN 88 WHEN contains(ln, lq) THEN 86
                     WHEN k <> '' AND contains(lq, k) THEN 80 WHEN t <> '' AND contains(lq, t) THEN 78 ELSE 0 END AS score
                  FROM (SELECT query, lower(query) AS lq FROM q), g),
            b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, first_row) AS r FROM s)
       SELECT query, CASE WHEN score > 0 THEN n END AS matched_group, CAST(score AS INTEGER) AS match_score FROM b WHERE r = 1""",
)
def join_fuzzy_position(spark, sf):
    part = table(spark, sf, "part")
    keyed = part.select(
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias("position_key"), F.col("p_name").alias("job_title"), "p_partkey"
    ).withColumn("group_name", F.when(F.col("position_key") == "", F.col("job_title")).otherwise(F.col("position_key")))
    groups = keyed.groupBy("group_name").agg(
        F.min_by("position_key", "p_partkey").alias("position_key"), F.min_by("job_title", "p_partkey").alias("job_title"), F.min("p_partkey").alias("first_row")
    )
    queries = part.select(
        F.explode(F.array("p_name", F.concat(F.lit("senior "), "p_name", F.lit(" lead")), F.upper("p_brand"), "p_type", F.right("p_brand", F.lit(2)))).alias("query")
    ).distinct()
    return J.fuzzy_position(queries, groups)


@query(
    "align_by_position",
    """WITH l AS (SELECT conv_id AS doc_id, turn AS section_idx, role AS header, text FROM conversations)
       SELECT doc_id, section_idx, header, length(text) AS n_chars, text AS summary FROM l""",
)
def align_by_position(spark, sf):
    base = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("section_idx"), F.col("role").alias("header"), "text")
    keys = ["doc_id", "section_idx"]
    sizes = base.select(*keys, F.length("text").cast("bigint").alias("n_chars"))
    summaries = base.select(*keys, F.col("text").alias("summary"))
    return J.align_sections([base.select(*keys, "header"), sizes, summaries], keys)


# --- set operations ----------------------------------------------------------------------------


@query(
    "union_all_aligned",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def union_all_aligned(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "union_sources_flatten",
    """SELECT event_type AS search_term, 'https://' || event_type || '/' || event_id AS url, 'w' || user_id AS description FROM events
       UNION ALL SELECT event_type, 'https://news/' || event_id, 'n' || user_id FROM events WHERE value > 10""",
)
def union_sources_flatten(spark, sf):
    e = table(spark, sf, "events")
    item = lambda url, text: F.array(F.struct(url.alias("url"), text.alias("description")))
    web = item(F.concat(F.lit("https://"), "event_type", F.lit("/"), "event_id"), F.concat(F.lit("w"), "user_id"))
    news = F.when(F.col("value") > 10, item(F.concat(F.lit("https://news/"), "event_id"), F.concat(F.lit("n"), "user_id")))
    raw = e.select(
        F.col("event_type").alias("search_term"),
        F.to_json(F.struct(F.struct(web.alias("results")).alias("web"), F.struct(news.alias("results")).alias("news"))).alias("body"),
    )
    from loamwork.functions.jsons import flatten_results

    return flatten_results(raw, "search_term", "body")


@query(
    "hstack_columns",
    """SELECT o_orderkey, o_totalprice, CAST(o_orderstatus = 'F' AS INTEGER) AS status_F, CAST(o_orderstatus = 'O' AS INTEGER) AS status_O,
              CAST(o_orderstatus = 'P' AS INTEGER) AS status_P FROM orders""",
)
def hstack_columns(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", *[(F.col("o_orderstatus") == s).cast("int").alias(f"status_{s}") for s in "FOP"]
    )


@query("set_membership_minus", "SELECT DISTINCT p_name AS term FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_type = 'ECONOMY' AND p_size < 5)")
def set_membership_minus(spark, sf):
    part = table(spark, sf, "part")
    stop = part.filter("p_type = 'ECONOMY' AND p_size < 5").select(F.col("p_name").alias("term"))
    return part.select(F.col("p_name").alias("term")).distinct().join(stop, "term", "left_anti")


@query(
    "token_jaccard",
    """WITH k AS (SELECT doc_id, string_split(trim(regexp_replace(lower(source || ' ' || text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
       t AS (SELECT l.doc_id, l.w AS a, r.w AS b FROM k l JOIN k r ON r.doc_id = l.doc_id + 1)
       SELECT doc_id, round(len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(list_concat(a, b))), 6) AS jaccard FROM t""",
)
def token_jaccard(spark, sf):
    keys = table(spark, sf, "documents").select("doc_id", T.normalize_key(F.concat_ws(" ", "source", "text")).alias("a"))
    pairs = keys.join(keys.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b")), "doc_id")
    return pairs.select("doc_id", F.round(T.token_jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))
