"""Joins. Spark and AQE choose how to join by sizes at run time and split skewed partitions; only fitted
dictionaries are measured and broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.text import lookup_key
from loamwork.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024


def dictionary_join(df: DataFrame, dictionary: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a fitted dictionary, which is written once and measured.

    Up to ``BROADCAST_BYTES`` of text it is broadcast, which spares the large side a shuffle; beyond that it is
    an ordinary shuffle join. Measuring stops at the rows that cannot fit any more.
    """
    side = cut_lineage(dictionary)
    rows = side.limit(BROADCAST_BYTES // 16 + 1)
    size = rows.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct("*"))) + 16), F.lit(0)).alias("b")).first()["b"]
    return df.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, on, how)


#: Pairs that one cell of a product makes, about.
CELL_PAIRS = 1 << 20


def product_cells(left: int, right: int) -> int:
    """Cells of a product of two tables: as many as its pairs ask for, no more than the left side has rows."""
    return max(1, min(left, -(-left * right // CELL_PAIRS)))


def every_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """All combinations of two tables whose product is the result.

    Both are written and counted; the left one is dealt into cells by the size of the product, the right one goes to every
    cell, so a task's share stays the same however large the product is.
    """
    left, right = cut_lineage(left), cut_lineage(right)
    salts = product_cells(left.count(), right.count())
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    return dealt.join(right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), "_salt").drop("_salt")


def join_all(frames: list[DataFrame], on: str | list[str]) -> DataFrame:
    """Inner join of all frames on their common columns."""
    return reduce(lambda a, b: a.join(b, on, "inner"), frames)


def owned_orders(claims: DataFrame, orders: DataFrame, order_key: str, owner_key: str) -> DataFrame:
    """Claims (order, customer) whose order does belong to that customer."""
    return claims.join(orders.select(order_key, owner_key), [order_key, owner_key], "left_semi")


def role_or_global(roles: DataFrame, role_rows: DataFrame, global_rows: DataFrame, role: str) -> DataFrame:
    """Rows of each role; roles without rows get the global rows."""
    own = roles.join(role_rows, role, "inner")
    missing = roles.join(role_rows.select(role).distinct(), role, "left_anti")
    filled = every_pair(missing, global_rows).select(role, *global_rows.columns)
    return own.select(role, *global_rows.columns).unionByName(filled)


def recode_join(df: DataFrame, codes: DataFrame, column: str, code: str, unseen: int = 0) -> DataFrame:
    """Dictionary code of each value; values without a code get ``unseen``."""
    return dictionary_join(df, codes, column).withColumn(code, F.coalesce(code, F.lit(unseen)))


def _grams(c: Column) -> Column:
    """All parts of one, two and three characters, without repeats."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)))

    def of_length(n: int) -> Column:
        return F.transform(starts, lambda i: F.substring(c, i, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(of_length(1), of_length(2), of_length(3))))


def contained_pairs(short: DataFrame, long: DataFrame) -> DataFrame:
    """(short_id, long_id) for texts that occur inside other texts.

    Columns: short(short_id, short_text), long(long_id, long_text). All three-character parts of a contained text are
    parts of the longer one; its rarest part among the long texts is joined by equality, so parts that many texts
    share pair nothing. Texts of up to three characters are their own part.
    """
    parts = long.filter("long_text <> ''").withColumn("gram", F.explode(_grams(F.col("long_text"))))
    counts = parts.groupBy("gram").agg(F.count("*").alias("_n"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("short_text") - 2, F.lit(1)))
    own = short.filter("short_text <> ''").withColumn("gram", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("short_text"), i, F.lit(3))))))
    rarest = F.min_by("gram", F.struct(F.coalesce("_n", F.lit(0)), "gram"))
    heads = own.join(counts, "gram", "left").groupBy("short_id", "short_text").agg(rarest.alias("gram"))
    return heads.join(parts, "gram").filter(F.contains("long_text", "short_text")).select("short_id", "long_id").distinct()


def fuzzy_position(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """Best catalogue group per query by tiered score; NULL group when nothing matches.

    queries(query), groups(group_name, position_key, job_title, first_row). Ties go to the group
    that comes first.
    """
    q = queries.select("query", lookup_key(F.col("query")).alias("q")).distinct()
    g = groups.select(
        "group_name", "first_row", lookup_key(F.col("position_key")).alias("k"),
        lookup_key(F.col("job_title")).alias("t"), lookup_key(F.col("group_name")).alias("n"),
    )
    q_texts = q.select("q").distinct()
    fields = g.select("group_name", F.explode(F.array("k", "t", "n")).alias("field"))
    field_texts = fields.select("field").distinct()
    inside = contained_pairs(
        q_texts.select(F.col("q").alias("short_id"), F.col("q").alias("short_text")),
        field_texts.select(F.col("field").alias("long_id"), F.col("field").alias("long_text")),
    ).select(F.col("short_id").alias("q"), F.col("long_id").alias("field"))
    around = contained_pairs(
        field_texts.select(F.col("field").alias("short_id"), F.col("field").alias("short_text")),
        q_texts.select(F.col("q").alias("long_id"), F.col("q").alias("long_text")),
    ).select(F.col("long_id").alias("q"), F.col("short_id").alias("field"))
    pairs = inside.union(around).join(fields, "field").select("q", "group_name").distinct().join(g, "group_name")
    has = lambda a, b: (a != "") & (b != "") & F.contains(a, b)
    c = F.col
    # fixed values: score tiers
    score = (
        F.when(c("q") == c("k"), 100).when(c("q") == c("t"), 98).when(c("q") == c("n"), 96)
        .when(has(c("k"), c("q")), 90).when(has(c("t"), c("q")), 88).when(has(c("n"), c("q")), 86)
        .when(has(c("q"), c("k")), 80).when(has(c("q"), c("t")), 78).otherwise(0)
    )
    best = (
        pairs.withColumn("score", score).filter("score > 0").groupBy("q")
        .agg(F.max_by(F.struct("group_name", "score"), F.struct(c("score"), -c("first_row"))).alias("best"))
    )
    return q.join(best, "q", "left").select(
        "query", c("best.group_name").alias("matched_group"), F.coalesce(c("best.score"), F.lit(0)).alias("match_score")
    )


def align_sections(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Parallel result lists side by side by their explicit (document, section) key."""
    return join_all(frames, keys)
