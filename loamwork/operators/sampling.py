"""Splits, samples and synthetic rows. Draws are hashes of keys: the same on any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.functions.values import hash_unit
from loamwork.operators.joins import dictionary_join
from loamwork.operators.ordered import global_row_number
from loamwork.session import cut_lineage, hold


def random_split(df: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """Add ``split`` ('train' for about ``share`` of the rows, else 'test'); no shuffle."""
    return df.withColumn("split", F.when(hash_unit(F.col(key), seed=seed) < share, "train").otherwise("test"))


def stratified_split(
    df: DataFrame, keys: Sequence[str], label: str, names: Sequence[str], cuts: Sequence[float], seed: int = 0, per_bucket: int = 100_000
) -> DataFrame:
    """Add ``split`` with exact shares per label: the first ceil(cut * n) rows by hash, and so on.

    ``cuts`` are cumulative. Bucket counts locate each cut, only the rows of the buckets that hold
    a cut are ordered, and the cut points then go to every row. The number of rows sets the number of
    buckets, so that a bucket has about ``per_bucket`` rows at most and no label is gathered in one task: the buckets with
    cuts and the cut points, a row per cut and one per label, are sent to the rows.
    """
    columns, buckets = df.columns, df.count() // per_bucket + 1
    df = hold(df, _u=hash_unit(*[F.col(k) for k in keys], seed=seed))
    draw = F.col("_u")
    place = F.struct(draw.alias("u"), *keys)
    bucket = F.floor(draw * buckets)
    counts = df.groupBy(label, bucket.alias("_b")).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy(label))
    located = counts.select(label, "_b", "n", F.sum("n").over(ordered).alias("upto"), total.alias("total"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.ceil(F.col("total") * F.lit(c)).alias("c")) for i, c in enumerate(cuts)])
    holding = (
        located.withColumn("w", F.explode(wanted))
        .filter((F.col("upto") - F.col("n") < F.col("w.c")) & (F.col("w.c") <= F.col("upto")))
        .select(label, "_b", F.col("w.i").alias("i"), (F.col("w.c") - F.col("upto") + F.col("n")).alias("k"))
    )
    near = df.select(label, *keys, bucket.alias("_b"), draw.alias("u"))
    near = dictionary_join(near, holding, [label, "_b"], "inner")
    rank = F.row_number().over(Window.partitionBy(label, "_b", "i").orderBy("u", *keys))
    points = near.withColumn("r", rank).filter(F.col("r") == F.col("k"))
    per_label = points.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("i", F.struct("u", *keys).alias("p")))).alias("_points"))
    passed = F.size(F.filter(F.coalesce("_points", F.array().cast(per_label.schema["_points"].dataType)), lambda e: e["p"] < place))
    split = F.element_at(F.array(*[F.lit(n) for n in names]), passed + 1)
    return dictionary_join(df, per_label, label).select(*columns, split.alias("split"))


def capped_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most n rows, drawn without replacement: the n smallest hashes."""
    return df.orderBy(hash_unit(F.col(key), seed=seed), key).limit(n)


def draw_columns(
    source: DataFrame, key: str, rows: DataFrame, row_key: Sequence[str], categorical: Sequence[str], numeric: Sequence[str], seed: int = 0
) -> DataFrame:
    """Add independently drawn columns to ``rows``, each with the distribution of its source column.

    Every column draws a row number and fetches its value by an equality join; the numbers are uniform, so no
    key is hot. The source is numbered once for all columns without NULLs, and once more for each other one. The joins
    are merges at any size: the source is as large as the input, and a broadcast for each column would meet in the driver.
    """
    names = [*categorical, *numeric]
    keys = [F.col(k) for k in row_key]
    counts = source.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in names]).first()
    whole = cut_lineage(global_row_number(source.select(key, *names), key, "_n"))
    out = rows
    for c in names:
        if counts[c] == 0:
            out = out.withColumn(c, F.lit(None if c in categorical else 0).cast(source.schema[c].dataType))
            continue
        full = counts[c] == counts["_all"]
        numbered = whole if full else cut_lineage(global_row_number(source.filter(F.col(c).isNotNull()).select(key, c), key, "_n"))
        drawn = out.withColumn("_n", F.floor(hash_unit(*keys, F.lit(c), seed=seed) * counts[c]) + 1)
        out = drawn.join(numbered.select("_n", c).hint("merge"), "_n").drop("_n")
    return out


def synthesize_marginals(
    df: DataFrame, key: str, categorical: Sequence[str], numeric: Sequence[str], factor: int = 10, seed: int = 0
) -> DataFrame:
    """``factor`` new rows per input row; every column is drawn from its own distribution."""
    rows = df.select(key).select(key, F.explode(F.sequence(F.lit(1), F.lit(factor))).alias("copy"))
    return draw_columns(df, key, rows, [key, "copy"], categorical, numeric, seed)


def complete_rows(
    source: DataFrame, source_key: str, partial: DataFrame, key: str, categorical: Sequence[str], numeric: Sequence[str], seed: int = 0
) -> DataFrame:
    """Fill NULL columns of partial rows with values drawn from the source columns."""
    names = [*categorical, *numeric]
    given = partial.withColumnsRenamed({c: f"_given_{c}" for c in names})
    drawn = draw_columns(source, source_key, given, [key], categorical, numeric, seed)
    return drawn.withColumns({c: F.coalesce(f"_given_{c}", c) for c in names}).drop(*[f"_given_{c}" for c in names])
