"""Order-dependent operators that never pull a whole table, or one hot group, into one task.

Spark's unpartitioned window runs in one task. Here the order key is cut into ranges of about
equal size, each range is scanned on its own, and the totals of the ranges before it are added.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork.session import cut_lineage


def with_ranges(df: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Add ``_range``: the range number of a numeric ``key``, rising with the key.

    Cut points come from a quantile sketch. They only steer the balance: any cut points give
    the same results.
    """
    n = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = df.withColumn("_key", F.col(key).cast("double"))
    shares = [i / n for i in range(1, n)]
    cuts = sorted(set(keyed.select("_key").approxQuantile("_key", shares, max(1.0 / (4 * n), 1e-6))))
    if not cuts:
        return keyed.drop("_key").withColumn("_range", F.lit(0.0))
    splits = [-float("inf"), *cuts, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_key", outputCol="_range", handleInvalid="keep")
    return cutter.transform(keyed).drop("_key").withColumn("_range", F.coalesce("_range", F.lit(-1.0)))


def running_totals(df: DataFrame, key: str, totals: Mapping[str, Column], ranges: int | None = None) -> DataFrame:
    """Add running sums by ascending ``key``, which must be unique and numeric.

    Only one row per range meets in the small window over the range totals.
    """
    ranged = with_ranges(df, key, ranges)
    for name, value in totals.items():
        ranged = ranged.withColumn(f"_v_{name}", value)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in totals]).select(
        "_range", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals]
    )
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(offsets, "_range")
        .select(
            *df.columns,
            *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}")).alias(n) for n in totals],
        )
    )


def global_row_number(df: DataFrame, key: str, name: str, ranges: int | None = None) -> DataFrame:
    """Number rows 1..n by a unique numeric key, range by range."""
    return running_totals(df, key, {name: F.lit(1).cast("bigint")}, ranges)


def running_best(df: DataFrame, key: str, value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Largest value so far by ascending unique key."""
    ranged = with_ranges(df, key, ranges)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = ranged.groupBy("_range").agg(F.max(value).alias("_top")).select(
        "_range", F.max("_top").over(before).alias("_best_before")
    )
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(tops, "_range").select(
        *df.columns, F.greatest(F.max(value).over(inside), F.col("_best_before")).alias(name)
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row (median): exact, from one row per distinct value and its running count."""
    counts = cut_lineage(
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    )
    ranked = running_totals(counts, "v", {"upto": F.col("n")})
    total = F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(0))
    low, high = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    first = F.col("upto") - F.col("n")
    hit = ((first < low) & (low <= F.col("upto"))) | ((first < high) & (high <= F.col("upto")))
    return ranked.filter(hit).agg(((F.min("v") + F.max("v")) / 2).alias("median"))


def latest_by_time(df: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    """Newest record per key; an aggregate, so a hot key is combined before the shuffle."""
    newest = F.max_by(F.struct(*df.columns), F.struct(time, tie))
    return df.groupBy(F.col(key).alias("_key")).agg(newest.alias("_row")).select("_row.*")


def seconds_from_start(df: DataFrame, label: str, time: str, name: str) -> DataFrame:
    """Seconds since the first row of the same label."""
    starts = df.groupBy(label).agg(F.min(time).alias("_start"))
    seconds = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col(time)) / 1e6
    return df.join(starts, label, "left").withColumn(name, seconds).drop("_start")


def sorted_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Rows range-partitioned and sorted by any key type, with the fixed range number ``_range``.

    The checkpoint freezes which row lies in which range, so a lost executor cannot move rows
    between ranges. Meant for keys without long runs of equal values (distinct values, ids).
    """
    return cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn(
        "_range", F.spark_partition_id()
    )


def number_distinct(df: DataFrame, column: str, name: str, start: int = 0) -> DataFrame:
    """Distinct non-NULL values of a column, numbered in sorted order from ``start``."""
    values = sorted_ranges(df.select(column).filter(F.col(column).isNotNull()).distinct(), column)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = values.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) + F.col("_o") - 1 + start
    return values.join(offsets, "_range").select(column, place.cast("bigint").alias(name))
