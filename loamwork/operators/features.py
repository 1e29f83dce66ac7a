"""Feature encoding, fitted preprocessing and the feature group (history and latest view)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamwork.operators.joins import dictionary_join
from loamwork.operators.ordered import exact_median, latest_by_time, number_distinct
from loamwork.session import cut_lineage


def label_dictionary(df: DataFrame, column: str, code: str, missing: str = "<NA>", start: int = 0) -> DataFrame:
    """(column, code): sorted distinct values, a missing value being a value of its own."""
    return number_distinct(df.select(F.coalesce(F.col(column), F.lit(missing)).alias(column)), column, code, start)


def label_encode(df: DataFrame, dictionary: DataFrame, column: str, code: str, missing: str = "<NA>", unseen: int | None = None) -> DataFrame:
    """Add the code of each value; values outside the dictionary get ``unseen``."""
    known = dictionary.select(F.col(column).alias("_value"), code)
    joined = dictionary_join(df.withColumn("_value", F.coalesce(F.col(column), F.lit(missing))), known, "_value").drop("_value")
    return joined if unseen is None else joined.withColumn(code, F.coalesce(code, F.lit(unseen)))


def label_decode(df: DataFrame, dictionary: DataFrame, column: str, code: str) -> DataFrame:
    return dictionary_join(df, dictionary.select(code, column), code)


def category_values(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values for a wide encoding, which needs them as columns; ``one_hot_long`` does not."""
    rows = df.select(F.coalesce(F.col(column), F.lit("__MISSING__")).alias("v")).distinct().collect()
    return sorted(r["v"] for r in rows)


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, value, hot): the ones of the encoding as rows, for columns of any number of values; no shuffle."""
    cells = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("__MISSING__")).alias("value")) for c in columns]
    return df.select(key, F.inline(F.array(*cells))).withColumn("hot", F.lit(1))


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed value; an unlisted value gives only zeros. No shuffle."""
    value = F.coalesce(F.col(column), F.lit("__MISSING__"))
    return df.withColumns({f"{column}_{v}": (value == v).cast("int") for v in values})


@dataclass
class Preprocessor:
    """Medians, scaling and code dictionaries of a training set, kept as small tables."""

    numeric: list[str]
    categorical: list[str]
    stats: DataFrame | None = None
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> Preprocessor:
        medians = {c: exact_median(train, c).scalar() for c in self.numeric}
        filled = train.select(*[F.coalesce(F.col(c).cast("double"), medians[c]).alias(c) for c in self.numeric])
        parts = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c) for c in self.numeric]
        fitted = filled.agg(F.struct(*parts).alias("fit"))
        for c in self.numeric:
            fitted = fitted.withColumn(f"median_{c}", medians[c])
        self.stats = cut_lineage(fitted)
        self.dictionaries = {c: label_dictionary(train, c, f"{c}_code", start=1) for c in self.categorical}
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        """Imputed and scaled numbers, codes from 1 on, 0 for categories not seen in training."""
        assert self.stats is not None, "fit first"
        row = self.stats.first()  # one row of fitted numbers
        scaled = {}
        for c in self.numeric:
            sd = row["fit"][c]["sd"] or 1.0
            filled = F.coalesce(F.col(c).cast("double"), F.lit(row[f"median_{c}"]))
            scaled[c] = (filled - F.lit(row["fit"][c]["mean"])) / F.lit(sd)
        out = df.withColumns(scaled)
        for c, dictionary in self.dictionaries.items():
            out = label_encode(out, dictionary, c, f"{c}_code", unseen=0)
        return out.drop(*self.categorical)


def feature_group_write(df: DataFrame, path: str, schema: StructType, record_id: str, event_time: str) -> None:
    """Append typed records, partitioned by the day of their event time."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f.name for f in schema if have.get(f.name) != f.dataType]
    if wrong or record_id not in have or event_time not in have:
        raise ValueError(f"columns do not fit the feature group: {wrong or [record_id, event_time]}")
    dated = df.select(*schema.names).withColumn("event_day", F.to_date(event_time))
    dated.write.mode("append").partitionBy("event_day").parquet(path)


def feature_group_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("event_day")


def feature_group_latest(spark: SparkSession, path: str, record_id: str, event_time: str) -> DataFrame:
    return latest_by_time(feature_group_history(spark, path), record_id, event_time, record_id)


def feature_group_get(latest: DataFrame, ids: DataFrame, record_id: str, features: Sequence[str]) -> DataFrame:
    """Chosen features of the given ids; ``found`` is false for ids without a record."""
    known = latest.select(record_id, *features, F.lit(True).alias("found"))
    return ids.select(record_id).distinct().join(known, record_id, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def training_dataset(df: DataFrame, label: str, features: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Label column first, then the features, ids left out."""
    return df.select(label, *[f for f in features if f not in drop])
