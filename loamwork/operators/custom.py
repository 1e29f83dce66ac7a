"""Functions of the caller's own, run on Arrow batches. Prefer a native expression where there is one."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_function(df: DataFrame, name: str, columns: list[str], fn: Callable, kind: str) -> DataFrame:
    """Add ``fn`` of the listed columns, row by row; no shuffle. NULLs reach the function as None."""

    def run(*series: pd.Series) -> pd.Series:
        plain = [s.astype(object).where(s.notna(), None) for s in series]
        return pd.Series([fn(*values) for values in zip(*plain, strict=True)], dtype=object)

    run.__annotations__ = {"series": pd.Series, "return": pd.Series}
    return df.withColumn(name, F.pandas_udf(run, kind)(*columns))


def group_function(df: DataFrame, keys: list[str], name: str, column: str, fn: Callable[[pd.Series], object], kind: str) -> DataFrame:
    """``fn`` of a column's values per group. A group has to fit in one task; native aggregates do not need that."""

    def run(values: pd.Series) -> object:
        return fn(values)

    run.__annotations__ = {"values": pd.Series, "return": object}
    return df.groupBy(*keys).agg(F.pandas_udf(run, kind)(column).alias(name))


def table_function(df: DataFrame, fn: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Any number of rows per row, as dictionaries with the fields of ``schema``; no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [made for row in batch.to_dict("records") for made in fn(row)]
            if rows:
                yield pd.DataFrame(rows)

    return df.mapInPandas(run, schema)
