"""Long/wide reshaping of indicator tables and the derived balance report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_periods(df: DataFrame, ids: Sequence[str], periods: Sequence[str], period: str, value: str) -> DataFrame:
    """One row per id and period column; a narrow expansion, no shuffle."""
    return df.unpivot(list(ids), list(periods), period, value)


def pivot(df: DataFrame, index: Sequence[str], key: str, values: Sequence, aggregate: Column) -> DataFrame:
    """Wide table over a given value list, so that no extra pass looks for the values."""
    return df.groupBy(*index).pivot(key, list(values)).agg(aggregate)


def pivot_mean(df: DataFrame, index: Sequence[str], key: str, values: Sequence, measure: str) -> DataFrame:
    return pivot(df, index, key, values, F.avg(measure))


def pivot_sum(df: DataFrame, index: Sequence[str], key: str, values: Sequence, measure: str) -> DataFrame:
    return pivot(df, index, key, values, F.sum(measure))


def balance_columns(df: DataFrame, exports: str, imports: str, gdp: str) -> DataFrame:
    """BALANCE and OPENNESS (percent of gdp) from three measures."""
    return df.withColumns(
        {
            "BALANCE": F.col(exports) - F.col(imports),
            "OPENNESS": F.try_divide(F.col(exports) + F.col(imports), F.col(gdp)) * 100,
        }
    )


def trade_balance(
    df: DataFrame, area: str, period: str, transaction: str, measure: str, codes: dict[str, str],
    areas: Sequence | None = None,
) -> DataFrame:
    """Filter, wide means per area and period, renamed measures, balance and openness.

    ``codes`` maps transaction codes to GDP, EXPORT and IMPORT.
    """
    rows = df.filter(F.col(transaction).isin(list(codes)))
    if areas is not None:
        rows = rows.filter(F.col(area).isin(list(areas)))
    rows = rows.select(area, F.col(period).cast("int").alias(period), transaction, measure)
    wide = pivot_mean(rows, [area, period], transaction, list(codes), measure).withColumnsRenamed(codes)
    return balance_columns(wide, "EXPORT", "IMPORT", "GDP")


def round_columns(df: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})
