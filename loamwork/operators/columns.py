"""Filters, projections and column edits. Each is a stateless rewrite of the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.values import literal_map


def filter_in_and_eq(df: DataFrame, members: Mapping[str, Sequence], equals: Mapping[str, object]) -> DataFrame:
    """Rows whose columns lie in the given lists and equal the given values."""
    for name, values in members.items():
        df = df.filter(F.col(name).isin(list(values)))
    for name, value in equals.items():
        df = df.filter(F.col(name) == value)
    return df


def select_reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Listed columns first (those that exist), all others behind in their order."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def distinct_value_counts(df: DataFrame) -> DataFrame:
    """(column, more_than_one): whether a column has two or more values, NULL being a value.

    min / max / null flags stay small per task, unlike a distinct count per column.
    """
    per_column = []
    for name in df.columns:
        c = F.col(name)
        varied = F.coalesce(F.min(c) != F.max(c), F.lit(False)) | (F.coalesce(F.bool_or(c.isNull()), F.lit(False)) & (F.count(c) > 0))
        per_column.append(varied.alias(name))
    return df.agg(*per_column).unpivot([], df.columns, "column", "more_than_one")


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Drop columns with at most one value; one pass decides (one row reaches the driver)."""
    rows = distinct_value_counts(df).collect()
    return df.drop(*[r["column"] for r in rows if not r["more_than_one"]])


def string_search(
    df: DataFrame, text: Column, pattern: str, equals: tuple[Column, str] | None = None,
    id_text: Column | None = None, id_part: str = "", all_word: str = "All",
) -> DataFrame:
    """Optional case-insensitive pattern, equality with an "all" word, and part of an id."""
    if pattern:
        df = df.filter(text.rlike("(?i)" + pattern))
    if equals is not None and equals[1] != all_word:
        df = df.filter(equals[0] == equals[1])
    if id_text is not None and id_part:
        df = df.filter(id_text.cast("string").contains(id_part))
    return df


def point_lookup(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """One row: the key that meets the condition, or -1."""
    return df.filter(condition).agg(F.coalesce(F.max(key), F.lit(-1)).alias(key))


def default_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns as numbers, in order; absent columns and bad values are 0."""
    have = set(df.columns)
    return df.select(
        *[
            (F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)).alias(c)
            for c in wanted
        ]
    )


def domain_filter_substring(df: DataFrame, url: Column, domains: Sequence[str]) -> DataFrame:
    keep = F.lit(False)
    for domain in domains:
        keep = keep | url.contains(domain)
    return df.filter(keep)


def domain_filter_suffix(df: DataFrame, url: Column, domains: Sequence[str]) -> DataFrame:
    """Host equals a domain or lies below it; a mere text suffix is not enough."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    keep = host.isin(list(domains))
    for domain in domains:
        keep = keep | host.endswith("." + domain)
    return df.filter(keep)


def row_delete(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """New snapshot without the listed keys."""
    return df.join(keys.select(on), on, "left_anti")


def infer_feature_types(df: DataFrame) -> DataFrame:
    """(feature, feature_type) from the schema; no data is read."""
    kinds = {
        "tinyint": "Integral", "smallint": "Integral", "int": "Integral", "bigint": "Integral",
        "float": "Fractional", "double": "Fractional",
    }
    types = literal_map({name: kinds.get(dtype, "String") for name, dtype in df.dtypes})
    return df.sparkSession.range(1).select(F.explode(types).alias("feature", "feature_type"))
