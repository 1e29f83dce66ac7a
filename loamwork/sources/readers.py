"""Readers. Schemas are explicit; inference is an option the caller asks for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from loamwork.functions.text import lookup_key_text


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",") -> DataFrame:
    """Header CSV. Without a schema the types are inferred, at the price of a second pass."""
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_csv_renamed(spark: SparkSession, path: str, names: Sequence[str], schema: StructType | str) -> DataFrame:
    """CSV whose columns are renamed by position."""
    return read_csv(spark, path, schema).toDF(*names)


def read_indicator_wide(spark: SparkSession, path: str, dims: Sequence[str], periods: Sequence[str]) -> DataFrame:
    """Tab-separated indicator table: dimension columns as text, one double per period."""
    fields = [f"`{d}` string" for d in dims] + [f"`{p}` double" for p in periods]
    return read_csv(spark, path, ", ".join(fields), sep="\t")


def read_indicator_file(spark: SparkSession, path: str) -> DataFrame:
    """Indicator table in its published form: dimensions, then for every period a value and a flag (``<period>_flag``).

    Nothing of the layout is known beforehand. The first column joins all dimensions by commas, in its header as in its
    cells; the others are periods of any kind. A cell is a number or ``:`` for none, with or without a flag behind it
    (``12.3 bp``, ``: c``); names and cells may have blanks around them. A cell that is neither keeps its text as the flag,
    so that nothing is lost unseen. Blank cells have no value and no flag. Only the header is read before the job.
    """
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    joined, *periods = raw.columns
    parts = F.split(F.col(quote_identifier(joined)), ",")
    dims = [F.trim(F.get(parts, F.lit(i))).alias(name.strip()) for i, name in enumerate(joined.split(","))]
    cells = [c for p in periods for c in indicator_cell(F.col(quote_identifier(p)), p.strip())]
    return raw.select(*dims, *cells)


def indicator_cell(cell: Column, name: str) -> list[Column]:
    """Value and flag of a cell."""
    text = F.trim(F.regexp_replace(cell, r"\s+", " "))
    known = text.rlike(r"^(:|[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?)( ?[a-zA-Z]+)*$")
    value = F.regexp_extract(text, r"^([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)", 1).try_cast("double")
    flag = F.trim(F.regexp_replace(text, r"^(:|[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?)", ""))
    return [F.when(known, value).alias(name), F.nullif(F.when(known, flag).otherwise(text), F.lit("")).alias(f"{name}_flag")]


def indicator_long(wide: DataFrame) -> DataFrame:
    """(dimensions..., period, value, flag): a row for every cell that has one of both."""
    periods = [c for c in wide.columns if f"{c}_flag" in wide.columns]
    dims = [c for c in wide.columns if c not in periods and not (c.endswith("_flag") and c.removesuffix("_flag") in periods)]
    cells = F.array(*[F.struct(F.lit(p).alias("period"), F.col(quote_identifier(p)).alias("value"), F.col(quote_identifier(f"{p}_flag")).alias("flag")) for p in periods])
    rows = wide.select(*[F.col(quote_identifier(d)) for d in dims], F.explode(F.filter(cells, lambda c: c["value"].isNotNull() | c["flag"].isNotNull())).alias("_c"))
    return rows.select(*[F.col(quote_identifier(d)) for d in dims], "_c.*")


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """Labelled observations; other columns of the file are not parsed."""
    wanted = ["REF_AREA", "TRANSACTION", "FREQ", "TIME_PERIOD", "OBS_VALUE"]
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*wanted).withColumns(
        {"TIME_PERIOD": F.col("TIME_PERIOD").cast("int"), "OBS_VALUE": F.col("OBS_VALUE").try_cast("double")}
    )


def quote_identifier(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def read_table(spark: SparkSession, *parts: str) -> DataFrame:
    """Whole catalogue table by its quoted name."""
    return spark.table(quote_identifier(*parts))


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_column: str, low: int, high: int, parts: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Remote table read by ``parts`` range queries at once; filters and columns are pushed down."""
    return spark.read.jdbc(
        url, table, column=split_column, lowerBound=low, upperBound=high, numPartitions=parts,
        properties=dict(properties or {}),
    )


def read_sheet(spark: SparkSession, folder: str, sheet: str, schema: StructType | str | None = None) -> DataFrame:
    """Workbook sheet that was exported as ``<folder>/<sheet>.csv``."""
    return read_csv(spark, f"{folder}/{sheet}.csv", schema)


# fixed values: accepted header spellings per canonical column
HEADER_ALIASES = {
    "position_key": ["position_key", "position id", "position_id", "role_key", "job_key"],
    "job_title": ["job_title", "job title", "pozicia", "position_name", "role_name", "nazov_pozicie"],
    "seniority": ["seniority", "seniorita", "level"],
    "requirement_id": ["requirement_id", "requirement id", "req_id", "id"],
    "requirement_text": ["requirement_text", "requirement text", "text", "poziadavka", "requirement"],
    "category": ["category", "kategoria"],
    "priority": ["priority", "priorita"],
    "weight": ["weight", "vaha"],
    "active": ["active", "aktivne", "enabled", "is_active"],
    "note": ["note", "notes", "poznamka"],
}


def apply_header_aliases(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = HEADER_ALIASES,
    required: Sequence[str] = ("job_title", "requirement_text"),
) -> DataFrame:
    """Columns renamed to their canonical names; raises when a required one is missing."""
    canonical_of = {spelling: canonical for canonical, spellings in aliases.items() for spelling in spellings}
    matched = [(canonical_of.get(lookup_key_text(name)), name) for name in df.columns]
    source = dict(reversed(matched))  # the first of several columns counts
    if missing := set(required) - set(source):
        raise ValueError("missing columns: " + ", ".join(c for c in required if c in missing))
    return df.select([F.col(quote_identifier(source[c])).alias(c) for c in aliases if c in source])


@F.pandas_udf(StringType())
def decode_legacy(contents: pd.Series) -> pd.Series:
    def decode(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        try:
            return bytes(raw).decode("cp1250")
        except UnicodeDecodeError:
            return bytes(raw).decode("latin-1")

    return contents.map(decode)


def read_text_files(spark: SparkSession, folder: str, extensions: Sequence[str] = ("txt", "md")) -> DataFrame:
    """(path, text) per non-empty file; utf-8, else cp1250, else latin-1.

    One file is one row, so files are spread over tasks by size. Only files that are no valid
    utf-8 are handed to Python.
    """
    pattern = ",".join(extensions)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{pattern}}}").option("recursiveFileLookup", True).load(folder)
    utf8 = F.try_validate_utf8(F.col("content").cast("string"))
    text = F.coalesce(utf8, decode_legacy(F.when(utf8.isNull(), F.col("content"))))
    return files.select("path", text.alias("text")).filter(F.length(F.trim("text")) > 0)


def term_list(lines: DataFrame, column: str) -> DataFrame:
    """Lower-cased distinct non-blank phrases."""
    return lines.select(F.lower(F.trim(column)).alias("term")).filter("term <> ''").distinct()


def thesaurus(cells: DataFrame, cell: str, order: str, stopwords: DataFrame) -> DataFrame:
    """(term, first_seen) from multi-term cells, without stopwords and one-letter terms.

    ``first_seen`` is the smallest (row order, place in the cell); grouping replaces a window,
    so a very frequent term is combined before the shuffle.
    """
    parts = cells.select(
        F.col(order).alias("row"), F.posexplode(F.split(F.col(cell), r"[,\n;]+")).alias("place", "raw")
    )
    terms = parts.select("row", "place", F.trim("raw").alias("term")).filter(F.length("term") > 1)
    stop = stopwords.select(F.col("term").alias("stop"))
    kept = terms.join(stop, F.lower("term") == F.col("stop"), "left_anti")
    return kept.groupBy("term").agg(F.min(F.struct("row", "place")).alias("first_seen"))
