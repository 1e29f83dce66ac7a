"""Writers: CSV, tables, text files, JSON documents and dated folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.operators.ordered import global_row_number


def write_csv(df: DataFrame, path: str, index: str | None = None, order: str | None = None, bom: bool = False) -> None:
    """Header CSV in parallel part files; ``index`` adds a zero-based row number by ``order``.

    With ``bom`` the first header name carries the utf-8 byte order mark.
    """
    if index is not None:
        if order is None:
            raise ValueError("a row index needs an order column")
        numbered = global_row_number(df, order, index).withColumn(index, F.col(index) - 1)
        df = numbered.select(index, *df.columns)
    if bom:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def next_version(df: DataFrame, folder: str, run_date: str) -> int:
    """1 + the highest version below ``folder/run_date=...`` (1 when there is none)."""
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = files.load(f"{folder}/run_date={run_date}").select(F.regexp_extract("path", r"/v=([0-9]+)/[^/]*$", 1).try_cast("int").alias("v"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1
    return (found.agg(F.max("v").alias("v")).first()["v"] or 0) + 1


def write_csv_dated(df: DataFrame, folder: str, run_date: str) -> str:
    """CSV below a dated folder under the next free version; returns the path."""
    path = f"{folder}/run_date={run_date}/v={next_version(df, folder, run_date)}"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def write_texts(blocks: DataFrame, path: str, owner: str, order: list[str], text: str = "text") -> None:
    """One text file per owner below ``path/owner=...``: its blocks in order. The blocks are sorted, never gathered."""
    placed = blocks.withColumn("_owner", F.col(owner).cast("string")).repartition("_owner").sortWithinPartitions("_owner", *order)
    placed.select(F.col(text).alias("value"), F.col("_owner").alias("owner")).write.mode("overwrite").partitionBy("owner").text(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, truncate: bool = False, properties: Mapping[str, str] | None = None) -> None:
    """Remote table in batches of 1000 rows; ``truncate`` keeps the table definition on overwrite."""
    options = {"batchsize": "1000", "truncate": str(truncate).lower(), **dict(properties or {})}
    df.write.mode(mode).jdbc(url, table, properties=options)


def truncate_table(df: DataFrame, schema: str, name: str) -> None:
    """Reload a catalogue table: rows go, the definition stays; the schema is made when absent."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    target = f"`{schema}`.`{name}`"
    if spark.catalog.tableExists(f"{schema}.{name}"):
        df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    else:
        df.write.format("parquet").saveAsTable(target)


def json_document(df: DataFrame, *cols: str) -> Column:
    return F.to_json(F.struct(*[df[c] for c in (cols or df.columns)]))


def preview(df: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows under an explicit order (per-task top n, then a merge of those)."""
    return df.orderBy(*order).limit(n)
