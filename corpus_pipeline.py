"""Corpus pipeline over ``documents``: language, shared lines, near duplicates, benchmark passages, packing.

Each stage reads what the one before kept, written as Parquet, and its decisions take effect: it returns the kept
documents with the columns of ``documents``, the last one the packed pieces. NULL ids, NULL texts, repeated rows and
empty tables pass through as the operators define it (NULL texts have no language and go in the first stage). Other
columns are carried along untouched, also extra ones, but for ``n_chars`` where lines go.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm import benchmark, language, lines, minhash, packing
from loamwork.llm.common import written
from loamwork.session import table


def _back(docs: DataFrame, found: DataFrame, **changed: Column) -> DataFrame:
    """The columns of the documents, taken from what an operator carried along but for the changed ones."""
    return found.select([changed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``und`` and ambiguous texts go."""
    found = language.identify(docs, carry=_others(docs))
    return _back(docs, found.filter((F.col("lang_pred") != "und") & ~F.col("ambiguous")), text=F.col("text"))


def keep_own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more share; documents that hold nothing else go."""
    found = lines.drop_shared_lines(docs, carry=_others(docs))
    rest = found.filter((F.col("n_dropped") == 0) | (F.length(F.btrim("kept", F.lit(lines.BLANKS))) > 0))
    size = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("carried.n_chars"))
    return _back(docs, rest, text=F.col("kept"), n_chars=size)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    found = minhash.near_duplicates(docs)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item's window."""
    found = benchmark.contamination(docs, table(spark, sf_dir, "benchmark"), carry=_others(docs))
    return _back(docs, found.filter(F.col("n_hit") == 0), text=F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 2048 tokens."""
    return packing.pack_best_fit(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", keep_own_lines),
    ("minhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", keep_clean_of_benchmark),
    ("best_fit_packing", pack),
]

#: The language stage fits a model, which SQL cannot say; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
