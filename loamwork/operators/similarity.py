"""Exact top-k by inner product."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.session import cut_lineage, scratch_folder

FOUND = "query_id bigint, chunk_id bigint, similarity double"


def _best(ids: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best similarities, smaller ids first among equals."""
    if len(sims) > 4 * k:
        limit = np.partition(sims, len(sims) - k)[len(sims) - k]
        near = np.flatnonzero(sims >= limit)
    else:
        near = np.arange(len(sims))
    return near[np.lexsort((ids[near], -sims[near]))][:k]


def _scan(chunks: DataFrame, query_ids: np.ndarray, matrix: np.ndarray, k: int, floor: float) -> DataFrame:
    """Best k per query within every task: one product per Arrow batch, few rows out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(0).to_numpy()
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(ids), -1)
            products = vectors @ matrix.T
            for q in range(matrix.shape[0]):
                over = np.flatnonzero(products[:, q] >= floor)
                if len(over) == 0:
                    continue
                old_ids, old_sims = held.get(q, (ids[:0], products[:0, q]))
                all_ids = np.concatenate([old_ids, ids[over]])
                all_sims = np.concatenate([old_sims, products[over, q]])
                chosen = _best(all_ids, all_sims, k)
                held[q] = (all_ids[chosen], all_sims[chosen])
        for q, (found, sims) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), query_ids[q], dtype="int64")), pa.array(found.astype("int64")), pa.array(sims)],
                names=["query_id", "chunk_id", "similarity"],
            )

    return chunks.mapInArrow(run, FOUND)


def topk_similarity(
    chunks: DataFrame, chunk_id: str, vector: str, queries: DataFrame, query_id: str, query_vector: str,
    k: int = 5, floor: float = 0.20, block: int = 1024,
) -> DataFrame:
    """(query_id, chunk_id, similarity, place): the k most similar chunks of each query.

    Queries go to the tasks in hashed blocks of about ``block`` vectors. A block's best rows are written before
    the next block is sent, so neither the driver's memory nor the plan grows with the number of queries. Every
    task keeps k rows per query; the merge sees only those.
    """
    asked = cut_lineage(queries.select(F.col(query_id).cast("bigint").alias("q"), F.col(query_vector).alias("v")))
    blocks = -(-asked.count() // block)
    searched = chunks.select(F.col(chunk_id).cast("bigint"), F.col(vector))
    folder, found = scratch_folder(chunks.sparkSession, "nearest"), False
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).collect()
        if rows:
            ids = np.array([r["q"] for r in rows], dtype="int64")
            part = _scan(searched, ids, np.array([r["v"] for r in rows], dtype="float64"), k, floor)
            part.write.mode("append").parquet(folder)
            found = True
    if not found:
        return searched.sparkSession.createDataFrame([], FOUND + ", place int")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "chunk_id"))
    merged = searched.sparkSession.read.schema(FOUND).parquet(folder)
    return merged.withColumn("place", place).filter(F.col("place") <= k)


def similarity_text(found: DataFrame, chunks: DataFrame, chunk_id: str, text: str) -> DataFrame:
    """Found chunks with their text behind ``[similarity=0.123]``."""
    texts = chunks.select(F.col(chunk_id).alias("chunk_id"), F.col(text).alias("_text"))
    line = F.concat(F.lit("[similarity="), F.format_string("%.3f", F.col("similarity")), F.lit("] "), F.col("_text"))
    return found.join(texts, "chunk_id").withColumn("text", line).drop("_text")


def mean_vectors(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, averaged place by place."""
    places = df.select(group, F.posexplode(vector).alias("i", "x"))
    means = places.groupBy(group, "i").agg(F.avg("x").alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    return means.groupBy(group).agg(F.transform(ordered, lambda e: e["x"]).alias(vector))
