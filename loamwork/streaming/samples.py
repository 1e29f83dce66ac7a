"""Structured Streaming jobs over landed device samples.

Every micro-batch is written to a folder that carries its batch number, so a batch that is run
again after a failure replaces its own rows: restarts neither lose nor repeat rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loamwork.functions.values import ratio_guarded
from loamwork.operators.joins import every_pair
from loamwork.operators.ordered import latest_by_time

NO_DATA = "NO_DATA"


def read_samples(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of samples from landed parquet files."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def sample_rows(df: DataFrame, first: Sequence[str], metrics: Sequence[str], total: str, available: str, free: str, digits: int = 2) -> DataFrame:
    """Stateless sample layout: free share, ``NO_DATA`` for missing metrics, fixed column order.

    The same function serves streams and tables.
    """
    share = ratio_guarded(F.col(available).try_cast("double"), F.col(total).try_cast("double"), digits)
    filled = df.withColumn(free, share).withColumns({m: F.coalesce(F.col(m).cast("string"), F.lit(NO_DATA)) for m in metrics})
    return filled.select(*first, *metrics, free)


def with_dead_rows(samples: DataFrame, hosts: DataFrame, host: str, cycle: str, metrics: Sequence[str], error: str = "unreachable") -> DataFrame:
    """One row per polling cycle and expected host; hosts without a sample carry the error text.

    """
    grid = every_pair(hosts.select(host).distinct(), samples.select(cycle).distinct())
    seen = samples.withColumn("_seen", F.lit(True))
    joined = grid.join(seen, [cycle, host], "left")
    return joined.select(
        cycle, host, *[F.coalesce(F.col(m).cast("string"), F.lit(NO_DATA)).alias(m) for m in metrics],
        F.when(F.col("_seen").isNull(), F.lit(error)).alias("error"),
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def start_flush(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Run ``write`` per micro-batch on a fixed cadence; ``every=None`` takes what is there and stops.

    A write that fails ends the query; its rows come again from the checkpoint on restart.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def append_flush(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def upsert_flush(offline: str, online: str, key: str, time: str, tie: str) -> Callable[[DataFrame, int], None]:
    """History of all records, and a log of the newest record per key of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(batch_folder(offline, batch_id))
            latest_by_time(batch, key, time, tie).write.mode("overwrite").parquet(batch_folder(online, batch_id))
        finally:
            batch.unpersist()

    return write


def online_view(spark: SparkSession, online: str, key: str, time: str, tie: str) -> DataFrame:
    """Newest record per key over the log of batch winners."""
    return latest_by_time(spark.read.parquet(online).drop("batch_id"), key, time, tie)


def compact_online(spark: SparkSession, online: str, target: str, key: str, time: str, tie: str) -> None:
    """Write the current view as batch -1 of a new log folder."""
    online_view(spark, online, key, time, tie).write.mode("overwrite").parquet(batch_folder(target, -1))
