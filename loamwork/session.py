"""Session helpers: table loading, shared scratch folders and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loamwork")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer copies an expensive expression into every place that uses its column. The
    output of a generator is not copied, so a one-row expansion keeps the value.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.explode(F.array(made)).alias("_held")).select(*df.columns, *[f"_held.{n}" for n in columns])


def unnest(df: DataFrame, keep: Sequence[str], items: Column, pos: str, item: str) -> DataFrame:
    """A row per array entry with its place.

    For an inner generator Spark puts a filter on the length of the array below it, and so computes the array twice;
    an outer one has none, and the rows of empty arrays go behind it.
    """
    return df.select(*keep, F.posexplode_outer(items).alias(pos, item)).filter(F.col(pos).isNotNull())


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    A local temporary folder is only used where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="loamwork-")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """New, not yet existing folder below the shared root."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that later passes read files instead of recomputing."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()
