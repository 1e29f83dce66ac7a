"""Shared parts of the corpus operators: Arrow maps, byte tables, ranks and connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamwork.session import cut_lineage, scratch_folder

#: Stretches from this length on are hashed by a digest: modulo 2^64, words can be built whose polynomials agree for any base.
LONG = 256

#: White space of the word contracts: tab to carriage return, and the blank.
SPACE = b"\t\n\x0b\x0c\r "


def arrow_schema(ddl: str | T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl)


def carried(docs: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as one struct ``carried``, where their names clash with nothing; no column without any."""
    return [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("carried")] if columns else []


def with_carried(ddl: str, rows: DataFrame) -> T.StructType:
    """Schema with the type of ``carried`` if the rows have it."""
    schema = T.StructType.fromDDL(ddl)
    return schema.add("carried", rows.schema["carried"].dataType) if "carried" in rows.columns else schema


def map_batches(df: DataFrame, ddl: str | T.StructType, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]]) -> DataFrame:
    """Arrow map with state: ``make()`` runs once per task and gives the function that turns a batch into columns."""
    schema = arrow_schema(ddl)

    def run(batches):
        step = make()
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_pydict(columns, schema=schema)

    return df.mapInArrow(run, ddl)


def slices(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text (column ``text``) each, one row at least."""
    lengths = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column("text")).to_pylist()], np.int64)
    first, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > size:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < batch.num_rows:
        yield batch.slice(first)


def raw_texts(batch: pa.RecordBatch) -> list[bytes]:
    """UTF-8 bytes of column ``text``; NULL is empty."""
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit words that scatters close values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Polynomial hashes of any stretch of a byte (or word) row from one running sum, in wrapping 64-bit arithmetic."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.values = mix(np.arange(1, 257, dtype=np.uint64))
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << n.bit_length()
            for name, base in (("powers", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the stretches [start, end): equal contents give equal hashes, wherever they stand."""
        return mix((sums[end] - sums[start]) * self.inverse[start])

    def bytes(self, text: np.ndarray) -> np.ndarray:
        return self.sums(self.values[text])

    def words(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words [start, end) of a text."""
        out = self.of(self.bytes(text), starts, ends)
        for i in np.flatnonzero(ends - starts >= LONG).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(text[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        return out


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space."""
    solid = np.concatenate(([False], ~((text == 32) | ((text >= 9) & (text <= 13))), [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... inside each group, in the order given.

    Rows are cut into ranges by sampled splitters; a row tag ends the order, so that neither a hot group nor a hot
    key keeps its rows in one range. The two checkpoints freeze tags and ranges against lost executors.
    """
    tagged = cut_lineage(df.withColumn("_tag", F.monotonically_increasing_id()))
    keys = [*group, *order, "_tag"]
    ranged = cut_lineage(tagged.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    offsets = totals.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_g_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order, "_tag")
    same = F.col("_range") == F.col("_g_range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    numbered = ranged.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(offsets, same).select(*df.columns, (F.col("_inside") + F.col("_before")).cast("long").alias(name))


def components(links: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over the links (a, b). Nodes without a link have no row.

    Labels fall to the smallest label of the neighbours and then jump to the label of their label, so long chains
    need about as many rounds as the logarithm of their length. Every round is checkpointed.
    """
    pairs = links.select("a", "b").filter("a <> b")
    edges = cut_lineage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = lower.select(F.col("node").alias("root"), F.col("label").alias("jump"))
        labels = cut_lineage(lower.join(roots, lower.label == roots.root).select("node", "old", F.least("label", "jump").alias("label")))
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            new |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def in_tiles(members: DataFrame, group: list[str], member: str, block: int) -> DataFrame:
    """Add ``_ti``, ``_tj`` and the own block ``_own``, so that any two rows of a group meet in one tile.

    A group of up to ``block`` rows is one tile; a larger one has its rows in several blocks and a tile for each two
    blocks, so no task ever holds a whole hot group.
    """
    sizes = members.groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int")
    placed = members.join(sizes, group).withColumn("_own", own)
    other = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.withColumn("_ti", F.least("_own", "_other")).withColumn("_tj", F.greatest("_own", "_other")).drop("_other", "_blocks")


def join_dealt(rows: DataFrame, sized: DataFrame, keys: Sequence[str], n: str, total: int, how: str = "left", share: int = 10_000, part: int = 128) -> DataFrame:
    """Join of ``rows`` with ``sized``, which has one row per key and in ``n`` how many of the ``total`` rows with such keys have it.

    Keys with at least one of ``share`` parts of all rows are hot: there are ``share`` of them at most, so their list
    may be broadcast. The rows of a hot key are dealt into parts, and its row of ``sized`` is repeated for every part, so
    that no key meets in one task. Keys must not be NULL in ``sized``.
    """
    hot = (F.col(n) * share >= max(total, 1)) & (F.col(n) >= 2 * part)
    parts = F.when(hot, F.least(F.ceil(F.col(n) * share / F.lit(max(total, 1))), F.ceil(F.col(n) / part))).otherwise(1).cast("long")
    listed = sized.filter(hot).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], parts.alias("_parts"))
    same = reduce(and_, [F.col(k) == F.col(f"_hot_{k}") for k in keys])
    mine = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.coalesce("_parts", F.lit(1))))
    dealt = rows.join(F.broadcast(listed), same, "left").withColumn("_part", mine.cast("long")).drop("_parts", *[f"_hot_{k}" for k in keys])
    repeated = sized.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")


def total_of(sized: DataFrame, n: str = "n") -> int:
    """Sum of a column of counts."""
    return sized.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n")).first()["n"]


def sorted_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal keys side by side in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def written(df: DataFrame, label: str) -> DataFrame:
    """Table in the shared folder, read again: lineage is cut, and the shuffles behind it may go at once."""
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = scratch_folder(spark, label), spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)
