"""Near-duplicate vectors: p-stable hashing of unit vectors into several tables, then exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import arrow_schema, components, in_tiles, key_runs, map_batches, mix, sorted_by
from loamwork.session import cut_lineage

#: Tables, projections of each, and the width of a projection's cells. Unit vectors of cosine 0.93 are 0.374 apart: they
#: share a cell with probability 0.85 and a table's bucket with 0.2, so they miss all tables with 0.0008.
TABLES, PROJECTIONS, CELL = 32, 10, 2.0

#: Vectors of one block of a bucket.
BLOCK = 256


class StableHash:
    """floor((a.x + b) / cell) for normal a and uniform b, ``projections`` of them per table."""

    def __init__(self, size: int, seed: int = 31) -> None:
        draw = np.random.default_rng([seed, size])
        self.along = draw.standard_normal((size, TABLES * PROJECTIONS))
        self.shift = draw.uniform(0, CELL, TABLES * PROJECTIONS)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per vector and table."""
        cells = np.floor((unit @ self.along + self.shift) / CELL).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, PROJECTIONS)
        key = np.broadcast_to(np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), cells.shape[:2]).copy()
        for p in range(PROJECTIONS):
            key = mix(key * np.uint64(0x100000001B3) + cells[:, :, p])
        return key.view(np.int64)


def hashed(vectors: DataFrame, kind: str) -> DataFrame:
    """(node, label, n, size, buckets, marks, raw): 32-bit marks of the buckets, and the components, scaled, as doubles."""

    def make():
        hashes: dict[int, StableHash] = {}

        def step(batch):
            ids, labels, copies = (batch.column(c).to_pylist() for c in ("node", "label", "n"))
            by_size: dict[int, list] = {}
            for i, v in enumerate(batch.column("vector").to_pylist()):
                by_size.setdefault(len(v), []).append((i, v))
            for size, rows in by_size.items():
                if size not in hashes:
                    hashes[size] = StableHash(size)
                raw = np.array([v for _, v in rows], np.float64)
                if size:  # squares must neither overflow nor vanish; a power of two changes no cosine
                    largest = np.abs(raw).max(1)
                    raw = np.ldexp(raw, -np.frexp(np.where(np.isfinite(largest), largest, 0))[1][:, None])
                norms = np.sqrt((raw * raw).sum(1))
                good = np.isfinite(raw).all(1) & np.isfinite(norms) & (norms > 0)
                raw, at = raw[good], [i for (i, _), g in zip(rows, good, strict=True) if g]
                if not at:
                    continue
                keys = hashes[size].buckets(raw / norms[good, None])
                marks = (keys & 0x7FFFFFFF).astype(np.int32)
                yield {
                    "node": [ids[i] for i in at], "label": [labels[i] for i in at], "n": [copies[i] for i in at], "size": [size] * len(at),
                    "buckets": list(keys), "marks": [m.tobytes() for m in marks], "raw": [r.tobytes() for r in raw],
                }

        return step

    return map_batches(vectors, f"node {kind}, label string, n long, size int, buckets array<long>, marks binary, raw binary", make)


def close_in_tiles(entries: DataFrame, least: float, kind: str) -> DataFrame:
    """Pairs of one bucket with a cosine of ``least`` or more, each counted in the first table that has both.

    A tile gives (a, NULL, n), the copies that a vector links to, and (a, b, 0), as many links as it takes to join what the
    tile joins. So its rows grow with its vectors, not with its pairs.
    """
    ddl = f"a {kind}, b {kind}, n long"
    schema = arrow_schema(ddl)

    def run(batches):
        for tile in key_runs(batches, ["label", "size", "t", "bucket", "_ti", "_tj"]):
            if tile.num_rows < 2:
                continue
            own, nodes = tile.column("_own").to_numpy(), tile.column("node").to_numpy()
            t, ti, tj = (tile.column(c)[0].as_py() for c in ("t", "_ti", "_tj"))
            raw = np.frombuffer(b"".join(tile.column("raw").to_pylist()), np.float64).reshape(len(nodes), -1)
            marks = np.frombuffer(b"".join(tile.column("marks").to_pylist()), np.int32).reshape(len(nodes), -1)
            squares = (raw * raw).sum(1)
            left, right = np.flatnonzero(own == ti), np.flatnonzero(own == tj)
            cosine = (raw[left] @ raw[right].T) / np.sqrt(squares[left][:, None] * squares[right])
            i, j = np.nonzero(cosine >= least)
            i, j = left[i], right[j]
            keep = (nodes[i] != nodes[j]) & ((ti != tj) | (i < j))
            i, j = i[keep], j[keep]
            if t:
                first = (marks[i, :t] != marks[j, :t]).all(1)
                i, j = i[first], j[first]
            if len(i):
                copies = tile.column("n").to_numpy()
                counts = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
                lowest, before = np.arange(len(nodes)), None
                while before is None or (lowest != before).any():
                    before = lowest.copy()
                    np.minimum.at(lowest, i, lowest[j])
                    np.minimum.at(lowest, j, lowest[i])
                    lowest = lowest[lowest]
                counted, joined = np.flatnonzero(counts), np.flatnonzero(lowest != np.arange(len(nodes)))
                rows = np.concatenate((counted, joined))
                b = [None] * len(counted) + nodes[lowest[joined]].tolist()
                yield pa.RecordBatch.from_pydict({"a": nodes[rows].tolist(), "b": b, "n": np.concatenate((counts[counted].astype(np.int64), np.zeros(len(joined), np.int64)))}, schema=schema)

    group = ["label", "size", "t", "bucket"]
    return sorted_by(in_tiles(entries, group, "node", BLOCK), [*group, "_ti", "_tj"]).mapInArrow(run, ddl)


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93) -> DataFrame:
    """Per row: (id, n_links, component_id, kept): vectors of one label linked by a cosine of ``least`` or more.

    Vectors that are NULL, zero, or hold NULL or non-finite components, and rows with NULL label or id, link with
    nothing; so do vectors of different sizes. Equal vectors of a label become one node with a count before anything
    is paired, so copies cost nothing and all count as links; rows that repeat an id are vectors of their own. A NULL id
    has component_id NULL and is kept, an empty table gives no rows. Candidates share a bucket in one table at least; buckets are compared in tiles,
    so that a hot bucket is many tasks, and every link has its exact cosine. Only a pair that shares no bucket in
    any table is missed.
    """
    kind = dict(vectors.dtypes)[id]
    rows = vectors.select(F.col(id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    marked = rows.withColumn("copy", F.when(usable, F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)))
    groups = marked.filter("copy is not null").groupBy("label", "copy").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    nodes = cut_lineage(groups.filter(F.size("vector") > 0))
    found = cut_lineage(hashed(nodes.select("node", "label", "n", "vector"), kind))
    entries = found.select("node", "label", "n", "size", "marks", "raw", F.posexplode("buckets").alias("t", "bucket"))
    shared = entries.groupBy("label", "size", "t", "bucket").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    pairs = cut_lineage(close_in_tiles(entries.join(shared, ["label", "size", "t", "bucket"], "left_semi"), least, kind))
    links = pairs.filter("b is null").groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("_links"))
    reached = components(pairs.filter("b is not null"))
    valid = found.select(F.col("node").alias("_node"))
    per_copy = (
        nodes.select("label", "copy", "node", "n").join(valid, F.col("node") == F.col("_node"), "left").join(links, F.col("node") == F.col("_a"), "left").join(reached, "node", "left")
        .select(
            F.col("label").alias("_label"), F.col("copy").alias("_copy"),
            F.when(F.col("_node").isNotNull(), F.col("n") - 1 + F.coalesce("_links", F.lit(0))).otherwise(0).alias("_n_links"),
            F.when(F.col("_node").isNotNull(), F.coalesce("component", "node")).alias("_component"),
        )
    )
    out = marked.join(per_copy, (F.col("label") == F.col("_label")) & (F.col("copy") == F.col("_copy")), "left")
    component = F.coalesce("_component", "vec_id")
    return out.select(F.col("vec_id").alias(id), F.coalesce("_n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
