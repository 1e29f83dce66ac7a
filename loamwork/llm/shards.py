"""Placing records into weighted shards by rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import ranked


def draw(key: Column, shard: int) -> Column:
    """Number in (0, 1) that a record draws for a shard: 52 bits of an MD5, so that other engines can repeat it."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard with the best draw: least -ln(draw) / weight. A shard more takes records only into itself."""
    scores = [F.struct((-F.log(draw(key, s)) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*scores))["shard"]


def place_in_shards(docs: DataFrame, id: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 16, grown: Sequence[float] | None = None) -> DataFrame:
    """Per row: (id, size, text_crc32, law, shard, slot, grown_shard).

    ``shard`` depends on the id and ``weights`` alone (law ``key``), ``grown_shard`` on the id and ``grown`` (one
    more shard of mean weight unless given). ``slot`` numbers a shard's rows 0, 1, ... by the MD5 of the id, then id,
    then text size. A NULL id draws like the empty string, rows with equal ids share a shard; equal rows take any order
    among themselves. NULL text counts no bytes; an empty table gives no rows. Texts are measured and dropped before anything is shuffled; ranks
    come from ranges with row tags, so an id that a third of all rows share is no hot spot.
    """
    weights = list(weights)
    grown = list(grown) if grown is not None else [*weights, sum(weights) / len(weights)]
    key, body = F.coalesce(F.col(id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias(id),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).cast("int").alias("shard"),
        rendezvous(key, grown).cast("int").alias("grown_shard"),
        F.md5(key.cast("binary")).alias("_order"),
    )
    placed = ranked(rows, ["shard"], ["_order", id, "size"], "slot")
    return placed.select(id, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
