"""Removal of lines that many documents share, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import carried, join_dealt, total_of, written
from loamwork.session import hold

#: Tab to carriage return, and the blank.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def drop_shared_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 10, shortest: int = 1, carry: Sequence[str] = ()) -> DataFrame:
    """Per row: (id, n_lines, n_dropped, kept[, carried]): the text without the lines whose key stands in ``least`` rows or more.

    Lines are split at ``\\n``; a key of fewer than ``shortest`` code points is never shared. Every input row is a
    document of its own, also when rows repeat, and gives one output row. NULL and empty texts are one empty line and stay.
    Rows with NULL ids, or ids that repeat, are kept apart by the hash of their text; equal rows get equal results.
    An empty table gives no rows. Columns named in ``carry`` come along in a struct, others are not read.

    Keys are hashed to 128 bits, once per document, and counted with partial sums, so a line that all documents
    share is one row per task. Only hashes travel; the whole lines stay in their document's row, which loses the
    positions that come back for it, in one pass over its lines. Rows of a hot line are dealt out.
    """
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    keyed = rows.select("_id", F.xxhash64("_text").alias("_row"), F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    keyed = keyed.select("_id", "_row", "_pos", line_key(F.col("_line")).alias("_key")).filter(F.length("_key") >= shortest)
    keyed = keyed.select("_id", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), "_key").alias("_h2"))
    # one document's copies of a line have to count once
    once = rows.select(F.explode(F.array_distinct(F.transform(F.split("_text", "\n", -1), line_key))).alias("_key")).filter(F.length("_key") >= shortest)
    shared = written(once.groupBy(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), "_key").alias("_h2")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least), "shared-lines")
    hits = join_dealt(keyed, shared, ["_h1", "_h2"], "_n", total_of(shared, "_n"), "inner")
    gone = hits.groupBy("_id", "_row").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    gone = gone.select(F.col("_id").alias("_gid"), F.col("_row").alias("_grow"), "_gone")
    body = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(F.col(id).alias("_id"), F.col(text).alias("_raw"), F.xxhash64(body).alias("_row"), *carried(docs, carry))
    joined = whole.join(gone, whole._id.eqNullSafe(gone._gid) & (whole._row == gone._grow), "left")
    # what stays are the stretches between two dropped lines
    edges = F.concat(F.array(F.lit(-1)), "_gone", F.array(F.size("_lines")))
    held = hold(hold(joined, _lines=F.split(F.coalesce("_raw", F.lit("")), "\n", -1)), _edges=edges)
    gaps = F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda k: F.slice("_lines", F.get("_edges", k) + 2, F.get("_edges", k + 1) - F.get("_edges", k) - 1))
    kept = F.when(F.col("_gone").isNull(), F.col("_raw")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return held.select(
        F.col("_id").alias(id),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
        *(["carried"] if carry else []),
    )
