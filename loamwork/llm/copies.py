"""Exact copies: sorted runs of text digests, merged over binomial rounds of exchanges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import arrow_schema, join_dealt, written

#: Runs that meet in one merge of a round.
RADIX = 8

#: White space that counts as one blank.
BLANKS = r"[\x20\x09-\x0D]+"

#: What two texts have to share before they count as equal: SHA-256, another hash and the length.
KEY = ["digest", "check", "size"]


def digests(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, digest, check, size) of the texts with every stretch of white space as one blank; NULL is empty."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")
    rows = docs.select(F.col(id).alias("doc_id"), plain.alias("plain"))
    return rows.select("doc_id", F.unhex(F.sha2("plain", 256)).alias("digest"), F.xxhash64("plain").alias("check"), F.octet_length("plain").cast("long").alias("size"))


def merged(runs: DataFrame, kind: str) -> DataFrame:
    """One sorted run per partition: the runs that it holds are merged, and of equal keys the smallest id stays.

    The merge is Spark's sort of the partition, which spills; the scan behind it holds one Arrow batch. Rows whose digests
    agree are only taken together if hash and length agree as well.
    """
    ddl = f"digest binary, check long, size long, head {kind}, n long, owner int, place int"
    schema = arrow_schema(ddl)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([*held, batch]).combine_chunks()
            key = np.empty((part.num_rows, 6), np.int64)
            key[:, :4] = np.frombuffer(b"".join(part.column("digest").to_pylist()), np.int64).reshape(-1, 4)
            key[:, 4], key[:, 5] = part.column("check").to_numpy(), part.column("size").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1))))
            n = np.add.reduceat(part.column("n").to_numpy(), first)
            out = part.take(first).set_column(4, part.schema.field("n"), pa.array(n, pa.int64())).combine_chunks().to_batches()[0]
            yield out.slice(0, out.num_rows - 1)
            held = [out.slice(out.num_rows - 1)]
        yield from held

    order = [*KEY, F.col("head").asc_nulls_last()]
    return runs.select([f.name for f in schema]).sortWithinPartitions(*order).mapInArrow(run, ddl)


def tree_merged(rows: DataFrame, kind: str, radix: int, partitions: int) -> DataFrame:
    """(digest, check, size, head, n): every key once, with the smallest id and the number of its rows.

    Partitions are numbered with ``rounds`` digits of base ``radix``. In round r the partitions whose numbers differ in
    digit r only exchange their runs: each keeps the keys whose place has its own digit there. So a key that stands
    everywhere is one row per partition before any exchange and one of ``radix`` as many after each round, no partition
    ever holds more than its share of the distinct keys, and after the last round every key has one owner.
    """
    rounds = 1
    while radix**rounds < partitions:
        rounds += 1
    size = radix**rounds
    place = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(size)).cast("int")
    own = F.pmod(F.spark_partition_id(), F.lit(size)).cast("int")
    runs = merged(rows.select(*KEY, F.col("doc_id").alias("head"), F.lit(1).cast("long").alias("n"), own.alias("owner"), place.alias("place")), kind)
    for r in range(rounds):
        step = radix**r

        def digit(c: str, step: int = step):
            return F.floor(F.col(c) / step).cast("int") % radix

        to = (F.col("owner") + (digit("place") - digit("owner")) * step).cast("int")
        runs = merged(runs.withColumn("owner", to).repartitionById(size, "owner"), kind)
    return runs.select(*KEY, "head", "n")


def exact_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", radix: int = RADIX, partitions: int | None = None) -> DataFrame:
    """Per row: (id, keep_id, group_size, kept, text_sha256): texts that are equal but for their white space.

    Every stretch of blanks and tab to carriage return counts as one blank, also at the ends; nothing else is changed.
    NULL texts are empty texts and copies of each other. Of equal texts the row with the smallest id stays: ``kept`` is
    ``id = keep_id``, so rows that repeat this id stay together, and each counts in ``group_size``. NULL ids come after all
    others: a group without any other id has ``keep_id`` NULL and all its rows stay. An empty table gives no rows; other
    columns are not read. A text is digested whole, whatever its length.

    Only ids and digests leave the document's row. ``partitions`` (default: the session's shuffle partitions) is the least
    number of partitions of the merge. The groups come back to the rows with the rows of hot groups dealt out.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id]
    rows = written(digests(docs, id, text), "digests")
    groups = written(tree_merged(rows, kind, radix, partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))), "groups")
    found = join_dealt(rows, groups, KEY, "n", rows.count())
    return found.select(
        F.col("doc_id").alias(id), F.col("head").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("head")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
