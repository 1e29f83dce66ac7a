"""Ranked lexical search: item bundles carry sparse accumulators from one term owner to the next."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.llm.benchmark import words_of
from loamwork.llm.common import arrow_schema, map_batches, raw_texts, slices, written

#: Owner k has the terms of up to this share of all documents, the rarest first; the last one has the others.
OWNERS = (0.001, 0.01, 0.1)

#: Documents and bytes of text in a block, about, and items in a bundle. A bundle meets a block in one task: its full
#: accumulators take 8 * BLOCK * ITEMS bytes there.
BLOCK, BLOCK_BYTES, ITEMS = 4096, 8 << 20, 256

#: Bits of the filter that keeps words of no item out of the postings: 1 MB, whatever the items; 2 bits a term.
FILTER_BITS = 1 << 23

#: Words whose place in the filter a task remembers; the memory is emptied when it is full.
REMEMBERED = 200_000

#: Least upper bound of what a term of weight 1 adds to a score.
MOST = 1_000_000


def places_in_filter(term: bytes) -> tuple[int, int]:
    x = int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")
    return x % FILTER_BITS, (x >> 32) % FILTER_BITS


def item_terms(items: DataFrame, item_id: str, text: str, kind: str) -> DataFrame:
    """(item, term, bit): the distinct terms of every item, two rows each with its places in the filter."""

    def make():
        def step(batch):
            for part in slices(batch):
                out = {"item": [], "term": [], "bit": []}
                for key, body in zip(part.column("item").to_pylist(), raw_texts(part), strict=True):
                    for term in set(words_of(body)):
                        for bit in places_in_filter(term):
                            out["item"].append(key)
                            out["term"].append(term)
                            out["bit"].append(bit)
                yield out

        return step

    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).filter("item is not null and text is not null")
    return map_batches(rows, f"item {kind}, term binary, bit int", make)


def term_filter(terms: DataFrame) -> np.ndarray:
    """The filter as bytes; at most FILTER_BITS / 32768 rows of 4 KB reach the driver."""
    at = F.col("bit").cast("long") + 1
    rows = terms.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["k"] - 1) * 4096 : (r["k"] - 1) * 4096 + len(own)] = own
    return bits


def postings(docs: DataFrame, bits: np.ndarray, kind: str) -> DataFrame:
    """Blocks of documents as lists by term: (block, term, places, tfs, sizes, ids).

    A block is a stretch of one task's documents, numbered in the order of their ids. It has a row per term that passes
    the filter (numbers of its documents, occurrences in them, terms of them), and one without a term, with the ids and
    sizes of all its documents.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def make():
        bits, known, blocks = shared.value, {}, [TaskContext.get().partitionId() << 32]

        def wanted(term: bytes) -> bool:
            if len(known) >= REMEMBERED:
                known.clear()
            found = known[term] = all(bits[x >> 3] >> (x & 7) & 1 for x in places_in_filter(term))
            return found

        def step(batch):
            for whole in slices(batch, BLOCK_BYTES):
                for at in range(0, whole.num_rows, BLOCK):
                    part = whole.slice(at, BLOCK)
                    ids, texts = part.column("doc_id").to_pylist(), raw_texts(part)
                    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
                    lists: dict[bytes, list[int]] = {}
                    sizes = []
                    for place, i in enumerate(order):
                        words = words_of(texts[i])
                        sizes.append(len(words))
                        for term, tf in Counter(words).items():
                            pass_on = known.get(term)
                            if pass_on is None:
                                pass_on = wanted(term)
                            if pass_on:
                                lists.setdefault(term, []).extend((place, tf))
                    block, n = blocks[0], np.array(sizes, np.int64)
                    blocks[0] += 1
                    out = {"block": [block] * (len(lists) + 1), "term": [None], "places": [None], "tfs": [None], "sizes": [n.tobytes()], "ids": [[ids[i] for i in order]] + [None] * len(lists)}
                    for term, pairs in lists.items():
                        found = np.array(pairs, np.int64).reshape(-1, 2)
                        out["term"].append(term)
                        out["places"].append(found[:, 0].astype(np.uint16).tobytes())
                        out["tfs"].append(found[:, 1].astype(np.uint32).tobytes())
                        out["sizes"].append(n[found[:, 0]].astype(np.uint32).tobytes())
                    yield out

        return step

    return map_batches(docs, f"block long, term binary, places binary, tfs binary, sizes binary, ids array<{kind}>", make)


def owner_stage(state: DataFrame, lists: DataFrame, documents: int, terms: int, top: int, kind: str) -> DataFrame:
    """(bundle, block, item, places, scores, best): the accumulators after one owner has added its terms.

    state: the same of the stage before; lists: postings of the owner's terms, with the items of the bundle that hold
    the term. A new accumulator is opened only if all that is still to come can reach the item's threshold, and one is
    kept only if it can reach it with what comes after this owner; the ``top``-th of a block is a threshold as well. Both are
    lower bounds of the last score that is wanted, so what is left out is below it for certain.
    """
    ddl = f"bundle long, block long, item {kind}, places binary, scores binary, best array<long>"
    schema = arrow_schema(ddl)

    def run(key, left, right):
        sums: dict[object, np.ndarray] = {}
        limits: dict[object, tuple[int, int]] = {}
        opened: dict[object, np.ndarray] = {}
        for item, places, scores in zip(*(left.column(c).to_pylist() for c in ("item", "places", "scores")), strict=True):
            sums[item] = np.zeros(BLOCK, np.int64)
            sums[item][np.frombuffer(places, np.uint16)] = np.frombuffer(scores, np.int64)
        for places, tfs, sizes, holders in zip(*(right.column(c).to_pylist() for c in ("places", "tfs", "sizes", "holders")), strict=True):
            at, tf, n = np.frombuffer(places, np.uint16), np.frombuffer(tfs, np.uint32).astype(np.int64), np.frombuffer(sizes, np.uint32).astype(np.int64)
            share = (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // terms))
            for h in holders:
                item = h["item"]
                limits[item] = h["threshold"], h["after"]
                if h["to_come"] >= h["threshold"]:
                    if item not in sums:
                        sums[item] = np.zeros(BLOCK, np.int64)
                    sums[item][at] += h["weight"] * share
                elif item in sums:
                    if item not in opened:
                        opened[item] = sums[item] > 0
                    own = opened[item][at]
                    sums[item][at[own]] += h["weight"] * share[own]
        out = {c: [] for c in schema.names}
        for item, total in sums.items():
            at = np.flatnonzero(total)
            scores = total[at]
            best = np.sort(scores)[::-1][:top]
            threshold, after = limits.get(item, (0, 0))
            if item in limits:
                keep = scores + after >= max(threshold, best[-1] if len(best) == top else 0)
                at, scores = at[keep], scores[keep]
            if len(at):
                for name, value in zip(schema.names, (key[0].as_py(), key[1].as_py(), item, at.astype(np.uint16).tobytes(), scores.tobytes(), best), strict=True):
                    out[name].append(value)
        return pa.Table.from_pydict(out, schema=schema)

    return state.groupBy("bundle", "block").cogroup(lists.groupBy("bundle", "block")).applyInArrow(run, ddl)


def thresholds(state: DataFrame, top: int) -> DataFrame:
    """(item, threshold): the ``top``-th largest accumulator of every item that has as many."""
    best = state.select("item", F.explode("best").alias("threshold"))
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("threshold")))
    return best.withColumn("nth", nth).filter(F.col("nth") == top).select("item", "threshold")


def ranked_search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = 10, owners: tuple[float, ...] = OWNERS) -> DataFrame:
    """Per item its ``top`` highest-scoring documents: (item_id, rank, id, score), scores above 0, equal ones by id.

    Terms are runs of letters, digits and everything beyond ASCII, A-Z in lower case. A term in df of N documents that have
    terms weighs floor(1000 * ln((2N + 2) / (2df + 1))); with tf occurrences in a document of n terms it adds weight *
    (1e9 * tf div (1000 * tf + 8m)), m = 10 + 90 * n * N div L, L terms in all documents. All but the weight is integer
    arithmetic.

    NULL and empty texts have no terms and are never found. Every row is a document of its own, whatever repeats; NULL ids
    come after all others among equal scores. Items that repeat an id are one item with the terms of all; items with NULL
    id or without terms get no rows. Without documents or items there are no rows. Whole texts are read, of any length.

    Terms belong to owners by their document frequency. Postings are lists by term and block of documents, made where the
    documents lie. Bundles of items visit the owners one after the other, the rarest terms first: at every owner a
    bundle's accumulators for a block meet the owner's lists of that block in a cogroup, take its integer contributions
    and go on. Accumulators that cannot reach the ``top``-th best any more stay behind, so few of them are left when the
    long lists come. The selection at the end orders at most ``top`` rows per item and block. A group is a block with a
    bundle, so its size is bounded, however frequent a term is.
    """
    spark, kind, item_kind = docs.sparkSession, dict(docs.dtypes)[id], dict(items.dtypes)[item_id]
    wanted = written(item_terms(items, item_id, item_text, item_kind), "item-terms")
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    lists = written(postings(rows, term_filter(wanted), kind), "postings")
    own = lists.filter("term is null").select("block", "ids", "sizes")

    counts = lists.filter("term is not null").groupBy("term").agg(F.sum(F.octet_length("places") / 2).cast("long").alias("df"))
    facts = _facts(own)
    documents, terms, blocks = facts
    bundles = wanted.agg(F.count_distinct("item").alias("n")).first()["n"] // ITEMS + 1
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1))).cast("long")
    owner = sum(((F.col("df") > F.lit(share * documents)).cast("int") for share in owners), F.lit(0))
    weighed = wanted.select("item", "term").distinct().join(counts, "term").select("item", "term", weight.alias("weight"), owner.alias("owner"))
    to_come = F.sum(F.col("weight") * MOST).over(Window.partitionBy("item").orderBy(F.desc("owner")).rangeBetween(Window.unboundedPreceding, 0))
    after = to_come - F.sum(F.col("weight") * MOST).over(Window.partitionBy("item", "owner"))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles))
    weighed = written(weighed.filter("weight > 0").select("item", "term", "weight", "owner", bundle.alias("bundle"), to_come.alias("to_come"), after.alias("after")), "weights")

    # a term's lists are as many as the blocks that hold it: they are dealt into salts, the term's holders go to each
    salts = blocks // 64 + 1
    salted = lists.filter("term is not null").select("term", "block", "places", "tfs", "sizes", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
    state = spark.createDataFrame([], f"bundle long, block long, item {item_kind}, places binary, scores binary, best array<long>")
    limits = spark.createDataFrame([], f"item {item_kind}, threshold long")
    for k in range(len(owners) + 1):
        mine = weighed.filter(F.col("owner") == k).join(limits, "item", "left")
        holder = F.struct("item", "weight", "to_come", "after", F.coalesce("threshold", F.lit(0)).cast("long").alias("threshold"))
        holders = mine.groupBy("term", "bundle").agg(F.collect_list(holder).alias("holders"))  # a bundle's items at most
        spread = holders.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        sent = salted.join(spread, ["term", "salt"]).select("bundle", "block", "places", "tfs", "sizes", "holders")
        state = written(owner_stage(state, sent, documents, max(terms, 1), top, item_kind), f"owner-{k}")
        limits = thresholds(state, top)
    return _selected(state, limits, own, top, id, item_id)


def _facts(own: DataFrame) -> tuple[int, int, int]:
    """Documents with a term, terms in all documents, blocks."""

    def make():
        def step(batch):
            found = [np.frombuffer(x, np.int64) for x in batch.column("sizes").to_pylist()]
            yield {"documents": [int((x > 0).sum()) for x in found], "terms": [int(x.sum()) for x in found]}

        return step

    r = map_batches(own.select("sizes"), "documents long, terms long", make).agg(F.sum("documents").alias("d"), F.sum("terms").alias("t"), F.count("*").alias("b")).first()
    return r["d"] or 0, r["t"] or 0, r["b"]


def _selected(state: DataFrame, limits: DataFrame, own: DataFrame, top: int, id: str, item_id: str) -> DataFrame:
    """The last selection: best accumulators of every block, then of every item."""
    kind = dict(state.dtypes)["item"]

    def make():
        def step(batch):
            out = {"item": [], "block": [], "place": [], "score": []}
            for item, block, places, scores, least in zip(*(batch.column(c).to_pylist() for c in ("item", "block", "places", "scores", "threshold")), strict=True):
                at, score = np.frombuffer(places, np.uint16).astype(np.int32), np.frombuffer(scores, np.int64)
                best = np.lexsort((at, -score))[:top]
                best = best[score[best] >= (least or 0)]
                for name, value in (("item", [item] * len(best)), ("block", [block] * len(best)), ("place", at[best].tolist()), ("score", score[best].tolist())):
                    out[name] += value
            yield out

        return step

    found = map_batches(state.join(limits, "item", "left").select("item", "block", "places", "scores", "threshold"), f"item {kind}, block long, place int, score long", make)
    named = found.join(own.select("block", "ids"), "block").select("item", "score", F.element_at("ids", F.col("place") + 1).alias("doc"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
    return named.withColumn("rank", rank).filter(F.col("rank") <= top).select(F.col("item").alias(item_id), "rank", F.col("doc").alias(id), "score")
