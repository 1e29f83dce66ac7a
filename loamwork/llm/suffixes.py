"""Repeated byte strings: suffixes in sampled ranges, sorted locally, with classes compared across the ranges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import PrefixHash, arrow_schema, join_dealt, mix, total_of, written
from loamwork.llm.repeats import Repeats

#: Bytes of an anchor, with which its suffixes begin.
GRAM = 40

#: Anchors with more different contexts than this may be cut into several ranges.
HOT = 20_000


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Order of the rows of a matrix of words, column by column: less, equal and greater parts around a pivot.

    Equal parts go on with the next column, short parts are sorted at once.
    """
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == keys.shape[1]:
            continue
        rows = order[lo:hi]
        if hi - lo <= 48:
            order[lo:hi] = rows[np.lexsort(keys[rows, depth:].T[::-1])]
            continue
        column = keys[rows, depth]
        pivot = np.sort(column[:: max(1, len(column) // 31)])[len(column[:: max(1, len(column) // 31)]) // 2]
        less, more = column < pivot, column > pivot
        order[lo:hi] = np.concatenate((rows[less], rows[~(less | more)], rows[more]))
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


class Strings:
    """Byte strings as a padded matrix, their order and the common prefixes of neighbours."""

    def __init__(self, strings: list[bytes], width: int) -> None:
        width += -width % 8
        self.sizes = np.array([len(s) for s in strings])
        self.bytes = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(len(strings), width)

    def words(self) -> np.ndarray:
        return self.bytes.view(">u8").astype(np.uint64)

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common prefix of each string, in order, with the one before it."""
        out = np.zeros(len(order), np.int64)
        for i in range(1, len(order), 4096):
            own, before = order[i : i + 4096], order[i - 1 : i + 4095][: len(order[i : i + 4096])]
            differ = self.bytes[own] != self.bytes[before]
            common = np.where(differ.any(1), differ.argmax(1), differ.shape[1])
            out[i : i + 4096] = np.minimum(common, np.minimum(self.sizes[own], self.sizes[before]))
        return out


def best_neighbour(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def range_classes(right: list[bytes], left: list[bytes], many: list[bool], length: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Within one range: least and greatest number of bytes before the anchor at which a context's string also stands
    in another context (lo > hi if none), and the strings (context, before, hash) that other ranges may hold.

    A string is ``before`` bytes to the left of the anchor and the rest from the anchor on. Contexts with the same rest
    are neighbours in the order of suffixes, contexts with the same left bytes in the order of reversed lefts.
    """
    n, before = len(right), length - GRAM
    rights, lefts = Strings(right, length), Strings([s[::-1] for s in left], before)
    r_order = multikey_quicksort(np.concatenate((rights.words(), lefts.words()), 1))
    l_order = multikey_quicksort(lefts.words())
    r_common, l_common = rights.neighbours(r_order), lefts.neighbours(l_order)
    live = best_neighbour(r_order, r_common) + best_neighbour(l_order, l_common) >= length
    lo, hi = np.full(n, length), np.full(n, -1)
    many, edges = np.array(many), []
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for j in range(before + 1):
        classes = np.cumsum(r_common < length - j)
        r_class[r_order] = classes
        l_class[l_order] = np.cumsum(l_common < j)
        valid = (rights.sizes >= length - j) & (lefts.sizes >= j)
        at = np.flatnonzero(valid & live)
        if len(at):
            _, place, times = np.unique(r_class[at] * (n + 1) + l_class[at], return_inverse=True, return_counts=True)
            twice = at[times[place] > 1]
            lo[twice], hi[twice] = np.minimum(lo[twice], j), j
        outer = np.flatnonzero(valid & many & ((r_class == classes[0]) | (r_class == classes[-1])))
        edges.append((outer, np.full(len(outer), j)))
    rows, js = (np.concatenate(x) for x in zip(*edges, strict=True))
    return lo, hi, (rows, js, string_hashes(rights, lefts, rows, js, length))


def string_hashes(rights: Strings, lefts: Strings, rows: np.ndarray, js: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings with ``js`` bytes before the anchor."""
    out = np.empty(len(rows), np.uint64)
    hashes = PrefixHash()
    hashes._grow(length + 8)
    powers = hashes.powers[:length]
    for start in range(0, len(rows), 20_000):
        own, inverse = np.unique(rows[start : start + 20_000], return_inverse=True)
        j = js[start : start + 20_000]
        sums = []
        for side in (rights, lefts):
            part = side.bytes[own]
            total = np.zeros((len(own), part.shape[1] + 1), np.uint64)
            np.cumsum(hashes.values[part] * powers[: part.shape[1]], axis=1, out=total[:, 1:])
            sums.append(total)
        out[start : start + 20_000] = mix(sums[0][inverse, length - j] + mix(sums[1][inverse, j] + j.astype(np.uint64)))
    return out


def compared_ranges(contexts: DataFrame, length: int) -> DataFrame:
    """(d1, d2, lo, hi): range of bytes before the anchor at which a context's string stands elsewhere, over all ranges.

    Spark samples the suffixes for splitters and deals them out by their leading bytes: those of the anchor, so that an
    anchor lies in one range; an anchor with very many contexts by all its bytes. Classes of the latter that reach the
    first or last suffix of a range may go on in the next one: their strings are counted over all ranges, with
    partial sums, so that one anchor may fill many ranges.
    """
    ddl = "d1 long, d2 long, lo int, hi int, string long"
    schema = arrow_schema(ddl)

    def run(batches):
        seen, right, left, many, keys = set(), [], [], [], []
        for batch in batches:
            for d1, d2, a, b, m in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "right", "left", "many")), strict=True):
                if (d1, d2) not in seen:
                    seen.add((d1, d2))
                    keys.append((d1, d2))
                    right.append(a)
                    left.append(b)
                    many.append(m)
        if not keys:
            return
        lo, hi, (rows, js, hashes) = range_classes(right, left, many, length)
        d1, d2 = np.array(keys, np.int64).T
        at = np.flatnonzero(hi >= 0)
        yield pa.RecordBatch.from_pydict({"d1": d1[at], "d2": d2[at], "lo": lo[at], "hi": hi[at], "string": pa.nulls(len(at), pa.int64())}, schema=schema)
        for i in range(0, len(rows), 50_000):
            own, j = rows[i : i + 50_000], js[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"d1": d1[own], "d2": d2[own], "lo": j, "hi": j, "string": hashes[i : i + 50_000].view(np.int64)}, schema=schema)

    leading = F.substring("right", 1, GRAM), F.when(F.col("many"), F.col("right")), F.when(F.col("many"), F.reverse(F.hex("left")))
    ranged = contexts.select("d1", "d2", "right", "left", "many").repartitionByRange(*leading)
    found = written(ranged.mapInArrow(run, ddl), "ranges")
    outer = found.filter("string is not null")
    where = F.xxhash64("d1", "d2")
    again = outer.groupBy("string", "lo").agg(F.min(where).alias("one"), F.max(where).alias("other")).filter("one <> other").select("string", "lo")
    across = outer.join(again, ["string", "lo"]).select("d1", "d2", "lo", "hi")
    return found.filter("string is null").select("d1", "d2", "lo", "hi").unionByName(across).groupBy("d1", "d2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def drop_repeated_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 200, hot: int = HOT) -> DataFrame:
    """Per row: (id, n, n_removed, n_spans, kept_sha256, spans): bytes in a string of ``length`` bytes that also starts elsewhere.

    Texts are UTF-8 bytes; NULL is empty. All occurrences go, also overlapping ones of one document; ``spans`` are
    the maximal removed byte runs, the digest is that of the bytes left. Rows with equal id and text are one document
    and get equal results; NULL ids are documents like others. An empty table gives no rows.

    Suffixes are sampled at anchors: of all strings of ``length`` bytes, each holds the anchor of its least gram, and only
    anchors that stand twice are sorted. A context is the suffix at an anchor and the bytes before it.
    """
    steps = Repeats(docs, id, text, False, length, GRAM)
    marked = steps.marked()
    copies = steps.copies(marked)
    candidates = steps.candidates(marked, copies)
    contexts = steps.contexts(candidates)
    distinct = steps.distinct(contexts)
    own = compared_ranges(steps.fetched(steps.compared(distinct, hot), candidates), length)
    known = written(distinct.select("d1", "d2", "n", "several").join(own, ["d1", "d2"], "left").filter("several or lo is not null"), "known")
    whole = F.col("several") & (F.col("before") + F.col("after") >= length)
    start = F.when(whole, F.col("place") - F.col("before")).otherwise(F.col("place") - F.col("hi"))
    end = F.when(whole, F.col("place") + F.col("after")).otherwise(F.col("place") - F.col("lo") + length)
    spans = join_dealt(contexts, known, ["d1", "d2"], "n", total_of(known), "inner").select("t1", "t2", start.alias("start"), end.alias("end")).filter("start is not null")
    return steps.result(marked, copies, steps.judged(spans, candidates), id, first_stays=False)
