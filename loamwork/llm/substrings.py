"""Repeated word passages: suffix automata of reference shards, matching statistics of the documents against them."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import arrow_schema, join_dealt, key_runs, total_of, written
from loamwork.llm.repeats import Repeats

#: Words of an anchor, and words of one shard's automaton, about.
GRAM, SHARD_WORDS = 6, 40_000

#: Anchors with more different contexts than this, whose automaton would take over about 300 MB, are counted window by window.
HOT = 15_000


class SuffixAutomaton:
    """Generalised suffix automaton. Every state knows the first place at which its words ended.

    Passages have to come in document order, places in rising order within a passage.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, edges: dict[int, int], link: int, length: int, first: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """State for the shorter words of q, reached from p and its suffixes."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int], place: int) -> None:
        """Words ending at ``place``, ``place + 1``, ..."""
        last = 0
        for c in words:
            p, q = last, self.next[last].get(c)
            if q is None:
                last = self._state({}, 0, self.length[p] + 1, place)
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][c]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            else:
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            place += 1

    def matches(self, words: list[int], least: int):
        """Matching statistics cut at ``least``: (end, first place) wherever the last ``least`` words stand in a passage."""
        v = n = 0
        for i, c in enumerate(words):
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if c in self.next[v]:
                v, n = self.next[v][c], n + 1
            while self.length[self.link[v]] >= least:
                v = self.link[v]
                n = self.length[v]
            if n >= least:
                yield i + 1, self.first[v]


def may_repeat(lefts: list[list[bytes]], rights: list[list[bytes]], length: int, gram: int = GRAM) -> list[int]:
    """Contexts of one anchor that can share a window with another: words before the anchor, and from the anchor on.

    A window has ``length - gram`` words beside its anchor, so half of them on one side: contexts that share a window have
    the same words that far to the left or that far to the right.
    """
    half = -(-(length - gram) // 2)
    sides = [[tuple(x[-half:]) if len(x) >= half else None for x in lefts], [tuple(x[gram : gram + half]) if len(x) >= gram + half else None for x in rights]]
    counts = [Counter(s) for s in sides]
    return [i for i, keys in enumerate(zip(*sides, strict=True)) if any(k is not None and n[k] > 1 for k, n in zip(keys, counts, strict=True))]


def shard_matches(contexts: DataFrame, length: int, kind: str) -> DataFrame:
    """(d1, d2, lo, hi): first and last start, within its context, of windows that also start earlier.

    Contexts of one anchor lie in one shard. A task reads its anchors one after the other, cuts them into shards of
    about SHARD_WORDS words, builds a shard's automaton and streams the shard's passages through it.
    """
    ddl = "d1 long, d2 long, lo int, hi int"
    schema = arrow_schema(ddl)

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1], r[2]))
        numbers: dict[bytes, int] = {}
        automaton, passages, text, base, seen = SuffixAutomaton(), [], None, 0, set()
        for doc, t1, place, before, words, d1, d2 in rows:
            if (d1, d2) in seen:
                continue
            seen.add((d1, d2))
            if (doc, t1) != text:
                text, base = (doc, t1), base + (1 << 40)
            coded = [numbers.setdefault(w, len(numbers)) for w in words]
            passages.append((coded, base + place - before, d1, d2))
            automaton.add(coded, base + place - before)
        out = {"d1": [], "d2": [], "lo": [], "hi": []}
        for coded, start, d1, d2 in passages:
            ends = [e for e, first in automaton.matches(coded, length) if first < start + e - 1]
            if ends:
                for name, value in (("d1", d1), ("d2", d2), ("lo", ends[0] - length), ("hi", ends[-1] - length)):
                    out[name].append(value)
        return pa.RecordBatch.from_pydict(out, schema=schema)

    def run(batches):
        held, words = [], 0
        for group in key_runs(batches, ["hash"]):
            lefts, rights = ([x.split() for x in group.column(c).to_pylist()] for c in ("left", "right"))
            columns = [group.column(c).to_pylist() for c in ("doc_id", "t1", "place", "before", "d1", "d2")]
            for i in may_repeat(lefts, rights, length):
                doc, t1, place, before, d1, d2 = (c[i] for c in columns)
                passage = lefts[i] + rights[i]
                held.append((doc, t1, place, before, passage, d1, d2))
                words += len(passage)
            if words >= SHARD_WORDS:
                yield judge(held)
                held, words = [], 0
        if held:
            yield judge(held)

    return contexts.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, ddl)


def hot_matches(contexts: DataFrame, length: int, kind: str) -> DataFrame:
    """The same for anchors with very many contexts: first places per window by partial aggregation."""
    ddl = f"w binary, doc_id {kind}, t1 long, start int, d1 long, d2 long, at int"
    schema = arrow_schema(ddl)

    def run(batches):
        import hashlib

        for batch in batches:
            out = {c: [] for c in schema.names}
            for doc, t1, place, before, left, right, d1, d2 in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "t1", "place", "before", "left", "right", "d1", "d2")), strict=True):
                words = left.split() + right.split()
                for at in range(len(words) - length + 1):
                    window = hashlib.blake2b(b" ".join(words[at : at + length]), digest_size=16).digest()
                    for name, value in zip(schema.names, (window, doc, t1, place - before + at, d1, d2, at), strict=True):
                        out[name].append(value)
            if out["w"]:
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t1", "start")
    windows = contexts.mapInArrow(run, ddl).withColumn("own", order)
    first = windows.groupBy("w").agg(F.min("own").alias("first"))
    return windows.join(first, "w").filter(F.col("own") > F.col("first")).groupBy("d1", "d2").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))


def drop_repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 20, hot: int = HOT) -> DataFrame:
    """Per row: (id, n, n_removed, n_spans, kept_sha256, spans): words in a window of ``length`` words that also starts earlier.

    Earlier is a smaller id, or an earlier start in the same document; the first occurrence stays. Words are runs without
    tab to carriage return and blank, unchanged; ``spans`` are removed word stretches, the digest is that of the
    words left, joined by blanks. NULL texts have no words, texts of fewer words than a window keep all. NULL ids come
    after all others; rows with equal id and text are one document and get equal results. An empty table gives no rows.

    The reference is the distinct contexts of anchors that stand in several places, dealt into shards by anchor. Instead
    of sending every shard to all documents, only passages around the shard's anchors are sent to it. So the
    work is linear, and no automaton passes through the driver.
    """
    steps = Repeats(docs, id, text, True, length, GRAM)
    marked = steps.marked()
    copies = steps.copies(marked)
    candidates = steps.candidates(marked, copies)
    contexts = steps.contexts(candidates)
    distinct = steps.distinct(contexts)
    wanted = steps.compared(distinct, hot)
    cold = shard_matches(steps.fetched(wanted.filter("not many"), candidates), length, steps.kind)
    warm = hot_matches(steps.fetched(wanted.filter("many"), candidates), length, steps.kind)
    own = written(cold.unionByName(warm).groupBy("d1", "d2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "matches")
    known = distinct.select("d1", "d2", "n", F.col("t1").alias("f1"), F.col("t2").alias("f2"), F.col("place").alias("f_place"), "several").join(own, ["d1", "d2"], "left").filter("several or lo is not null")
    known = written(known, "known")
    first = (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2")) & (F.col("place") == F.col("f_place"))
    begin = F.col("place") - F.col("before")
    start = F.when(first, begin + F.col("lo")).when(F.col("before") + F.col("after") >= length, begin)
    end = F.when(first, begin + F.col("hi") + length).otherwise(F.col("place") + F.col("after"))
    spans = join_dealt(contexts, known, ["d1", "d2"], "n", total_of(known), "inner").select("t1", "t2", start.alias("start"), end.alias("end")).filter("start is not null")
    return steps.result(marked, copies, steps.judged(spans, candidates), id, first_stays=True)
