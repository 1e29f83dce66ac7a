"""Stretches of ``length`` units (bytes or words) that stand in several places: shared anchors and their contexts.

Equal stretches have the same least gram hash at the same place. Only these anchors are shuffled, not all starts. An
anchor that stands once rules out every stretch around it. For the others the context is compared: up to
``length - gram`` units before the anchor and ``length`` from it on, which hold all stretches that the anchor stands for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.llm.common import PrefixHash, join_dealt, map_batches, mix, slices, total_of, word_spans, written


class Units:
    """Bytes or words of a text, as rows of 64-bit values."""

    def __init__(self, words: bool, length: int, gram: int) -> None:
        self.words, self.length, self.gram = words, length, gram
        self.text_hash, self.unit_hash = PrefixHash(), PrefixHash()

    def row(self, text: bytes) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Values, and the starts and ends of words."""
        raw = np.frombuffer(text, np.uint8)
        if not self.words:
            return self.text_hash.values[raw], None, None
        starts, ends = word_spans(raw)
        return self.text_hash.words(raw, starts, ends), starts, ends

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the least gram of every stretch."""
        n, width = len(values) - self.gram + 1, self.length - self.gram + 1
        if len(values) < self.length:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        sums = self.unit_hash.sums(values)
        grams = mix((sums[self.gram :] - sums[: -self.gram]) * self.unit_hash.inverse[:n])
        at = np.unique(least_places(grams, width))
        return at, grams[at].view(np.int64)

    def contexts(self, text: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For anchors: units before, units from the anchor on, and a 128-bit digest of the context's bytes in two halves."""
        if self.words:
            words = text.split()
            text, n = b" ".join(words), len(words)
            edges = np.cumsum([0, *[len(w) + 1 for w in words]])
        else:
            n, edges = len(text), None
        left, right = np.minimum(at, self.length - self.gram), np.minimum(n - at, self.length)
        starts, ends = at - left, at + right
        if self.words:
            starts, ends = edges[starts], edges[ends] - 1
        digests = [hashlib.blake2b(text[a:b], digest_size=16, salt=k.to_bytes(8, "little")).digest() for a, b, k in zip(starts.tolist(), ends.tolist(), left.tolist(), strict=True)]
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return left, right, halves[:, 0], halves[:, 1]


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in every window of ``width``, the first one of equals."""
    n = len(values) - width + 1
    tagged = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = tagged
    blocks = padded.reshape(-1, width)
    head = np.minimum.accumulate(blocks, 1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def removed_runs(spans: list[int]) -> list[tuple[int, int]]:
    """Sorted, merged stretches from [start, end, start, end, ...]."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Repeats:
    """Steps that both substring operators share, over one table of documents.

    Rows with equal id and text are one document; NULL ids come after all others. Texts are worked on once, under the
    first id that has them. ``t1``, ``t2`` are two 64-bit hashes of the text.
    """

    def __init__(self, docs: DataFrame, id: str, text: str, words: bool, length: int, gram: int) -> None:
        self.words, self.length, self.gram = words, length, gram
        self.kind = dict(docs.dtypes)[id]
        self.rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(7), "text")})

    def units(self) -> Callable[[], Units]:
        words, length, gram = self.words, self.length, self.gram
        return lambda: Units(words, length, gram)

    def marked(self) -> DataFrame:
        """(doc_id, t1, t2, n, whole, hashes, places): units, digest of the unchanged result, anchors."""
        new = self.units()

        def make():
            units = new()

            def step(batch):
                for part in slices(batch):
                    out = {"n": [], "whole": [], "hashes": [], "places": []}
                    for text in part.column("text").cast(pa.binary()).to_pylist():
                        values = units.row(text)[0]
                        at, hashes = units.anchors(values)
                        for name, value in (("n", len(values)), ("whole", hashlib.sha256(b" ".join(text.split()) if units.words else text).hexdigest()), ("hashes", hashes), ("places", at.astype(np.int32))):
                            out[name].append(value)
                    yield {**{c: part.column(c) for c in ("doc_id", "t1", "t2")}, **out}

            return step

        return written(map_batches(self.rows, f"doc_id {self.kind}, t1 long, t2 long, n long, whole string, hashes array<long>, places array<int>", make), "marked")

    def copies(self, marked: DataFrame) -> DataFrame:
        """(t1, t2, head, several): first id of every text, and if more than one document has it."""
        key = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
        return marked.groupBy("t1", "t2").agg(F.min(key).alias("_low"), F.max(key).alias("_high")).select("t1", "t2", F.col("_low.doc_id").alias("head"), (F.col("_low") != F.col("_high")).alias("several"))

    def candidates(self, marked: DataFrame, copies: DataFrame) -> DataFrame:
        """(doc_id, t1, t2, text, places, hashes): texts with shared anchors, and these anchors."""
        anchors = marked.select("t1", "t2", F.explode(F.arrays_zip("hashes", "places")).alias("a")).select("t1", "t2", F.col("a.hashes").alias("hash"), F.col("a.places").alias("place"))
        where = F.xxhash64("t1", "t2", "place")
        shared = written(anchors.groupBy("hash").agg(F.min(where).alias("lo"), F.max(where).alias("hi"), F.count("*").alias("n")).filter("lo <> hi").select("hash", "n"), "shared")
        hits = join_dealt(anchors, shared, ["hash"], "n", total_of(shared), "inner").groupBy("t1", "t2").agg(F.collect_set(F.struct("place", "hash")).alias("found"))
        hits = written(hits, "anchors")
        heads = hits.join(copies, ["t1", "t2"]).select("t1", "t2", "head", "found")
        texts = self.rows.join(heads, ["t1", "t2"]).filter(F.col("doc_id").eqNullSafe(F.col("head")))
        texts = texts.withColumn("_nth", F.row_number().over(Window.partitionBy("t1", "t2").orderBy("t1"))).filter("_nth = 1")  # rows may repeat
        return written(texts.select("doc_id", "t1", "t2", "text", F.col("found.place").alias("places"), F.col("found.hash").alias("hashes")), "candidates")

    def contexts(self, candidates: DataFrame) -> DataFrame:
        """(doc_id, t1, t2, hash, place, before, after, d1, d2): one row per shared anchor."""
        new = self.units()

        def make():
            units = new()

            def step(batch):
                for part in slices(batch):
                    out = {c: [] for c in ("doc_id", "t1", "t2", "hash", "place", "before", "after", "d1", "d2")}
                    whose = [part.column(c).to_pylist() for c in ("doc_id", "t1", "t2")]
                    for i, (text, places, hashes) in enumerate(zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("places"), part.column("hashes"), strict=True)):
                        at = places.values.to_numpy().astype(np.int64)
                        left, right, d1, d2 = units.contexts(text, at)
                        for name, value in (("hash", hashes.values.to_numpy()), ("place", at), ("before", left), ("after", right), ("d1", d1), ("d2", d2)):
                            out[name].append(value)
                        for name, column in zip(("doc_id", "t1", "t2"), whose, strict=True):
                            out[name] += [column[i]] * len(at)
                    for name in ("hash", "place", "before", "after", "d1", "d2"):
                        out[name] = np.concatenate(out[name])
                    yield out

            return step

        ddl = f"doc_id {self.kind}, t1 long, t2 long, hash long, place int, before int, after int, d1 long, d2 long"
        return written(map_batches(candidates, ddl, make), "contexts")

    def distinct(self, contexts: DataFrame) -> DataFrame:
        """(d1, d2, n, hash, before, after, several, doc_id, t1, t2, place): every context once, with its first place."""
        order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t1", "t2", "place")
        found = contexts.groupBy("d1", "d2").agg(F.min(order).alias("low"), F.max(order).alias("high"), F.min("hash").alias("hash"), F.min("before").alias("before"), F.min("after").alias("after"), F.count("*").alias("n"))
        return written(found.select("d1", "d2", "n", "hash", "before", "after", (F.col("low") != F.col("high")).alias("several"), "low.doc_id", "low.t1", "low.t2", "low.place"), "distinct")

    def compared(self, distinct: DataFrame, hot: int) -> DataFrame:
        """Distinct contexts whose anchor has others, with ``many``: whether it has more than ``hot``."""
        groups = distinct.groupBy("hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("hash", (F.col("_n") > hot).alias("many"))
        return distinct.select("d1", "d2", "hash", "before", "after", "t1", "t2", "place").join(groups, "hash")

    def fetched(self, wanted: DataFrame, candidates: DataFrame) -> DataFrame:
        """Distinct contexts with their units: (d1, d2, hash, place, before, many, doc_id, t1, left, right), bytes or words joined by a blank.

        wanted: rows of ``distinct`` with ``many``, whether their anchor has very many contexts.
        """
        by_text = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("d1", "d2", "hash", "place", "before", "after", "many")).alias("wanted"))
        new = self.units()

        def make():
            units = new()

            def step(batch):
                for part in slices(batch, 1 << 18):
                    out = {c: [] for c in ("d1", "d2", "hash", "place", "before", "many", "doc_id", "t1", "left", "right")}
                    for doc, t1, text, own in zip(part.column("doc_id").to_pylist(), part.column("t1").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), part.column("wanted").to_pylist(), strict=True):
                        pieces = text.split() if units.words else None
                        for c in own:
                            at = c["place"]
                            start, end = at - c["before"], at + c["after"]
                            cut = (lambda a, b: b" ".join(pieces[a:b])) if units.words else (lambda a, b: text[a:b])
                            for name, value in (*((k, c[k]) for k in ("d1", "d2", "hash", "place", "before", "many")), ("doc_id", doc), ("t1", t1), ("left", cut(start, at)), ("right", cut(at, end))):
                                out[name].append(value)
                    if out["d1"]:
                        yield out

            return step

        ddl = f"d1 long, d2 long, hash long, place int, before int, many boolean, doc_id {self.kind}, t1 long, left binary, right binary"
        return map_batches(candidates.select("doc_id", "t1", "t2", "text").join(by_text, ["t1", "t2"]), ddl, make)

    def judged(self, spans: DataFrame, candidates: DataFrame) -> DataFrame:
        """(t1, t2, n_removed, n_spans, digest, spans) of texts with spans (t1, t2, start, end)."""
        by_text = spans.groupBy("t1", "t2").agg(F.flatten(F.collect_set(F.array("start", "end"))).alias("ends"))
        new = self.units()
        ddl = "t1 long, t2 long, n_removed long, n_spans long, digest string, spans array<int>"

        def make():
            units = new()

            def step(batch):
                for part in slices(batch):
                    out = {c: [] for c in ("n_removed", "n_spans", "digest", "spans")}
                    for text, ends in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("ends").to_pylist(), strict=True):
                        runs = removed_runs(ends)
                        pieces = text.split() if units.words else text
                        rest, last = [], 0
                        for start, end in [*runs, (len(pieces), len(pieces))]:
                            rest.append(pieces[last:start])
                            last = end
                        kept = b" ".join([w for ws in rest for w in ws]) if units.words else b"".join(rest)
                        for name, value in (("n_removed", sum(b - a for a, b in runs)), ("n_spans", len(runs)), ("digest", hashlib.sha256(kept).hexdigest()), ("spans", [x for r in runs for x in r])):
                            out[name].append(value)
                    yield {"t1": part.column("t1"), "t2": part.column("t2"), **out}

            return step

        return map_batches(candidates.select("t1", "t2", "text").join(by_text, ["t1", "t2"]), ddl, make)


    def result(self, marked: DataFrame, copies: DataFrame, judged: DataFrame, id: str, first_stays: bool) -> DataFrame:
        """Per row: (id, n, n_removed, n_spans, kept_sha256, spans). Copies of a text go whole; its first document does unless it stays."""
        gone = F.coalesce("several", F.lit(False)) & (F.col("n") >= self.length)
        if first_stays:
            gone = gone & ~F.col("doc_id").eqNullSafe(F.col("head"))
        nothing = hashlib.sha256(b"").hexdigest()

        def pick(all_gone, some, none):
            return F.when(gone, all_gone).when(F.col("n_removed").isNotNull(), some).otherwise(none)

        joined = marked.select("doc_id", "t1", "t2", "n", "whole").join(copies, ["t1", "t2"], "left").join(judged, ["t1", "t2"], "left")
        return joined.select(
            F.col("doc_id").alias(id), "n",
            pick(F.col("n"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
            pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
            pick(F.lit(nothing), F.col("digest"), F.col("whole")).alias("kept_sha256"),
            pick(F.array(F.lit(0), F.col("n").cast("int")), F.col("spans"), F.array().cast("array<int>")).alias("spans"),
        )
