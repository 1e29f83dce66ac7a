"""Packing of tokenised documents into sequences, planned on the histogram of lengths."""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import map_batches, ranked, slices

#: Distinct chunks a task remembers; the memory is emptied when it is full.
REMEMBERED = 300_000

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, ids binary"


class ByteBpe:
    """Ids of a byte-level BPE file of ``tokenizers`` as little-endian 32-bit words, chunk by chunk with a memory.

    A chunk is a text between two blanks, with the blank before it. The splitting pattern cuts before a blank that
    stands alone, so chunks have their ids on their own; texts where blanks meet other white space, or that hold a
    special token, go to the library whole. New chunks of plain Latin letters use the rank file of the same
    vocabulary, which is faster; all others use the library.
    """

    def __init__(self, path: str, ranks: str | None, special: str = "<|endoftext|>") -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = special
        self.hard = re.compile(r" \s|\s ")
        self.known: dict[str, bytes] = {}
        self.quick = None
        if ranks:
            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return b"".join([x.to_bytes(4, "little") for x in ids])

    def library(self, text: str) -> bytes:
        return self.packed(self.whole.encode(text, add_special_tokens=False).ids)

    def learn(self, chunk: str) -> bytes:
        if self.quick is not None and (chunk.isascii() or max(chunk) < "ɐ"):
            ids = self.packed(self.quick.encode_ordinary(chunk))
        else:
            ids = self.library(chunk)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special in text or self.hard.search(text):
            return self.library(text)
        first, *rest = text.split(" ")
        known, learn = self.known, self.learn
        parts = [learn(first)] if first else []
        for x in rest:
            x = " " + x
            parts.append(known.get(x) or learn(x))
        return b"".join(parts)


def tokenised_pieces(docs: DataFrame, path: str, ranks: str | None, room: int, id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``room`` tokens: ids of the text and then id 0. The first piece takes what a cut leaves over."""
    kind = dict(docs.dtypes)[id]

    def make():
        coder = ByteBpe(path, ranks)

        def step(batch):
            for part in slices(batch, 4 << 20):
                out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for key, body in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = coder.encode(body or "") + b"\0\0\0\0"
                    n = len(ids) // 4
                    start, end, k = 0, n % room or room, 0
                    while start < n:
                        piece = ids[4 * start : 4 * end]
                        for name, value in (("doc_id", key), ("piece", k), ("start", start), ("length", end - start), ("ids_crc32", zlib.crc32(piece)), ("ids", piece if keep_ids else None)):
                            out[name].append(value)
                        start, end, k = end, end + room, k + 1
                yield out

        return step

    return map_batches(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), PIECES.format(id=kind), make)


def best_fit_plan(counts: dict[int, int], room: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest first: (length, first rank, end rank, first sequence, per sequence, offset) rows.

    Pieces of one length are alike, so a step places as many as possible at once: into the sequences with the least
    room left that still takes the length, or into new ones. Ranks of a length are dealt out in order.
    """
    plan, open_bins, rooms, sequences = [], {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                size = rooms[at]
                first, n = open_bins[size].pop()
                if not open_bins[size]:
                    del open_bins[size], rooms[at]
            else:
                size, first, n = room, sequences, max(1, left // (room // length))
                sequences += n
            per = min(size // length, left)
            used = min(n, left // per)
            plan.append((length, rank, rank + used * per, first, per, room - size))
            rank, left = rank + used * per, left - used * per
            for rest, start, many in ((size - per * length, first, used), (size, first + used, n - used)):
                if many and rest:
                    if rest not in open_bins:
                        insort(rooms, rest)
                    open_bins.setdefault(rest, []).append((start, many))
    return plan


def pack_best_fit(docs: DataFrame, path: str, ranks: str | None = None, room: int = 2048, id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per piece: (id, piece, start, length, ids_crc32, sequence_id, offset[, ids]); sequences hold ``room`` tokens at most.

    Every row gives one piece at least: NULL and empty texts are the closing id 0 alone. Only texts of more than
    ``room`` tokens are cut, from their end; the first piece may be shorter. Repeated rows and NULL ids are packed like
    all others. No row gives an empty result. Of sequences with equal room any may be taken, and pieces of one length
    are alike: which document stands where among them follows their ids. Only the histogram (``room`` counts at most) reaches the driver; the plan
    has a row per step, not per document, and its width is bounded by the lengths that exist.
    """
    from loamwork.session import cut_lineage

    pieces = cut_lineage(tokenised_pieces(docs, path, ranks, room, id, text, keep_ids))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = "p_length long, p_first long, p_end long, p_sequence long, p_per long, p_offset long"
    plan = docs.sparkSession.createDataFrame(best_fit_plan(counts, room), schema)
    slots = ranked(pieces, ["length"], ["doc_id", "piece"], "_rank")
    place = F.col("_rank") - F.col("p_first")
    hit = (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("p_first")) & (F.col("_rank") < F.col("p_end"))
    # at most a few thousand rows: steps are bounded by pairs of length and room left
    return slots.join(F.broadcast(plan), hit).select(
        F.col("doc_id").alias(id), "piece", "start", "length", "ids_crc32",
        (F.col("p_sequence") + F.floor(place / F.col("p_per"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + (place % F.col("p_per")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
