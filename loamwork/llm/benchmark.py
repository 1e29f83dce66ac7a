"""Benchmark passages in documents: a prefix-filtered join of item windows with document words."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import carried, map_batches, raw_texts, slices, with_carried, written

#: Bytes of item text in one broadcast index; more items make more blocks.
BLOCK_BYTES = 16 << 20

#: Buckets of word frequencies, and words whose bucket a task remembers; the memory is emptied when it is full.
BUCKETS, REMEMBERED = 1 << 20, 300_000

#: Word bytes: digits, letters (A-Z lowered) and everything beyond ASCII; all others become blanks.
WORD_TABLE = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))

FOUND = "doc_id {id}, text string, n_words long, n_hit long, spans array<int>, items array<{item}>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


class WindowIndex:
    """Windows of items by their rarest word, in flat arrays of about 20 bytes a window.

    A document holds a window only if it holds all its words, so one prefix token is enough (the prefix length of a
    containment of 1). Its place in the window gives the positional bound, the window's length the length bound.
    """

    def __init__(self, items: list[tuple[object, bytes]], width: int, often: np.ndarray) -> None:
        """often: documents by bucket of a word (see ``bucket``)."""
        vocabulary: dict[bytes, int] = {}
        rows, self.keys = [], [key for key, _ in items]
        for _, text in items:
            rows.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int32))
        self.vocabulary, self.words = vocabulary, np.concatenate([*rows, np.full(width, -1, np.int32)])
        names = list(vocabulary)
        by_rarity = sorted(range(len(names)), key=lambda i: (often[bucket(names[i])], names[i]))
        rank = np.empty(len(names) + 1, np.int64)
        rank[by_rarity], rank[-1] = np.arange(len(names)), len(names)  # the last entry stands for the end of the row
        starts, offsets, lengths, owners, base = [], [], [], [], 0
        for k, row in enumerate(rows):
            if len(row):
                size = min(width, len(row))
                views = np.lib.stride_tricks.sliding_window_view(rank[row], size)
                offsets.append(views.argmin(1).astype(np.int32))
                starts.append(np.arange(base, base + len(views), dtype=np.int32))
                lengths.append(np.full(len(views), size, np.int32))
                owners.append(np.full(len(views), k, np.int32))
            base += len(row)
        empty = np.empty(0, np.int32)
        self.start, self.offset, self.length, self.owner = (np.concatenate(x) if x else empty for x in (starts, offsets, lengths, owners))
        rare = self.words[self.start + self.offset]
        order = np.argsort(rare, kind="stable")
        self.start, self.offset, self.length, self.owner = (x[order] for x in (self.start, self.offset, self.length, self.owner))
        self.first = np.searchsorted(rare[order], np.arange(len(names) + 1))

    def parts(self) -> dict:
        """Plain values: a broadcast is unpickled where this package may be missing."""
        return self.__dict__

    @classmethod
    def of(cls, parts: dict) -> WindowIndex:
        index = cls.__new__(cls)
        index.__dict__.update(parts)
        return index

    def search(self, texts: list[list[bytes]], room: int = 1 << 20) -> list[tuple[list[int], list]]:
        """For every text, given as its words: covered stretches as [start, end, start, end, ...], and the items.

        All texts are searched in one row, parted by a word of no item. Pairs of a word and a window that it may be the
        rarest word of are compared word by word, about ``room`` at once.
        """
        get = self.vocabulary.get
        row = np.array([get(w, -1) for words in texts for w in (*words, None)], np.int64)
        begins = np.cumsum([0, *[len(words) + 1 for words in texts]])
        sizes = np.where(row >= 0, self.first[row + 1] - self.first[row], 0) if len(self.start) else np.zeros(len(row), np.int64)
        at = np.flatnonzero(sizes)
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        ends = np.cumsum(sizes[at])
        done = 0
        while done < len(at):
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + room, side="right")))
            own = at[done:upto]
            n = sizes[own]
            window = np.repeat(self.first[row[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            start = np.repeat(own, n) - self.offset[window]
            fits = (start >= 0) & (start + self.length[window] <= len(row))
            start, window = start[fits], window[fits]
            for k in range(int(self.length.max())):
                inside = np.minimum(start + k, len(row) - 1)
                same = (k >= self.length[window]) | (row[inside] == self.words[self.start[window] + k])
                start, window = start[same], window[same]
            text = np.searchsorted(begins, start, side="right") - 1
            for i, a, w in zip(text.tolist(), (start - begins[text]).tolist(), window.tolist(), strict=True):
                spans[i].append((a, a + int(self.length[w])))
                items[i].add(self.keys[self.owner[w]])
            done = upto
        return [(merged(set(s)), list(i)) for s, i in zip(spans, items, strict=True)]


def merged(stretches) -> list[int]:
    """Union of (start, end) stretches as [start, end, start, end, ...]."""
    spans: list[int] = []
    for start, end in sorted(stretches):
        if spans and start <= spans[-1]:
            spans[-1] = max(spans[-1], end)
        else:
            spans += [start, end]
    return spans


def bucket(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


def word_frequencies(docs: DataFrame, items: DataFrame) -> np.ndarray:
    """Documents by bucket of their words, for the buckets that item words have: one pass over items and documents.

    The counts only order the words of a window, so words that share a bucket do no harm; both arrays have a fixed size.
    """

    def item_buckets():
        def step(batch):
            for part in slices(batch):
                yield {"k": list({bucket(w) for t in raw_texts(part) for w in words_of(t)})}

        return step

    found = map_batches(items.select("text"), "k int", item_buckets).distinct().collect()  # BUCKETS at most
    wanted = np.zeros(BUCKETS, bool)
    wanted[[r["k"] for r in found]] = True
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def make():
        wanted, known = shared.value, {}

        def place(word: bytes) -> int:
            if len(known) >= REMEMBERED:
                known.clear()
            k = bucket(word)
            known[word] = k = k if wanted[k] else -1
            return k

        def step(batch):
            counts = np.zeros(BUCKETS, np.int64)
            for part in slices(batch):
                for text in raw_texts(part):
                    words = set(words_of(text))
                    own = [known[w] if w in known else place(w) for w in words]
                    counts[np.unique([k for k in own if k >= 0]).astype(np.int64)] += 1
            at = np.flatnonzero(counts)
            yield {"k": at, "n": counts[at]}

        return step

    often = np.zeros(BUCKETS, np.int64)
    rows = map_batches(docs.select("text"), "k int, n long", make).groupBy("k").agg(F.sum("n").alias("n")).collect()  # BUCKETS at most
    for r in rows:
        often[r["k"]] = r["n"]
    shared.destroy()
    return often


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 10, carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: (id, n_words, n_hit, items, spans[, text, carried]): words inside an occurrence of an item window, and those items.

    NULL and empty texts have no words and no hits; items without words have no window; items that repeat count once
    by their id, items with NULL id are left out. Every row has its own result, whatever repeats; ids may be NULL. Without
    items nothing is hit, without documents there are no rows; texts are read whole, whatever their length. Columns named in ``carry`` come along in a struct. Documents are read in place and never
    shuffled.

    Items are dealt into blocks of about ``block_bytes`` of text, whatever their ids, so that each broadcast index has a
    bound (about four times its text); every block passes over all documents and adds to what the blocks before it found.
    Word frequencies come from one pass for all blocks.
    """
    kinds = dict(docs.dtypes)[id], dict(items.dtypes)[item_id]
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), *carried(docs, carry))
    listed = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).filter("item_id is not null and text is not null")
    total = listed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = total // block_bytes + 1
    dealt = listed.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    schema = with_carried(FOUND.format(id=kinds[0], item=kinds[1]), rows)
    often = word_frequencies(rows, listed) if total else np.zeros(BUCKETS, np.int64)

    def passed(found: DataFrame, block: int) -> DataFrame:
        own = [(r["item_id"], r["text"].encode()) for r in dealt.filter(F.col("block") == block).collect()]
        index = rows.sparkSession.sparkContext.broadcast(WindowIndex(own, width, often).parts())

        def make():
            by_word = WindowIndex.of(index.value)

            def step(batch):
                for part in slices(batch):
                    split = [words_of(t) for t in raw_texts(part)]
                    new = by_word.search(split)
                    if block:
                        before = zip(part.column("spans").to_pylist(), part.column("items").to_pylist(), strict=True)
                        new = [(merged([*zip(s[::2], s[1::2]), *zip(b[::2], b[1::2])]), list({*i, *o})) for (s, i), (b, o) in zip(new, before, strict=True)]
                    yield {
                        **{c: part.column(c) for c in ("doc_id", "text", "carried") if c in schema.names},
                        "n_words": [len(w) for w in split], "n_hit": [sum(s[1::2]) - sum(s[::2]) for s, _ in new],
                        "spans": [s for s, _ in new], "items": [i for _, i in new],
                    }

            return step

        return map_batches(found, schema, make)

    found = passed(rows, 0)
    for block in range(1, blocks):
        found = passed(written(found, "contamination"), block)
    return found.select(F.col("doc_id").alias(id), "n_words", "n_hit", F.array_sort("items").alias("items"), "spans", *(["text", "carried"] if carry else []))
