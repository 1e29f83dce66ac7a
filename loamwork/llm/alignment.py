"""Alignment of two tokenizers over a corpus: every distinct text once, pair counts weighted by its copies."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import arrow_schema, join_dealt, map_batches, slices, written

#: Bytes of text that are aligned at once, about.
SLICE = 1 << 20

#: The mark that stands for a blank in the pieces of the second tokenizer.
MARK = "▁"


def byte_level() -> dict[str, int]:
    """Byte of every character of a byte-level vocabulary: printable bytes are themselves, the others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Token ids of both tokenizers for whole texts, and their common byte ends."""

    def __init__(self, bpe: str, ranks: str | None, pieces: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bpe)
        self.a.encode_special_tokens = True
        self.quick = None
        if ranks:
            import public_tokenizers
            import tiktoken

            table = {base64.b64decode(x): int(y) for x, y in map(bytes.split, open(ranks, "rb"))}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        to_byte, names = byte_level(), {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        b_names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_tokens = [bytes(to_byte.get(c, 63) for c in names.get(i, "?")) for i in range(max(names) + 1)]
        self.b_tokens = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(b_names)]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_tokens, self.b_tokens))
        #: an id's number in decimal, followed by what stands behind it: inside and at the end of its side of a group
        self.words = [b"%d%s" % (i, c) for n, ends in ((len(self.a_tokens), b",|"), (len(self.b_tokens), b",;")) for i in range(n) for c in (ends[:1], ends[1:])]

    def encoded(self, text: str) -> list[int]:
        """Ids of blank + text. Latin texts without very long words take the rank file of the same vocabulary, which is faster."""
        if self.quick is not None and (text.isascii() or max(text) < "ɐ") and max(map(len, text.split()), default=0) < 2000:
            return self.quick.encode_ordinary(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def texts(self, texts: list[str]) -> dict[str, list]:
        """Counts, pair codes and digests of whole texts; zeros, no pairs and an empty digest where bytes are lost."""
        out = {"n_a": [0] * len(texts), "n_b": [0] * len(texts), "n_groups": [0] * len(texts), "pairs": [np.empty(0, np.int64)] * len(texts), "groups_sha256": [""] * len(texts)}
        for i, (text, b) in enumerate(zip(texts, self.b.encode(texts, num_threads=1), strict=True)):
            a, whole = self.encoded(text), b" " + text.encode()
            if b"".join(map(self.a_tokens.__getitem__, a)) == whole == b"".join(map(self.b_tokens.__getitem__, b)):
                pairs, groups = self.aligned(np.array(a, np.int64), np.array(b, np.int64))
                for name, value in (("n_a", len(a)), ("n_b", len(b)), ("n_groups", len(pairs)), ("pairs", pairs), ("groups_sha256", hashlib.sha256(groups).hexdigest())):
                    out[name][i] = value
        return out

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Codes a * 2**32 + b of the ids that end together, and the groups as text. Tokens are not empty, so one of each ends there."""
        ends_a, ends_b = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        place = np.searchsorted(ends_b, ends_a)
        last_a = ends_b[place] == ends_a
        at_a, at_b = np.flatnonzero(last_a), place[last_a]
        last_b = np.zeros(len(b), bool)
        last_b[at_b] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        # in the text, a group's ids of a follow all of b in the groups before, its ids of b follow its ids of a
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + at_a[group_b] + 1] = 2 * (len(self.a_tokens) + b) + last_b
        return (a[at_a] << 32) + b[at_b], b"".join(map(self.words.__getitem__, order.tolist()))[:-1]


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with the sums of their counts."""
    own, place = np.unique(codes, return_inverse=True)
    return own, np.bincount(place, counts, len(own)).astype(np.int64)


def measured(texts: DataFrame, bpe: str, ranks: str | None, pieces: str) -> DataFrame:
    """Rows of two kinds: (key, n, n_a, n_b, n_groups, groups_sha256, links) for a text, (pairs, counts) for a task.

    texts(key, text, n): distinct texts with their copies. ``links`` are pair codes, eight bytes each; a task's counts
    are weighted by ``n``. They are held in the task, bounded by the vocabularies (see ``corpus_measures``).
    """
    ddl = "key binary, n long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pairs array<long>, counts array<long>"
    schema = arrow_schema(ddl)

    def run(batches):
        aligner, pairs, counts = Aligner(bpe, ranks, pieces), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for part in slices(batch, SLICE):
                found = aligner.texts(part.column("text").to_pylist())
                own = found.pop("pairs")
                weights = np.repeat(part.column("n").to_numpy(), [len(x) for x in own])
                pairs, counts = summed(np.concatenate((pairs, *own)), np.concatenate((counts, weights)))
                row = {"key": part.column("key"), "n": part.column("n"), **found, "links": [x.tobytes() for x in own], "pairs": [None] * len(own), "counts": [None] * len(own)}
                yield pa.RecordBatch.from_pydict(row, schema=schema)
        if len(pairs):
            yield pa.RecordBatch.from_pydict({**{name: [None] for name in schema.names}, "pairs": [pairs], "counts": [counts]}, schema=schema)

    return texts.mapInArrow(run, ddl)


def corpus_measures(aligned: DataFrame) -> DataFrame:
    """(key, n, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): links weighed by the counts of the corpus.

    The counts are broadcast: of two tokens that end together one is the end of the other, so there are no more
    pairs than bytes in both vocabularies (twice, if single bytes have two ids), whatever the corpus.
    """
    spark = aligned.sparkSession
    each = aligned.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")).toArrow()
    pairs, counts = totals.column("pair").to_numpy(), totals.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    by_b = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)[1]
    most = np.zeros(by_b.max(initial=-1) + 1, np.int64)
    np.maximum.at(most, by_b, counts)
    table = spark.sparkContext.broadcast((pairs, counts, (counts == most[by_b]).astype(np.int64)))

    def make():
        pairs, counts, best = table.value

        def step(batch):
            links = [np.frombuffer(x, np.int64) for x in batch.column("links").to_pylist()]
            lengths = np.array([len(x) for x in links], np.int64)
            at = np.searchsorted(pairs, np.concatenate(links)) if lengths.sum() else np.empty(0, np.int64)
            ends = np.concatenate(([0], np.cumsum(lengths)))

            def summed(values):
                running = np.concatenate(([0], np.cumsum(values[at]))) if len(at) else np.zeros(1, np.int64)
                return running[ends[1:]] - running[ends[:-1]]

            yield {**{c: batch.column(c) for c in ("key", "n", "n_a", "n_b", "n_groups", "groups_sha256")}, "n_links": lengths, "n_best": summed(best), "count_sum": summed(counts)}

        return step

    ddl = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return map_batches(aligned.filter("key is not null").select("key", "n", "n_a", "n_b", "n_groups", "groups_sha256", "links"), ddl, make)


def align_tokenizers(docs: DataFrame, bpe: str, pieces: str, ranks: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): how two tokenizers cut the texts.

    ``bpe`` (a byte-level file of ``tokenizers``) encodes blank + text, ``pieces`` (a sentencepiece file that adds the blank
    itself) the text, both without special tokens, whose strings are plain text; ``ranks`` may name the ranks of the first
    vocabulary, for speed. Byte offsets where tokens of both end
    cut them into groups; the two tokens that end there are linked. The count of a pair of ids is the number of its
    links in all rows, copies included; a link is best if no other pair of its second id has a higher count.

    NULL and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and an
    empty digest; they count for no pair. Rows are what they are: repeated ids and NULL ids get a row each, equal texts the
    same measures. An empty table gives no rows. A text is encoded whole, whatever its length.

    Texts are shuffled once, as the key of an aggregate that combines copies before the shuffle; each distinct text is
    tokenised and aligned once. Its pairs count as often as it has copies. Measures find their documents by the digest
    of the text, with the rows of hot texts dealt out.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("key")
    distinct = rows.filter(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("n")).select(digest, "text", "n")
    measures = written(corpus_measures(written(measured(distinct, bpe, ranks, pieces), "aligned")), "measures")
    keyed = rows.select("doc_id", F.when(F.length("text") > 0, digest).alias("key"))
    found = join_dealt(keyed, measures, ["key"], "n", keyed.count())
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return found.select(F.col("doc_id").alias(id), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
