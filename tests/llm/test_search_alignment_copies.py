"""Ranked search, tokenizer alignment and exact copies against plain Python on small, odd and long tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from loamwork.llm import alignment, copies, queries, search
from loamwork.llm.common import join_dealt

BPE, PIECES, RANKS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# search


def ranked(docs, items, top=10):
    """docs and items: (id, text) rows."""
    words = [[w.translate(LOW) for w in TERM.findall(t or "")] for _, t in docs]
    n, total = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    terms = defaultdict(set)
    for key, text in items:
        if key is not None:
            terms[key] |= {w.translate(LOW) for w in TERM.findall(text or "")}
    out = []
    for key, own in terms.items():
        scores = []
        for (doc, _), w in zip(docs, words, strict=True):
            counts, score = Counter(w), 0
            for t in own & set(counts):
                m = 10 + (90 * len(w) * n) // total
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(key, i + 1, doc, -score) for i, (score, _, doc) in enumerate(scores[:top])]
    return sorted(out, key=str)


def test_search_of_the_small_table(spark, small, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert rows_of(queries.op11_ranked_search(spark, small)) == ranked(texts, items)


def test_search_on_odd_rows(spark, odd, none):
    items = [(1, "one TWO three"), (1, "漢字"), (2, None), (3, "!!"), (None, "one"), (4, "0123456789 id here"), (5, "zzz")]
    wanted = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(search.ranked_search(odd, wanted)) == ranked(docs, items)
    assert search.ranked_search(none, wanted).count() == 0
    assert search.ranked_search(odd, wanted.limit(0)).count() == 0


def test_search_with_ties_hot_terms_and_many_blocks(spark, monkeypatch):
    """Thresholds and pruning against all scores: copies that tie at the last rank, terms in all documents, small blocks."""
    monkeypatch.setattr(search, "BLOCK", 16)
    monkeypatch.setattr(search, "ITEMS", 3)
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    chances = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(draw.choices(vocabulary, chances, k=draw.choice([3, 20, 60])))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(200)]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices(vocabulary, k=12) + draw.choices(vocabulary, chances, k=12))) for i in range(20)] + [(99, docs[5][1])]
    found = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"), owners=(0.01, 0.05, 0.3))
    assert rows_of(found) == ranked(docs, items)


def test_search_leaves_accumulators_behind(spark, monkeypatch):
    """Ten documents with an item's rare words rule out all those that hold its frequent one only."""
    kept = []
    stage = search.owner_stage
    monkeypatch.setattr(search, "owner_stage", lambda *a: kept.append(stage(*a)) or kept[-1])
    docs = [(i, f"common filler{i}" + (" rare words here" if i < 10 else "")) for i in range(2000)]
    items = spark.createDataFrame([(1, "rare words here common")], "item_id long, text string")
    found = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(10))
    assert sum(len(r["scores"]) // 8 for r in kept[-1].collect()) == 10


# alignment


def token_bytes():
    bpe, pieces = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    bpe.encode_special_tokens = True
    names = alignment.byte_level()

    def a(text):
        ids = bpe.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(names[c] for c in bpe.id_to_token(i)) for i in ids]

    def b(text):
        ids = pieces.encode(text)
        names = [pieces.id_to_piece(i) for i in ids]
        return ids, [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, names, strict=True)]

    return a, b


def aligned(docs):
    """Whole texts through both libraries, text by text, in plain Python."""
    a, b = token_bytes()
    links, rows, counts = [], [], Counter()
    for _, text in docs:
        own, groups, n_a, n_b = [], [], 0, 0
        if text:
            (ids_a, bytes_a), (ids_b, bytes_b) = a(text), b(text)
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = [0], [0]
                for ends, parts in ((ends_a, bytes_a), (ends_b, bytes_b)):
                    for x in parts:
                        ends.append(ends[-1] + len(x))
                place_b = {e: j for j, e in enumerate(ends_b)}
                n_a, n_b, last = len(ids_a), len(ids_b), (0, 0)
                for i, e in enumerate(ends_a[1:], 1):
                    if e in place_b:
                        j = place_b[e]
                        own.append((ids_a[i - 1], ids_b[j - 1]))
                        groups.append(",".join(map(str, ids_a[last[0] : i])) + "|" + ",".join(map(str, ids_b[last[1] : j])))
                        last = (i, j)
        links.append(own)
        counts.update(own)
        rows.append((n_a, n_b, len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((doc, *r[:4], sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), r[4]) for (doc, _), r, own in zip(docs, rows, links, strict=True)), key=str)


def test_alignment_of_the_small_table(spark, small, texts):
    assert rows_of(queries.op12_tokenizer_alignment(spark, small)) == aligned(texts)


def test_alignment_on_odd_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(alignment.align_tokenizers(odd, BPE, PIECES, RANKS)) == aligned(docs)
    assert alignment.align_tokenizers(none, BPE, PIECES, RANKS).count() == 0


def test_alignment_of_white_space_marks_bytes_and_long_texts(spark):
    docs = [
        (1, " "), (2, "   two  blanks "), (3, "tab\tand\n new  line\r\n"), (4, "a ▁ mark"), (5, "<s> </s> <unk> <0x0A> <|endoftext|> [x]"),
        (6, "naïve 漢字 😀 ‍ \x00 \x1c x y 　z"), (7, "don't can't I'm"), (8, "x" * 300), (9, "nospace" * 30_000), (10, "some words again " * 70_000), (11, "some words again " * 70_000),
        (12, "▁"), (13, "é é"), (14, " \n \n lines"), (15, "a  "),
    ]
    assert rows_of(alignment.align_tokenizers(spark.createDataFrame(docs, "doc_id long, text string"), BPE, PIECES, RANKS)) == aligned(docs)


def test_alignment_of_random_texts_with_and_without_ranks(spark):
    draw = random.Random(8)
    letters = "ab cd  e\n\t'ß漢 .,1▁"
    docs = [(i, "".join(draw.choices(letters, k=draw.choice([1, 5, 60])))) for i in range(300)]
    docs += [(500 + i, docs[3][1]) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(alignment.align_tokenizers(rows, BPE, PIECES, RANKS)) == rows_of(alignment.align_tokenizers(rows, BPE, PIECES)) == aligned(docs)


# exact copies


def grouped(docs):
    groups = defaultdict(list)
    for doc, text in docs:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc)
    out = []
    for plain, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(plain.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_copies_of_the_small_table(spark, small, texts):
    assert rows_of(queries.op13_exact_dedup(spark, small)) == grouped(texts)


def test_copies_on_odd_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(copies.exact_copies(odd)) == grouped(docs)
    assert copies.exact_copies(none).count() == 0


def test_copies_with_a_hot_text_many_rounds_and_long_texts(spark):
    draw = random.Random(3)
    docs = [(i, draw.choice(["hot  text", "hot text", "hot\ttext", f"own {draw.randrange(400)}", " x", "x", None])) for i in range(3000)]
    docs += [(9000, "long text\n" * 200_000), (9001, "long  text " * 200_000), (9002, "long text " * 200_000)]
    draw.shuffle(docs)
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    expected = grouped(docs)
    for radix, partitions in ((2, 8), (3, 20), (8, 1)):
        assert rows_of(copies.exact_copies(rows, radix=radix, partitions=partitions)) == expected


def test_equal_digests_of_different_texts_stay_apart(spark, monkeypatch):
    """A digest of one byte: only texts that agree in hash and length as well are taken together."""
    whole = copies.digests

    def weak(docs, id, text):
        from pyspark.sql import functions as F

        return whole(docs, id, text).withColumn("digest", F.unhex(F.repeat(F.substring(F.hex("digest"), 1, 2), 32)))

    monkeypatch.setattr(copies, "digests", weak)
    docs = [(i, f"text {i % 700}") for i in range(2100)]
    found = copies.exact_copies(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in found.collect()) == [(i, i % 700, 3) for i in range(2100)]


def test_runs_are_combined_before_every_exchange(spark):
    """A key that stands in all partitions is one row of each run, and every key has one owner at the end."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(4000)], "doc_id long, text string").repartition(10)
    rows = copies.digests(docs, "doc_id", "text")
    first = copies.merged(rows.select(*copies.KEY, F.col("doc_id").alias("head"), F.lit(1).cast("long").alias("n"), F.lit(0).alias("owner"), F.lit(0).alias("place")), "bigint")
    assert first.filter(f"digest = unhex(sha2('same', 256))").count() <= 10
    last = copies.tree_merged(rows, "bigint", 2, 8)
    assert last.count() == last.select("digest").distinct().count() == 4000 // 3 + 2


def test_hot_keys_are_dealt_out(spark):
    from pyspark.sql import functions as F

    rows = spark.range(6000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    sized = rows.groupBy("k").agg(F.count("*").alias("n"))
    found = join_dealt(rows, sized, ["k"], "n", 6000)
    assert sorted((r["v"], r["n"]) for r in found.collect()) == [(v, 3000 if v % 2 == 0 else 1) for v in range(6000)]
    assert found.filter("n is null").count() == 0
