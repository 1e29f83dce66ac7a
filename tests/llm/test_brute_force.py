"""Fit and decoding of languages, best fit piece by piece, and every stage of the pipeline in plain Python."""

import math
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_corpus import LOW, expected_hits
from test_near_duplicates import expected
from tokenizers import Tokenizer

import corpus_pipeline
from loamwork.llm import language, packing

BPE = public_tokenizers.path("byte_bpe_50k.json")


def gram_counts(text):
    plain = bytes(x if 97 <= x <= 122 or x >= 128 else 32 for x in text.lower().encode())
    row = b"   " + plain + b"   "
    # grams of the text with one blank before and one behind it, and those that begin or end in them
    return [(row[i] | row[i + 1] << 8 | row[i + 2] << 16) * 2654435761 % (1 << 32) >> (32 - language.GRAM_BITS) for i in range(2, 2 + len(plain) + 1)]


def predicted(rows, place):
    """Language and share of every text: rows are (doc_id, text, lang), ``place`` the part of a learned row (0, 1 or none)."""
    def letter(t):
        return t is not None and any(c.isalpha() for c in t)

    learned = [(t, x, place[i]) for i, t, x in rows if x is not None and letter(t) and zlib.crc32(str(i).encode()) % 3 != 1]
    names = sorted({x for _, x, p in learned if p == 0})
    words = language.codewords(len(names)).tolist()
    size, counts = 1 << language.GRAM_BITS, {x: Counter() for x in names}
    for t, x, p in learned:
        if p == 0:
            counts[x].update(gram_counts(t))
    shares = {x: (sum(c.values()) + 0.5 * size, c) for x, c in counts.items()}

    def rate(bit, gram):
        sides = {1: [], -1: []}
        for k, x in enumerate(names):
            total, own = shares[x]
            sides[words[k][bit]].append((own[gram] + 0.5) / total)
        return math.log((sum(sides[1]) / len(sides[1])) / (sum(sides[-1]) / len(sides[-1])))

    known = {}

    def margins(text):
        grams, out = gram_counts(text), []
        for bit in range(len(words[0])):
            total = 0.0
            for g in grams:
                if (bit, g) not in known:
                    known[bit, g] = float(np.float32(rate(bit, g)))
                total += known[bit, g]
            out.append(total / math.sqrt(len(grams)))
        return out

    right = [[1.0] * len(words[0]) for _ in names]
    seen = [2.0] * len(names)
    for t, x, p in learned:
        if p == 1 and x in names:
            k = names.index(x)
            seen[k] += 1
            for bit, m in enumerate(margins(t)):
                right[k][bit] += m * words[k][bit] > 0
    weights = [[r / seen[k] for r in own] for k, own in enumerate(right)]
    weights = [[w / sum(own) for w in own] for own in weights]
    out = []
    for i, t, _ in rows:
        if not letter(t):
            out.append((i, "und", 0.0))
            continue
        own = margins(t)
        losses = [sum(w * math.log1p(math.exp(-m * c)) if -m * c < 30 else w * -m * c for m, c, w in zip(own, words[k], weights[k], strict=True)) for k in range(len(names))]
        best = min(range(len(names)), key=losses.__getitem__)
        out.append((i, names[best], 1 / sum(math.exp((losses[best] - x) * len(own)) for x in losses)))
    return out


def parts_of(docs, sample=2000):
    """Which rows the operator draws, by its rule for small languages: halves of the hash of the id."""
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id", F.length("text")), F.lit(language.PARTS))
    return {r["doc_id"]: 0 if r["p"] < language.PARTS // 2 else 1 for r in docs.select("doc_id", place.alias("p")).collect()}


def test_languages_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], (r["text"] or "")[:1500], r["lang"]) for r in docs.collect()]
    rows += [(10_001, "12 !!", "en"), (10_002, None, "fr"), (10_003, "é", None), (10_004, "abc def", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = predicted(rows, parts_of(table))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(table).collect()}
    assert len(found) == len(want)
    for i, name, score in want:
        assert found[i][0] == name and abs(found[i][1] - score) < 1e-6


def test_a_sample_is_bounded(spark):
    labelled = spark.range(40_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "if(id % 4 = 0, 'a', 'b') AS lang")
    for part in (0, 1):
        counts = {r["lang"]: r["count"] for r in language.sampled(labelled, {"a": 10_000, "b": 30_000}, part, 500).groupBy("lang").count().collect()}
        assert all(400 < n < 600 for n in counts.values())
    both = [language.sampled(labelled, {"a": 10_000, "b": 30_000}, p, 9_000).select("doc_id") for p in (0, 1)]
    assert both[0].join(both[1], "doc_id").count() == 0 and both[0].count() < 5_300 + 9_600
    huge = language.sampled(labelled, {"a": 4 * 10**12, "b": 4 * 10**12}, 0, 2_000)
    assert huge.count() == 0  # the share of so large a language is a few of 2**40 parts, not a millionth


def sequences_piece_by_piece(lengths, room):
    """Best fit, the longest first, one piece at a time: the fullest sequence that still takes it."""
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(rooms, length)
        if at < len(rooms):
            left = rooms.pop(at) - length
        else:
            left, n = room - length, n + 1
        insort(rooms, left)
    return n


def test_plan_needs_as_many_sequences_as_best_fit_piece_by_piece():
    draw = random.Random(4)
    for _ in range(300):
        room = draw.choice([8, 50, 2048])
        lengths = [draw.randint(1, draw.choice([3, room // 3 + 1, room])) for _ in range(draw.choice([1, 20, 400]))]
        lengths += [draw.randint(1, room)] * draw.choice([0, 50])
        plan = packing.best_fit_plan(Counter(lengths), room)
        used = max(first + -(-(end - rank) // per) for _, rank, end, first, per, _ in plan)
        assert used == sequences_piece_by_piece(lengths, room)


def kept_lines(rows, least):
    """Dropped lines and the text left, by id."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    counts = Counter(k for _, t in rows for k in {key(x) for x in t.split("\n")})
    out = {}
    for i, t in rows:
        split = t.split("\n")
        kept = [x for x in split if not key(x) or counts[key(x)] < least]
        out[i] = len(split) - len(kept), "\n".join(kept)
    return out


def test_every_stage_of_the_pipeline(spark, small):
    """Each stage on what the one before kept, held against plain Python."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]

    def texts(df):
        assert df.columns == docs.columns
        return sorted((r["doc_id"], r["text"]) for r in df.collect())

    first = stages["language_id"](spark, docs, small).cache()
    named = {i: (x, s) for i, x, s in predicted(rows, parts_of(docs))}
    assert texts(first) == sorted((i, t) for i, t, _ in rows if named[i][0] != "und" and named[i][1] >= 0.5)

    second = stages["line_dedup"](spark, first, small).cache()
    kept = kept_lines(texts(first), 10)
    want = [(i, kept[i][1]) for i, t in texts(first) if kept[i][0] == 0 or kept[i][1].strip(" \t\n\x0b\x0c\r")]
    assert texts(second) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in second.collect() if kept[r["doc_id"]][0])

    third = stages["minhash_near_dedup"](spark, second, small).cache()
    stay = {i for i, _, _, own in expected(texts(second)) if own}
    assert texts(third) == [(i, t) for i, t in texts(second) if i in stay]

    fourth = stages["benchmark_decontamination"](spark, third, small).cache()
    hit = {r[0] for r in expected_hits(texts(third), items) if r[2]}
    assert texts(fourth) == [(i, t) for i, t in texts(third) if i not in hit] and hit

    coder, room = Tokenizer.from_file(BPE), 2048
    lengths = {i: len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts(fourth)}
    last = stages["best_fit_packing"](spark, fourth, small).collect()
    pieces = [n for total in lengths.values() for n in [total % room or room] + [room] * ((total - 1) // room)]
    assert sorted(r["length"] for r in last) == sorted(pieces)
    assert {i: sum(r["length"] for r in last if r["doc_id"] == i) for i in lengths} == lengths
    assert len({r["sequence_id"] for r in last}) == sequences_piece_by_piece(pieces, room)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in whole] == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in last)
