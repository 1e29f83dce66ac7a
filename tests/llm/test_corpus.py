"""Language, shards, decontamination, token counts, lines, packing and the pipeline on small and odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamwork.llm import benchmark, language, lines, packing, shards, tokens

BPE, RANKS, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# language


def test_language_of_held_out_rows(spark, small):
    for sf in (small, small.replace("0.001", "0.01")):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        found = language.identify(docs, carry=["lang"]).collect()
        judged = [(r["lang_pred"], r["carried"]["lang"]) for r in found if r["held_out"] and r["lang_pred"] != "und"]
        assert sum(a == b for a, b in judged) >= 0.97 * len(judged)
        assert {r["doc_id"] for r in found if r["held_out"]} == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
        assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows(spark, odd, none):
    found = language.identify(odd).collect()
    assert len(found) == odd.count()
    by_id = defaultdict(set)
    for r in found:
        by_id[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert by_id[1] == by_id[2] == by_id[9] == {("und", 0.0)}
    assert len(by_id[4]) == 1
    assert language.identify(none).count() == 0
    assert {r["lang_pred"] for r in language.identify(odd.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()} == {"und"}


def test_predictions_ignore_ids_labels_and_neighbours(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    twice = docs.unionByName(docs.selectExpr("doc_id", "text", "lang")).repartition(7)
    seen = defaultdict(set)
    for r in language.identify(twice, carry=["doc_id"]).collect():
        seen[r["text"]].add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in seen.values())


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 30])
def test_codewords_differ(n):
    words = language.codewords(n)
    assert len({tuple(w) for w in words.tolist()}) == n
    if n > 5:
        assert min((words[i] != words[j]).sum() for i in range(n) for j in range(i)) >= words.shape[1] // 4


# shards


def test_one_more_shard_takes_rows_only_into_itself(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = shards.place_in_shards(docs).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shares_follow_weights(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    counts = Counter(r["shard"] for r in shards.place_in_shards(docs, weights=(1, 3, 0, 4)).collect())
    assert counts[2] == 0 and all(math.isclose(counts[s], 20000 * w / 8, rel_tol=0.08) for s, w in ((0, 1), (1, 3), (3, 4)))


def test_shards_of_odd_rows(spark, odd, none):
    found = shards.place_in_shards(odd).collect()
    texts = Counter((len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert Counter((r["size"], r["text_crc32"]) for r in found) == texts
    assert all(len({r["shard"] for r in found if r["doc_id"] == i}) == 1 for i in (None, 4, 7))
    assert shards.place_in_shards(none).count() == 0


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected_hits(rows, items, width=10):
    windows = defaultdict(set)
    for key, text in items:
        words = WORD.findall((text or "").translate(LOW))
        if key is not None and words:
            for i in range(max(1, len(words) - width + 1)):
                windows[tuple(words[i : i + width])].add(key)
    out = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if keys := windows.get(tuple(words[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= keys
        out.append((i, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [8 << 20, 700])
def test_contamination_in_one_block_and_in_many(spark, block_bytes):
    draw = random.Random(3)
    words = ["aa", "bb", "Cc", "dé", "7"]
    some = lambda n: " ".join(draw.choice(words) + draw.choice(["", "", ".", "'x"]) for _ in range(n))
    items = [(i, some(draw.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(80)] + [(3, "aa"), (None, "bb bb"), (90, None)]
    rows = [(i, some(draw.randrange(40)) + " " + draw.choice(items)[1].__str__() + " " + some(draw.randrange(20))) for i in range(60)] + [(None, None), (5, "aa"), (5, "aa"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS items", "1 AS row")
    found = benchmark.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "items")) == expected_hits(rows, items)


def test_contamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "one two"), (2, "漢字")], "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows_of(benchmark.contamination(odd, items).select("doc_id", "n_words", "n_hit", "items")) == expected_hits(rows, [(1, "one two"), (2, "漢字")])
    assert rows_of(benchmark.contamination(odd, items.limit(0)).select("n_hit")) == [(0,)] * len(rows)
    assert benchmark.contamination(none, items).count() == 0


# token counts


def greedy(word, pieces, longest):
    """Pieces of a word by trying the longest first."""
    rest, n = "▁" + word, 0
    while rest:
        for size in range(min(len(rest), longest), 0, -1):
            if rest[:size] in pieces:
                n, rest = n + 1, rest[size:]
                break
        else:
            n, rest = n + len(rest[0].encode()), rest[1:]
    return n


def test_token_counts_of_the_small_table_and_odd_rows(spark, small, texts, odd, none):
    pieces = set(tokens.vocabulary(PIECES))
    longest = max(map(len, pieces))

    def expected(rows):
        out = []
        for i, t in rows:
            words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            out.append((i, len(words), sum(greedy(w, pieces, longest) for w in words)))
        return sorted(out, key=str)

    assert rows_of(tokens.token_counts(spark.read.parquet(f"{small}/documents.parquet"), PIECES)) == expected(texts)
    assert rows_of(tokens.token_counts(odd, PIECES)) == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert tokens.token_counts(none, PIECES).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab▁", min_size=1, max_size=5), min_size=1, max_size=12), st.text("abc", max_size=14))
def test_automaton_equals_greedy(vocabulary, word):
    pieces = vocabulary | {c for p in vocabulary for c in p}
    assert tokens.LongestMatch(sorted(vocabulary)).count("▁" + word) == (greedy(word, pieces, 5) if "▁" in pieces else 3 + greedy(word, pieces | {"▁"}, 5) - 1)


# lines


def expected_lines(rows, least):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        split = (t or "").split("\n")
        kept = [x for x in split if not key(x) or counts[key(x)] < least]
        out.append((i, len(split), len(split) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_lines(spark, odd, none):
    draw = random.Random(9)
    pool = ["", " ", "Shared", "shared ", "\tSHARED\r", "É", "é", "rare", "x\x0by", "a\r"] + [f"line {i}" for i in range(30)]
    rows = [(draw.choice([i, None]), "\n".join(draw.choice(pool) for _ in range(draw.randrange(1, 8)))) for i in range(200)]
    rows += [(r["doc_id"], r["text"]) for r in odd.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _n", "2 AS n_lines")
    found = lines.drop_shared_lines(docs).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(coalesce(kept, ''), 256)")
    assert rows_of(found) == expected_lines(rows, 10)
    assert lines.drop_shared_lines(none).count() == 0


# packing


def check_packing(pieces, texts, coder, room):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in by_sequence.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= room
    for key, text in texts.items():
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[key], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == room for r in own[1:]) and len(own) == -(-len(ids) // room)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    return len(by_sequence)


def test_packing_of_the_small_table_and_odd_rows(spark, small, texts, odd, none):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(BPE)
    for docs, known, room in ((spark.read.parquet(f"{small}/documents.parquet"), dict(texts), 2048), (odd.dropDuplicates(["doc_id"]), None, 50)):
        known = known or {r["doc_id"]: r["text"] for r in docs.collect()}
        pieces = packing.pack_best_fit(docs, BPE, RANKS, room).collect()
        n = check_packing(pieces, known, coder, room)
        assert n <= math.ceil(sum(r["length"] for r in pieces) / room) * 1.03 + 1
    assert packing.pack_best_fit(odd, BPE, RANKS).count() == len(packing.pack_best_fit(odd, BPE, None).collect()) >= odd.count()
    assert packing.pack_best_fit(none, BPE, RANKS).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 40), min_size=1, max_size=10))
def test_plan_places_every_piece_once(counts):
    used = defaultdict(list)
    for length, first, end, sequence, per, offset in packing.best_fit_plan(counts, 20):
        for rank in range(first, end):
            used[sequence + (rank - first) // per].append((offset + (rank - first) % per * length, length))
    assert Counter(n for s in used.values() for _, n in s) == counts
    for rows in used.values():
        rows.sort()
        assert rows[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:], strict=False)) and sum(rows[-1]) <= 20


CODER = packing.ByteBpe(BPE, RANKS)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(" \n\t'sreé1.,漢\xa0_<|endoftext|>", max_size=40)))
def test_chunks_give_the_ids_of_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert CODER.encode(text) == CODER.library(text)


# pipeline


def test_pipeline(spark, small, tmp_path):
    import os

    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd_rows = spark.createDataFrame([(10_000, None, None, None, None), (None, "Nothing here has an id, but it has words.", "en", "src1", 41)], docs.schema)
    docs = docs.unionByName(odd_rows).selectExpr("*", "'extra' AS lang_pred")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == docs.columns and kept.schema["text"].dataType == docs.schema["text"].dataType
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        before, after = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in kept.collect()}
        assert set(after) <= set(before) and len(after) == kept.count()
        if name != "line_dedup":
            assert all(after[i] == before[i] for i in after)
        assert len(after) > 0.5 * len(before)
        docs = kept
    assert os.path.isdir(tmp_path)
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()} == set(after)
    assert corpus_pipeline.run(spark, small).count() > 100
