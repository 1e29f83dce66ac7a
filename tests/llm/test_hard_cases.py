"""Words whose polynomial hashes agree, very long texts and lines, extreme vectors, and the pipeline on odd tables."""

import time

import numpy as np
import public_tokenizers
from test_corpus import rows_of
from test_near_duplicates import expected

import corpus_pipeline
from loamwork.llm import benchmark, language, lines, minhash, packing, repeats, shards, substrings, suffixes, tokens, vectors
from loamwork.llm.common import PrefixHash

BPE, RANKS, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


def swapped(n):
    """Two words of n letters or more whose polynomials agree modulo 2^64 for every odd base."""
    a, b = "ab", "ba"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def test_colliding_words_have_their_own_hashes():
    a, b = (np.frombuffer(w.encode(), np.uint8) for w in swapped(2048))
    hashes, whole = PrefixHash(), (np.array([0]), np.array([len(a)]))
    assert hashes.of(hashes.bytes(a), *whole) == hashes.of(hashes.bytes(b), *whole)
    assert hashes.words(a, *whole) != hashes.words(b, *whole)


def test_near_duplicates_tell_colliding_words_apart(spark):
    a, b = swapped(2048)
    rows = [(1, f"one two three four {a} five"), (2, f"one two three four {b} five"), (3, f"one two three four {a} five")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found) == expected(rows) == [(1, 2, 1, True), (2, 2, 2, True), (3, 2, 1, False)]


def test_links_are_decided_on_the_words(monkeypatch):
    """Equal hashed sets of different texts are no link."""
    hashed = np.arange(10, dtype=np.uint64)
    x, y = (minhash.Document(hashed, f"a b c d {w}".encode(), 5) for w in "ef")
    assert not x.alike(y, 75) and x.alike(minhash.Document(hashed, b"A  b c d E", 5), 75)


def test_passages_with_colliding_words_stay(spark):
    a, b = swapped(2048)
    words = [f"w{i}" for i in range(10)]
    rows = [(i, " ".join([*words, w, *words])) for i, w in ((1, a), (2, b), (3, a))]
    found = substrings.drop_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_removed"]) for r in found.collect()) == [(1, 0), (2, 0), (3, 21)]
    a, b = swapped(128)
    rows = [(1, "x" * 40 + a + "y" * 40), (2, "x" * 40 + b + "y" * 40)]
    found = suffixes.drop_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_removed"]) for r in found.collect()) == [(1, 0), (2, 0)]


def test_contexts_that_share_no_window_are_left_out():
    """No context that shares a window of 20 words around its anchor with another one is left out, for all cuts of a text."""
    draw = np.random.default_rng(3)
    anchor = [b"a%d" % i for i in range(6)]
    for _ in range(200):
        lefts = [[b"%d" % w for w in draw.integers(0, 2, draw.integers(0, 15))] for _ in range(5)]
        rights = [[*anchor, *[b"%d" % w for w in draw.integers(0, 2, draw.integers(0, 15))]] for _ in range(5)]
        windows = []
        for x, y in zip(lefts, rights, strict=True):
            words = x + y
            windows.append({(tuple(words[i : i + 20]), len(x) - i) for i in range(len(words) - 19) if i <= len(x) <= i + 14})
        kept = substrings.may_repeat(lefts, rights, 20)
        for i in range(5):
            if any(windows[i] & windows[j] for j in range(5) if j != i):
                assert i in kept


def test_contexts_are_digests_of_bytes():
    for words in (True, False):
        units = repeats.Units(words, 20, 6)
        text = b"  a bb\tccc d" * 30
        left, right, d1, d2 = units.contexts(text, np.array([15, 18, 21]))
        again = units.contexts(b"a bb ccc d " * 30 if words else text, np.array([15, 18, 21]))
        assert (np.array(again) == np.array([left, right, d1, d2])).all() and len(set(zip(d1, d2, strict=True))) == 3


def test_book_long_sets_share_few_bands():
    """Two disjoint sets of a million shingles, and one that differs in a tenth."""
    draw = np.random.default_rng(4)
    x, y = (np.unique(draw.integers(0, 1 << 62, 1_000_000, dtype=np.uint64)) for _ in range(2))
    sketch = minhash.CirculantMinHash(minhash.ROWS * minhash.BANDS).sketch([x, y, np.concatenate((x[100_000:], y[:100_000]))])
    assert (sketch[:, 0] == sketch[:, 1]).mean() < 0.2
    keys = minhash.band_keys(sketch, minhash.ROWS)
    assert (keys[0] == keys[1]).sum() <= 1 and (keys[0] == keys[2]).sum() > 10


def test_sketch_estimate_keeps_pairs_at_the_limit():
    """Of 4,000 pairs of similarity 0.75 none looks so far apart that it would not be confirmed, and all share a band."""
    draw = np.random.default_rng(9)
    hasher, lost = minhash.CirculantMinHash(minhash.ROWS * minhash.BANDS), 0
    for _ in range(20):
        sets = []
        for _ in range(200):
            every = draw.integers(0, 1 << 62, 400, dtype=np.uint64)
            sets += [every[:350], every[50:]]
        sketch = hasher.sketch(sets)
        low = (sketch & 0xFF).astype(np.uint8)
        keys = minhash.band_keys(sketch, minhash.ROWS)
        close = (low[:, ::2] == low[:, 1::2]).mean(0) >= minhash.LEAST_ESTIMATE + (1 - minhash.LEAST_ESTIMATE) / 256
        lost += int((~close).sum()) + int((~(keys[::2] == keys[1::2]).any(1)).sum())
    assert lost == 0


def test_vectors_of_any_size(spark):
    rows = [(1, "a", [1e200, 1e200]), (2, "a", [1e200, 1e200]), (3, "a", [2e200, 2.1e200]), (4, "a", [1e-300, 1.1e-300]), (5, "a", [5e-324, 0.0]), (6, "a", [1e308, 1e-308]), (7, "a", [-1e200, -1e200]), (8, "a", [float("inf"), 1.0]), (9, "a", [0.0, 0.0])]
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>"))
    assert rows_of(found) == [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 1, 5, True), (6, 1, 5, False), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)]


def test_a_tile_gives_rows_by_its_vectors(spark):
    """A group of near vectors: counts and a forest of links, not its pairs."""
    draw = np.random.default_rng(5)
    base = draw.standard_normal(16)
    rows = [(i, "a", (base + 0.02 * draw.standard_normal(16)).tolist()) for i in range(900)]
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>"))
    assert {(r["n_links"], r["component_id"]) for r in found.collect()} == {(899, 0)}
    entries = vectors.hashed(spark.createDataFrame([(i, "a", 1, v) for i, _, v in rows], "node long, label string, n long, vector array<double>"), "bigint")
    tiles = vectors.close_in_tiles(entries.selectExpr("node", "label", "n", "size", "marks", "raw", "0 as t", "0L as bucket"), 0.93, "bigint")
    assert tiles.count() < 900 * 2 * 8


def test_lines_of_a_long_text_are_read_once(spark):
    """100,000 lines, half of them shared: linear in the lines, also with the dropped ones at both ends."""
    many = [f"shared {i // 2}" if i % 2 else f"own {i}" for i in range(100_000)]
    rows = [(d, "\n".join(x.replace("own", f"own{d}") for x in many)) for d in range(10)] + [(10, "shared 0\nlast\nSHARED 1 "), (11, "shared 3")]
    start = time.time()
    found = {r["doc_id"]: r for r in lines.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert time.time() - start < 60
    assert found[3]["n_dropped"] == 50_000 and found[3]["kept"] == "\n".join(f"own3 {i}" for i in range(0, 100_000, 2))
    assert found[10]["kept"] == "last" and found[11]["kept"] == "" and found[11]["n_lines"] == 1


def test_texts_above_a_slice_through_every_operator(spark, small):
    """Texts of 1.5 and 3 MB, one of them twice, next to short ones."""
    draw = np.random.default_rng(6)
    letters = np.array(list("etaoinshrdlu"))
    words = ["".join(draw.choice(letters, 6)) for _ in range(3000)]
    long = [" ".join(draw.choice(words, 220_000)), "\n".join(" ".join(draw.choice(words, 9)) for _ in range(48_000))]
    rows = [(1, long[0]), (2, long[1]), (3, long[0]), (4, "a short text of some words"), (5, long[0][:1_200_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    assert rows_of(minhash.near_duplicates(docs)) == expected(rows)
    assert [r["n_removed"] for r in substrings.drop_repeated_passages(docs).orderBy("doc_id").collect()][:4] == [0, 0, 220_000, 0]
    removed = [r["n_removed"] for r in suffixes.drop_repeated_bytes(docs).orderBy("doc_id").collect()]
    assert removed == [len(long[0]), 0, len(long[0]), 0, 1_200_000]
    dropped = {r["doc_id"]: r for r in lines.drop_shared_lines(docs).collect()}
    assert [dropped[i]["n_lines"] for i in range(1, 6)] == [1, 48_000, 1, 1, 1] and all(dropped[i]["kept"] == t for i, t in rows)
    items = spark.createDataFrame([(7, " ".join(long[1].split()[100_000:100_012]))], "item_id long, text string")
    hits = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in benchmark.contamination(docs, items).collect()}
    assert hits[2] == (432_000, 12) and hits[1] == (220_000, 0)
    placed = {r["doc_id"]: r["size"] for r in shards.place_in_shards(docs).collect()}
    assert placed == {i: len(t) + 1 for i, t in rows}
    counts = {r["doc_id"]: r for r in tokens.token_counts(docs, PIECES).collect()}
    assert counts[1].asDict() | {"doc_id": 3} == counts[3].asDict()
    pieces = packing.pack_best_fit(docs, BPE, RANKS).collect()
    assert len({(p["sequence_id"], p["offset"]) for p in pieces}) == len(pieces)
    one = sorted((p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == 1)
    assert one == sorted((p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == 3)
    assert sum(p[2] for p in one) == one[-1][1] + one[-1][2]
    given = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").unionByName(docs.selectExpr("doc_id + 1000000 as doc_id", "text", "cast(null as string) as lang"))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(given).collect()}
    assert found[1_000_001] == found[1_000_003] != "und"
    docs.unpersist()


def test_pipeline_on_an_empty_table_long_texts_and_repeats(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = ("documents", "benchmark")

    def folder(name, rows):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{small}/{names[1]}.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        return f"{tmp_path}/{name}"

    assert corpus_pipeline.run(spark, folder("empty", docs.limit(0))).count() == 0
    long = docs.orderBy("doc_id").limit(40).selectExpr("900000 as doc_id", "array_join(collect_list(text), ' ') as text", "'en' as lang", "'x' as source", "1L as n_chars")
    long = long.selectExpr("cast(doc_id as long) as doc_id", "repeat(concat(text, ' '), 40) as text", "lang", "source", "n_chars")
    assert long.selectExpr("length(text) as n").first()["n"] > 1 << 20
    rows = docs.unionByName(long).unionByName(docs.filter("doc_id % 7 = 0"))
    whole = rows_of(corpus_pipeline.run(spark, folder("plain", docs)))
    again = corpus_pipeline.run(spark, folder("more", rows)).collect()
    assert {r["doc_id"] for r in again} - {900000} <= {w[0] for w in whole}
