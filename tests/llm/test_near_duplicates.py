"""MinHash and vector operators against all pairs."""

import random
import re
from itertools import combinations

import numpy as np

from loamwork.llm import minhash, vectors

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = BLANK.findall((text or "").translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def labels(ids, links):
    lowest = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(lowest[a], lowest[b])
            changed |= lowest[a] != low or lowest[b] != low
            lowest[a] = lowest[b] = low
    return lowest


def expected(rows):
    sets = {}
    for i, t in rows:
        if i is not None and shingles(t):
            sets.setdefault(i, []).append(shingles(t))
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if any(100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    lowest = labels({i for i, _ in rows}, links)
    return sorted(((i, len(shingles(t)), lowest.get(i), i == lowest.get(i)) for i, t in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_pairs_of_the_small_table(spark, small, texts):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert result(minhash.near_duplicates(docs)) == expected(texts)


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(minhash.near_duplicates(odd)) == expected(rows)
    assert minhash.near_duplicates(none).count() == 0


def test_chains_hubs_and_shared_passages(spark):
    """Copies with growing edits, so that far ends of a group have no link of their own, around one shared passage."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows = []
    for g in range(12):
        base = [word() for _ in range(draw.choice([30, 90, 150]))] + passage
        for _ in range(12):
            for _ in range(draw.choice([0, 1, 2])):
                base = list(base)
                base[draw.randrange(len(base))] = word()
            rows.append((len(rows), " ".join(base)))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs)) == expected(rows)


def test_circulant_sketch_estimates_similarity():
    draw = np.random.default_rng(1)
    hasher = minhash.CirculantMinHash(240)
    shared, own = draw.integers(0, 1 << 62, 1500, dtype=np.uint64), draw.integers(0, 1 << 62, 1000, dtype=np.uint64)
    sketch = hasher.sketch([np.concatenate((shared, own[:500])), np.concatenate((shared, own[500:]))])
    assert abs((sketch[:, 0] == sketch[:, 1]).mean() - 0.6) < 0.12
    # coordinate k is the first one of the set shifted by k places in the second permutation
    places = hasher.first[(shared & np.uint64(hasher.size - 1)).astype(np.int64)]
    assert hasher.sketch([shared])[7, 0] == hasher.second[: hasher.size][(places + 7) % hasher.size].min()


def close_vectors(rows):
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(k, i, np.array(v, np.float64), label) for k, (i, v, label) in enumerate(rows) if i is not None and usable(v, label)]
    count, links = [0] * len(rows), []
    for (k, i, x, a), (m, j, y, b) in combinations(good, 2):
        if a == b and len(x) == len(y) and (x @ y) / np.sqrt((x @ x) * (y @ y)) >= 0.93:
            count[k] += 1
            count[m] += 1
            links.append((i, j))
    lowest = labels({i for i, _, _ in rows}, links)
    return sorted(((i, n, lowest[i], i == lowest[i]) for (i, _, _), n in zip(rows, count, strict=True)), key=str)


def test_vectors_of_the_small_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert result(vectors.near_vectors(table)) == close_vectors(rows)


def test_odd_vectors(spark):
    draw = np.random.default_rng(3)
    base = draw.standard_normal(16)
    rows = [(i, (base + 0.1 * draw.standard_normal(16)).tolist(), 1) for i in range(600)]  # more than two blocks
    rows += [(1000, base.tolist(), 2), (1001, base.tolist(), 2), (1001, base.tolist(), 2), (1002, None, 1), (1003, [0.0] * 16, 1), (1004, [float("nan"), *base[1:].tolist()], 1)]
    rows += [(1005, [None, *base[1:].tolist()], 1), (1006, base.tolist(), None), (None, base.tolist(), 1), (1007, [], 1), (1008, base[:8].tolist(), 1), (1009, [float("inf")] * 16, 1), (1010, (3 * base).tolist(), 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS n", "2 AS node", "3 AS copy")
    got, want = result(vectors.near_vectors(table)), close_vectors(rows)
    assert [(i, c, k) for i, _, c, k in got] == [(i, c, k) for i, _, c, k in want]
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.995 * there <= found <= there
    assert vectors.near_vectors(table.limit(0)).count() == 0
