"""Substring operators against plain dictionaries of all windows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from loamwork.llm import substrings, suffixes
from loamwork.llm.repeats import Units, least_places

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def order(doc):
    return (doc[0] is None, doc[0] or 0, doc[1])


def sha(x):
    return hashlib.sha256(x).hexdigest()


def spans(gone):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return len(edges) // 2


def expected_words(rows, length=20):
    first = {}
    split = {d: BLANK.findall(d[1]) for d in {(i, t or "") for i, t in rows}}
    for d in sorted(split, key=order):
        for s in range(len(split[d]) - length + 1):
            first.setdefault(tuple(split[d][s : s + length]), (d, s))
    out = []
    for i, t in rows:
        d = (i, t or "")
        gone = np.zeros(len(split[d]), bool)
        for s in range(len(split[d]) - length + 1):
            if first[tuple(split[d][s : s + length])] != (d, s):
                gone[s : s + length] = True
        out.append((i, len(gone), int(gone.sum()), spans(gone), sha(" ".join([w for w, g in zip(split[d], gone, strict=True) if not g]).encode())))
    return sorted(out, key=str)


def expected_bytes(rows, length=200):
    places = defaultdict(set)
    docs = {(i, t or "") for i, t in rows}
    for d in docs:
        raw = d[1].encode()
        for s in range(len(raw) - length + 1):
            places[raw[s : s + length]].add((d, s))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if len(places[raw[s : s + length]]) > 1:
                gone[s : s + length] = True
        out.append((i, len(raw), int(gone.sum()), spans(gone), sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


BOTH = [(substrings.drop_repeated_passages, expected_words), (suffixes.drop_repeated_bytes, expected_bytes)]


@pytest.mark.parametrize(("operator", "expected"), BOTH)
def test_small_table(spark, small, texts, operator, expected):
    assert result(operator(spark.read.parquet(f"{small}/documents.parquet"))) == expected(texts)


@pytest.mark.parametrize(("operator", "expected"), BOTH)
def test_odd_rows(spark, odd, none, operator, expected):
    assert result(operator(odd)) == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert operator(none).count() == 0


def passages(seed):
    """Texts from few words, with shared passages at changing places, periods, copies and near copies."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.choice([1, 3, 6]))) for _ in range(40)]
    some = lambda n: [draw.choice(words) for _ in range(n)]
    shared = [some(n) for n in (20, 21, 35, 60, 90, 150)]
    rows = []
    for i in range(150):
        text = some(draw.randrange(0, 60))
        for _ in range(draw.randrange(3)):
            text += draw.choice(shared) + some(draw.randrange(0, 30))
        if draw.random() < 0.1:
            text += some(draw.choice([1, 2, 5])) * 40
        rows.append((draw.choice([i, i, i, None]), " ".join(text)))
        if draw.random() < 0.15:
            rows.append((draw.choice([1000 + i, rows[-1][0]]), rows[-1][1]))
        if draw.random() < 0.15 and text:
            text = list(text)
            text[draw.randrange(len(text))] = "new"
            rows.append((2000 + i, "\n".join(text)))
    return rows


@pytest.mark.parametrize(("operator", "expected"), BOTH)
def test_passages(spark, operator, expected):
    rows = passages(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(operator(docs)) == expected(rows)


@pytest.mark.parametrize(("operator", "expected"), BOTH)
def test_hot_anchors_may_lie_in_several_tasks(spark, operator, expected):
    rows = passages(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(operator(docs, hot=2)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_least_places_and_anchors():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 9, 500, dtype=np.uint64) << np.uint64(40)
    assert least_places(values, 7).tolist() == [i + int(np.argmin(values[i : i + 7])) for i in range(494)]
    units = Units(False, 200, 40)
    at, _ = units.anchors(units.row(b"x" * 199)[0])
    assert not len(at)


def test_multikey_quicksort():
    keys = np.random.default_rng(1).integers(0, 3, (3000, 6), dtype=np.uint64)
    assert keys[suffixes.multikey_quicksort(keys)].tolist() == sorted(keys.tolist())


def test_automaton_finds_first_places():
    draw = random.Random(1)
    passages_, automaton, place = [], substrings.SuffixAutomaton(), 0
    for _ in range(30):
        words = [draw.randrange(3) for _ in range(draw.randrange(1, 40))]
        passages_.append((words, place))
        automaton.add(words, place)
        place += 100
    for words, start in passages_:
        for end, first in automaton.matches(words, 4):
            window = words[end - 4 : end]
            assert first == min(p + e - 1 for w, p in passages_ for e in range(4, len(w) + 1) if w[e - 4 : e] == window)
        assert len(list(automaton.matches(words, 4))) == max(0, len(words) - 3)
