"""First similar key of a list, inside its row: candidates by rare words and grams instead of all against all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.text import SIMILAR_LEAST, SIMILAR_SHORTEST, bind
from loamwork.session import hold

#: Characters of a gram; windows of as many grams as the shortest contained key has.
GRAM = 12

#: Lists of up to this many entries are compared directly, which is cheaper for them than an index; the result is the same.
SMALL = 64

#: Base of a pair's code.
PAIR = 1 << 31


def runs(c: Column, key: str) -> Column:
    """A sorted array of structs, cut where the field ``key`` changes."""

    def cut(c: Column) -> Column:
        edge = F.transform(c, lambda e, i: F.when((i == 0) | (F.get(c, F.greatest(i - 1, F.lit(0)))[key] != e[key]), i))
        return bind(F.filter(edge, lambda i: i.isNotNull()), lambda starts: F.transform(
            starts, lambda s, r: F.slice(c, s + 1, F.coalesce(F.get(starts, r + 1), F.size(c)) - s)))

    return bind(c, cut)


def rarest_first(entries: Column) -> Column:
    """For every list entry i its parts as (i, n, t, x), those that the fewest entries have first.

    entries: array of (t, i, x), a part t once per entry, with a mark x.
    """
    counted = F.transform(runs(F.sort_array(entries), "t"), lambda r: F.transform(r, lambda e: F.struct(e["i"].alias("i"), F.size(r).alias("n"), e["t"].alias("t"), e["x"].alias("x"))))
    return runs(F.sort_array(F.flatten(counted)), "i")


def containing(parts: Column, keys: Column) -> Column:
    """Codes of the pairs of about equal length in which one entry's rarest marked part is a part of the other."""

    def marked(r: Column) -> Column:
        return bind(F.get(F.filter(r, lambda e: e["x"]), F.lit(0))["t"], lambda own: F.transform(r, lambda e: F.struct(
            e["t"].alias("t"), (~e["t"].eqNullSafe(own)).alias("other"), e["i"].alias("i"), F.length(F.get(keys, e["i"])).alias("m"))))

    every = F.filter(F.flatten(F.transform(parts, marked)), lambda e: e["m"] >= SIMILAR_SHORTEST)
    # entries that stand for their whole key come first in a run, and meet all entries behind them
    return F.flatten(F.transform(runs(F.sort_array(every), "t"), lambda r: F.flatten(F.transform(F.filter(r, lambda e: ~e["other"]), lambda e, a: F.transform(
        F.filter(F.slice(r, a + 2, F.size(r)), lambda f: close_lengths(e["m"], f["m"])), lambda f: code(e["i"], f["i"]))))))


def same_words_or_part(x: Column, y: Column) -> Column:
    """``looks_like_duplicate`` for entries (k, t, m, n) of a key, its distinct words and how many characters and words these are.

    Cheap tests first: equal keys have as many words.
    """
    long = (F.least(x["m"], y["m"]) >= SIMILAR_SHORTEST) & (F.least(x["m"], y["m"]) / F.greatest(x["m"], y["m"]) >= SIMILAR_LEAST)
    part = long & (F.contains(x["k"], y["k"]) | F.contains(y["k"], x["k"]))
    shared = bind(F.size(F.array_intersect(x["t"], y["t"])), lambda n: n / (x["n"] + y["n"] - n) >= SIMILAR_LEAST)
    return (x["m"] > 0) & (y["m"] > 0) & ((close_lengths(x["n"], y["n"]) & ((x["k"] == y["k"]) | shared)) | part)


def code(i: Column, j: Column) -> Column:
    return F.greatest(i, j).cast("long") * PAIR + F.least(i, j)


def close_lengths(a: Column, b: Column) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * SIMILAR_LEAST - 1e-9


def keyed_entries(keys: Column) -> Column:
    """(k, t, m, n) of every key, see ``same_words_or_part``."""
    words = lambda x: F.array_distinct(F.filter(F.split(x, " "), lambda t: t != ""))
    return F.transform(keys, lambda x: bind(words(x), lambda t: F.struct(x.alias("k"), t.alias("t"), F.length(x).alias("m"), F.size(t).alias("n"))))


def pairs_of(s: Column) -> Column:
    """Sorted codes j * PAIR + i of all i < j with similar keys; s: ``keyed_entries``.

    Keys with a Jaccard similarity of t share one of their first m - ceil(t m) + 1 words in any common order of words; the
    order taken is rarest first. Of a key that another contains, all words but the first and the last are words of the
    other, so its rarest inner word is. Of one without inner words every window of SIMILAR_SHORTEST characters stands in the
    other, so the rarest least gram of its windows is one of the other's. Only such pairs of about equal length are
    tested. Short lists skip all of that.
    """
    earlier = lambda j: F.when(j > 0, F.sequence(F.lit(0), j - 1)).otherwise(F.array().cast("array<int>"))
    direct = F.flatten(F.transform(s, lambda y, j: F.transform(F.filter(earlier(j), lambda i: bind(F.get(s, i), lambda x: same_words_or_part(x, y))), lambda i: code(i, j))))
    return F.sort_array(F.when(F.size(s) <= SMALL, direct).otherwise(bind(F.transform(s, lambda e: e["k"]), lambda k: indexed_pairs(s, k))))


def indexed_pairs(s: Column, k: Column) -> Column:
    """Codes of all similar pairs of a long list, see ``pairs_of``; k: the keys alone."""
    inner = lambda x: bind(F.split(x, " "), lambda w: F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0))))
    every = F.flatten(F.transform(s, lambda e, i: bind(inner(e["k"]), lambda own: F.transform(e["t"], lambda t: F.struct(t.alias("t"), i.alias("i"), F.array_contains(own, t).alias("x"))))))

    def by_words(w: Column) -> Column:
        prefix = F.flatten(F.transform(w, lambda r: F.transform(F.slice(r, 1, F.floor(F.size(r) * (1 - SIMILAR_LEAST) + 1e-9).cast("int") + 1), lambda e: F.struct(e["t"].alias("t"), e["i"].alias("i"), F.size(r).alias("m")))))
        return F.flatten(F.transform(runs(F.sort_array(prefix), "t"), lambda r: F.flatten(F.transform(r, lambda e, a: F.transform(
            F.filter(F.slice(r, 1, a), lambda f: close_lengths(e["m"], f["m"])), lambda f: code(f["i"], e["i"]))))))

    # grams only where a key without inner words may be contained
    few = F.filter(k, lambda x: (F.length(x) >= SIMILAR_SHORTEST) & ~x.rlike(" .* "))

    def grams(x: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.length(x) - GRAM + 1), lambda p: F.xxhash64(F.substring(x, p, F.lit(GRAM))))
        width = SIMILAR_SHORTEST - GRAM + 1
        return bind(hashes, lambda h: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(h) - width + 1), lambda p: F.array_min(F.slice(h, p, width)))))

    def by_grams(most: Column) -> Column:
        every = F.flatten(F.transform(k, lambda x, i: F.when(F.length(x).between(SIMILAR_SHORTEST, most), F.transform(grams(x), lambda t: F.struct(t.alias("t"), i.alias("i"), (~x.rlike(" .* ")).alias("x")))).otherwise(F.array())))
        return containing(rarest_first(every), k)

    most = F.coalesce(F.array_max(F.transform(few, lambda x: F.length(x))) / SIMILAR_LEAST, F.lit(0.0))
    candidates = F.array_distinct(F.concat(bind(rarest_first(every), lambda w: F.concat(by_words(w), containing(w, k))), bind(most, by_grams)))
    return F.filter(candidates, lambda p: bind(F.get(s, (p / PAIR).cast("int")), lambda x: bind(F.get(s, (p % PAIR).cast("int")), lambda y: same_words_or_part(x, y))))


def similar_pairs(df: DataFrame, keys: str, name: str) -> DataFrame:
    """Add ``name``: sorted codes j * PAIR + i of all i < j with similar keys (see ``looks_like_duplicate``)."""
    return hold(df, **{name: bind(keyed_entries(F.col(keys)), pairs_of)})


def similar_places(df: DataFrame, keys: str, name: str, scores: str | None = None) -> DataFrame:
    """Add ``name``: per list entry the place that it takes, or -1 - place where an earlier entry with a similar key has it.

    Entries are taken in order. One without a similar key among the holders of places gets a place of its own, numbered
    by the entry; the others belong to the first place whose holder is similar, and take it if they have a better
    score (with ``scores``). Only entries with a similar one before them are looked at again.
    """
    codes = bind(keyed_entries(F.col(keys)), pairs_of)
    twins = runs(F.transform(codes, lambda p: F.struct((p / PAIR).cast("int").alias("j"), (p % PAIR).cast("int").alias("i"))), "j")

    def put(places: Column, at: Column, value: Column) -> Column:
        return F.concat(F.slice(places, 1, at), F.array(value), F.slice(places, at + 2, F.size(places)))

    def step(places: Column, run: Column) -> Column:
        j = F.get(run, F.lit(0))["j"]
        held = F.filter(F.transform(run, lambda e: F.struct(F.get(places, e["i"]).alias("p"), e["i"].alias("i"))), lambda x: x["p"] >= 0)

        def moved(first: Column) -> Column:
            behind = put(places, j, -1 - first["p"])
            if scores is not None:
                better = F.get(F.col(scores), j) > F.get(F.col(scores), first["i"])
                behind = F.when(better, put(put(places, first["i"], -1 - first["p"]), j, first["p"])).otherwise(behind)
            return F.when(first.isNull(), places).otherwise(behind)

        return bind(F.array_min(held), moved)

    start = F.when(F.size(keys) > 0, F.sequence(F.lit(0), F.size(keys) - 1)).otherwise(F.array().cast("array<int>"))
    return hold(df, **{name: F.aggregate(twins, start, step)})
