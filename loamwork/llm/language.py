"""Language of texts by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import carried, map_batches, slices, with_carried

#: Buckets of hashed three-byte grams, as a power of two.
GRAM_BITS = 15

#: Parts that the hash of an id tells apart, for samples of any share.
PARTS = 1 << 40

#: Non-letters of ASCII are blanks.
LETTER_TABLE = bytes(x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
GAP = b"   "


def held_out(id: Column) -> Column:
    """Documents that learning leaves alone."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed grams of all texts in one row, and for reduceat the start and end of each text."""
    raw = [t.lower().encode("utf-8", "surrogatepass").translate(LETTER_TABLE) for t in texts]
    row = np.frombuffer(GAP + GAP.join(raw) + GAP, np.uint8).astype(np.uint32)
    hashed = (row[:-2] | (row[1:-1] << np.uint32(8)) | (row[2:] << np.uint32(16))) * np.uint32(2654435761) >> np.uint32(32 - GRAM_BITS)
    lengths = np.array([len(r) for r in raw])
    start = np.cumsum(np.concatenate(([len(GAP)], lengths[:-1] + len(GAP)))) - 1
    return hashed, np.stack((start, start + lengths + 1), 1).ravel()


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1, one for each language: every split for up to 5, else the best of many seeded draws."""
    if n <= 5:
        splits = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        return np.array([[1 if i in s else -1 for s in splits] for i in range(n)], np.int8).reshape(n, -1)
    draw, best, distance = np.random.default_rng(7), None, -1
    for _ in range(200):
        words = draw.choice(np.array([-1, 1], np.int8), (n, int(np.ceil(10 * np.log2(n)))))
        words = words[:, np.abs(words.sum(0)) < n]
        least = min(int((words[i] != words[j]).sum()) for i in range(n) for j in range(i))
        if least > distance:
            best, distance = words, least
    return best


class CodeModel:
    """Bit classifiers over grams, codewords, and the weight of each bit's loss for each language."""

    def __init__(self, languages: list[str], words: np.ndarray, rates: np.ndarray, weights: np.ndarray) -> None:
        self.languages, self.words, self.rates, self.weights = languages, words, rates, weights

    @classmethod
    def from_counts(cls, languages: list[str], counts: np.ndarray) -> CodeModel:
        words = codewords(len(languages))
        rates = np.zeros((counts.shape[1], words.shape[1]), np.float32)
        shares = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
        for b in range(words.shape[1]):
            inside = words[:, b] > 0
            rates[:, b] = np.log(shares[inside].mean(0) / shares[~inside].mean(0))
        return cls(languages, words, rates, np.full(words.shape, 1 / max(1, words.shape[1])))

    def parts(self) -> tuple:
        """Plain values: a broadcast is unpickled where this package may be missing."""
        return self.languages, self.words, self.rates, self.weights

    def margins(self, texts: list[str]) -> np.ndarray:
        """Log odds of each bit, tempered by the root of the number of grams."""
        hashed, bounds = grams(texts)
        sums = np.add.reduceat(self.rates[hashed].astype(np.float64), bounds, axis=0)[::2]
        return sums / np.sqrt(np.diff(bounds)[::2])[:, None]

    def weigh(self, right: np.ndarray, all_: np.ndarray) -> None:
        """Losses count by how often a bit was right for a language."""
        accuracy = (right + 1.0) / (all_ + 2.0)
        self.weights = accuracy / accuracy.sum(1, keepdims=True)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language with the least weighted logistic loss, and its share among all."""
        if len(self.languages) == 1:
            return np.zeros(len(margins), np.int64), np.ones(len(margins))
        loss = np.stack([(np.logaddexp(0, -margins * self.words[k]) * self.weights[k]).sum(1) for k in range(len(self.languages))], 1)
        best = loss.argmin(1)
        odds = np.exp((loss.min(1, keepdims=True) - loss) * self.words.shape[1])
        return best, 1 / odds.sum(1)


def sampled(labelled: DataFrame, counts: dict[str, int], part: int, sample: int) -> DataFrame:
    """About ``sample`` rows per language by the hash of the id, half of a smaller language; the parts 0 and 1 share no row.

    The languages' counts set the shares, so sampling needs no shuffle of texts and no order.
    """
    if not counts:
        return labelled.limit(0)
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id", F.length("text")), F.lit(PARTS))
    share = F.lit(0).cast("long")
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(PARTS // 2, -(-sample * PARTS // n))).cast("long")).otherwise(share)
    return labelled.filter((place >= share * part) & (place < share * (part + 1)))


def fit(docs: DataFrame, sample: int) -> CodeModel | None:
    """Model from rows (doc_id, text, lang) that are not held out; None without a labelled row that has a letter."""
    labelled = docs.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id"))).filter(F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language

    def count():
        def step(batch):
            totals = {}
            for part in slices(batch):
                langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
                for lang in set(langs):
                    hashed, bounds = grams([t for x, t in zip(langs, texts, strict=True) if x == lang])
                    own = np.concatenate([hashed[a:b] for a, b in bounds.reshape(-1, 2)])
                    totals[lang] = totals.get(lang, 0) + np.bincount(own, minlength=1 << GRAM_BITS)
            for lang, total in totals.items():
                at = np.flatnonzero(total)
                yield {"lang": [lang] * len(at), "gram": at, "n": total[at]}

        return step

    found = map_batches(sampled(labelled, sizes, 0, sample).select("text", "lang"), "lang string, gram int, n long", count).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # languages times buckets at most
    if found.empty:
        return None
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), 1 << GRAM_BITS))
    counts[[languages.index(x) for x in found["lang"]], found["gram"].to_numpy()] = found["n"].to_numpy()
    model = CodeModel.from_counts(languages, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def judge():
        own = CodeModel(*shared.value)

        def step(batch):
            for part in slices(batch):
                langs = part.column("lang").to_pylist()
                right = own.margins(part.column("text").to_pylist())
                out = {"lang": [], "bit": [], "hit": [], "n": []}
                for k, lang in enumerate(own.languages):
                    mine = np.array([x == lang for x in langs])
                    for b in range(own.words.shape[1]):
                        for name, value in (("lang", k), ("bit", b), ("hit", int((right[mine, b] * own.words[k, b] > 0).sum())), ("n", int(mine.sum()))):
                            out[name].append(value)
                yield out

        return step

    hits = map_batches(sampled(labelled, sizes, 1, sample).select("text", "lang"), "lang int, bit int, hit long, n long", judge).groupBy("lang", "bit").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n")).collect()
    right, seen = np.zeros(model.words.shape), np.zeros(model.words.shape)
    for r in hits:
        right[r["lang"], r["bit"]], seen[r["lang"], r["bit"]] = r["hit"], r["n"]
    model.weigh(right, seen)
    return model


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.5, carry: Sequence[str] = (), sample: int = 2_000) -> DataFrame:
    """Per row: (id, held_out, lang_pred, score, ambiguous), and with ``carry`` the text and a struct of these columns.

    Bits of language codewords are predicted by log-odds classifiers over hashed three-byte grams of the whole
    lower-cased text; the codeword with the least weighted logistic loss wins and ``score`` is its share. A share below
    ``least`` is ambiguous; of equal losses the first language in order wins. NULL texts, texts without a letter, and all
    texts if nothing can be learned are ``und`` with score 0; an empty table gives no rows. Texts are read whole, whatever
    their length. Classifiers come from about ``sample`` rows per language at most (half of a language's rows, if it has
    fewer than twice as many), drawn by the hash of the id among rows that are not held out, and as many others weigh
    their losses; a row with NULL id may be learned from. Ids, labels and sources are no inputs of a prediction, so equal
    texts get equal results.
    """
    kind = dict(docs.dtypes)[id]
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    model = fit(rows, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model and model.parts())

    def make():
        own = shared.value and CodeModel(*shared.value)

        def step(batch):
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                at = [i for i, t in enumerate(texts) if own is not None and has_letter(t)]
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
                if at:
                    best, share = own.decode(own.margins([texts[i] for i in at]))
                    for i, k, s in zip(at, best.tolist(), share.tolist(), strict=True):
                        pred[i], score[i] = own.languages[k], s
                more = {c: part.column(c) for c in ("text", "carried")} if carry else {}
                yield {"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": pred, "score": score, **more}

        return step

    read = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(id)).alias("held_out"), *carried(docs, carry))
    ddl = f"doc_id {kind}, held_out boolean, lang_pred string, score double" + (", text string" if carry else "")
    named = map_batches(read, with_carried(ddl, read), make)
    ambiguous = ((F.col("lang_pred") != "und") & (F.col("score") < least)).alias("ambiguous")
    return named.select(F.col("doc_id").alias(id), "held_out", "lang_pred", "score", ambiguous, *(["text", "carried"] if carry else []))
