"""Word-bounded term matching: a trie of the terms, walked once over every text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamwork.session import cut_lineage

#: Words and what is between them; ``\w`` is letters, numbers and the underscore.
PARTS = re.compile(r"\w+|\W+")

#: Latin-1 with a blank for what is no ``\w``.
BLANKED = bytes(c if re.match(r"\w", chr(c)) else 32 for c in range(256))

#: Terms of several parts that are looked for one by one in a text; beyond that the trie is walked.
FEW = 32

#: Bytes of terms in one trie, about; a trie takes some thirty times as much in a task.
TRIE_BYTES = 4 << 20

#: Bytes of text that are matched at once, about.
SLICE = 4 << 20


def words_of(low: str) -> list[str]:
    """The words of a text; those of Latin-1 without a regular expression."""
    try:
        return low.encode("latin-1").translate(BLANKED).decode("latin-1").split()
    except UnicodeEncodeError:
        return re.findall(r"\w+", low)


class TermTrie:
    """Terms by their parts. Terms of one word are counted with the words of a text; the others hang on their first word."""

    def __init__(self, terms: Iterable[tuple[str, str]]) -> None:
        """terms: (term, its lower-case form); several terms may share a form."""
        self.single: dict[str, list[str]] = {}
        self.root: dict = {}
        self.longer: dict[str, dict[str, list[str]]] = {}
        for term, low in terms:
            parts = PARTS.findall(low)
            if not parts or not PARTS.fullmatch("a" + parts[0]):  # a term that begins with a sign stands behind no word edge
                continue
            if len(parts) == 1:
                self.single.setdefault(low, []).append(term)
                continue
            self.longer.setdefault(parts[0], {}).setdefault(low, []).append(term)
            node = self.root
            for part in parts:
                node = node.setdefault(part, {})
            node.setdefault(None, []).append(term)

    def counts(self, low: str) -> dict[str, int]:
        """How often each term stands in a lower-case text, from any word on."""
        words = Counter(words_of(low))
        found = {term: words[w] for w in self.single.keys() & words.keys() for term in self.single[w]}
        heads = self.longer.keys() & words.keys()
        if sum(len(self.longer[h]) for h in heads) > FEW:
            self.walk(low, found)
        else:
            for form, terms in (x for h in heads for x in self.longer[h].items()):
                n = occurrences(form, low)
                if n:
                    found.update(dict.fromkeys(terms, n))
        return found

    def walk(self, low: str, found: dict[str, int]) -> None:
        """Counts of the terms of several parts, in one walk over the parts of the text."""
        parts, root = PARTS.findall(low), self.root
        n = len(parts)
        for i in [i for i, p in enumerate(parts) if p in root]:
            node = root[parts[i]]
            while node is not None:
                for term in node.get(None, ()):
                    found[term] = found.get(term, 0) + 1
                i += 1
                node = node.get(parts[i]) if i < n else None


def occurrences(form: str, low: str) -> int:
    """How often a term stands in a text with its first and last part whole."""
    n, at = 0, low.find(form)
    while at >= 0:
        end = at + len(form)
        # parts alternate, so the neighbours of a whole part are of the other kind
        n += (at == 0 or not is_word(low[at - 1])) and (end == len(low) or is_word(low[end]) != is_word(form[-1]))
        at = low.find(form, at + 1)
    return n


def is_word(c: str) -> bool:
    return c == "_" or c.isalnum()


def term_blocks(terms: DataFrame, term: str) -> list:
    """Broadcast lists of the distinct terms with their lower-case forms, of about TRIE_BYTES at most; one for a usual dictionary."""
    known = cut_lineage(terms.select(F.col(term).alias("term"), F.lower(term).alias("low")).filter("low <> ''").distinct())
    size = known.agg(F.coalesce(F.sum(F.octet_length("low") + 16), F.lit(0)).alias("n")).first()["n"]
    blocks = size // TRIE_BYTES + 1
    spark, out = terms.sparkSession, []
    for k in range(blocks):
        own = known.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == k).collect()  # TRIE_BYTES by measure
        out.append(spark.sparkContext.broadcast([(r["term"], r["low"]) for r in own]))
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    first = total = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column("_low")).to_pylist()):
        if total and total + (n or 0) > SLICE:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n or 0
    yield batch.slice(first)


def term_counts(texts: DataFrame, doc: str, text: str, terms: DataFrame, term: str, keep: Sequence[str] = ()) -> DataFrame:
    """(doc, found): per text the array of (term, n), how often each term stands in it as whole words, any case.

    A term of k parts (words and what is between them) equals k consecutive parts of the text that start at a word;
    occurrences that share a word with the one before are counted as well. Texts without any term have an empty array, NULL
    texts too. Columns to ``keep`` stay in the row of their text.

    A text is read once, in its row: its words are counted, and terms of several parts are looked for where it has their first
    word. Nothing is shuffled. A
    dictionary of more than TRIE_BYTES is matched block by block; then a text has a row for each block, which are
    brought together by document.
    """
    kind = texts.schema[doc].dataType
    schema = T.StructType([T.StructField("doc", kind), *[texts.schema[c] for c in keep]]).add("found", T.ArrayType(T.StructType().add("term", T.StringType()).add("n", T.LongType())))
    rows = texts.select(F.col(doc).alias("doc"), *keep, F.coalesce(F.lower(text), F.lit("")).alias("_low"))
    blocks = term_blocks(terms, term)

    def matched(block, rows: DataFrame, schema: T.StructType) -> DataFrame:
        names = schema.names[:-1]

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            trie, arrow = TermTrie(block.value), to_arrow_schema(schema)
            for batch in batches:
                for part in _slices(batch) if batch.num_rows else ():
                    found = [[{"term": t, "n": n} for t, n in trie.counts(low).items()] for low in part.column("_low").to_pylist()]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(found, arrow.field("found").type)], schema=arrow)

        return rows.mapInArrow(run, schema)

    if len(blocks) == 1:
        return matched(blocks[0], rows, schema).withColumnRenamed("doc", doc)
    bare = T.StructType([schema["doc"], schema["found"]])
    parts = [matched(b, rows.select("doc", "_low"), bare) for b in blocks]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    found = whole.groupBy("doc").agg(F.flatten(F.collect_list("found")).alias("found")).withColumnRenamed("doc", doc)
    return texts.select(doc, *keep).join(found, doc) if keep else found


def match_terms(texts: DataFrame, doc: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """(doc, term, n): a row per text and term that stands in it."""
    found = term_counts(texts, doc, text, terms, term).select(doc, F.explode("found").alias("_f"))
    return found.select(doc, F.col("_f.term").alias(term), F.col("_f.n").alias("n"))


def ranked_terms(counts: DataFrame, doc: str, order: Callable[[Column], list[Column]], limit: int | None = None, sep: str | None = ", ", keep: Sequence[str] = ()) -> DataFrame:
    """(doc, columns to ``keep``, terms): all or the first ``limit`` terms of every text that has any, in one line or, without ``sep``, as an array.

    ``order`` gives the sort keys of an entry (term, n), ascending. The array is sorted in its row: no shuffle.
    """
    keyed = F.transform("found", lambda f: F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order(f))], f["term"].alias("t")))
    ordered = F.transform(F.array_sort(keyed), lambda s: s["t"])
    kept = ordered if limit is None else F.slice(ordered, 1, limit)
    return counts.filter(F.size("found") > 0).select(doc, *keep, (kept if sep is None else F.array_join(kept, sep)).alias("terms"))


def top_terms(matches: DataFrame, doc: str, term: str, order: list[Column], limit: int | None = None, sep: str | None = ", ") -> DataFrame:
    """The same for matches given as rows (doc, term, ...): one shuffle by text."""
    place = F.row_number().over(Window.partitionBy(doc).orderBy(*order))
    placed = matches.withColumn("_place", place)
    kept = placed if limit is None else placed.filter(F.col("_place") <= limit)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col("_place"), F.col(term).alias("t")))), lambda s: s["t"])
    return kept.groupBy(doc).agg((ordered if sep is None else F.array_join(ordered, sep)).alias("terms"))
