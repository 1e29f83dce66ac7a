"""Document operators. Everything here works inside the row of one document, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from loamwork.functions.text import cache_key, is_header_footer_line, is_heading_line, split_lines, split_words
from loamwork.session import hold, unnest


def first_occurrences(docs: DataFrame, doc: str, items: Column, limit: int | None = None) -> DataFrame:
    """(doc, items): array entries without repeats (case ignored), first spelling and order kept.

    Sorting the entries of a row by key and place puts repeats side by side, so the work per
    document grows with n log n.
    """
    placed = F.sort_array(F.transform(items, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("p"), x.alias("x"))))
    sorted_rows = hold(docs, _s=placed).select(doc, "_s")
    is_first = lambda e, i: (i == 0) | (F.get(F.col("_s"), F.greatest(i - 1, F.lit(0)))["k"] != e["k"])
    firsts = sorted_rows.select(doc, F.filter("_s", is_first).alias("_f"))
    back = F.transform(F.sort_array(F.transform("_f", lambda e: F.struct(e["p"].alias("p"), e["x"].alias("x")))), lambda e: e["x"])
    return hold(firsts, items=back if limit is None else F.slice(back, 1, limit)).select(doc, "items")


def heading_sections(docs: DataFrame, doc: str, text: str, known_lines: list[str] | None = None) -> DataFrame:
    """(doc, idx, header, body): a ``__DOCUMENT__`` row with all body lines, then one row per section.

    Page lines and blank lines are removed; sections without a body drop out.
    """
    trimmed = F.transform(split_lines(F.col(text)), lambda x: F.trim(x))
    kept = F.filter(trimmed, lambda x: (x != "") & ~is_header_footer_line(x, known_lines))
    marked = F.transform(kept, lambda x: F.struct(x.alias("t"), is_heading_line(x).alias("h")))
    rows = hold(docs, _l=marked).select(doc, "_l")
    heads = F.filter(F.transform("_l", lambda e, i: F.when(e["h"], i)), lambda i: i.isNotNull())
    placed = hold(rows, _h=heads, _n=F.size("_l"))
    text_of = lambda part: F.array_join(F.transform(part, lambda e: e["t"]), "\n")
    whole = F.struct(F.lit("__DOCUMENT__").alias("header"), text_of(F.filter("_l", lambda e: ~e["h"])).alias("body"))

    def section(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("_h"), k + 1), F.col("_n"))
        return F.struct(F.get(F.col("_l"), start)["t"].alias("header"), text_of(F.slice(F.col("_l"), start + 2, end - start - 1)).alias("body"))

    sections = F.filter(F.transform("_h", section), lambda s: s["body"] != "")
    return unnest(placed, [doc], F.concat(F.array(whole), sections), "idx", "s").select(doc, "idx", "s.header", "s.body")


def chunk_words(docs: DataFrame, doc: str, text: str, size: int = 220, overlap: int = 55, least: int = 20) -> DataFrame:
    """(doc, chunk, text): word windows; a later window with fewer than ``least`` words is left out."""
    step = max(1, size - overlap)
    worded = hold(docs, _w=split_words(F.col(text))).select(doc, "_w").filter(F.size("_w") > 0)
    starts = F.filter(F.sequence(F.lit(0), F.size("_w") - 1, F.lit(step)), lambda s: (s == 0) | (F.size("_w") - s >= least))
    chunks = F.transform(starts, lambda s: F.array_join(F.slice(F.col("_w"), s + 1, size), " "))
    return unnest(worded, [doc], chunks, "chunk", "text")


def _pieces(text: str, separators: list[str]) -> tuple[list[str], list[str]]:
    """Text cut before each occurrence of the first separator that occurs; separators left to try."""
    for i, sep in enumerate(separators):
        if sep == "":
            return list(text), []
        if sep in text:
            head, *rest = text.split(sep)
            return [p for p in [head, *[sep + r for r in rest]] if p], separators[i + 1 :]
    return [text], []


def split_chars(text: str, size: int, overlap: int, separators: list[str]) -> list[str]:
    """Pack pieces of a text into chunks of at most ``size`` characters.

    Pieces that are too long are cut again by the next separator. A new chunk starts with the
    last pieces of the one before, up to ``overlap`` characters.
    """
    pieces, finer = _pieces(text, separators)
    chunks: list[str] = []
    window: list[str] = []

    def emit() -> None:
        joined = "".join(window).strip()
        if joined:
            chunks.append(joined)

    for piece in pieces:
        if len(piece) > size:
            emit()
            window.clear()
            chunks.extend(split_chars(piece, size, overlap, finer))
            continue
        held = sum(map(len, window))
        if held + len(piece) > size:
            emit()
            while window and (held > overlap or held + len(piece) > size):
                held -= len(window.pop(0))
        window.append(piece)
    emit()
    return chunks


# fixed values: order of the separators
SEPARATORS = ["\n\n", "\n", ". ", " ", ""]


def chunk_chars(docs: DataFrame, doc: str, text: str, size: int = 1200, overlap: int = 200) -> DataFrame:
    """(chunk_id, doc, chunk, text, meta). Packing is sequential, so it is a small helper per row.

    It takes rows a hundred at a time: an Arrow batch holds 10,000 whole texts and all their pieces at once.
    """

    @F.udf(ArrayType(StringType()), useArrow=False)
    def cut(t: str | None) -> list[str]:
        return [] if t is None else split_chars(t, size, overlap, SEPARATORS)

    pieces = unnest(docs, [doc], cut(F.col(text)), "chunk", "text")
    meta = F.create_map(F.lit("doc"), F.col(doc).cast("string"), F.lit("chunk"), F.col("chunk").cast("string"))
    return pieces.select(F.concat_ws("_", doc, "chunk").alias("chunk_id"), doc, "chunk", "text", meta.alias("meta"))


def score_distinct(
    docs: DataFrame, key: str, text: str, load: Callable[[], Callable[[list[str]], list[float]]], batch: int = 4
) -> DataFrame:
    """(key, score) from a user model; every distinct text (by cache key) is scored once.

    ``load`` runs once per task and returns the batch function. A failed batch is tried once more.
    Only keys and scores meet in the join back; AQE splits the rows of a text with many copies.
    """
    keyed = docs.select(key, text, cache_key("score", "", F.col(text)).alias("_ck"))
    once = keyed.groupBy("_ck").agg(F.min(text).alias("_text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            texts, scores = frame["_text"].tolist(), []
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                try:
                    scores += model(part)
                except Exception:
                    scores += model(part)
            yield pd.DataFrame({"_ck": frame["_ck"], "score": scores})

    scored = once.mapInPandas(run, "_ck string, score double")
    return keyed.select(key, "_ck").join(scored, "_ck", "left").select(key, "score")
