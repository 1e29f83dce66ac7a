"""Readable text of raw web pages, by native regular expressions in the row of the page."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.text import normalize_space
from loamwork.operators.documents import first_occurrences
from loamwork.session import hold

# fixed values: elements without content of their own, in the order they are removed
SWALLOWING = ["script", "style"]
REMOVED = ["noscript", "svg", "nav", "footer", "header"]
# fixed values: where the content is looked for
CONTENT = ["main", "article", "body"]
# fixed values: entities that are decoded, the ampersand last
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def removal_patterns() -> list[str]:
    """Comments, then elements with their content; an unclosed script or style runs to the end."""
    open_ended = [rf"(?is)<{t}(?:\s[^>]*)?>.*?(?:</{t}\s*>|\z)" for t in SWALLOWING]
    closed = [rf"(?is)<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in REMOVED]
    return [r"(?s)<!--.*?-->", *open_ended, *closed]


def content_pattern(tag: str) -> str:
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}\s*>|\z)"


def without_extras(html: Column) -> Column:
    """HTML without comments and elements that hold no content."""
    return reduce(lambda c, p: F.regexp_replace(c, p, ""), removal_patterns(), html)


def content_text(bare: Column) -> Column:
    """Text of the content element, from HTML without extras, with a line break for every tag."""
    found = [F.when(bare.rlike(content_pattern(t)), F.regexp_extract(bare, content_pattern(t), 1)) for t in CONTENT]
    lined = F.regexp_replace(F.coalesce(*found, bare), r"(?s)<[^>]*>", "\n")
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), lined)


def clean_html(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, text): lines longer than 2 characters, repeats removed, in one line."""
    bare = hold(pages.select(key, html), _bare=without_extras(F.col(html))).select(key, "_bare")
    lines = F.transform(F.split(content_text(F.col("_bare")), "\n"), normalize_space)
    kept = first_occurrences(bare, key, F.filter(lines, lambda x: F.length(x) > 2))
    return kept.select(key, F.array_join("items", " ").alias("text"))
