"""Text column functions. All but the ``unicodedata`` variant are native expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# NUL, the four separators of ASCII and all Unicode white space. Single signs and one property make two looks at a
# character; a class of many ranges looks at each, most of all where tasks share a process.
SPACE_CLASS = r"[\x00\x1C\x1D\x1E\x1F\p{IsWhite_Space}]"


def _accent_pairs() -> tuple[str, str]:
    """Letters of Latin, Greek and Cyrillic blocks that decompose to one base letter."""
    blocks = [(0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000)]
    source, target = [], []
    for low, high in blocks:
        for code in range(low, high):
            base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
            if len(base) == 1 and base[0] != chr(code):
                source.append(chr(code))
                target.append(base[0])
    return "".join(source), "".join(target)


ACCENTED, UNACCENTED = _accent_pairs()


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def normalize_space(c: Column) -> Column:
    """NUL and every run of white space become one space; ends are trimmed.

    Nothing is replaced in texts whose white space is single blanks, which is what most are.
    """
    replaced = lambda x: F.regexp_replace(x, SPACE_CLASS + "+", " ")
    odd = lambda x: x.contains("  ") | x.rlike(rf"[[^ -~]&&{SPACE_CLASS}]")
    return F.trim(bind(c, lambda x: F.when(odd(x), replaced(x)).otherwise(x)))


def is_ascii(c: Column) -> Column:
    """Whether every character takes one byte."""
    return F.octet_length(c) == F.length(c)


def strip_accents(c: Column) -> Column:
    """Base letters for accented Latin, Greek and Cyrillic letters; combining marks go.

    Texts without such characters skip the per-character table.
    """
    bare = F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"[\x{300}-\x{36F}]", "")
    return F.when(is_ascii(c), c).otherwise(bare)


@F.pandas_udf(StringType())
def strip_accents_full(texts: pd.Series) -> pd.Series:
    """Full compatibility decomposition for all of Unicode; slower than ``strip_accents``."""
    decomposed = texts.str.normalize("NFKD")
    return decomposed.map(lambda t: None if t is None else "".join(ch for ch in t if not unicodedata.combining(ch)))


def normalize_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits, all else one space."""
    return key_of_clean(normalize_space(c))


def key_of_clean(c: Column) -> Column:
    """``normalize_key`` of a text that has gone through ``normalize_space``."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{Alnum}]+", " "))


def lookup_key(c: Column) -> Column:
    return F.coalesce(strip_accents(F.lower(normalize_space(c))), F.lit(""))


def lookup_key_text(name: str) -> str:
    """``lookup_key`` for a column name, used while a schema is read."""
    folded = unicodedata.normalize("NFKD", " ".join(name.split()).lower())
    return "".join(ch for ch in folded if not unicodedata.combining(ch))


def split_lines(c: Column) -> Column:
    """Lines of a text as an array."""
    return F.split(bind(c, lambda x: F.when(x.contains("\r"), F.regexp_replace(x, "\r\n?", "\n")).otherwise(x)), "\n")


def split_words(c: Column) -> Column:
    """Words of a text; no entry for a blank text."""
    return F.filter(F.split(normalize_space(c), " "), lambda w: w != "")


def word_count(c: Column) -> Column:
    return bind(normalize_space(c), lambda clean: F.when(clean == "", 0).otherwise(F.length(clean) - F.length(F.replace(clean, F.lit(" "))) + 1))


def token_jaccard(a: Column, b: Column) -> Column:
    """Share of common tokens of two key texts; 0 when one is blank."""
    left, right = F.split(a, " "), F.split(b, " ")
    share = F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(share)


# fixed values: least share of common words or of length, and least length of a contained key
SIMILAR_LEAST, SIMILAR_SHORTEST = 0.72, 18


def looks_like_duplicate(a: Column, b: Column) -> Column:
    """Whether two key texts (see ``normalize_key``) say the same."""
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    contained = (F.contains(a, b) | F.contains(b, a)) & (shorter >= SIMILAR_SHORTEST) & (shorter / longer >= SIMILAR_LEAST)
    return F.when((a == "") | (b == ""), F.lit(False)).otherwise(
        (a == b) | contained | (token_jaccard(a, b) >= SIMILAR_LEAST)
    )


def is_heading_line(line: Column) -> Column:
    """At most 8 words, and mostly capitals or a section number in front."""
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    loud = bind(letters, lambda n: (n > 0) & (capitals >= n * 0.7))
    return (word_count(line) <= 8) & (loud | line.rlike(r"^[0-9]+(\.[0-9]+)*\s+\S"))


def is_header_footer_line(line: Column, known: list[str] | None = None) -> Column:
    """Page number lines, dotted leaders, short all-capital lines and given running titles."""
    clean = F.trim(line)
    page = F.lower(clean).rlike(r"^(strana|page)\s+[0-9]+(\s*/\s*[0-9]+)?$")
    leader = clean.rlike(r"[.\-–—]{3,}")
    shout = (clean == F.upper(clean)) & clean.rlike(r"\p{L}") & (word_count(clean) <= 6)
    hit = page | leader | shout
    if known:
        hit = hit | clean.isin(known)
    return (clean != "") & hit


def truncate_middle(c: Column, max_chars: int, marker: str = "\n\n[...SKRATENE...]\n\n") -> Column:
    """Head and tail halves around a marker when the trimmed text is longer than ``max_chars``."""
    clean, half = F.trim(c), max_chars // 2
    return F.when(F.length(clean) <= max_chars, clean).otherwise(
        F.concat(F.left(clean, F.lit(half)), F.lit(marker), F.right(clean, F.lit(half)))
    )


def summary_or_prefix(summary: Column, text: Column, chars: int = 500) -> Column:
    return F.coalesce(F.nullif(summary, F.lit("")), F.left(text, F.lit(chars)))


def after_last_marker(c: Column, marker: str) -> Column:
    """Text behind the last marker with collapsed white space."""
    return normalize_space(F.substring_index(c, marker, -1))


def first_output_line(c: Column) -> Column:
    """First line without quotes and spaces at its ends; 'ERROR' for a blank text."""
    line = F.btrim(F.substring_index(c, "\n", 1), F.lit('" '))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("ERROR")).otherwise(line)


def retrieval_query_text(summary: Column, terms: Column, n: int | None = None) -> Column:
    """Query text from a summary and all or the first ``n`` terms of an array."""
    # fixed values: wording of the query text
    return F.concat(
        F.lit("Právny kontext: "), summary, F.lit("\nKľúčové pojmy: "), F.array_join(terms if n is None else F.slice(terms, 1, n), ", ")
    )


def clean_title_line(c: Column) -> Column:
    """First non-blank line without quotes and without a leading NADPIS: or POJEM: label."""
    quotes = '"„”'
    body = F.regexp_replace(F.coalesce(c, F.lit("")), rf'^[\s{quotes}]+|[\s{quotes}]+$', "")
    line = F.trim(F.regexp_extract(body, r"([^\n]*\S[^\n]*)", 1))
    plain = F.regexp_replace(line, r"(?i)^\s*(NADPIS|POJEM)\s*[:\-–]\s*", "")
    return F.btrim(F.trim(plain), F.lit(quotes))


def strip_thinking(c: Column) -> Column:
    """Remove closed thinking blocks; when a stray end tag remains keep what follows the first."""
    open_close = F.trim(F.regexp_replace(c, r"(?is)<think>.*?</think>", ""))
    after = F.substring(open_close, F.locate("</think>", open_close) + 8, 2**31 - 1)
    return F.trim(F.when(open_close.contains("</think>"), after).otherwise(open_close))


def strip_code_fence(c: Column) -> Column:
    """Remove a code fence at the start and at the end of the text."""
    head = F.regexp_replace(F.trim(c), r"(?i)^```(json|sql|markdown)?\s*", "")
    return F.trim(F.regexp_replace(head, r"\s*```\s*$", ""))


def extract_select(c: Column) -> Column:
    """First SELECT statement in free text on one line without its semicolon, else NULL."""
    unfenced = F.regexp_replace(c, r"(?im)^```(sql)?\s*|\s*```$", "")
    found = F.regexp_extract(unfenced, r"(?is)(?:^|[^a-z0-9_])(select[^a-z0-9_;][^;]*)(?:;|$)", 1)
    return F.nullif(normalize_space(found), F.lit(""))


def email_username(first: Column, last: Column, domain: str) -> Column:
    """Struct (email, username) from a name, lower-case and without accents."""
    f, l = strip_accents(F.lower(F.trim(first))), strip_accents(F.lower(F.trim(last)))
    return F.struct(
        F.concat(f, F.lit("."), l, F.lit("@" + domain)).alias("email"),
        F.concat(F.left(f, F.lit(1)), l).alias("username"),
    )


def cache_key(prefix: str, model: str, text: Column) -> Column:
    return F.sha1(F.concat(F.lit(f"{prefix}||{model}||"), normalize_space(text)))
