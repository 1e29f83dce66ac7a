"""Column functions that read requirements out of text lines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamwork.functions import wordlists as W
from loamwork.functions.text import bind, normalize_space, strip_accents
from loamwork.functions.values import clamp, recode


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    """Whether one of the parts occurs; one scan (see ``any_text``). A part that holds another one needs no look."""
    least = [p for p in parts if not any(o != p and o in p for o in parts)]
    if "" in least:
        return c.isNotNull() | F.lit(None)
    return c.rlike(W.any_text([(p, "", "") for p in least])) if least else F.lit(False)


def detect_section(line: Column, must: Sequence[str] = W.MUST_HEADERS, nice: Sequence[str] = W.NICE_HEADERS) -> Column:
    """'must' or 'nice' for a line with a header phrase, else NULL."""
    return bind(F.lower(line), lambda low: F.when(contains_any(low, must), "must").when(contains_any(low, nice), "nice"))


#: Patterns of every category, in the order in which they are tried.
CATEGORY_PATTERNS: dict[str, Sequence[str]] = {
    "education": W.EDUCATION_PATTERNS, "language": W.LANGUAGE_PATTERNS, "location": W.LOCATION_PATTERNS,
    "hard_skill": W.HARD_SKILL_PATTERNS, "soft_skill": W.SOFT_SKILL_PATTERNS, "experience": W.YEARS_PATTERNS,
}


def classify_category(line: Column, patterns: Mapping[str, Sequence[str]] = CATEGORY_PATTERNS) -> Column:
    """First matching category. Most lines have none, which one pattern for all of them tells."""
    def first(low: Column) -> Column:
        found = F.coalesce(*[F.when(low.rlike(W.java_pattern(list(p))), name) for name, p in patterns.items()], F.lit("other"))
        return F.when(low.rlike(any_category(patterns)), found).otherwise("other")

    return bind(F.lower(line), first)


def any_category(patterns: Mapping[str, Sequence[str]]) -> str:
    """One pattern that a line matches if it matches one of any category."""
    return W.java_pattern([p for own in patterns.values() for p in own])


def infer_priority(line: Column, section: Column, must: Sequence[str] = W.MUST_CUES, nice: Sequence[str] = W.NICE_CUES) -> Column:
    return bind(F.lower(line), lambda low: (
        F.when(contains_any(low, must), "must").when(contains_any(low, nice), "nice")
        .when(section.isin("must", "nice"), section).otherwise("unknown")
    ))


def section_bonus(section: Column) -> Column:
    return F.when(section == "must", 2.0).when(section == "nice", 1.0).otherwise(0.0)


def line_score(
    line: Column, section: Column, must: Sequence[str] = W.MUST_CUES, nice: Sequence[str] = W.NICE_CUES,
    patterns: Mapping[str, Sequence[str]] = CATEGORY_PATTERNS, plain: Column | None = None,
) -> Column:
    """Sum of the signals that a line states a requirement; 0 for very short or long lines.

    ``plain`` tells, where the caller knows it, that none of the cues and patterns is in the line.
    """
    # fixed values: weight of every category
    weights = {"experience": 2.0, "hard_skill": 2.5, "education": 2.5, "language": 2.0, "location": 1.5, "soft_skill": 1.5}

    def points(condition: Column, value: float) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    def signals(low: Column) -> Column:
        first = F.left(line, F.lit(1))
        shape = points(first.isin("•", "-", "*"), 2.0) + section_bonus(section) + points(line.contains(":") & (F.length(F.substring_index(line, ":", 1)) < 35), 0.5)
        if plain is not None:
            return shape + F.when(plain, F.lit(0.0)).otherwise(words(low))
        return shape + words(low)

    def words(low: Column) -> Column:
        cues = F.when(contains_any(low, [*must, *nice]), points(contains_any(low, must), 3.0) + points(contains_any(low, nice), 2.0)).otherwise(F.lit(0.0))
        named = [points(low.rlike(W.java_pattern(list(patterns[name]))), weight) for name, weight in weights.items() if name in patterns]
        known = F.when(low.rlike(any_category({n: p for n, p in patterns.items() if n in weights})), sum(named, F.lit(0.0))).otherwise(F.lit(0.0))
        return cues + known

    return F.when(bind(F.length(line), lambda n: n.between(12, 320)), bind(F.lower(line), signals)).otherwise(0.0)


def says_nothing(low: Column) -> Column:
    """Whether a lower-case line has no header phrase, cue or category pattern; one scan for all of them, as most lines have none."""
    phrases = [*W.MUST_HEADERS, *W.NICE_HEADERS, *W.MUST_CUES, *W.NICE_CUES]
    least = [p for p in phrases if not any(o != p and o in p for o in phrases)]
    return ~low.rlike(W.java_pattern([*[re.escape(p) for p in least], *[p for own in CATEGORY_PATTERNS.values() for p in own]]))


def strip_bullet(line: Column) -> Column:
    return normalize_space(F.regexp_replace(line, r"^[•\-*]\s*", ""))


def default_weight(priority: Column) -> Column:
    return F.when(priority == "must", 5.0).when(priority == "nice", 2.0).otherwise(1.5)


def guess_seniority(text: Column) -> Column:
    return bind(F.lower(text), lambda low: (
        F.when(low.contains("senior"), "senior").when(low.contains("junior"), "junior")
        .when(contains_any(low, ["medior", "mid-level", "mid level"]), "medior").otherwise("unknown")
    ))


def filler_passes(phrases: Sequence[str]) -> list[str]:
    r"""Patterns that leave out the phrases as words, one after the other, in as few passes as give the same result.

    A phrase that holds an earlier one can never stand any more. The others share a pass unless one could overlap with
    another of the pass.
    """
    live: list[str] = []
    passes: list[list[str]] = []

    def edges(p: str) -> set[int]:
        return {m.start() for m in re.finditer(r"\b", p)} - {0, len(p)}

    def overlap(a: str, b: str) -> bool:
        """Whether words at the end of a are words at the start of b."""
        return any(len(a) - x in edges(b) and b.startswith(a[x:]) for x in edges(a))

    for phrase in phrases:
        if any(re.search(rf"\b{re.escape(p)}\b", phrase) for p in live):
            continue
        live.append(phrase)
        if not passes or any(overlap(p, phrase) or overlap(phrase, p) or re.search(rf"\b{re.escape(phrase)}\b", p) for p in passes[-1]):
            passes.append([])
        passes[-1].append(phrase)
    return [rf"\b(?:{'|'.join(re.escape(p) for p in own)})\b" for own in passes]


#: All but ASCII letters, digits and the signs of keys. One class for letters and digits is one look at a character; a
#: class of ranges looks at each of them, which took most of the time of a key.
NO_KEY_SIGN = r"[^\p{Alnum}+.#/ ]"


def requirement_key(
    text: Column, synonyms: Mapping[str, str] = W.SYNONYMS, fillers: Sequence[str] = W.STOP_PHRASES, aliases: Mapping[str, str] = W.ALIASES
) -> Column:
    """Plain key of a requirement text: synonyms, without filler phrases, aliases."""
    return clean_key(normalize_space(text), synonyms, fillers, aliases)


def clean_key(
    clean: Column, synonyms: Mapping[str, str] = W.SYNONYMS, fillers: Sequence[str] = W.STOP_PHRASES, aliases: Mapping[str, str] = W.ALIASES
) -> Column:
    """``requirement_key`` of a text that has gone through ``normalize_space``."""
    bare = bind(F.lower(clean), strip_accents)
    plain = F.regexp_replace(F.replace(bare, F.lit("&"), F.lit(" and ")), NO_KEY_SIGN + "+", " ")
    key = bind(plain, lambda k: recode(k, synonyms))

    def without_fillers(k: Column) -> Column:
        bare = k
        for pattern in filler_passes(fillers):
            bare = F.regexp_replace(bare, pattern, " ")
        return F.when(contains_any(k, fillers), bare).otherwise(k)

    spaced = lambda k: F.regexp_replace(k, r"\s+", " ")
    if not any(re.search(r"[^\S ]", v) for v in synonyms.values()):  # then blanks are the only white space
        spaced = lambda k: F.when(k.contains("  "), F.regexp_replace(k, "  +", " ")).otherwise(k)
    return bind(F.trim(bind(bind(key, without_fillers), spaced)), lambda k: recode(k, aliases))


def canonical_requirement(text: Column, key: Column, entries: Mapping[str, Sequence[str]] = W.CANONICAL) -> Column:
    """Struct (canonical_key, canonical_text, category_hint, confidence) for a text and its key."""
    clean, guess = normalize_space(text), F.when(key_words(key) <= 3, 0.68).otherwise(0.52)
    return bind(canonical_entry(key, entries), lambda e: F.struct(
        F.coalesce(F.get(e, F.lit(0)), key).alias("canonical_key"), F.coalesce(F.get(e, F.lit(1)), clean).alias("canonical_text"),
        F.coalesce(F.get(e, F.lit(2)), F.lit("unknown")).alias("category_hint"), F.when(e.isNotNull(), 0.99).otherwise(guess).alias("confidence"),
    ))


def canonical_entry(key: Column, entries: Mapping[str, Sequence[str]] = W.CANONICAL) -> Column:
    """Array (canonical key, canonical text, category) of a known key, else NULL; one look-up."""
    known = F.create_map(*[c for k, v in entries.items() for c in (F.lit(k), F.array(*[F.lit(x) for x in v]))])
    return F.try_element_at(known, key)


def key_words(key: Column) -> Column:
    """Words of a plain key, which has one blank between them."""
    return F.when(key == "", 0).otherwise(F.length(key) - F.length(F.replace(key, F.lit(" "))) + 1)


def whole_part(first: str, core: str) -> str:
    """Pattern for ``core`` between edges of words: a place is left at once unless one of ``first`` stands there.

    The edges are looked at only there; a pattern that begins with them tries every place at length.
    """
    return rf"(?=[{first}])(?<![a-z0-9_])(?:{core})(?![a-z0-9_])"


def genericness(key: Column, generic: Sequence[str] = W.GENERIC_PARTS, concrete: Sequence[str] = W.CONCRETE_PARTS) -> Column:
    """Struct (is_generic, score, confidence, band) of a plain requirement key (see ``requirement_key``)."""
    # fixed values: weight of every signal
    score = bind(key_words(key), lambda words: bind(key.rlike("[0-9]"), lambda digit: (
        F.lit(0.50)
        + F.when(contains_any(key, generic), 0.32).otherwise(0.0)
        + F.when((words <= 2) & ~digit, 0.12).otherwise(0.0)
        - F.when(contains_any(key, ["aspon", "min"]) & key.rlike(whole_part("am", r"aspon|min\.?|minimalne")), 0.18).otherwise(0.0)
        - F.when(digit & key.rlike(whole_part("abc", "[abc][12]")), 0.24).otherwise(0.0)
        - F.when(digit & key.rlike(whole_part("0-9", "[0-9]+")), 0.20).otherwise(0.0)
        - F.when(contains_any(key, concrete), 0.30).otherwise(0.0)
        - F.when(words >= 6, 0.08).otherwise(0.0)
    )))
    return bind(F.round(clamp(score, 0.0, 1.0), 4), lambda bounded: F.struct(
        (bounded >= 0.5).alias("is_generic"), bounded.alias("score"),
        F.round(F.least(F.abs(bounded - 0.5) + 0.55, F.lit(0.99)), 4).alias("confidence"),
        F.when(bounded <= 0.25, "strong_concrete").when(bounded >= 0.75, "strong_generic").otherwise("weak").alias("band"),
    ))
