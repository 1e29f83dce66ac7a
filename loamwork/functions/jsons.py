"""JSON columns: result lists, lenient parsing, validated evaluation records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loamwork.functions.text import bind, normalize_space, strip_thinking
from loamwork.functions.values import clamp, safe_float

RESULTS = "struct<web: struct<results: array<struct<url: string, description: string>>>, news: struct<results: array<struct<url: string, description: string>>>>"


def flatten_results(df: DataFrame, key: str, body: str) -> DataFrame:
    """(key, url, description) for every web and news result of a response document.

    Both lists come out of one scan: they are joined as arrays before the expansion.
    """
    parsed = F.from_json(body, RESULTS)
    empty = F.from_json(F.lit("[]"), "array<struct<url: string, description: string>>")
    both = F.concat(F.coalesce(parsed["web"]["results"], empty), F.coalesce(parsed["news"]["results"], empty))
    return df.select(key, F.explode(both).alias("r")).select(key, "r.url", "r.description")


def unfence_json(c: Column) -> Column:
    head = F.trim(F.regexp_replace(strip_thinking(c), r"(?i)^```(?:json)?", ""))
    return F.trim(F.regexp_replace(head, r"```$", ""))


def last_json_value(text: str) -> str | None:
    """The object or array that starts last among those that parse.

    Read from the end, so the first hit is the answer. A bracket with another one directly inside has failed with
    it, so nested text is neither parsed again nor descended into.
    """
    decode = json.JSONDecoder().raw_decode
    end = len(text)
    for at in [m.start() for m in re.finditer(r"[\[{]", text)][::-1]:
        between, end_before = text[at + 1 : end], end
        end = at
        if end_before < len(text) and not re.search(r'["\]}]', between):
            continue
        try:
            return json.dumps(decode(text, at)[0], ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            pass
    return None


@F.pandas_udf(StringType())
def _salvage(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: None if t is None else last_json_value(t))


def parse_lenient(df: DataFrame, column: str, name: str, fallback: str = "null") -> DataFrame:
    """Add the JSON text found in ``column``: the whole text, else its last JSON part, else the
    fallback. Only rows that fail the built-in parser carry a text to the Python workers, and what
    they find goes through the same parser, so object keys come in one order."""
    clean = df.withColumn("_clean", unfence_json(F.col(column)))
    direct = F.try_parse_json("_clean")
    checked = clean.withColumn("_direct", F.to_json(direct))
    broken = F.when(F.col("_direct").isNull(), F.col("_clean"))
    salvaged = F.to_json(F.try_parse_json(_salvage(broken)))
    return checked.withColumn(name, F.coalesce("_direct", salvaged, F.lit(fallback))).drop("_clean", "_direct")


EVALUATION = "requirement_id string, requirement string, status string, score string, confidence string, evidence_used array<string>, explanation string, risk_note string"


def dedupe_texts(items: Column, limit: int | None = None) -> Column:
    """Distinct texts without regard to case, first spelling kept, all or at most ``limit``."""
    clean = F.transform(items, lambda x, i: F.struct(normalize_space(x).alias("x"), i.alias("i")))
    keyed = F.transform(F.filter(clean, lambda e: e["x"] != ""), lambda e: F.struct(F.lower(e["x"]).alias("k"), e["i"].alias("i"), e["x"].alias("x")))

    def firsts(s: Column) -> Column:
        """Of entries sorted by key and place, the first of every key."""
        return F.filter(s, lambda e, i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0)))["k"] != e["k"]))

    found = F.transform(bind(F.sort_array(keyed), firsts), lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x")))
    kept = F.transform(F.sort_array(found), lambda e: e["x"])
    return F.when(items.isNull(), F.array().cast("array<string>")).otherwise(kept if limit is None else F.slice(kept, 1, limit))


def validate_evaluation(body: Column, evidence: Column, limit: int | None = None, found: int | None = None) -> Column:
    """Evaluation record with known status, clamped numbers and all or ``limit`` evidences.

    A record without evidences takes those found for it, all or the first ``found``.
    """
    raw = F.from_json(body, EVALUATION)
    # fixed values: known statuses, the first is the default
    statuses = ["nejasne", "splnene", "ciastocne_splnene", "nesplnene"]
    used = F.coalesce(raw["evidence_used"], evidence if found is None else F.slice(evidence, 1, found))
    return F.struct(
        F.when(raw["status"].isin(statuses), raw["status"]).otherwise(F.lit(statuses[0])).alias("status"),
        clamp(safe_float(raw["score"]), 0.0, 100.0).alias("score"),
        clamp(safe_float(raw["confidence"]), 0.0, 1.0).alias("confidence"),
        dedupe_texts(used, limit).alias("evidence_used"),
        F.coalesce(F.nullif(raw["explanation"], F.lit("")), F.lit("Bez vysvetlenia.")).alias("explanation"),
        F.coalesce(raw["risk_note"], F.lit("")).alias("risk_note"),
    )


# fixed values: list fields of a candidate profile
CANDIDATE_LISTS = ["skills", "experience", "education", "languages", "certifications", "risks_or_missing_info"]


def candidate_lists(body: Column, limit: int | None = None) -> Column:
    """The list fields of a candidate profile, each cleaned and without repeats."""
    raw = F.from_json(body, ", ".join(f"{n} array<string>" for n in CANDIDATE_LISTS))
    return F.struct(*[dedupe_texts(raw[n], limit).alias(n) for n in CANDIDATE_LISTS])
