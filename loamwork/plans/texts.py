"""Text operators, bound to documents, pages, conversations and embeddings."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from loamwork.functions import requirements as R
from loamwork.functions import text as T
from loamwork.functions import vectors
from loamwork.functions import wordlists as W
from loamwork.operators import conversations as CV
from loamwork.operators import documents as D
from loamwork.operators import joins as J
from loamwork.operators import pages as PG
from loamwork.operators import requirements as RQ
from loamwork.operators import similarity as SM
from loamwork.plans.joining import TERM_COUNT_SQL, matched_terms
from loamwork.plans.registry import query
from loamwork.session import hold, table, unnest


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


#: Unicode white space and NUL, for RE2.
SPACES = r"[\x00\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def space_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACES}+', ' ', 'g'))"


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("normalize_space", f"SELECT doc_id, {space_sql('text')} AS clean FROM documents")
def normalize_space(spark, sf):
    return documents(spark, sf).select("doc_id", T.normalize_space(F.col("text")).alias("clean"))


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS bare FROM documents")
def strip_accents(spark, sf):
    return documents(spark, sf).select("doc_id", T.strip_accents(F.col("text")).alias("bare"))


KEY_SQL = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query("normalize_key", f"SELECT doc_id, {KEY_SQL.format('text')} AS k FROM documents")
def normalize_key(spark, sf):
    return documents(spark, sf).select("doc_id", T.normalize_key(F.col("text")).alias("k"))


@query("lookup_key", f"SELECT doc_id, coalesce(strip_accents(lower({space_sql('text')})), '') AS k FROM documents")
def lookup_key(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.lookup_key(F.col("text")).alias("k"))


@query("cache_key", f"SELECT doc_id, sha1('score||m1||' || {space_sql('text')}) AS ck FROM documents")
def cache_key(spark, sf):
    return documents(spark, sf).select("doc_id", T.cache_key("score", "m1", F.col("text")).alias("ck"))


# --- job advertisements: whole document lines, with lines of requirement wording put between them ---

AD_LINE = """coalesce(CASE length({x}) % 11 WHEN 0 THEN 'Requirements' WHEN 1 THEN '- must know Python and SQL: ' || left({x}, 60) WHEN 2 THEN '• 3+ years of experience, ' || left({x}, 60)
 WHEN 3 THEN 'Nice to have' WHEN 4 THEN 'fluent English B2 ' || left({x}, 40) WHEN 5 THEN 'Master degree or university: ' || left({x}, 60)
 WHEN 6 THEN 'Bratislava hybrid team, ' || left({x}, 30) WHEN 7 THEN '* communication and leadership ' || left({x}, 50) WHEN 8 THEN 'Senior data engineer ' || left({x}, 20) END || chr(10), '') || {x}"""
AD_SQL = f"ads AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: {AD_LINE.format(x='x')}), chr(10)) AS text FROM documents)"
LINES_SQL = AD_SQL + f""", lines AS (SELECT doc_id, pos, line FROM (SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, {space_sql('unnest(p)')} AS line
 FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM ads)) WHERE line <> '')"""


def with_lengths(line: str, n: int) -> str:
    """The lines of ``text`` by the SQL of one ``line``, its length modulo n taken once and not for every case."""
    counted = line.replace(f"length({{x}}) % {n}", "{x}.n").replace("{x}", "x.v").replace("x.v.n", "x.n")
    return f"transform(transform(split(text, '\\n'), v -> named_struct('v', v, 'n', length(v) % {n})), x -> {counted})"


def ads(spark, sf):
    lines = F.expr(with_lengths(AD_LINE, 11))
    return documents(spark, sf).select("doc_id", F.array_join(lines, "\n").alias("text"))


def ad_lines(spark, sf):
    return RQ.document_lines(ads(spark, sf), "doc_id", "text")


def any_sql(x: str, parts: list[str]) -> str:
    return f"regexp_matches({x}, {q('|'.join(re.escape(p) for p in parts))})"


def pattern_sql(x: str, patterns: list[str]) -> str:
    return f"regexp_matches({x}, {q(W.any_pattern(patterns))})"


SECTION_SQL = f"CASE WHEN {any_sql('lower(line)', W.MUST_HEADERS)} THEN 'must' WHEN {any_sql('lower(line)', W.NICE_HEADERS)} THEN 'nice' END"
CATEGORY_SQL = f"""CASE WHEN {pattern_sql('lower(line)', W.EDUCATION_PATTERNS)} THEN 'education' WHEN {pattern_sql('lower(line)', W.LANGUAGE_PATTERNS)} THEN 'language'
 WHEN {pattern_sql('lower(line)', W.LOCATION_PATTERNS)} THEN 'location' WHEN {pattern_sql('lower(line)', W.HARD_SKILL_PATTERNS)} THEN 'hard_skill'
 WHEN {pattern_sql('lower(line)', W.SOFT_SKILL_PATTERNS)} THEN 'soft_skill' WHEN {pattern_sql('lower(line)', W.YEARS_PATTERNS)} THEN 'experience' ELSE 'other' END"""
SCORE_SQL = f"""CASE WHEN length(line) < 12 OR length(line) > 320 THEN 0 ELSE (CASE WHEN regexp_matches(line, '^[•*-]') THEN 2 ELSE 0 END) + (CASE WHEN {any_sql('lower(line)', W.MUST_CUES)} THEN 3 ELSE 0 END)
 + (CASE WHEN {any_sql('lower(line)', W.NICE_CUES)} THEN 2 ELSE 0 END) + (CASE section WHEN 'must' THEN 2 WHEN 'nice' THEN 1 ELSE 0 END)
 + (CASE WHEN {pattern_sql('lower(line)', W.YEARS_PATTERNS)} THEN 2 ELSE 0 END) + (CASE WHEN {pattern_sql('lower(line)', W.HARD_SKILL_PATTERNS)} THEN 2.5 ELSE 0 END)
 + (CASE WHEN {pattern_sql('lower(line)', W.EDUCATION_PATTERNS)} THEN 2.5 ELSE 0 END) + (CASE WHEN {pattern_sql('lower(line)', W.LANGUAGE_PATTERNS)} THEN 2 ELSE 0 END)
 + (CASE WHEN {pattern_sql('lower(line)', W.LOCATION_PATTERNS)} THEN 1.5 ELSE 0 END) + (CASE WHEN {pattern_sql('lower(line)', W.SOFT_SKILL_PATTERNS)} THEN 1.5 ELSE 0 END)
 + (CASE WHEN contains(line, ':') AND length(split_part(line, ':', 1)) < 35 THEN 0.5 ELSE 0 END) END"""
STATE_SQL = LINES_SQL + f""", marked AS (SELECT *, {SECTION_SQL} AS header FROM lines),
 state AS (SELECT doc_id, pos, line, section FROM (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM marked) WHERE header IS NULL)"""
PRIORITY_SQL = f"CASE WHEN {any_sql('lower(line)', W.MUST_CUES)} THEN 'must' WHEN {any_sql('lower(line)', W.NICE_CUES)} THEN 'nice' WHEN section IS NOT NULL THEN section ELSE 'unknown' END"


@query("detect_section", f"WITH {LINES_SQL} SELECT doc_id, pos, {SECTION_SQL} AS section FROM lines")
def detect_section(spark, sf):
    return ad_lines(spark, sf).select("doc_id", "pos", R.detect_section(F.col("line")).alias("section"))


@query("section_state", f"WITH {STATE_SQL} SELECT doc_id, pos, section FROM state")
def section_state(spark, sf):
    return RQ.section_state(ads(spark, sf), "doc_id", "text").select("doc_id", "pos", "section")


@query("classify_category", f"WITH {LINES_SQL} SELECT doc_id, pos, {CATEGORY_SQL} AS category FROM lines")
def classify_category(spark, sf):
    return ad_lines(spark, sf).select("doc_id", "pos", R.classify_category(F.col("line")).alias("category"))


@query("infer_priority", f"WITH {STATE_SQL} SELECT doc_id, pos, {PRIORITY_SQL} AS priority FROM state")
def infer_priority(spark, sf):
    state = RQ.section_state(ads(spark, sf), "doc_id", "text")
    return state.select("doc_id", "pos", R.infer_priority(F.col("line"), F.col("section")).alias("priority"))


@query("line_score", f"WITH {STATE_SQL} SELECT doc_id, pos, CAST({SCORE_SQL} AS DOUBLE) AS score FROM state")
def line_score(spark, sf):
    state = RQ.section_state(ads(spark, sf), "doc_id", "text")
    return state.select("doc_id", "pos", R.line_score(F.col("line"), F.col("section")).alias("score"))


ROLE_SQL = "regexp_matches(lower(line), 'engineer|scientist|developer|analyst|manager|specialist')"


@query(
    "guess_title",
    f"""WITH {LINES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM lines),
        t AS (SELECT doc_id, arg_min(line, pos) AS title FROM n WHERE length(line) BETWEEN 8 AND 120 AND {ROLE_SQL} GROUP BY 1)
        SELECT doc_id, coalesce(title, 'unknown') AS job_title FROM ads LEFT JOIN t USING (doc_id)""",
)
def guess_title(spark, sf):
    return RQ.guess_title(ads(spark, sf), "doc_id", "text").select("doc_id", "job_title")


SENIORITY_SQL = "CASE WHEN contains(lower(text), 'senior') THEN 'senior' WHEN contains(lower(text), 'junior') THEN 'junior' WHEN regexp_matches(lower(text), 'medior|mid-level|mid level') THEN 'medior' ELSE 'unknown' END"


@query("guess_seniority", f"WITH t AS (SELECT doc_id, source || CASE doc_id % 4 WHEN 0 THEN ' Junior ' WHEN 1 THEN ' mid-level' ELSE '' END || CASE WHEN lang = 'en' THEN 'SENIOR' ELSE '' END || text AS text FROM documents) SELECT doc_id, {SENIORITY_SQL} AS seniority FROM t")
def guess_seniority(spark, sf):
    level = F.when(F.col("doc_id") % 4 == 0, " Junior ").when(F.col("doc_id") % 4 == 1, " mid-level").otherwise("")
    text = F.concat("source", level, F.when(F.col("lang") == "en", "SENIOR").otherwise(""), "text")
    return table(spark, sf, "documents").select("doc_id", R.guess_seniority(text).alias("seniority"))


DUP_SQL = """CASE WHEN a = '' OR b = '' THEN false ELSE a = b OR ((contains(a, b) OR contains(b, a)) AND least(length(a), length(b)) >= 18 AND least(length(a), length(b)) / greatest(length(a), length(b)) >= 0.72)
 OR len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))) >= 0.72 END"""


@query(
    "looks_like_duplicate",
    f"WITH {LINES_SQL}, k AS (SELECT doc_id, pos, {KEY_SQL.format('line')} AS a, {KEY_SQL.format(chr(39) + 'more ' + chr(39) + ' || left(line, greatest(length(line) - length(line) % 7 * 3, 0))')} AS b FROM lines) SELECT doc_id, pos, {DUP_SQL} AS duplicate FROM k",
)
def looks_like_duplicate(spark, sf):
    shortened = F.expr("'more ' || left(line, greatest(length(line) - length(line) % 7 * 3, 0))")
    keyed = hold(ad_lines(spark, sf), a=T.normalize_key(F.col("line")), b=T.normalize_key(shortened))
    return keyed.select("doc_id", "pos", T.looks_like_duplicate(F.col("a"), F.col("b")).alias("duplicate"))


# the duplicate rule between a kept entry m and a new entry x
SAME_SQL = DUP_SQL.replace("(a, b)", "(m.key, x[1].key)").replace("(b, a)", "(x[1].key, m.key)").replace("a = '' OR b = ''", "m.key = '' OR x[1].key = ''").replace("a = b", "m.key = x[1].key").replace("(a)", "(m.key)").replace("(b)", "(x[1].key)").replace("(a, ' ')", "(m.key, ' ')").replace("(b, ' ')", "(x[1].key, ' ')")
TWIN_SQL = f"coalesce(list_position(list_transform(acc, lambda m: {SAME_SQL}), true), 0)"
CANDIDATE_SQL = STATE_SQL + f""", scored AS (SELECT doc_id, pos, section, CAST({SCORE_SQL} AS DOUBLE) AS score, {space_sql("regexp_replace(line, '^[•*-]\\s*', '')")} AS line FROM state),
 candidates AS (SELECT doc_id, pos, line AS text, {KEY_SQL.format('line')} AS key, {CATEGORY_SQL} AS category, {PRIORITY_SQL} AS priority, score FROM scored WHERE score >= 2.5),
 folded AS (SELECT doc_id, list_reduce(list([{{'key': key, 'text': text, 'category': category, 'priority': priority, 'score': score, 'pos': pos}}] ORDER BY pos), lambda acc, x:
   CASE WHEN {TWIN_SQL} = 0 THEN list_concat(acc, x) ELSE list_transform(acc, lambda m, i: CASE WHEN i = {TWIN_SQL} AND x[1].score > m.score THEN x[1] ELSE m END) END) AS found FROM candidates GROUP BY doc_id),
 found AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY f.score DESC, f.pos) AS n, f.* FROM (SELECT doc_id, unnest(found) AS f FROM folded))"""
WEIGHT_SQL = "CASE priority WHEN 'must' THEN 5.0::DOUBLE WHEN 'nice' THEN 2.0 ELSE 1.5 END"


@query("job_requirements", f"WITH {CANDIDATE_SQL} SELECT doc_id, 'R' || n AS id, text, category, priority, {WEIGHT_SQL} AS weight FROM found")
def job_requirements(spark, sf):
    return RQ.job_requirements(ads(spark, sf), "doc_id", "text")


# --- requirement keys and lists ---------------------------------------------------------------------

REQ_LINE = """coalesce(CASE length({x}) % 13 WHEN 0 THEN 'Znalosť Python' WHEN 1 THEN 'Skúsenosti s Pythonom' WHEN 2 THEN 'MS Excel' WHEN 3 THEN 'Anglický jazyk' WHEN 4 THEN 'prax v SQL & Git'
 WHEN 5 THEN 'komunikačné schopnosti' WHEN 6 THEN 'aspoň 3 roky praxe s Dockerom ' || left({x}, 12) WHEN 7 THEN 'REST APIs' WHEN 8 THEN 'prezentačné schopnosti' WHEN 9 THEN 'Angličtina na úrovni B2' END || chr(10), '') || {x}"""
REQ_FIELDS = """CASE pos % 4 WHEN 0 THEN 'hard_skill' WHEN 1 THEN 'odd' WHEN 2 THEN 'other' END AS category, CASE pos % 3 WHEN 0 THEN 'must' WHEN 1 THEN 'x' ELSE 'nice' END AS priority,
 CASE WHEN pos % 5 = 0 THEN 'bad' ELSE CAST(pos % 9 AS {text}) END AS weight"""
REQ_ROWS_SQL = f"""posted AS (SELECT doc_id, string_split(array_to_string(list_transform(string_split(text, chr(10)), lambda x: {REQ_LINE.format(x='x')}), chr(10)), chr(10)) AS p FROM documents),
 reqs AS (SELECT doc_id, pos, text, {REQ_FIELDS.format(text='VARCHAR')} FROM (SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, {space_sql('unnest(p)')} AS text FROM posted) WHERE text <> '')"""


def posted(spark, sf):
    lines = F.expr(with_lengths(REQ_LINE, 13))
    return documents(spark, sf).select("doc_id", F.array_join(lines, "\n").alias("text"))


def requirement_rows(spark, sf):
    rows = RQ.document_lines(posted(spark, sf), "doc_id", "text").withColumnRenamed("line", "text")
    return rows.selectExpr("doc_id", "pos", "text", *_fields())


def _fields():
    category, priority, weight = REQ_FIELDS.format(text="STRING").replace("AS category, ", "AS category; ").replace("AS priority,\n ", "AS priority; ").split("; ")
    return category, priority, weight


def requirement_lists(spark, sf):
    """(doc_id, items): the same rows as arrays in their document's row."""
    lines = F.filter(F.transform(T.split_lines(F.col("text")), lambda x, i: F.struct(i.alias("pos"), T.normalize_space(x).alias("text"))), lambda r: r["text"] != "")
    fields = ", ".join(f"'{name}', {e.rsplit(' AS ', 1)[0].replace('pos', 'r.pos')}" for name, e in zip(("category", "priority", "weight"), _fields()))
    held = posted(spark, sf).select("doc_id", "text", lines.alias("l"))
    return held.select("doc_id", "text", F.expr(f"transform(l, r -> named_struct('pos', r.pos, 'text', r.text, {fields}))").alias("items"))


def case_sql(x: str, mapping: dict, default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


def requirement_key_sql(x: str) -> str:
    """Chain of sub-selects turned into one expression over ``x``."""
    plain = f"regexp_replace(replace(strip_accents(lower({space_sql(x)})), '&', ' and '), '[^a-zA-Z0-9+.#/ ]+', ' ', 'g')"
    return plain


def keyed_sql(source: str) -> str:
    """CTE chain k0..k3 adding ``key`` to the rows of ``source``."""
    removed = "k"
    for phrase in W.STOP_PHRASES:
        removed = f"regexp_replace({removed}, {q(chr(92) + 'b' + re.escape(phrase).replace(chr(92) + ' ', ' ') + chr(92) + 'b')}, ' ', 'g')"
    return f"""k0 AS (SELECT *, {requirement_key_sql('text')} AS raw FROM {source}), k1 AS (SELECT *, {case_sql('raw', W.SYNONYMS, 'raw')} AS k FROM k0),
     k2 AS (SELECT *, trim(regexp_replace({removed}, '\\s+', ' ', 'g')) AS k9 FROM k1), keyed AS MATERIALIZED (SELECT * EXCLUDE (raw, k, k9), {case_sql('k9', W.ALIASES, 'k9')} AS key FROM k2)"""


WORDS_SQL = "CASE WHEN key = '' THEN 0 ELSE len(string_split(key, ' ')) END"
CANON_SQL = f"""canon AS MATERIALIZED (SELECT *, {case_sql('key', {k: v[0] for k, v in W.CANONICAL.items()}, 'key')} AS canonical_key, {case_sql('key', {k: v[1] for k, v in W.CANONICAL.items()}, space_sql('text'))} AS canonical_text,
 {case_sql('key', {k: v[2] for k, v in W.CANONICAL.items()}, q('unknown'))} AS category_hint, CASE WHEN key IN ({', '.join(q(k) for k in W.CANONICAL)}) THEN 0.99::DOUBLE WHEN {WORDS_SQL} <= 3 THEN 0.68 ELSE 0.52 END AS confidence FROM keyed)"""
GENERIC_SQL = f"""round(least(greatest(0.5::DOUBLE + (CASE WHEN {any_sql('key', W.GENERIC_PARTS)} THEN 0.32 ELSE 0 END) + (CASE WHEN {WORDS_SQL} <= 2 AND NOT regexp_matches(key, '[0-9]') THEN 0.12 ELSE 0 END)
 - (CASE WHEN regexp_matches(key, '\\b(aspon|min\\.?|minimalne)\\b') THEN 0.18 ELSE 0 END) - (CASE WHEN regexp_matches(key, '\\b(a1|a2|b1|b2|c1|c2)\\b') THEN 0.24 ELSE 0 END)
 - (CASE WHEN regexp_matches(key, '\\b[0-9]+\\b') THEN 0.20 ELSE 0 END) - (CASE WHEN {any_sql('key', W.CONCRETE_PARTS)} THEN 0.30 ELSE 0 END) - (CASE WHEN {WORDS_SQL} >= 6 THEN 0.08 ELSE 0 END), 0), 1), 4)"""


@query("requirement_key", f"WITH {REQ_ROWS_SQL}, {keyed_sql('reqs')} SELECT doc_id, pos, key FROM keyed")
def requirement_key(spark, sf):
    return requirement_rows(spark, sf).select("doc_id", "pos", R.requirement_key(F.col("text")).alias("key"))


@query("canonical_requirement", f"WITH {REQ_ROWS_SQL}, {keyed_sql('reqs')}, {CANON_SQL} SELECT doc_id, pos, canonical_key, canonical_text, category_hint, confidence FROM canon")
def canonical_requirement(spark, sf):
    keyed = hold(requirement_rows(spark, sf), key=R.requirement_key(F.col("text")))
    return keyed.select("doc_id", "pos", R.canonical_requirement(F.col("text"), F.col("key")).alias("c")).select("doc_id", "pos", "c.*")


@query(
    "genericness_score",
    f"""WITH {REQ_ROWS_SQL}, {keyed_sql('reqs')}, g AS (SELECT doc_id, pos, {GENERIC_SQL} AS score FROM keyed)
        SELECT doc_id, pos, score, score >= 0.5 AS is_generic, round(least(0.55 + abs(score - 0.5), 0.99), 4) AS confidence,
               CASE WHEN score <= 0.25 THEN 'strong_concrete' WHEN score >= 0.75 THEN 'strong_generic' ELSE 'weak' END AS band FROM g""",
)
def genericness_score(spark, sf):
    keyed = hold(requirement_rows(spark, sf), key=R.requirement_key(F.col("text")))
    return keyed.select("doc_id", "pos", R.genericness(F.col("key")).alias("g")).select("doc_id", "pos", "g.*")


CLEAN_SQL = f"""{REQ_ROWS_SQL}, {keyed_sql('reqs')}, {CANON_SQL},
 firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, canonical_key ORDER BY pos) AS r FROM canon WHERE text <> '' AND canonical_key <> '') WHERE r = 1),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM firsts),
 cleaned AS (SELECT doc_id, 'R' || n AS id, text, CASE WHEN category = 'hard_skill' THEN category WHEN category_hint <> 'unknown' THEN category_hint ELSE 'other' END AS category,
   CASE WHEN priority IN ('must', 'nice') THEN priority ELSE 'unknown' END AS priority, least(greatest(coalesce(TRY_CAST(weight AS DOUBLE), 1.0), 0.5), 5.0) AS weight, canonical_key,
   {GENERIC_SQL} >= 0.5 AS generic_flag, n FROM ranked)"""


def cleaned(spark, sf):
    return RQ.clean_requirement_lists(requirement_lists(spark, sf), "doc_id", F.col("items"))


@query("clean_requirements", f"WITH {CLEAN_SQL} SELECT * EXCLUDE (n) FROM cleaned")
def clean_requirements(spark, sf):
    return RQ.numbered(cleaned(spark, sf), "doc_id", "cleaned")


@query(
    "weak_output_flag",
    f"""WITH {CLEAN_SQL}, c AS (SELECT doc_id, count(*) AS n, count(DISTINCT canonical_key) AS keys, count(*) FILTER (WHERE generic_flag) AS g, count(*) FILTER (WHERE category IN ('hard_skill', 'experience', 'education', 'language')) AS hard,
          avg(length(text)) AS len, count(DISTINCT category) AS cats, count(*) FILTER (WHERE priority = 'must') AS must FROM cleaned GROUP BY 1)
        SELECT doc_id, n < 3 OR n - keys >= 2 OR g >= greatest(2, n // 2) OR hard = 0 AS weak_output, n < 4 OR len < 12 OR (cats <= 1 AND n <= 5) OR (must = 0 AND n <= 5) AS weak_extraction FROM c""",
)
def weak_output_flag(spark, sf):
    return RQ.weak_output_flags(cleaned(spark, sf), "doc_id", "cleaned")


MERGE_SQL = CANDIDATE_SQL + ", " + CLEAN_SQL + f""", counts AS (SELECT doc_id, count(*) AS n, avg(length(text)) AS len, count(DISTINCT category) AS cats, count(*) FILTER (WHERE priority = 'must') AS must FROM cleaned GROUP BY 1),
 strong AS (SELECT doc_id FROM counts WHERE NOT (n < 4 OR len < 12 OR (cats <= 1 AND n <= 5) OR (must = 0 AND n <= 5))),
 sides AS (SELECT doc_id, 0 AS side, n, {space_sql('text')} AS text, category, priority, weight FROM cleaned WHERE doc_id IN (FROM strong)
   UNION ALL SELECT doc_id, 1, n, text, category, priority, {WEIGHT_SQL} FROM found),
 merged AS (SELECT doc_id, list_reduce(list([{{'key': {KEY_SQL.format('text')}, 'text': text, 'category': category, 'priority': priority, 'weight': weight}}] ORDER BY side, n), lambda acc, x:
   CASE WHEN {TWIN_SQL} = 0 THEN list_concat(acc, x) ELSE list_transform(acc, lambda m, i: CASE WHEN i = {TWIN_SQL} THEN {{'key': m.key, 'text': m.text,
     'category': CASE WHEN m.category IN ('other', 'unknown') AND x[1].category NOT IN ('other', 'unknown') THEN x[1].category ELSE m.category END,
     'priority': CASE WHEN m.priority = 'unknown' THEN x[1].priority ELSE m.priority END, 'weight': greatest(m.weight, x[1].weight)}} ELSE m END) END) AS l FROM sides WHERE text <> '' GROUP BY doc_id)"""


@query("merge_requirement_lists", f"WITH {MERGE_SQL} SELECT doc_id, 'R' || i AS id, l[i].text AS text, l[i].category AS category, l[i].priority AS priority, l[i].weight AS weight FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM merged)")
def merge_requirement_lists(spark, sf):
    primary = cleaned(spark, sf)
    secondary = RQ.job_requirement_lists(ads(spark, sf), "doc_id", "text")
    lists = hold(secondary.join(primary, "doc_id", "left"), weak=RQ.weak_flags(F.coalesce("cleaned", F.array()))["weak_extraction"])
    return RQ.merge_requirement_lists(lists, "doc_id", "cleaned", "found", F.col("weak"))


HYBRID_SQL = MERGE_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM lines),
 titles AS (SELECT doc_id, arg_min(line, pos) AS title FROM n WHERE length(line) BETWEEN 8 AND 120 AND {ROLE_SQL} GROUP BY 1),
 p AS (SELECT doc_id, count(*) AS n1 FROM cleaned GROUP BY 1), f AS (SELECT doc_id, count(*) AS n2 FROM found GROUP BY 1)
 SELECT a.doc_id, CASE WHEN a.doc_id % 3 = 0 THEN 'Role ' || a.doc_id ELSE coalesce(title, 'unknown') END AS job_title,
   CASE WHEN a.doc_id % 4 = 0 THEN 'lead' ELSE {SENIORITY_SQL} END AS seniority,
   CASE WHEN s.doc_id IS NULL THEN 'fallback_dynamic_rules_only' ELSE 'llm_json_plus_fallback_merge' END AS source,
   CAST(coalesce(n1, 0) AS INTEGER) AS primary_count, CAST(coalesce(n2, 0) AS INTEGER) AS secondary_count, s.doc_id IS NULL AS weak, CAST(coalesce(len(l), 0) AS INTEGER) AS merged_count, coalesce(l[1].text, '') AS first_text
 FROM ads a LEFT JOIN titles USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN strong s USING (doc_id) LEFT JOIN merged USING (doc_id)"""


@query("hybrid_extraction", f"WITH {HYBRID_SQL}")
def hybrid_extraction(spark, sf):
    """Given titles for every third document, given levels for every fourth; the others come from the text."""
    given = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Role "), "doc_id")).when(F.col("doc_id") % 3 == 1, "unknown")
    level = F.when(F.col("doc_id") % 4 == 0, "lead").when(F.col("doc_id") % 4 == 1, "")
    texts = ads(spark, sf)
    said = RQ.guess_title(texts, "doc_id", "text").withColumnsRenamed({"job_title": "found_title", "seniority": "found_seniority"})
    lists = RQ.job_requirement_lists(texts, "doc_id", "text").join(cleaned(spark, sf), "doc_id", "left").join(said, "doc_id")
    whole = RQ.hybrid_extraction(lists.withColumns({"title": given, "level": level}), "doc_id", "cleaned", "found", "title", "level", "found_title", "found_seniority")
    return whole.withColumn("first_text", F.coalesce(F.get("requirements", F.lit(0))["text"], F.lit(""))).drop("requirements")


@query(
    "manual_catalog",
    f"""WITH c AS (SELECT p_partkey, p_type AS group_name, p_type AS job_title, p_name AS text, 'other' AS category, CASE WHEN p_size > 25 THEN 'must' ELSE 'unknown' END AS priority, CAST(p_size AS VARCHAR) AS weight
         FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#4')), {keyed_sql('c')}, {CANON_SQL},
        u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_name, canonical_key ORDER BY p_partkey) AS r FROM canon) WHERE r = 1),
        n AS (SELECT *, row_number() OVER (PARTITION BY group_name ORDER BY p_partkey) AS n FROM u)
        SELECT 'senior ' || lower(group_name) AS query, group_name AS matched_group, CAST(78 AS INTEGER) AS match_score, 'R' || n AS id, text, priority, least(greatest(CAST(weight AS DOUBLE), 0.5), 5.0) AS weight FROM n""",
)
def manual_catalog(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", F.lit(" ").alias("position_key"), F.col("p_type").alias("job_title"), F.lit(None).cast("string").alias("seniority"), F.col("p_name").alias("requirement_text"),
        F.lit(None).cast("string").alias("category"), F.when(F.col("p_size") > 25, "must").alias("priority"), F.col("p_size").cast("string").alias("weight"),
        F.when(F.col("p_brand") == "Brand#3", "no").when(F.col("p_brand") == "Brand#4", "0").when(F.col("p_brand") == "Brand#5", "ano").alias("active"),
    )
    catalog = RQ.manual_catalog(part, "p_partkey")
    groups = catalog.groupBy("group_name").agg(F.min_by("position_key", "p_partkey").alias("position_key"), F.min_by("job_title", "p_partkey").alias("job_title"), F.min("p_partkey").alias("first_row"))
    queries = table(spark, sf, "part").select(F.concat(F.lit("senior "), F.lower("p_type")).alias("query")).distinct()
    matched = J.fuzzy_position(queries, groups)
    lists = RQ.clean_requirements(catalog, "group_name", "p_partkey")
    return matched.join(lists.withColumnRenamed("group_name", "matched_group"), "matched_group").select("query", "matched_group", "match_score", "id", "text", "priority", "weight")


# --- document structure ------------------------------------------------------------------------------

MARKED = """coalesce(CASE length({x}) % 9 WHEN 0 THEN '1.' || length({x}) || ' ' || left({x}, 15) WHEN 1 THEN 'STRANA 3 / 7' WHEN 2 THEN left({x}, 10) || ' .... 12' WHEN 3 THEN 'ÚVOD A CIELE' WHEN 4 THEN 'SECTION TITLE WITH MORE THAN SIX WORDS' END || chr(10), '') || {x}"""
MARKED_SQL = f"marked AS (SELECT doc_id, string_split(array_to_string(list_transform(string_split(text, chr(10)), lambda x: {MARKED.format(x='x')}), chr(10)), chr(10)) AS p FROM documents), raw AS (SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, trim(unnest(p)) AS line FROM marked)"
UPPER_SQL = "replace(replace(upper(line), 'ẞ', 'SS'), 'ß', 'SS')"
LINE_WORDS_SQL = f"(CASE WHEN {space_sql('line')} = '' THEN 0 ELSE len(string_split({space_sql('line')}, ' ')) END)"
HEADING_SQL = f"""({LINE_WORDS_SQL} <= 8 AND ((length(regexp_replace(line, '[^\\p{{L}}]', '', 'g')) > 0 AND length(regexp_replace(line, '[^\\p{{Lu}}]', '', 'g')) >= 0.7 * length(regexp_replace(line, '[^\\p{{L}}]', '', 'g')))
 OR regexp_matches(line, '^[0-9]+(\\.[0-9]+)*\\s+\\S')))"""
FOOTER_SQL = f"""(line <> '' AND (regexp_matches(lower(line), '^(strana|page)\\s+[0-9]+(\\s*/\\s*[0-9]+)?$') OR regexp_matches(line, '[.\\-–—]{{3,}}') OR ({LINE_WORDS_SQL} <= 6 AND line = {UPPER_SQL} AND regexp_matches(line, '\\p{{L}}'))))"""


def marked_docs(spark, sf):
    lines = F.expr(f"transform(split(text, '\\n'), x -> {MARKED.format(x='x')})")
    return documents(spark, sf).select("doc_id", F.array_join(lines, "\n").alias("text"))


def marked_lines(spark, sf):
    return unnest(marked_docs(spark, sf), ["doc_id"], T.split_lines(F.col("text")), "pos", "line").withColumn("line", F.trim("line"))


@query("is_heading_line", f"WITH {MARKED_SQL} SELECT doc_id, pos, {HEADING_SQL} AS heading FROM raw")
def is_heading_line(spark, sf):
    return marked_lines(spark, sf).select("doc_id", "pos", T.is_heading_line(F.col("line")).alias("heading"))


@query("is_header_footer_line", f"WITH {MARKED_SQL} SELECT doc_id, pos, {FOOTER_SQL} AS footer FROM raw")
def is_header_footer_line(spark, sf):
    return marked_lines(spark, sf).select("doc_id", "pos", T.is_header_footer_line(F.col("line")).alias("footer"))


@query(
    "heading_sections",
    f"""WITH {MARKED_SQL}, k AS (SELECT doc_id, pos, line, {HEADING_SQL} AS h FROM raw WHERE line <> '' AND NOT {FOOTER_SQL}),
        s AS (SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS sec FROM k),
        b AS (SELECT doc_id, sec, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT h) AS body, min(CASE WHEN h THEN line END) AS header FROM s GROUP BY 1, 2),
        r AS (SELECT doc_id, sec, header, body FROM b WHERE sec > 0 AND body IS NOT NULL),
        w AS (SELECT d.doc_id, -1 AS sec, '__DOCUMENT__' AS header, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT h), '') AS body FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY 1)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS INTEGER) AS idx, header, body FROM (SELECT * FROM r UNION ALL SELECT * FROM w)""",
)
def heading_sections(spark, sf):
    return D.heading_sections(marked_docs(spark, sf), "doc_id", "text")


@query(
    "first_occurrence_dedup",
    f"""WITH {LINES_SQL}, u AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY pos) AS r FROM lines), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM u WHERE r = 1)
        SELECT doc_id, CAST(n - 1 AS INTEGER) AS place, line FROM k""",
)
def first_occurrence_dedup(spark, sf):
    lines = F.filter(F.transform(T.split_lines(F.col("text")), T.normalize_space), lambda x: x != "")
    kept = D.first_occurrences(ads(spark, sf), "doc_id", lines)
    return unnest(kept, ["doc_id"], F.col("items"), "place", "line")


@query(
    "chunk_words",
    f"""WITH w AS (SELECT doc_id, string_split({space_sql('text')}, ' ') AS w FROM documents WHERE {space_sql('text')} <> ''),
        s AS (SELECT doc_id, w, unnest(range(0, len(w), 165)) AS s FROM w)
        SELECT doc_id, CAST(s // 165 AS INTEGER) AS chunk, array_to_string(w[s + 1 : s + 220], ' ') AS text FROM s WHERE s = 0 OR len(w) - s >= 20""",
)
def chunk_words(spark, sf):
    return D.chunk_words(documents(spark, sf), "doc_id", "text")


@query(
    "chunk_chars",
    """SELECT doc_id, true AS bounded, true AS contained, true AS numbered, true AS complete FROM documents WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
)
def chunk_chars(spark, sf):
    """What must hold for the pieces of every document: their size, that the text holds each, their numbers, and that
    they have at least the text's own letters together."""
    docs = documents(spark, sf)
    pieces = D.chunk_chars(docs, "doc_id", "text").select("doc_id", "chunk", F.col("text").alias("piece"))
    letters = lambda c: F.length(F.regexp_replace(c, r"\s+", ""))
    return (
        pieces.join(docs, "doc_id").groupBy("doc_id").agg(
            F.bool_and(F.length("piece") <= 1200).alias("bounded"), F.bool_and(F.contains("text", "piece")).alias("contained"),
            (F.max("chunk") + 1 == F.count("*")).alias("numbered"), (F.sum(letters(F.col("piece"))) >= F.max(letters(F.col("text")))).alias("complete"),
        )
    )


@query("truncate_middle", "SELECT doc_id, CASE WHEN length(t) <= 1000 THEN t ELSE left(t, 500) || chr(10) || chr(10) || '[...SKRATENE...]' || chr(10) || chr(10) || right(t, 500) END AS short FROM (SELECT doc_id, trim(text) AS t FROM documents)")
def truncate_middle(spark, sf):
    return documents(spark, sf).select("doc_id", T.truncate_middle(F.col("text"), 1000).alias("short"))


@query("summary_or_prefix", "SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' WHEN lang = 'fr' THEN 'sum ' || source END, ''), left(text, 500)) AS summary FROM documents")
def summary_or_prefix(spark, sf):
    summary = F.when(F.col("lang") == "en", "").when(F.col("lang") == "fr", F.concat(F.lit("sum "), "source"))
    return table(spark, sf, "documents").select("doc_id", T.summary_or_prefix(summary, F.col("text")).alias("summary"))


@query(
    "retrieval_query_text",
    TERM_COUNT_SQL + """, r AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(term) DESC, term) AS place FROM hits WHERE n > 0),
    t AS (SELECT doc_id, string_agg(term, ', ' ORDER BY place) AS terms FROM r GROUP BY 1)
    SELECT doc_id, 'Právny kontext: ' || text || chr(10) || 'Kľúčové pojmy: ' || terms AS query FROM documents JOIN t USING (doc_id)""",
)
def retrieval_query_text(spark, sf):
    from loamwork.operators.terms import ranked_terms
    from loamwork.plans.joining import by_count

    joined = ranked_terms(matched_terms(spark, sf, ["text"]), "doc_id", by_count, sep=None, keep=["text"]).filter("doc_id is not null")
    return joined.select("doc_id", T.retrieval_query_text(F.col("text"), F.col("terms")).alias("query"))


TURN = ["conv_id", "turn"]


def turns(spark, sf):
    return table(spark, sf, "conversations")


@query(
    "after_last_marker",
    f"""WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'x ZHRNUTIE: y ZHRNUTIE:' || chr(10) || text ELSE text END AS raw FROM conversations)
        SELECT conv_id, turn, {space_sql("list_last(string_split(raw, 'ZHRNUTIE:'))")} AS after, CASE WHEN raw = '' THEN 'ERROR' ELSE trim(split_part(raw, chr(10), 1), '" ') END AS first_line FROM t""",
)
def after_last_marker(spark, sf):
    raw = F.when(F.col("role") == "user", F.concat(F.lit("x ZHRNUTIE: y ZHRNUTIE:\n"), "text")).otherwise(F.col("text"))
    return turns(spark, sf).select(*TURN, T.after_last_marker(raw, "ZHRNUTIE:").alias("after"), T.first_output_line(raw).alias("first_line"))


@query(
    "clean_title_line",
    """WITH t AS (SELECT conv_id, turn, regexp_replace(CASE WHEN role = 'user' THEN chr(10) || ' „Nadpis: ' || text || '”' ELSE text END, '^[\\s"„”]+|[\\s"„”]+$', '', 'g') AS b FROM conversations),
       l AS (SELECT conv_id, turn, trim(regexp_extract(b, '([^\\n]*\\S[^\\n]*)', 1)) AS line FROM t)
       SELECT conv_id, turn, trim(trim(regexp_replace(line, '(?i)^\\s*(NADPIS|POJEM)\\s*[:\\-–]\\s*', '')), '"„”') AS title FROM l""",
)
def clean_title_line(spark, sf):
    raw = F.when(F.col("role") == "user", F.concat(F.lit("\n „Nadpis: "), "text", F.lit("”"))).otherwise(F.col("text"))
    return turns(spark, sf).select(*TURN, T.clean_title_line(raw).alias("title"))


@query(
    "strip_thinking",
    """WITH t AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '<think>' || left(text, 30) || chr(10) || '</think> ' || text WHEN 1 THEN left(text, 9) || '</think> tail ' || text ELSE text END AS raw FROM conversations),
       o AS (SELECT conv_id, turn, trim(regexp_replace(raw, '(?is)<think>.*?</think>', '', 'g')) AS o FROM t)
       SELECT conv_id, turn, trim(CASE WHEN contains(o, '</think>') THEN substr(o, strpos(o, '</think>') + 8) ELSE o END) AS clean FROM o""",
)
def strip_thinking(spark, sf):
    raw = F.expr("CASE turn % 3 WHEN 0 THEN '<think>' || left(text, 30) || '\\n</think> ' || text WHEN 1 THEN left(text, 9) || '</think> tail ' || text ELSE text END")
    return turns(spark, sf).select(*TURN, T.strip_thinking(raw).alias("clean"))


@query("strip_code_fence", "SELECT conv_id, turn, trim(regexp_replace(text, '^\\s+', '')) AS clean FROM (SELECT conv_id, turn, regexp_replace(text, '\\s+$', '') AS text FROM conversations)")
def strip_code_fence(spark, sf):
    raw = F.expr("CASE turn % 3 WHEN 0 THEN '```json\\n' || text || '\\n```' WHEN 1 THEN '```SQL ' || text || '```  ' ELSE text END")
    bare = F.regexp_replace(F.regexp_replace(T.strip_code_fence(raw), r"^\s+", ""), r"\s+$", "")
    return turns(spark, sf).select(*TURN, bare.alias("clean"))


@query(
    "extract_select",
    f"""SELECT conv_id, turn, CASE role WHEN 'user' THEN 'SELECT a, b FROM t WHERE c = ' || turn WHEN 'assistant' THEN 'select ' || {space_sql("replace(text, ';', ' ')")} END AS sql FROM conversations""",
)
def extract_select(spark, sf):
    raw = F.expr(
        "CASE role WHEN 'user' THEN '```sql\\nSELECT a,\\n b  FROM t WHERE c = ' || turn || ';\\n``` and more text; ' || text "
        "WHEN 'assistant' THEN 'Preselected: select\\n' || replace(text, ';', ' ') ELSE 'drop table x; ' || text END"
    )
    return turns(spark, sf).select(*TURN, T.extract_select(raw).alias("sql"))


@query("conversation_history", "SELECT conv_id, turn, upper(role) || ': ' || text AS line FROM conversations")
def conversation_history(spark, sf):
    return CV.conversation_history(turns(spark, sf), "conv_id", "turn", "role", "text")


CHAT_SQL = """WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND length(text) % 3 = 0 THEN 'tool' WHEN role = 'user' AND length(text) % 5 = 0 THEN 'tool' ELSE role END AS role,
  CASE WHEN length(text) % 4 = 1 THEN '<think>' || chr(10) || 'why ' || left(text, 10) || chr(10) || '</think>' || chr(10) || chr(10) || text ELSE text END AS text FROM conversations),
 s AS (SELECT *, max(turn) OVER c AS last, max(CASE WHEN role = 'user' THEN turn END) OVER c AS qu, lag(role) OVER o AS before, lead(role) OVER o AS after FROM t WINDOW c AS (PARTITION BY conv_id), o AS (PARTITION BY conv_id ORDER BY turn)),
 a AS (SELECT *, CASE WHEN contains(text, '</think>') THEN 'why ' || rtrim(regexp_extract(text, '^<think>\\nwhy ([^<]*?)\\n+</think>', 1), chr(10)) ELSE '' END AS why,
  CASE WHEN contains(text, '</think>') THEN ltrim(substr(text, strpos(text, '</think>') + 8), chr(10)) ELSE text END AS answer FROM s),
 r AS (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN CASE WHEN turn > coalesce(qu, last) AND (turn = last OR why <> '')
   THEN '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || why || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(answer, chr(10)) || '<|im_end|>' || chr(10)
   ELSE '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10) END
  WHEN 'tool' THEN CASE WHEN before = 'tool' THEN '' ELSE '<|im_start|>user' END || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>' || CASE WHEN after = 'tool' THEN '' ELSE '<|im_end|>' || chr(10) END
  ELSE '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) END AS rendered FROM a)
 SELECT conv_id, turn, rendered FROM r"""


@query("render_chat_template", CHAT_SQL)
def render_chat_template(spark, sf):
    role = F.expr("CASE WHEN role = 'assistant' AND length(text) % 3 = 0 THEN 'tool' WHEN role = 'user' AND length(text) % 5 = 0 THEN 'tool' ELSE role END")
    text = F.expr("CASE WHEN length(text) % 4 = 1 THEN '<think>\\nwhy ' || left(text, 10) || '\\n</think>\\n\\n' || text ELSE text END")
    return CV.render_turns(turns(spark, sf).select("conv_id", "turn", role.alias("role"), text.alias("text")), "conv_id", "turn", "role", "text")


# tool calls of every second assistant turn, two of them where the length is a multiple of four
CALLS = "CASE WHEN length(text) % 4 = 0 THEN 2 WHEN length(text) % 2 = 0 THEN 1 ELSE 0 END"
CALLED_SQL = f"""WITH t AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN '' ELSE text END AS text, CASE WHEN role = 'assistant' THEN {CALLS} ELSE 0 END AS n FROM conversations),
 s AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS qu FROM t),
 c AS (SELECT *, coalesce(array_to_string(list_transform(range(n), lambda i: CASE WHEN i > 0 OR text <> '' THEN chr(10) ELSE '' END || '<tool_call>' || chr(10) || '{{"name": "search' || i || '", "arguments": {{"turn":"' || turn || '"}}}}' || chr(10) || '</tool_call>'), ''), '') AS calls FROM s)
 SELECT conv_id, turn, CASE WHEN role = 'assistant' AND turn > coalesce(qu, last) AND turn = last THEN '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || text || calls || '<|im_end|>' || chr(10)
   ELSE '<|im_start|>' || role || chr(10) || text || calls || '<|im_end|>' || chr(10) END AS rendered FROM c"""


@query("render_tool_calls", CALLED_SQL)
def render_tool_calls(spark, sf):
    n = F.when(F.col("role") == "assistant", F.expr(CALLS)).otherwise(0)
    named = lambda i: F.struct(F.concat(F.lit("search"), i).alias("name"), F.create_map(F.lit("turn"), F.col("turn").cast("string")).alias("arguments"))
    calls = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), named))
    rows = turns(spark, sf).select("conv_id", "turn", "role", F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("text")).alias("text"), calls.alias("calls"))
    return CV.render_turns(rows, "conv_id", "turn", "role", "text", "calls")


def html_sql() -> str:
    bare = "html"
    for pattern in PG.removal_patterns():
        bare = f"regexp_replace({bare}, {q(pattern)}, '', 'g')"
    cases = " ".join(f"WHEN regexp_matches(b, {q(PG.content_pattern(t))}) THEN regexp_extract(b, {q(PG.content_pattern(t))}, 1)" for t in PG.CONTENT)
    decoded = "regexp_replace(c, '(?s)<[^>]*>', chr(10), 'g')"
    for entity, char in PG.ENTITIES.items():
        decoded = f"replace({decoded}, {q(entity)}, {q(char)})"
    return f"""WITH b AS (SELECT page_id, {bare} AS b FROM pages), c AS (SELECT page_id, CASE {cases} ELSE b END AS c FROM b),
     l AS (SELECT page_id, generate_subscripts(p, 1) AS pos, {space_sql('unnest(p)')} AS line FROM (SELECT page_id, string_split({decoded}, chr(10)) AS p FROM c)),
     f AS (SELECT *, row_number() OVER (PARTITION BY page_id, lower(line) ORDER BY pos) AS r FROM l WHERE length(line) > 2)
     SELECT page_id, coalesce(string_agg(line, ' ' ORDER BY pos) FILTER (WHERE r = 1), '') AS text FROM pages LEFT JOIN f USING (page_id) GROUP BY 1"""


@query("clean_html", html_sql())
def clean_html(spark, sf):
    return PG.clean_html(table(spark, sf, "pages").select("page_id", "html"), "page_id", "html")


# --- vectors -------------------------------------------------------------------------------------------

TOPK_SQL = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), p AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
 m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM p GROUP BY 1, 2) GROUP BY 1), n AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS c FROM m),
 s AS (SELECT n.label AS query_id, vec_id AS chunk_id, list_inner_product(c, v) / sqrt(list_inner_product(v, v)) AS similarity FROM n, e),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, chunk_id) AS place FROM s WHERE similarity >= 0.2)"""


def similar(spark, sf, k):
    """Queries are the mean vectors of all labels."""
    e = table(spark, sf, "embeddings")
    chunks = e.select("vec_id", vectors.normalize(F.col("embedding")).alias("v"))
    centres = SM.mean_vectors(e, "label", "embedding").select("label", vectors.normalize(F.col("embedding")).alias("v"))
    return SM.topk_similarity(chunks, "vec_id", "v", centres, "label", "v", k=k)


@query("join_vector_topk", TOPK_SQL + " SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, round(similarity, 6) AS similarity FROM r WHERE place <= 5")
def join_vector_topk(spark, sf):
    return similar(spark, sf, 5).select("query_id", "chunk_id", F.round("similarity", 6).alias("similarity"))


@query(
    "topk_similarity",
    TOPK_SQL + " SELECT CAST(query_id AS BIGINT) AS query_id, CAST(place AS INTEGER) AS place, '[similarity=' || format('{:.3f}', similarity) || '] vector ' || chunk_id AS text FROM r WHERE place <= 10",
)
def topk_similarity(spark, sf):
    texts = table(spark, sf, "embeddings").select("vec_id", F.concat(F.lit("vector "), "vec_id").alias("t"))
    return SM.similarity_text(similar(spark, sf, 10), texts, "vec_id", "t").select("query_id", "place", "text")


@query("batch_score", "SELECT doc_id, CAST(length(text) AS DOUBLE) AS score FROM documents")
def batch_score(spark, sf):
    """A toy model that measures texts; each distinct normalised text is scored once."""
    return D.score_distinct(documents(spark, sf), "doc_id", "text", lambda: (lambda texts: [float(len(t)) for t in texts]))
