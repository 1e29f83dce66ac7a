"""The corpus operators bound to the given tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm import alignment, benchmark, copies, language, lines, minhash, packing, search, shards, substrings, suffixes, tokens, vectors
from loamwork.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


#: A-Z in lower case and nothing else, for DuckDB.
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Runs without white space.
WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Smallest node reachable over the table ``links`` (a, b), for the nodes of ``nodes`` (node).
COMPONENTS = """edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT node, node AS root FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
components AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS node FROM documents), {COMPONENTS}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN components ON node = doc_id LEFT JOIN sizes USING (doc_id)
"""

NEAR_VECTORS_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
counts AS (SELECT vec_id, count(*) AS n FROM (SELECT a AS vec_id FROM links UNION ALL SELECT b FROM links) GROUP BY 1),
nodes AS (SELECT vec_id AS node FROM embeddings), {COMPONENTS}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON node = vec_id LEFT JOIN counts USING (vec_id)
"""

SUBSTRINGS_SQL = rf"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS win FROM w, unnest(range(1, len(ws) - 18)) AS u(i) WHERE len(ws) >= 20),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, p FROM again, unnest(range(i, i + 20)) AS u(p)),
pieces AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS u(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM pieces ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SUFFIXES_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS i, unnest(list_transform(range(0, length(h) // 2 - 199), lambda x: md5(substr(h, 2 * x + 1, 400)))) AS win
  FROM d WHERE length(h) >= 400),
twice AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows JOIN twice USING (win)),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
spans AS (SELECT doc_id, run, min(i) AS s, max(i) + 200 AS e FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER o, 0) AS s, s AS e FROM spans WINDOW o AS (PARTITION BY doc_id ORDER BY s)
  UNION ALL SELECT doc_id, coalesce(max(e), 0), any_value(length(h) // 2) FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
counts AS (SELECT doc_id, sum(e - s) AS n, count(*) AS runs FROM spans GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

SHARDS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
draws AS (
  SELECT doc_id, t, k, s, -ln((('0x' || substr(md5(k || ':' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS score
  FROM d, range(17) AS r(s)),
placed AS (
  SELECT doc_id, t, k, (arg_min(s, score) FILTER (WHERE s < 16))::INTEGER AS shard, arg_min(s, score)::INTEGER AS grown_shard
  FROM draws GROUP BY doc_id, t, k),
-- CRC-32, one byte at a time; a step's table entry is eight shifts of (crc XOR byte)
steps AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY n) AS st
  FROM (SELECT unnest(range(256)) AS n)),
bytes AS (
  SELECT doc_id, list_transform(string_split_regex(regexp_replace(hex(encode(t)), '(..)', '\1 ', 'g'), ' '), lambda x: CASE WHEN x = '' THEN NULL ELSE ('0x' || x)::BIGINT END) AS bs FROM d),
crcs AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295, list_filter(bs, lambda x: x IS NOT NULL)), lambda c, b: xor(c >> 8, st[(xor(c, b) & 255) + 1])) AS crc
  FROM bytes, steps)
SELECT p.doc_id, (strlen(t) + 1)::BIGINT AS size, xor(crc, 4294967295)::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(k), p.doc_id, strlen(t)) - 1 AS slot, grown_shard
FROM placed p JOIN crcs c ON p.doc_id = c.doc_id
"""

BENCHMARK_SQL = rf"""
WITH pattern AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
dw AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, p) AS ws FROM documents, pattern),
bw AS (SELECT item_id, regexp_extract_all({LOWER.format("text")}, p) AS ws FROM benchmark, pattern WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, ws[i + 1 : i + least(10, len(ws))] AS w
  FROM bw, unnest(range(0, greatest(len(ws) - 10, 0) + 1)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT len(w) AS n FROM windows),
starts AS (
  SELECT doc_id, i, n, ws[i + 1 : i + n] AS w FROM dw, sizes, unnest(range(0, len(ws) - n + 1)) AS u(i) WHERE len(ws) >= n),
found AS (SELECT doc_id, i, n, item_id FROM starts JOIN windows USING (w)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM found, unnest(range(i, i + n)) AS u(x) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

LINES_SQL = rf"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i, ls[i] AS line, {LOWER.format("trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM parts, unnest(range(1, len(ls) + 1)) AS u(i)),
shared AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.*, s.k IS NOT NULL AS gone FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SEARCH_SQL = rf"""
WITH pattern AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS p),
d AS (SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), p), lambda x: {LOWER.format("x")}) AS ws FROM documents, pattern),
facts AS (SELECT count(*) FILTER (WHERE len(ws) > 0)::BIGINT AS nn, sum(len(ws))::BIGINT AS ll FROM d),
q AS (SELECT DISTINCT item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), p), lambda x: {LOWER.format("x")})) AS term FROM benchmark, pattern WHERE item_id IS NOT NULL),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, facts GROUP BY term),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(ws)::BIGINT * nn) // ll) AS m FROM d, facts WHERE len(ws) > 0),
scores AS (
  SELECT item_id, m.r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.r = tf.r GROUP BY item_id, m.r),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""

COPIES_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents)
SELECT doc_id, min(doc_id) OVER own AS keep_id, count(*) OVER own AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER own AS kept, sha256(plain) AS text_sha256
FROM t WINDOW own AS (PARTITION BY plain)
"""


@query("op1_minhash_near_dedup", NEAR_DUPLICATES_SQL)
def op1_minhash_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


@query("op2_substring_dedup", SUBSTRINGS_SQL)
def op2_substring_dedup(spark, sf):
    found = substrings.drop_repeated_passages(table(spark, sf, "documents"))
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


@query("op3_embedding_near_dedup", NEAR_VECTORS_SQL)
def op3_embedding_near_dedup(spark, sf):
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query("op4_language_id")
def op4_language_id(spark, sf):
    return language.identify(table(spark, sf, "documents"))


@query("op5_suffix_array_dedup", SUFFIXES_SQL)
def op5_suffix_array_dedup(spark, sf):
    found = suffixes.drop_repeated_bytes(table(spark, sf, "documents"))
    return found.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


@query("op6_sharding", SHARDS_SQL)
def op6_sharding(spark, sf):
    return shards.place_in_shards(table(spark, sf, "documents"))


@query("op7_decontamination", BENCHMARK_SQL)
def op7_decontamination(spark, sf):
    found = benchmark.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_token_counts")
def op8_token_counts(spark, sf):
    return tokens.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_line_dedup", LINES_SQL)
def op9_line_dedup(spark, sf):
    kept = lines.drop_shared_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark, sf):
    return packing.pack_best_fit(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op11_ranked_search", SEARCH_SQL)
def op11_ranked_search(spark, sf):
    return search.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark, sf):
    return alignment.align_tokenizers(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op13_exact_dedup", COPIES_SQL)
def op13_exact_dedup(spark, sf):
    return copies.exact_copies(table(spark, sf, "documents"))
