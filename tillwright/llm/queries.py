"""The operators of this subpackage as queries over the given tables, with the columns their contracts name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    decontamination,
    extraction,
    lexical_search,
    licenses,
    mixing,
    near_dedup,
    neighbours,
    packing,
    prefix_trie,
    quality,
    quotes,
    token_counts,
    token_files,
)
from tillwright.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sizes_of(table(spark, sf_dir, "documents"))
    return mixing.taken(sizes, mixing.mix(sizes)).select("doc_id", "size", "source_size", "target", "taken", "source")


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def written_and_read(docs: DataFrame) -> DataFrame:
    """Encode, write and read back: where each document lies in the sequence of all ids, and the checksum of its own."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    token_files.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_and_read(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_scores(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=2)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": source_mixing,
    "op2_token_counts": token_count,
    "op3_token_id_files": token_id_files,
    "op4_license_scan": license_scan,
    "op5_quotation_links": quotation_links,
    "op6_nearest_neighbours": nearest_neighbours,
    "op7_quality_classifier": quality_classifier,
    "op8_html_extraction": html_extraction,
    "op9_benchmark_decontamination": benchmark_decontamination,
    "op10_minhash_near_dedup": minhash_near_dedup,
    "op11_sequence_packing": sequence_packing,
    "op12_ranked_search": ranked_search,
    "op13_conversation_trie": conversation_trie,
}
# Windows by position: every run of ten words (or all words of a shorter item) is one row, and rows meet by their text.
_DECONTAMINATION_SQL = """
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS s FROM iw WHERE len(w) > 0)
), pos AS (
  SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
  FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
), hit AS (
  SELECT r, s, pos.n, item
  FROM pos JOIN win ON win.n = pos.n AND win.g = array_to_string(list_slice(w, s, s + pos.n - 1), ' ')
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

# Pairs that share a shingle are counted in full, then the smallest reachable id is passed on along the links.
_NEAR_DEDUP_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) < 2 THEN w
         ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS (
  SELECT node, n, unnest(s) AS g FROM classes
), counted AS (
  SELECT g, node, n, count(*) OVER (PARTITION BY g) AS df FROM shingles
), ranked AS (
  SELECT node, n, g, row_number() OVER (PARTITION BY node ORDER BY df, g) AS r FROM counted
), prefix AS (
  SELECT node, n, g FROM ranked WHERE 100 * (n - r + 1) >= 80 * n
), candidates AS (
  SELECT DISTINCT x.node AS a, y.node AS b, x.n AS m, y.n AS n
  FROM prefix x JOIN prefix y ON x.g = y.g AND x.node < y.node AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), common AS (
  SELECT a, b, any_value(m) AS m, any_value(c.n) AS n, count(*) AS k
  FROM candidates c JOIN shingles x ON x.node = a JOIN shingles y ON y.node = b AND y.g = x.g GROUP BY a, b
), links AS (
  SELECT a, b FROM common WHERE 100 * k >= 80 * (m + n - k)
  UNION ALL SELECT b, a FROM common WHERE 100 * k >= 80 * (m + n - k)
), reach AS (
  SELECT node, node AS root FROM classes
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
), grouped AS (
  SELECT c.s, min(root) AS component_id FROM reach JOIN classes c USING (node) GROUP BY c.s
)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN grouped ON grouped.s = sets.s
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BIGRAMS = """list_distinct(list_transform(generate_series(1, len({w}) - 1), lambda i: {w}[i] || ' ' || {w}[i + 1]))"""
_LICENSES_SQL = f"""
WITH texts(template, license, text) AS (
  VALUES {", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))}
), t AS (
  SELECT template, license, {_BIGRAMS.format(w="w")} AS g
  FROM (SELECT template, license, string_split(trim(regexp_replace(lower(text), '[^\\pL\\pN]+', ' ', 'g')), ' ') AS w FROM texts)
), passages AS (
  SELECT DISTINCT doc_id, unnest(list_concat([text], regexp_split_to_array(text, '\\n\\s*\\n'), string_split(text, chr(10)),
         list_transform(string_split(regexp_replace(text, '([.!?])([ \\t\\r\\f\\v]+|\\n)', '\\1' || chr(10), 'g'), chr(10)),
                        lambda x: ltrim(x, ' ' || chr(9) || chr(13))))) AS p
  FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT doc_id, p, {_BIGRAMS.format(w="w")} AS g
  FROM (SELECT doc_id, p, string_split(trim(regexp_replace(lower(p), '[^\\pL\\pN]+', ' ', 'g')), ' ') AS w FROM passages)
), scored AS (
  SELECT doc_id, p, license, 2.0::DOUBLE * len(list_intersect(cut.g, t.g)) / (len(cut.g) + len(t.g)) AS dice
  FROM cut JOIN t ON len(cut.g) > 0 AND 2.0 * least(len(cut.g), len(t.g)) >= 0.8 * (len(cut.g) + len(t.g))
), best AS (
  SELECT doc_id, count(DISTINCT p) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         max(dice) AS best_dice, arg_min(license, struct_pack(d := -dice, l := license)) AS best_license
  FROM scored WHERE dice >= 0.8 GROUP BY doc_id
)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses, best_license, best_dice
FROM documents LEFT JOIN best USING (doc_id)
"""

_QUOTES_SQL = """
WITH m AS (
  SELECT row_number() OVER () AS r, conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS body FROM conversations
), lines AS (
  SELECT r, i, string_split(body, chr(10))[i] AS raw
  FROM (SELECT r, body, unnest(generate_series(1, len(string_split(body, chr(10))))) AS i FROM m)
), levels AS (
  SELECT r, i, raw, len(regexp_replace(regexp_extract(raw, '^((?:[ \\t]*>)+)', 1), '[^>]', '', 'g')) AS level FROM lines
), marked AS (
  SELECT r, i, raw, level, regexp_replace(raw, '^(?:[ \\t]*>)+', '') AS line, level = 0
         AND coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) > 0
         AND regexp_matches(raw, '(?i)^\\s*(?:on|am|le|el)\\s.*(?:wrote|schrieb.*|a écrit|escribió)\\s*:\\s*$') AS intro
  FROM levels
), own AS (
  SELECT r, coalesce(sum((level > 0)::INT), 0)::BIGINT AS n_quoted,
         trim(regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (level = 0 AND NOT intro), ''), '\\n{3,}', chr(10) || chr(10), 'g'),
              ' ' || chr(10) || chr(9) || chr(13)) AS cut
  FROM marked GROUP BY r
), told AS (
  SELECT m.*, n_quoted, CASE WHEN n_quoted = 0 THEN body ELSE cut END AS text FROM m JOIN own USING (r)
), quoted AS (
  SELECT DISTINCT r, trim(regexp_replace(lower(p), '[^\\pL\\pN]+', ' ', 'g')) AS p FROM (
    SELECT r, line AS p FROM marked WHERE level > 0
    UNION ALL
    SELECT r, string_agg(line, ' ' ORDER BY i) FROM (
      SELECT r, i, level, line, i - row_number() OVER (PARTITION BY r, level ORDER BY i) AS run FROM marked WHERE level > 0)
    GROUP BY r, level, run)
), passages AS (
  SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(p), '[^\\pL\\pN]+', ' ', 'g')) AS p FROM (
    SELECT conv_id, turn, unnest(list_concat([text], regexp_split_to_array(text, '\\n\\s*\\n'), string_split(text, chr(10)))) AS p FROM told)
), met AS (
  SELECT q.r, q.p, max(o.turn) AS quotes
  FROM quoted q JOIN told t USING (r) JOIN passages o ON o.conv_id = t.conv_id AND o.p = q.p AND o.turn < t.turn
  WHERE q.p <> '' GROUP BY q.r, q.p
), links AS (
  SELECT r, arg_max(quotes, struct_pack(c := chars, q := quotes)) AS quotes
  FROM (SELECT r, quotes, sum(len(p)) AS chars FROM met GROUP BY r, quotes) GROUP BY r
)
SELECT conv_id, turn, coalesce(role, 'unknown') AS role, text, n_quoted,
       coalesce(quotes, CASE WHEN conv_id IS NOT NULL THEN
         (SELECT max(x.turn) FROM m x WHERE x.conv_id = told.conv_id AND x.turn < told.turn) END) AS reply_to,
       quotes IS NOT NULL AS by_quote,
       CASE WHEN conv_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text, r) END AS position,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text AS chat
FROM told LEFT JOIN links USING (r)
"""

_TERMS = """list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""
_SEARCH_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL
), size AS (
  SELECT count(*) AS big_n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0
), tf AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY t, big_n
), q AS (
  SELECT i, item_id, t, count(*) AS k
  FROM (SELECT i, item_id, unnest({_TERMS}) AS t FROM (SELECT row_number() OVER () AS i, * FROM benchmark WHERE text IS NOT NULL))
  GROUP BY i, item_id, t
), scored AS (
  SELECT i, item_id, d.r, doc_id, sum(k * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * big_n) // l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN weights w USING (t) JOIN d ON d.r = tf.r, size GROUP BY i, item_id, d.r, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# A step of -1 in the list is one of the eight shifts of crc32 (reflected polynomial), any other element a byte.
_CRC32 = """xor(list_reduce(flatten([[4294967295::BIGINT], flatten(list_transform(string_split({c}::VARCHAR, ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
  WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
# Every node meets all nodes that its members pass at and below it.
_TRIE_SQL = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT conv_id, {_CRC32.format(c="conv_id")} % 4 AS h, conv_id - conv_id % 20 AS base FROM own GROUP BY conv_id
), parts AS (
  SELECT c.conv_id, 0 AS part, o.p, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.p <= c.h
  UNION ALL SELECT c.conv_id, 1, o.p, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.p > c.h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth, role, text FROM parts
), paths AS (
  SELECT conv_id, depth, text, string_agg(sha256(len(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
  UNION ALL SELECT conv_id, 0, '', '' FROM convs
), nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(len(list_filter(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS words
  FROM paths GROUP BY depth, path
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, len(n.path) - 64)
), counted AS (
  SELECT l.*, (SELECT count(*) FROM linked c WHERE c.depth = l.depth + 1 AND c.parent_conv_id = l.conv_id) AS n_children FROM linked l
), below AS (
  SELECT DISTINCT a.depth, a.path, b.depth AS d, b.path AS q FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT b.depth, b.path, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM below b JOIN counted c ON c.depth = b.d AND c.path = b.q GROUP BY b.depth, b.path
), ends AS (
  SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM paths WHERE (conv_id, depth) IN (SELECT (conv_id, max(depth)) FROM paths GROUP BY conv_id) GROUP BY depth, path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted JOIN sums USING (depth, path) LEFT JOIN ends USING (depth, path)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": _LICENSES_SQL,
    "op5_quotation_links": _QUOTES_SQL,
    "op9_benchmark_decontamination": _DECONTAMINATION_SQL,
    "op10_minhash_near_dedup": _NEAR_DEDUP_SQL,
    "op12_ranked_search": _SEARCH_SQL,
    "op13_conversation_trie": _TRIE_SQL,
}
