"""The operators as registered queries over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import ctw, decontam, language, linededup, notices, packing, prefixes, quality, sharding, simhash, spelling, substrings, toxicity
from footfall.llm.common import documents


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(documents(spark, folder))
    return found.select("doc_id", simhash.fingerprint_text("fp").alias("fingerprint"), "component_id")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(documents(spark, folder), _table(spark, folder, "labels"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.deduplicate(documents(spark, folder))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge(documents(spark, folder), _table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score(documents(spark, folder))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(documents(spark, folder))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove(documents(spark, folder)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.overlaps(documents(spark, folder), _table(spark, folder, "benchmark")).drop("tie")


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return notices.summary(notices.scan(documents(spark, folder)))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(_table(spark, folder, "conversations"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group(documents(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_simhash_neardup, op2_language_id, op3_toxicity, op4_line_dedup, op5_packing, op6_quality_rules,
        op7_lm_scoring, op8_sharding, op9_substring_dedup, op10_decontamination, op11_license_scan,
        op12_prefix_trie, op13_spelling_variants,
    )
    return {f.__name__: f for f in found}


# Lines of 20 characters or more; a line goes if it, or another one edit away, came earlier.
_LINE_DEDUP = """
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS number
    FROM documents
), firsts AS (
    SELECT line, min((doc_id, number)) AS first, length(line) AS size FROM split WHERE length(line) >= 20 GROUP BY line
), cut AS (
    SELECT *, part, CASE part WHEN 0 THEN left(line, size // 2 - 1) ELSE right(line, size // 2 - 1) END AS half
    FROM firsts, (VALUES (0), (1)) AS p(part)
), near AS (
    SELECT DISTINCT later.line FROM cut AS later JOIN cut AS earlier
    ON later.part = earlier.part AND later.half = earlier.half AND earlier.first < later.first AND later.size = earlier.size
    WHERE levenshtein(later.line, earlier.line) = 1
    UNION
    SELECT DISTINCT later.line FROM firsts AS later JOIN firsts AS earlier
    ON abs(later.size - earlier.size) = 1 AND earlier.first < later.first
       AND (left(later.line, 9) = left(earlier.line, 9) OR right(later.line, 9) = right(earlier.line, 9))
    WHERE levenshtein(later.line, earlier.line) = 1
), kept AS (
    SELECT s.doc_id, s.line, s.number FROM split AS s LEFT JOIN firsts AS f ON s.line = f.line
    WHERE f.line IS NULL OR (f.first = (s.doc_id, s.number) AND NOT EXISTS (SELECT 1 FROM near WHERE near.line = s.line))
), joined AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY number) AS text FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(j.text, '') AS text, d.lang, d.source, CAST(length(coalesce(j.text, '')) AS BIGINT) AS n_chars
FROM documents AS d LEFT JOIN joined AS j USING (doc_id)
"""

# The crc32 of a text, byte by byte, with the table of remainders made from its rule.
_SHARDING = """
WITH RECURSIVE steps AS (
    SELECT range AS byte, CAST(range AS BIGINT) AS rest, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384) ELSE rest >> 1 END, step + 1 FROM steps WHERE step < 8
), remainders AS MATERIALIZED (
    SELECT list(rest ORDER BY byte) AS table_of FROM steps WHERE step = 8
), sized AS (
    SELECT doc_id, CAST(strlen(text) + 8 AS BIGINT) AS size, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
        lambda c, b: xor(table_of[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32
    FROM documents, remainders
), ended AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM sized
), dealt AS (
    SELECT *, CAST(((upto * 2 - size) * 24) // (2 * total) AS INTEGER) AS shard FROM ended
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""

_SUBSTRINGS = """
WITH worded AS (
    SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM worded
), windows AS (
    SELECT doc_id, p, md5(array_to_string(w[p : p + 19], ' ')) AS h FROM starts
), marked AS (
    SELECT doc_id, p, (doc_id, p) > min((doc_id, p)) OVER (PARTITION BY h) AS copied FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM marked WHERE copied
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""


# Every shift of an item along a document that leaves enough words equal, and its stretches of 16 words (or of the whole item).
_DECONTAMINATION = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), sized AS MATERIALIZED (
    SELECT item_id, w, least(16, len(w)) AS size, CASE WHEN len(w) < 12 THEN len(w) ELSE least(16, len(w)) - least(16, len(w)) // 5 END AS needed FROM items WHERE len(w) > 0
), placed AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs
), asked AS (
    SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM sized
), shifts AS (
    SELECT doc_id, item_id, p - j AS shift FROM placed JOIN asked USING (word) JOIN sized USING (item_id)
    GROUP BY doc_id, item_id, p - j, needed HAVING count(*) >= needed
), aligned AS MATERIALIZED (
    SELECT s.doc_id, s.item_id, shift, size, needed, len(d.w) AS n,
           list_transform(range(1, len(i.w) + 1), lambda j: CASE WHEN shift + j >= 1 AND d.w[shift + j] = i.w[j] THEN 1 ELSE 0 END) AS same
    FROM shifts AS s JOIN docs AS d ON d.doc_id = s.doc_id JOIN sized AS i ON i.item_id = s.item_id
), stretches AS (
    SELECT doc_id, item_id, size, needed, n, shift, same, unnest(range(1, len(same) - size + 2)) AS j FROM aligned
), good AS (
    SELECT doc_id, item_id, size, shift + j - 1 AS first, list_sum(same[j : j + size - 1]) AS matched FROM stretches
    WHERE shift + j >= 1 AND shift + j + size - 1 <= n AND list_sum(same[j : j + size - 1]) >= needed
)
SELECT doc_id, item_id, CAST(min(first) AS INTEGER) AS first_word, CAST(max(first + size - 1) AS INTEGER) AS last_word,
       CAST(max(matched) AS INTEGER) AS matched, CAST(max(size) AS INTEGER) AS compared
FROM good GROUP BY doc_id, item_id
"""

# A node is known by the hashes of its turns, joined; its ancestors are those of its smallest member.
_PREFIXES = """
WITH RECURSIVE steps AS (
    SELECT range AS byte, CAST(range AS BIGINT) AS rest, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384) ELSE rest >> 1 END, step + 1 FROM steps WHERE step < 8
), remainders AS MATERIALIZED (
    SELECT list(rest ORDER BY byte) AS table_of FROM steps WHERE step = 8
), numbered AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, md5(coalesce(text, '')) AS digest, strlen(coalesce(text, '')) AS bytes,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS number
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT conv_id, count(*) AS own FROM numbered GROUP BY conv_id
), hashed AS (
    SELECT conv_id, own, conv_id - conv_id % 5 AS first, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
        lambda c, b: xor(table_of[(xor(c, b) & 255) + 1], c >> 8))) % 9 AS h
    FROM sizes, remainders
), heads AS MATERIALIZED (
    SELECT a.conv_id, a.first, h, least(h, coalesce(b.own, 0)) AS taken, least(h, coalesce(b.own, 0)) + greatest(a.own - h, 0) AS size
    FROM hashed AS a LEFT JOIN sizes AS b ON b.conv_id = a.first
), rebuilt AS (
    SELECT conv_id, taken + number - h AS number, role, digest, bytes FROM numbered JOIN heads USING (conv_id) WHERE number > h
    UNION ALL
    SELECT heads.conv_id, number, role, digest, bytes FROM heads JOIN numbered ON numbered.conv_id = first AND number <= taken
), members AS MATERIALIZED (
    SELECT conv_id, number AS depth, bytes, string_agg(md5(digest || role), ',') OVER (PARTITION BY conv_id ORDER BY number ROWS UNBOUNDED PRECEDING) AS key FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), named AS MATERIALIZED (
    SELECT depth, key, min(conv_id) AS node, count(*) AS n_convs, min(bytes) AS bytes FROM members GROUP BY depth, key
), ways AS MATERIALIZED (
    SELECT m.conv_id, m.depth, n.node FROM members AS m JOIN named AS n USING (depth, key)
), nodes AS MATERIALIZED (
    SELECT n.*, w.node AS parent FROM named AS n LEFT JOIN ways AS w ON w.conv_id = n.node AND w.depth = n.depth - 1
), children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY ALL
), rolled AS (
    SELECT w.node, w.depth, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
    FROM nodes AS n JOIN ways AS w ON w.conv_id = n.node AND w.depth <= n.depth LEFT JOIN children AS c ON c.node = n.node AND c.depth = n.depth
    GROUP BY w.node, w.depth
), ends AS (
    SELECT w.node, w.depth, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
    FROM ways AS w JOIN heads USING (conv_id) WHERE w.depth = size GROUP BY w.node, w.depth
)
SELECT n.node AS conv_id, CAST(n.depth AS BIGINT) AS depth, n.parent AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes AS n JOIN rolled AS r ON r.node = n.node AND r.depth = n.depth
LEFT JOIN children AS c ON c.node = n.node AND c.depth = n.depth LEFT JOIN ends AS e ON e.node = n.node AND e.depth = n.depth
"""

# Near words share the word with one character left out, at the same place or as the word itself.
_SPELLING = """
WITH RECURSIVE steps AS (
    SELECT range AS byte, CAST(range AS BIGINT) AS rest, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384) ELSE rest >> 1 END, step + 1 FROM steps WHERE step < 8
), remainders AS MATERIALIZED (
    SELECT list(rest ORDER BY byte) AS table_of FROM steps WHERE step = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
        lambda c, b: xor(table_of[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM counted, remainders
), harmed AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM harmed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS MATERIALIZED (
    SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut AS a JOIN cut AS b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN words AS b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN words AS b ON a.less = b.word
), best AS (
    SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM near GROUP BY word
), formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN -(best[1]) >= 2 * w.n THEN best[2] END AS form, CASE WHEN -(best[1]) >= 2 * w.n THEN -(best[1]) END AS form_n
    FROM words AS w LEFT JOIN best USING (word)
), ways AS (
    SELECT word, form AS root FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT w.word, f.form FROM ways AS w JOIN formed AS f ON f.word = w.root WHERE f.form IS NOT NULL
), ends AS (
    SELECT w.word, w.root FROM ways AS w JOIN formed AS f ON f.word = w.root WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed AS f LEFT JOIN ends AS e USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": _LINE_DEDUP, "op8_sharding": _SHARDING, "op9_substring_dedup": _SUBSTRINGS,
        "op10_decontamination": _DECONTAMINATION, "op12_prefix_trie": _PREFIXES, "op13_spelling_variants": _SPELLING,
    }
