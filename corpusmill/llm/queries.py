"""The queries of the training-data operators, thin over the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, importance, licenses, media, mixing, neardup, quality, repeats, secrets, spelling, toxicity
from .common import documents


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).drop("class_id")


#: The definition itself: all pairs that share a shingle, confirmed, and their closure. For small tables only.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w
), e AS (
  SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.c) AS component_id, s.doc_id = min(r.c) AS kept FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


OP5_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents
), g AS (
  SELECT t, count(*) AS group_size, first(doc_id ORDER BY n DESC, doc_id) AS keep_id FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_texts(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP6_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS txt,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS pos FROM conversations
), v AS (
  SELECT t.*, pos // 256 AS part, p.speaker AS perspective,
    CASE WHEN t.speaker = p.speaker THEN '<|assistant|>' WHEN t.speaker = 'system' THEN '<|system|>' ELSE '<|user name=' || t.speaker || '|>' END || chr(10) AS head
  FROM t JOIN (SELECT DISTINCT conv_id, speaker FROM t WHERE speaker <> 'system') p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, sum(length(head) + length(txt) + 8) OVER (PARTITION BY conv_id, perspective, part ORDER BY pos) AS stop FROM v
)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || txt || '<|end|>' || chr(10), '' ORDER BY pos) AS text,
  string_agg((stop - length(txt) - 8)::BIGINT || ':' || (stop - 1)::BIGINT, ',' ORDER BY pos) FILTER (speaker = perspective) AS mask,
  (sum(length(txt) + 7) FILTER (speaker = perspective))::BIGINT AS n_masked
FROM o GROUP BY conv_id, perspective, part
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    return found.select(
        "doc_id",
        *(F.size(secrets.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{secrets.KINDS[k]}") for k in range(3)),
        F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def _located_sql(kind_no: int, pattern: str) -> str:
    """Matches of a pattern with their starts, from the lengths of the gaps and matches before them."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind_no} AS k, unnest(m) AS m, unnest(list_transform(range(1, len(m) + 1), lambda i: coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)))::BIGINT AS s
      FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, string_split_regex(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}'))"""


def _entropy_sql(k: int) -> str:
    """Every window of a candidate counted afresh."""
    _, pattern, _, fold, bits = secrets.CLASSES[k]
    allowed = " OR ".join(f"regexp_matches(m, '{a}')" for a in secrets.ALLOWED)
    terms = [secrets.terms(c) for c in range(secrets.WINDOW + 1)]
    return f"""SELECT doc_id, k, s + list_min(h) AS s, s + list_max(h) + {secrets.WINDOW} AS e FROM (
      SELECT doc_id, k, s, list_filter(range(0, length(x) - {secrets.WINDOW - 1}), lambda i: list_sum(list_transform(list_distinct(string_split(substr(x, i + 1, {secrets.WINDOW}), '')), lambda ch: ({terms}::BIGINT[])[len(list_filter(string_split(substr(x, i + 1, {secrets.WINDOW}), ''), lambda y: y = ch)) + 1])) <= {secrets.most(bits)}) AS h
      FROM (SELECT *, {"lower(m)" if fold else "m"} AS x FROM ({_located_sql(3 + k, pattern)}) WHERE NOT ({allowed}))) WHERE len(h) > 0"""


OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), sp AS (
  SELECT doc_id, k, s, s + length(m) AS e FROM ({_located_sql(0, secrets.ASSIGN)}) WHERE length(regexp_extract(m, '{secrets.ASSIGN.replace("'", "''")}', 2)) >= 6
  UNION ALL SELECT doc_id, k, s, s + length(m) FROM ({_located_sql(1, "AKIA[A-Z0-9]+")}) WHERE length(m) >= 20
  UNION ALL SELECT doc_id, k, s, s + length(m) FROM ({_located_sql(2, "[0-9a-f]+")}) WHERE length(m) >= 24
  UNION ALL {_entropy_sql(0)} UNION ALL {_entropy_sql(1)}
), g AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
    string_agg({list(secrets.KINDS)}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg({list(secrets.KINDS)}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) AS a FROM sp GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""

def _shingles_sql(table: str, key: str, text: str) -> str:
    words = f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+(?:[.''\\-][0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+)*')"
    return f"SELECT {key}, array_to_string(w[i + 1:i + 5], ' ') AS sh, i AS pos FROM (SELECT {key}, w, unnest(range(0, len(w) - 4)) AS i FROM (SELECT {key}, {words} AS w FROM {table}))"


_TEMPLATES_SQL = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in licenses.TEMPLATES.items())
#: All shingles that a document shares with a template, counted in every window of the template's level.
OP9_SQL = f"""
WITH tt(name, text) AS (VALUES {_TEMPLATES_SQL}), ts AS ({_shingles_sql("tt", "name", "text")}),
tl AS (SELECT name, count(DISTINCT sh) AS m, (2 ^ ceil(log2(count(*))))::BIGINT AS level FROM ts GROUP BY name), tu AS (SELECT DISTINCT name, sh FROM ts),
ds AS ({_shingles_sql("documents", "doc_id", "coalesce(text, '')")}),
h AS (SELECT doc_id, name, m, level, sh, pos // level AS k FROM ds JOIN tu USING (sh) JOIN tl USING (name)),
wn AS (SELECT doc_id, name, m, level, k, count(DISTINCT sh) AS n FROM (SELECT * FROM h UNION ALL SELECT doc_id, name, m, level, sh, k - 1 FROM h WHERE k > 0) GROUP BY ALL HAVING count(DISTINCT sh) >= {licenses.CONTAINED} * m),
b AS (SELECT doc_id, name, max(n) AS n, arg_max(k * level, (n, -k)) AS first FROM wn GROUP BY doc_id, name),
g AS (SELECT doc_id, count(*) AS c, string_agg(name, ',' ORDER BY name) AS l, string_agg(name || ':' || n || ':' || first, ',' ORDER BY name) AS x FROM b GROUP BY doc_id)
SELECT doc_id, coalesce(c, 0) AS n_licenses, coalesce(l, '') AS licenses, coalesce(x, '') AS matches FROM documents LEFT JOIN g USING (doc_id)
"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc_sql(text: str) -> str:
    """The unsigned checksum of a string's UTF-8 bytes, by the table of all bytes (``crc_table``) and a fold."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc_t[xor(c & 255, b) + 1])), 4294967295)"""


_CRC_TABLE = """crc_table AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc_t)"""

#: Near words from all pairs that share a wildcard or a deletion; forms are followed one by one.
OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE}, r AS (
  SELECT doc_id, r, count(*) AS c FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {_LOWER}) AS r FROM documents) WHERE length(r) >= {spelling.LEAST_LENGTH} GROUP BY ALL
), h AS (
  SELECT r, c, coalesce({_crc_sql("doc_id || ':' || r")}, 1) AS h FROM r, crc_table
), v AS (
  SELECT CASE WHEN h % {spelling.DAMAGED} = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, sum(c)::BIGINT AS n FROM h GROUP BY 1 HAVING sum(c) >= {spelling.LEAST_N} AND length(word) >= {spelling.LEAST_LENGTH}
), w AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)
), p AS (
  SELECT x.word, y.word AS other, y.n FROM w x JOIN w y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, v.word, v.n FROM w x JOIN v ON v.word = x.a || x.b
  UNION SELECT v.word, x.word, x.n FROM w x JOIN v ON v.word = x.a || x.b
), g AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS other_n FROM p GROUP BY word
), f AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {spelling.TIMES} * n THEN other END AS form, CASE WHEN other_n >= {spelling.TIMES} * n THEN other_n END AS form_n FROM v LEFT JOIN g USING (word)
), c AS (
  SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL
), e AS (
  SELECT c.word, c.at AS root FROM c JOIN f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN e USING (word)
"""

#: Every string of 100 bytes, in hexadecimal; the first of each stays, and the bytes that the others cover go.
OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, {2 * repeats.LENGTH})) AS s FROM (SELECT doc_id, x, unnest(range(0, n - {repeats.LENGTH - 1})) AS p FROM d)
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1
), e AS (
  SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM r
), g AS (
  SELECT doc_id, p, count(*) FILTER (gap IS NULL OR gap > {repeats.LENGTH}) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM e
), s AS (
  SELECT doc_id, run, min(p) AS a, max(p) + {repeats.LENGTH} AS b FROM g GROUP BY doc_id, run
), k AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM s
  UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), t AS (
  SELECT d.doc_id, any_value(n) AS n, sum(b - a)::BIGINT AS kept, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS y FROM d JOIN k USING (doc_id) GROUP BY d.doc_id
)
SELECT t.doc_id, n AS n_bytes, n - kept AS n_removed, coalesce(c, 0) AS n_spans, sha256(unhex(y)) AS kept_sha256 FROM t LEFT JOIN (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id) USING (doc_id)
"""

OP13_SQL = rf"""
WITH {_CRC_TABLE}, d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{importance.WORD}') AS w FROM documents
), q AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{importance.WORD}')) AS word FROM benchmark
), b AS (
  SELECT word, {_crc_sql("word")} % {importance.BUCKETS} AS bucket FROM (SELECT DISTINCT unnest(w) AS word FROM d UNION SELECT word FROM q), crc_table
), dw AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL
), s AS (
  SELECT bucket, sum(n) AS s FROM dw JOIN b USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM q JOIN b USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {importance.BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * ((SELECT count(*) FROM q) + {importance.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)
), m AS (
  SELECT doc_id, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM dw JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id
), x AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (doc_id)
), k AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM x WHERE n_features >= {importance.LEAST_WORDS}
)
SELECT x.doc_id, n_features, weight, score, CASE WHEN k <= n * {importance.PERCENT} // 100 THEN k END AS rank FROM x LEFT JOIN k USING (doc_id)
"""

QUERIES = {
    f.__name__: f
    for f in (op1_minhash_neardup, op2_toxicity, op3_ogg_media, op4_mixing, op5_exact_dedup, op6_chat_rotation, op7_quality, op8_bpe, op9_licenses, op10_secrets, op11_spelling, op12_repeats, op13_importance)
}
SQL = {"op1_minhash_neardup": OP1_SQL, "op5_exact_dedup": OP5_SQL, "op6_chat_rotation": OP6_SQL, "op9_licenses": OP9_SQL, "op10_secrets": OP10_SQL, "op11_spelling": OP11_SQL, "op12_repeats": OP12_SQL, "op13_importance": OP13_SQL}
