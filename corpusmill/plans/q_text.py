"""Queries over text: primitives, legibility and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.languages import EN, STOP
from ..operators import quality as Q
from ..operators import rules as R
from .registry import query

_FOLD = f"translate(lower({{}}), '{T.ACCENTED}', '{T.PLAIN}')"
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def _list(words):
    return "[" + ",".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


@query(f"SELECT doc_id, md5({_FOLD.format('text')}) AS folded_md5 FROM documents")
def text_fold(read):
    return read("documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded_md5"))


@query("SELECT doc_id, md5(regexp_replace(text, '[0-9]+', 'N', 'g')) AS template_md5, length(regexp_replace(text, '[0-9]+', 'N', 'g')) AS n FROM documents")
def text_template(read):
    t = T.template(F.col("text"))
    return read("documents").select("doc_id", F.md5(t).alias("template_md5"), F.length(t).cast("long").alias("n"))


@query(r"""
SELECT doc_id, CASE WHEN length(t) > 1000 THEN t[1:550] || ' […] ' || right(t, 400) ELSE t END AS summary
FROM (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS t FROM documents)
""")
def text_summary(read):
    return read("documents").select("doc_id", T.summary(T.collapse(F.col("text")), 1000, 550, 400).alias("summary"))


@query(f"SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_words FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)")
def tokens_unicode(read):
    d = read("documents").select("doc_id", T.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_words"))


@query(rf"""
SELECT doc_id, len(w) AS n_words, array_to_string(list_sort(w), ' ') AS words FROM (
  SELECT doc_id, list_filter(list_distinct(regexp_extract_all(lower(text), '\p{{L}}{{4,}}')), lambda x: NOT list_contains({_list(sorted(set(EN)))}, x)) AS w FROM documents)
""")
def content_words(read):
    w = T.content_words(F.col("text"), sorted(set(EN)))
    d = read("documents").select("doc_id", w.alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"), F.array_join(F.array_sort("w"), " ").alias("words"))


@query(rf"""
SELECT doc_id, CASE WHEN len(t) >= 3 THEN len(t) - 2 ELSE 0 END AS n_grams,
  CASE WHEN len(t) >= 3 THEN len(list_distinct(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i+2], ' ')))) ELSE 0 END AS n_distinct
FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)
""")
def ngrams(read):
    d = read("documents").select("doc_id", T.ngrams(T.tokens(F.col("text")), 3).alias("g"))
    return d.select("doc_id", F.size("g").cast("long").alias("n_grams"), F.size(F.array_distinct("g")).cast("long").alias("n_distinct"))


@query(r"""
SELECT page_id, p[-1] AS base, array_to_string(p[1:len(p)-1], '/') AS dir, len(p) AS depth,
  regexp_extract(p[-1], '\.([A-Za-z0-9_]+)$', 1).lower() AS ext
FROM (SELECT page_id, string_split(regexp_extract(url, '^https?://([^?#]*)', 1), '/') AS p FROM pages)
""")
def url_parts(read):
    p = F.regexp_extract("url", r"^https?://([^?#]*)", 1)
    return read("pages").select("page_id", T.basename(p).alias("base"), T.dirname(p).alias("dir"), T.depth(p).cast("long").alias("depth"), T.extension(p).alias("ext"))


@query(r"""
SELECT page_id, md5(regexp_replace(html, '\{\{[^}]*\}\}|\\\(|\\\)|<[^>]+>|\*', ' ', 'g')) AS bare_md5,
  length(regexp_replace(html, '\{\{[^}]*\}\}|\\\(|\\\)|<[^>]+>|\*', ' ', 'g')) AS n FROM pages
""")
def marker_strip(read):
    bare = T.strip_markers(F.col("html"))
    return read("pages").select("page_id", F.md5(bare).alias("bare_md5"), F.length(bare).cast("long").alias("n"))


@query(r"""
SELECT doc_id, md5(regexp_replace('{{fonte:1}}A {{img:' || doc_id || '}} ' || text, '\{\{img:[^}]*\}\}', '[figura]').replace('{{fonte:1}}', '')) AS shown_md5 FROM documents
""")
def figure_markers(read):
    c = F.concat(F.lit("{{fonte:1}}A {{img:"), F.col("doc_id").cast("string"), F.lit("}} "), F.col("text"))
    return read("documents").select("doc_id", F.md5(T.figure_markers(c)).alias("shown_md5"))


@query("""
SELECT conv_id, turn, 'a {{img:' || CASE turn WHEN 1 THEN 40 WHEN 2 THEN 7 ELSE turn END || '}} b {{img:2000}}' || text AS remapped FROM conversations
""")
def marker_remap(read):
    c = F.concat(F.lit("a {{img:"), F.col("turn").cast("string"), F.lit("}} b {{img:2000}}"), F.col("text"))
    return read("conversations").select("conv_id", "turn", T.remap_markers(c, F.create_map(F.lit(1), F.lit(40), F.lit(2), F.lit(7))).alias("remapped"))


@query("""
SELECT user_id, min(ts)::VARCHAR AS first_ts, floor(epoch(max(ts)) / 60)::BIGINT - floor(epoch(min(ts)) / 60)::BIGINT AS minutes,
  ((floor(epoch(max(ts)) / 60)::BIGINT - floor(epoch(min(ts)) / 60)::BIGINT) // 60) || ':' || lpad(((floor(epoch(max(ts)) / 60)::BIGINT - floor(epoch(min(ts)) / 60)::BIGINT) % 60)::VARCHAR, 2, '0') AS elapsed
FROM (SELECT user_id, date_trunc('minute', ts) AS ts FROM events) GROUP BY user_id
""")
def elapsed_times(read):
    """Times as ISO texts, parsed again: each user's first minute, and how long their events go on."""
    e = read("events").select("user_id", T.iso_timestamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:00XXX")).alias("ts"))
    g = e.groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    s = F.unix_timestamp("hi") - F.unix_timestamp("lo")
    return g.select("user_id", F.date_format("lo", "yyyy-MM-dd HH:mm:ss").alias("first_ts"), F.floor(s / 60).alias("minutes"), T.hours_minutes(s).alias("elapsed"))


@query("""
WITH b AS (SELECT c_custkey, c_name, bin(c_custkey) AS b FROM customer), p AS (SELECT *, rpad(b, (ceil(length(b) / 8) * 8)::INT, '0') AS w FROM b)
SELECT c_custkey, array_to_string(list_transform(range(length(w) // 8), lambda i: right('0' || lower(hex(list_sum(list_transform(range(8), lambda j: (w[i * 8 + j + 1] = '1')::BIGINT << (7 - j)))::BIGINT)), 2)), '') AS packed, base64(c_name::BLOB) AS name64 FROM p
""")
def packed_keys(read):
    return read("customer").select("c_custkey", T.packed_bits(F.bin("c_custkey")).alias("packed"), F.base64(F.encode("c_name", "UTF-8")).alias("name64"))


@query("""
SELECT conv_id, turn, '{{img:' || (turn + conv_id) || '}} x {{img:' || (turn + conv_id + 1) || '}}' || text AS renumbered FROM conversations
""")
def marker_renumber(read):
    c = F.concat(F.lit("{{img:"), F.col("turn").cast("string"), F.lit("}} x {{img:"), (F.col("turn") + 1).cast("string"), F.lit("}}"), F.col("text"))
    return read("conversations").select("conv_id", "turn", T.renumber_markers(c, F.col("conv_id")).alias("renumbered"))


@query(r"""
WITH p AS (
  SELECT doc_id, list_filter(string_split('Fonte: A' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) || chr(10) || chr(10) || 'Fonte: A', chr(10) || chr(10)), lambda x: trim(x) <> '') AS p FROM documents
), q AS (
  SELECT doc_id, list_filter(p, lambda x: regexp_matches(x, '^(Fonte|Source|Disponível em)\b')) AS moved, list_filter(p, lambda x: NOT regexp_matches(x, '^(Fonte|Source|Disponível em)\b')) AS rest FROM p
)
SELECT doc_id, md5(array_to_string(rest[1:greatest(len(rest) - 1, 0)] || [moved[1]] || rest[greatest(len(rest), 1):greatest(len(rest), 1)], chr(10) || chr(10))) AS placed_md5 FROM q
""")
def source_placement(read):
    gap = "\n\n"
    c = F.concat(F.lit("Fonte: A" + gap), F.replace(F.col("text"), F.lit("\n"), F.lit(gap)), F.lit(gap + "Fonte: A"))
    return read("documents").select("doc_id", F.md5(T.place_sources(c)).alias("placed_md5"))


def _legibility_sql(text, least):
    toks = f"regexp_extract_all(lower({text}), '[a-zà-öø-ÿ]+')"
    lists = " ".join(f"WHEN lang = '{k}' THEN {_list(v)}" for k, v in STOP.items())
    return f"CASE WHEN len({toks}) >= {least} THEN len(list_filter({toks}, lambda x: list_contains(CASE {lists} ELSE []::VARCHAR[] END, x))) / len({toks}) END"


@query(f"SELECT doc_id, round({_legibility_sql('text', 20)}, 6) AS legibility FROM documents")
def legibility(read):
    return read("documents").select("doc_id", F.round(Q.legibility(F.col("text"), F.col("lang")), 6).alias("legibility"))


_LINES = """
l0 AS (SELECT doc_id, lang, string_split(text, chr(10)) AS p FROM documents),
l1 AS (SELECT doc_id, lang, CASE WHEN trim(p[-1]) = '' THEN p[1:len(p)-1] ELSE p END AS p FROM l0),
l AS (SELECT doc_id, lang, unnest(p) AS line, unnest(range(1, len(p) + 1)) AS line_no FROM l1)
"""
_STATUS = f"s AS (SELECT doc_id, line_no, CASE WHEN length(trim(line)) < 80 THEN 'empty' WHEN {_legibility_sql('line', 30)} < 0.10 THEN 'poor' ELSE 'ok' END AS status FROM l)"


@query(f"WITH {_LINES}, {_STATUS} SELECT doc_id, line_no, status FROM s")
def line_status(read):
    return Q.line_status(read("documents")).withColumn("line_no", F.col("line_no").cast("long"))


def _ranges_sql(kind):
    return f"""(SELECT doc_id, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ',' ORDER BY lo) AS r FROM (
      SELECT doc_id, min(line_no) AS lo, max(line_no) AS hi FROM (SELECT doc_id, line_no, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM s WHERE status = '{kind}') GROUP BY doc_id, g) GROUP BY doc_id)"""


@query(f"""
WITH {_LINES}, {_STATUS}, c AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (status = 'empty') AS ne, count(*) FILTER (status = 'poor') AS np FROM s GROUP BY doc_id)
SELECT c.doc_id, CASE WHEN n = ne THEN 'no_text' WHEN np > 0.5 * (n - ne) THEN 'corrupt' WHEN np > 0 THEN 'partly_corrupt' WHEN ne > 0.5 * n THEN 'mostly_empty' ELSE 'ok' END AS status,
  n AS n_lines, coalesce(e.r, '') AS empty_lines, coalesce(p.r, '') AS poor_lines
FROM c LEFT JOIN {_ranges_sql('empty')} e USING (doc_id) LEFT JOIN {_ranges_sql('poor')} p USING (doc_id)
""")
def doc_status(read):
    return Q.document_status(Q.line_status(read("documents")))


@query(f"WITH {_LINES}, {_STATUS} SELECT doc_id, line_no FROM s WHERE status = 'empty'")
def line_ranges(read):
    """Ranges written and read again: the numbers must come back."""
    d = Q.document_status(Q.line_status(read("documents")))
    return d.select("doc_id", F.explode(T.expand_ranges(F.col("empty_lines"))).alias("line_no")).withColumn("line_no", F.col("line_no").cast("long"))


@query(f"""
SELECT doc_id, CASE WHEN n_chars < 50 THEN 'no_text' WHEN s < 0.10 THEN 'corrupt' WHEN s < 0.20 THEN 'doubtful' ELSE 'ok' END AS status
FROM (SELECT doc_id, n_chars, {_legibility_sql('text', 20)} AS s FROM documents)
""")
def sample_status(read):
    s = Q.legibility(F.col("text"), F.col("lang"))
    return read("documents").select("doc_id", Q.sample_status(F.col("n_chars"), s, F.lit(3), F.lit(10)).alias("status"))


@query(r"""
SELECT doc_id, regexp_matches(regexp_replace(text, '\{\{[^}]+\}\}|https?://\S+|\S+@\S+|\\\(.*?\\\)', '', 'g'), '[A-Za-zÀ-ÿ]{20,}') AS glued FROM documents
""")
def glued_words(read):
    return read("documents").select("doc_id", T.glued(F.col("text"), 20).alias("glued"))


@query(r"SELECT doc_id, regexp_matches(text, '[\x{E000}-\x{F8FF}\x{FFFD}]') AS odd FROM documents")
def odd_chars(read):
    return read("documents").select("doc_id", T.odd_characters(F.col("text")).alias("odd"))


@query(f"""
WITH {_LINES} SELECT doc_id, key, count(*) AS n, min(line_no) AS first_line FROM (
  SELECT doc_id, trim(regexp_replace(line, '[0-9]+', '#', 'g')) AS key, line_no FROM l) WHERE length(key) > 5 GROUP BY doc_id, key HAVING count(*) >= 3
""")
def repeated_lines(read):
    return Q.repeated_lines(read("documents")).withColumn("first_line", F.col("first_line").cast("long"))


@query("""
WITH l AS (SELECT doc_id, string_split(text || chr(10) || '_____', chr(10)) AS l FROM documents), e AS (SELECT doc_id, trim(unnest(l), ' ') AS line FROM l),
g AS (SELECT doc_id, list(line) AS gone FROM (SELECT doc_id, line FROM e WHERE length(line) > 5 GROUP BY ALL HAVING count(*) >= 3) GROUP BY doc_id),
k AS (SELECT doc_id, len(l) AS n, list_filter(l, lambda x: NOT coalesce(list_contains(gone, trim(x, ' ')), false) AND NOT regexp_matches(x, '^ *_{4,} *$')) AS kept FROM l LEFT JOIN g USING (doc_id))
SELECT doc_id, array_to_string(kept, chr(10)) AS text, n - len(kept) AS n_dropped FROM k
""")
def repeated_line_removal(read):
    return Q.without_repeated_lines(read("documents").select("doc_id", F.concat("text", F.lit("\n_____")).alias("text")))


@query(r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+(?:-\p{L}+)*')) AS word FROM documents) GROUP BY word HAVING count(*) >= 2
""")
def vocabulary(read):
    return Q.vocabulary(read("documents"))


@query(r"""
SELECT doc_id, CASE WHEN n >= 3 THEN n END AS n_items FROM (
  SELECT doc_id, greatest(len(list_distinct(list_filter(list_transform(regexp_extract_all(text, '\b(?:the|la|der) ([0-9]{1,3})\b', 1), lambda x: x::INT), lambda x: x BETWEEN 1 AND 300))),
    len(regexp_extract_all(text, '(?m)^E'))) AS n FROM documents)
""")
def estimate_items(read):
    n = Q.estimated_items(F.col("text"), r"\b(?:the|la|der) ([0-9]{1,3})\b", r"(?m)^E")
    return read("documents").select("doc_id", n.cast("long").alias("n_items"))


@query(r"""
SELECT page_id, CASE WHEN regexp_matches(n, 'folha de reda|cartao|modelo gab|modelo folha') THEN 'auxiliar'
  WHEN regexp_matches(n, '\((com|sem)\s+gabarito\)') THEN 'prova'
  WHEN regexp_matches(n, 'resposta[s]?[ -_]esperada|resp cienc|resposta ciencia|^resp[ _]') THEN 'padrao_resposta'
  WHEN regexp_matches(n, 'criterio|grade de correcao|expectativa|padrao de resposta|respostas esperadas') THEN 'padrao_resposta'
  WHEN n LIKE '%errata%' THEN 'auxiliar' WHEN regexp_matches(n, 'resolu|coment|respost|correcao|^res_|_res_|cmtd') THEN 'resolucao'
  WHEN regexp_matches(n, 'gab|(^|[_\W])gb[_\W]') THEN 'gabarito' ELSE 'prova' END AS role,
  coalesce(nullif(regexp_extract(url, '(?:[^0-9]|^)(19[0-9][0-9]|20[0-2][0-9])(?:[^0-9]|$)', 1), ''), '') AS year
FROM (SELECT page_id, url, lower(['gabarito ', 'resolucao ', 'cartao ', 'errata ', 'prova '][page_id % 5 + 1] || string_split(url, '/')[-1]) AS n FROM pages)
""")
def role_rules(read):
    kinds = F.array(*map(F.lit, ("gabarito ", "resolucao ", "cartao ", "errata ", "prova ")))
    name = F.concat(F.element_at(kinds, (F.col("page_id") % 5 + 1).cast("int")), T.basename(F.col("url")))
    return read("pages").select("page_id", R.role(name, F.lit("")).alias("role"), T.year(F.col("url")).alias("year"))


@query(r"""
SELECT page_id, CASE WHEN regexp_matches(url, '\?') THEN 'query' WHEN regexp_matches(url, '#') THEN 'anchor' WHEN regexp_matches(url, '^https:') THEN 'secure' WHEN regexp_matches(url, '^http:') THEN 'plain' ELSE '' END AS grp,
  CASE WHEN regexp_matches(url, '/fr/') THEN 'fr' WHEN regexp_matches(url, '/en/') THEN 'en' ELSE '' END AS lang FROM pages
""")
def path_rules(read):
    staged = [("^http:", {"grp": "plain"}), ("^https:", {"grp": "secure"}), ("#", {"grp": "anchor"}), (r"\?", {"grp": "query"}), ("/en/", {"lang": "en"}), ("/fr/", {"lang": "fr"})]
    g = R.path_group(F.col("url"), staged)
    return read("pages").select("page_id", g["grp"].alias("grp"), g["lang"].alias("lang"))


@query(f"SELECT doc_id, CASE WHEN f LIKE '%tion%' THEN 'latin' WHEN f LIKE '%keit%' THEN 'german' WHEN f LIKE '%eau%' THEN 'french' ELSE 'other' END AS label FROM (SELECT doc_id, {_FOLD.format('text')} AS f FROM documents)")
def keyword_lookup(read):
    return read("documents").select("doc_id", T.first_keyword(F.col("text"), [("tion", "latin"), ("keit", "german"), ("eau", "french")], "other").alias("label"))


def _alerts_of_orders():
    return R.alerts([("OCR conferido", F.col("o_orderkey") % 17 == 0), ("PENDENTE de leitura", F.col("o_orderkey") % 13 == 0), ("texto curto solto", F.col("o_totalprice") < 60000), ("sem gabarito oficial", F.col("o_orderstatus") == "P"), ("alternativas fora de ordem", F.col("o_orderpriority").startswith("5"))])


_ALERTS = """list_filter([CASE WHEN o_orderkey % 17 = 0 THEN 'OCR conferido' END, CASE WHEN o_orderkey % 13 = 0 THEN 'PENDENTE de leitura' END, CASE WHEN o_totalprice < 60000 THEN 'texto curto solto' END,
  CASE WHEN o_orderstatus = 'P' THEN 'sem gabarito oficial' END, CASE WHEN o_orderpriority LIKE '5%' THEN 'alternativas fora de ordem' END], lambda x: x IS NOT NULL)"""
_BUCKET = """CASE WHEN list_contains(a, 'OCR conferido') THEN 'ocr' WHEN list_contains(a, 'PENDENTE de leitura') THEN 'pendente' WHEN o_orderstatus = 'O' THEN 'sem_gabarito'
  WHEN o_orderkey % 5 < 1 THEN 'alternativas' WHEN len(a) = 0 THEN 'ok_sem_alerta' WHEN NOT list_contains(a, 'alternativas fora de ordem') THEN 'ok_alerta_leve' ELSE 'alerta_grave' END"""


@query(f"SELECT o_orderkey, array_to_string(a, '; ') AS alerts, len(a) AS n_alerts FROM (SELECT *, {_ALERTS} AS a FROM orders)")
def alerts(read):
    a = _alerts_of_orders()
    return read("orders").select("o_orderkey", F.array_join(a, "; ").alias("alerts"), F.size(a).cast("long").alias("n_alerts"))


def _bucketed(read):
    o = read("orders").withColumn("a", _alerts_of_orders())
    return o.withColumn("bucket", R.status_bucket(F.col("a"), F.col("o_orderstatus") != "O", F.col("o_orderkey") % 5 >= 1, "texto curto solto"))


@query(f"SELECT o_orderkey, {_BUCKET} AS bucket FROM (SELECT *, {_ALERTS} AS a FROM orders)")
def status_bucket(read):
    return _bucketed(read).select("o_orderkey", "bucket")


@query(f"SELECT o_orderkey FROM (SELECT *, {_ALERTS} AS a FROM orders) WHERE o_orderpriority NOT LIKE '1%' AND len(a) = 0 AND (o_orderstatus <> 'O' OR o_orderkey % 7 = 0) AND o_orderkey % 6 >= 4")
def ready_rows(read):
    o = read("orders").withColumn("a", _alerts_of_orders())
    key = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise("")
    return R.ready(o, F.col("o_orderpriority").startswith("1"), F.col("a"), key, F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") % 6, F.lit(""), F.lit(False)).select("o_orderkey")


@query("""
SELECT l_orderkey, n AS found, n = 0 OR (e IS NOT NULL AND n < 0.5 * e) OR (e IS NULL AND p >= 8 AND n < p) OR (n >= 10 AND pend > 0.5 * n) AS failed FROM (
  SELECT l_orderkey, count(*) AS n, CASE WHEN l_orderkey % 2 = 0 THEN max(l_linenumber) * 2 END AS e, sum(l_quantity) / 10 AS p, count(*) FILTER (l_returnflag = 'N') AS pend FROM lineitem GROUP BY l_orderkey)
""")
def failure_flag(read):
    g = read("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("found"), F.max("l_linenumber").alias("m"), (F.sum("l_quantity") / 10).alias("p"), F.count_if(F.col("l_returnflag") == "N").alias("pend"))
    e = F.when(F.col("l_orderkey") % 2 == 0, F.col("m") * 2)
    return g.select("l_orderkey", "found", R.failed(F.col("found"), e, F.col("p"), F.col("pend")).alias("failed"))


@query("""
SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (length(w) > 12) AS n_long FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS w FROM documents) GROUP BY doc_id
""")
def token_lengths(read):
    t = read("documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("w"))
    return t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.length("w") > 12).alias("n_long"))


@query("""
SELECT o_orderkey, lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS padded, format('{:,}', o_orderkey * 1000).replace(',', '.') AS dotted,
  'P' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') AS exam, (o_orderkey % 1000)::INT AS number, CASE WHEN o_orderkey % 3 = 0 THEN 'ING' END AS language FROM orders
""")
def formatted_ids(read):
    code = F.concat(F.lit("P"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"), F.lit("-Q"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"), F.when(F.col("o_orderkey") % 3 == 0, "-ING").otherwise(""))
    s = T.source_id(code)
    return read("orders").select("o_orderkey", F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0").alias("padded"), T.dotted(F.col("o_orderkey") * 1000).alias("dotted"), s["exam"].alias("exam"), s["number"].alias("number"), s["language"].alias("language"))


@query(r"""
SELECT page_id, CASE WHEN n >= 5 THEN array_to_string(p[1:2], '/') ELSE array_to_string(p, '/') END AS folder FROM (
  SELECT page_id, len(p) AS n, p FROM (SELECT page_id, ['a', 'b', 'c' || page_id % 2, 'gabaritos', 'cadernos'] [1:page_id % 5 + 1] AS p FROM pages)) WHERE NOT (page_id % 5 IN (3, 4))
UNION ALL SELECT page_id, 'a/b/c' || page_id % 2 FROM pages WHERE page_id % 5 IN (3, 4)
""")
def folder_climb(read):
    parts = F.slice(F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("c"), (F.col("page_id") % 2).cast("string")), F.lit("gabaritos"), F.lit("cadernos")), F.lit(1), (F.col("page_id") % 5 + 1).cast("int"))
    return read("pages").select("page_id", T.climb(F.array_join(parts, "/"), "gabaritos?|cadernos").alias("folder"))
