"""Queries of parsers, lots, validators, upserts and incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batch as B
from ..operators import blocks as K
from ..operators import merge as M
from ..operators import parse as P
from ..streaming import incremental as I
from .registry import query

# Orders written as exam keys: four blocks an exam, with answers in several wordings.
_L = "chr(65 + (k % 5)::INT)"
_KEYS = f"""
b AS (SELECT o_custkey AS doc, o_orderkey AS k, 'QUESTÃO ' || (o_orderkey % 50 + 1) || chr(10) || CASE o_orderkey % 4 WHEN 0 THEN 'Resposta correta: ' || {_L.replace('k', 'o_orderkey', 1)} WHEN 1 THEN 'Texto.' || chr(10) || {_L.replace('k', 'o_orderkey', 1)} || ') CORRETA porque' WHEN 2 THEN 'A alternativa correta é a ' || {_L.replace('k', 'o_orderkey', 1)} || '.' ELSE 'nada' END || chr(10) AS t FROM orders)
"""


def _key_texts(read):
    k = F.col("o_orderkey")
    letter = F.chr(65 + k % 5)
    body = F.when(k % 4 == 0, F.concat(F.lit("Resposta correta: "), letter)).when(k % 4 == 1, F.concat(F.lit("Texto.\n"), letter, F.lit(") CORRETA porque"))).when(k % 4 == 2, F.concat(F.lit("A alternativa correta é a "), letter, F.lit("."))).otherwise("nada")
    o = read("orders").select("o_custkey", "o_orderkey", F.concat(F.lit("QUESTÃO "), (k % 50 + 1).cast("string"), F.lit("\n"), body, F.lit("\n")).alias("t"))
    g = o.groupBy(F.col("o_custkey").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "t"))).alias("x"))
    return g.select("doc", F.concat(F.lit("Gabarito comentado\n"), F.array_join(F.transform("x", lambda y: y["t"]), "")).alias("text"))


@query(f"""
WITH {_KEYS} SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY k) - 1 AS block_no, (k % 50 + 1)::BIGINT AS number, CASE WHEN k % 4 = 3 THEN '' ELSE {_L} END AS found FROM b
""")
def answer_blocks(read):
    a = P.answers(P.split_blocks(_key_texts(read), "doc", "text"))
    return a.select("doc", F.col("block_no").cast("long").alias("block_no"), F.col("number").cast("long").alias("number"), F.array_join(F.array_distinct("found"), ",").alias("found"))


@query(f"""
WITH {_KEYS}, g AS (SELECT doc, k % 50 + 1 AS number, count(*) AS n, list(CASE WHEN k % 4 < 3 THEN {_L} END) AS f, max(k) AS m FROM b GROUP BY ALL),
s AS (SELECT *, list_filter(f, lambda x: x IS NOT NULL) AS l FROM g), t AS (SELECT doc, number, chr(65 + (m % 5)::INT) AS key, n, l FROM s)
SELECT doc, number::BIGINT AS number, key, CASE WHEN n = 1 AND len(list_distinct(l)) = 1 AND list_contains(l, key) THEN 'confirmed' WHEN n > 1 THEN 'several blocks' WHEN len(l) = 0 THEN 'unreadable' ELSE 'disagreeing' END AS outcome FROM t
""")
def key_triangulate(read):
    found = P.answers(P.split_blocks(_key_texts(read), "doc", "text"))
    stored = read("orders").groupBy(F.col("o_custkey").alias("doc"), (F.col("o_orderkey") % 50 + 1).cast("int").alias("number")).agg(F.chr(65 + F.max("o_orderkey") % 5).alias("key"))
    t = P.triangulated(stored, found.select("doc", "number", "found"))
    return t.select("doc", F.col("number").cast("long").alias("number"), "key", "outcome")


@query("""
SELECT o_custkey AS doc, o_orderkey % 60 + 1 AS number, arg_min(chr(65 + (o_orderkey % 5)::INT), o_orderkey) AS letter FROM orders GROUP BY ALL
""")
def key_pairs(read):
    k = F.col("o_orderkey")
    g = read("orders").groupBy(F.col("o_custkey").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.concat((k % 60 + 1).cast("string"), F.lit(". "), F.chr(65 + k % 5)).alias("t")))).alias("x"))
    t = g.select("doc", F.array_join(F.transform("x", lambda y: y["t"]), "   ").alias("text"))
    return P.key_pairs(t, "doc", "text").withColumn("number", F.col("number").cast("long"))


def _two_lines(read, sep=" "):
    k = F.col("l_linenumber")
    g = read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.chr(65 + F.col("p") % 5).alias("c")))).alias("x"))
    g = g.where(F.size("x") >= 5)
    top = F.array_join(F.transform("x", lambda y: F.lpad((y["l_linenumber"] + 10).cast("string"), 6, " ")), "")
    low = F.array_join(F.transform("x", lambda y: F.lpad(y["c"], 6, " ")), "")
    lines = g.select("l_orderkey", F.explode(F.array(F.struct(F.lit(1).alias("n"), top.alias("t")), F.struct(F.lit(2).alias("n"), F.lit("  ").alias("t")), F.struct(F.lit(3).alias("n"), low.alias("t")))).alias("l"))
    return lines.select("l_orderkey", "l.n", "l.t")


_TWO = """
WITH g AS (SELECT l_orderkey, l_linenumber, chr(65 + (min(l_partkey) % 5)::INT) AS letter FROM lineitem GROUP BY ALL)
SELECT l_orderkey, (l_linenumber + 10)::BIGINT AS number, letter FROM g QUALIFY count(*) OVER (PARTITION BY l_orderkey) >= 5
"""


@query(_TWO)
def horizontal_key(read):
    return P.horizontal_key(_two_lines(read), "l_orderkey", "n", "t").withColumn("number", F.col("number").cast("long"))


@query(_TWO)
def paired_lines_key(read):
    return P.paired_lines_key(_two_lines(read), "l_orderkey", "n", "t").withColumn("number", F.col("number").cast("long"))


@query("""
SELECT conv_id, chr(97 + turn::INT) AS letter, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS item FROM conversations QUALIFY count(*) OVER (PARTITION BY conv_id) BETWEEN 2 AND 8 AND min(turn) OVER (PARTITION BY conv_id) = 0 AND max(turn) OVER (PARTITION BY conv_id) = count(*) OVER (PARTITION BY conv_id) - 1
""")
def item_split(read):
    c = read("conversations")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", T.collapse(F.col("text")).alias("t")))).alias("x"))
    t = g.select("conv_id", F.array_join(F.transform("x", lambda y: F.concat(F.chr(97 + y["turn"]), F.lit(") "), y["t"])), "\n").alias("text"))
    return P.split_items(t, "conv_id", "text")


@query("SELECT c_custkey, c_custkey % 40 + 1 AS lo, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 40 + 1 ELSE c_custkey % 40 + 4 END AS hi FROM customer WHERE c_custkey % 5 <> 0")
def label_ranges(read):
    k = F.col("c_custkey")
    n = (k % 40 + 1).cast("string")
    s = F.when(k % 5 == 0, "Capa da prova").when(k % 3 == 0, F.concat(F.lit("Leia o texto para responder a questão "), n, F.lit("."))).otherwise(F.concat(F.lit("Considere os textos para responder as questões de "), n, F.lit(" a "), (k % 40 + 4).cast("string"), F.lit(".")))
    r = P.label_range(s)
    return read("customer").select("c_custkey", r["lo"].cast("long").alias("lo"), r["hi"].cast("long").alias("hi")).where("lo is not null")


@query(r"""
SELECT page_id, p - 1 AS pos, href[p] AS href, trim(regexp_replace(name[p], '<[^>]+>', '', 'g')) AS name FROM (
  SELECT page_id, unnest(range(1, len(href) + 1)) AS p, href, name FROM (SELECT page_id, regexp_extract_all(html, '(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS href, regexp_extract_all(html, '(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS name FROM pages))
""")
def html_links(read):
    return P.html_links(read("pages"), "page_id", "html").withColumn("pos", F.col("pos").cast("long"))


@query("SELECT DISTINCT s_nationkey, 'P' || lpad(s_suppkey::VARCHAR, 4, '0') AS id FROM supplier WHERE s_suppkey % 3 > 0")
def list_ids(read):
    k = F.col("s_suppkey")
    line = F.concat(F.when(k % 3 == 0, "# fora: ").when(k % 3 == 1, "* ").otherwise(""), F.lit("P"), F.lpad(k.cast("string"), 4, "0"), F.lit(" — grupo"))
    g = read("supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(line), "\n").alias("t"))
    return P.key_lines(g, "s_nationkey", "t")


@query("SELECT s_suppkey, s_name AS name, 'k: ' || s_nationkey AS note FROM supplier")
def property_lines(read):
    p = P.properties(F.concat(F.lit("Title: "), F.col("s_name"), F.lit("\nno value\nNote: k: "), F.col("s_nationkey").cast("string")))
    return read("supplier").select("s_suppkey", p["Title"].alias("name"), p["Note"].alias("note"))


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'named' WHEN doc_id % 3 = 1 THEN 'dotted' ELSE 'bare' END AS styles, doc_id % 90 AS number FROM documents
""")
def heading_styles(read):
    n = F.lpad((F.col("doc_id") % 90).cast("string"), 2, "0")
    line = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("QUESTÃO "), n, F.lit(" leia"))).when(F.col("doc_id") % 3 == 1, F.concat(n, F.lit(". texto"))).otherwise(n)
    h = P.candidate_headings(line)
    return read("documents").select("doc_id", F.array_join(F.transform(h, lambda x: x["style"]), ",").alias("styles"), F.element_at(h, 1)["number"].cast("long").alias("number"))


@query(r"""
WITH v AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+(?:-\p{L}+)*')) AS word FROM documents) GROUP BY word),
l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, line_no, regexp_extract(l[line_no], '([A-Za-z]+)\W*$', 1) AS a, regexp_extract(l[line_no + 1], '^\W*([A-Za-z]+)', 1) AS b FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS line_no FROM l))
SELECT doc_id, line_no, CASE WHEN a <> '' AND b <> '' AND coalesce(j.n, 0) > coalesce(h.n, 0) THEN a || b ELSE a || '-' || b END AS joined, a <> '' AND b <> '' AND coalesce(j.n, 0) = coalesce(h.n, 0) AS doubt
FROM p LEFT JOIN v j ON j.word = lower(a || b) LEFT JOIN v h ON h.word = lower(a || '-' || b)
""")
def hyphen_join(read):
    from ..operators.quality import vocabulary

    d = read("documents")
    v = vocabulary(d, 1)
    l = F.split("text", "\n", -1)
    pairs = F.arrays_zip(l.alias("left"), F.slice(l, 2, F.size(l)).alias("right"))
    p = d.select("doc_id", F.posexplode(pairs).alias("p", "x")).where("x.right is not null")
    p = p.select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), F.regexp_extract("x.left", r"([A-Za-z]+)\W*$", 1).alias("a"), F.regexp_extract("x.right", r"^\W*([A-Za-z]+)", 1).alias("b"))
    p = p.withColumn("j", F.lower(F.concat("a", "b"))).withColumn("h", F.lower(F.concat("a", F.lit("-"), "b")))
    q = p.join(v.select(F.col("word").alias("j"), F.col("n").alias("nj")), "j", "left").join(v.select(F.col("word").alias("h"), F.col("n").alias("nh")), "h", "left").fillna(0, ["nj", "nh"])
    r = P.join_hyphen(F.concat("a", F.lit("-")), F.col("b"), F.col("nj"), F.col("nh"))
    return q.select("doc_id", "line_no", r["text"].alias("joined"), r["doubt"].alias("doubt"))


@query("""
SELECT doc_id, 'lote_' || lpad(((row_number() OVER w - 1) // 30)::VARCHAR, 3, '0') AS lot, (row_number() OVER w - 1) % 30 AS pos FROM documents LEFT JOIN labels USING (doc_id) WINDOW w AS (ORDER BY quality IS NULL, lang, doc_id)
""")
def lots(read):
    d = read("documents").join(read("labels"), "doc_id", "left").withColumn("unlabelled", F.col("quality").isNull())
    return B.lots(d, ["unlabelled", "lang", "doc_id"], 30).select("doc_id", "lot", "pos")


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 200")
def seeded_sample(read):
    return B.seeded_sample(read("documents"), "doc_id", "7", 200).select("doc_id")


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(source || ':' || doc_id), doc_id) <= 5")
def group_sample(read):
    return B.per_group_sample(read("documents"), "source", "doc_id", 5).select("source", "doc_id")


@query("""
WITH l AS (SELECT conv_id AS lot, turn AS pos, conv_id * 100 + turn AS id FROM conversations), a AS (SELECT lot, CASE WHEN lot % 5 = 1 AND pos < 2 THEN 1 - pos ELSE pos END AS pos, id FROM l WHERE lot % 7 <> 0 AND NOT (lot % 11 = 3 AND pos = 1))
SELECT lot, CASE WHEN count(a.id) = 0 THEN 'no answer' WHEN bool_and(l.id IS NOT DISTINCT FROM a.id) THEN 'ok' ELSE 'ids differ' END AS status FROM l FULL JOIN a USING (lot, pos) GROUP BY lot
""")
def lot_validate(read):
    l = read("conversations").select(F.col("conv_id").alias("lot"), F.col("turn").alias("pos"), (F.col("conv_id") * 100 + F.col("turn")).alias("id"))
    a = l.where("lot % 7 <> 0 and not (lot % 11 = 3 and pos = 1)").withColumn("pos", F.when((F.col("lot") % 5 == 1) & (F.col("pos") < 2), 1 - F.col("pos")).otherwise(F.col("pos")))
    return B.lot_status(l, a)


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN s_suppkey IS NULL THEN 'unknown code' WHEN l_returnflag NOT IN ('A', 'R') THEN 'bad confidence' END AS error FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 9 > 0) ON s_suppkey = l_suppkey
""")
def row_validator(read):
    a = read("lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("code"), F.col("l_returnflag").alias("conf"))
    return B.validated(a, read("supplier").where("s_suppkey % 9 > 0").select(F.col("s_suppkey").alias("code")), ("A", "R")).select("l_orderkey", "l_linenumber", "error")


@query("""
WITH s AS (SELECT s_nationkey::VARCHAR AS sub, s_nationkey || CASE WHEN s_suppkey % 13 = 0 THEN '-X1' ELSE '-E' || s_suppkey % 12 END AS code, CASE WHEN s_suppkey % 17 = 0 THEN ' ' ELSE s_name END AS name FROM supplier),
a AS (SELECT c_nationkey::VARCHAR AS sub, c_custkey AS id, c_nationkey || '-E' || c_custkey % 12 AS code FROM customer),
g AS (SELECT sub, count(*) <> count(DISTINCT code) AS rep, bool_or(NOT regexp_full_match(code, sub || '-E[0-9]{1,2}')) AS mal, bool_or(trim(name) = '') AS un, count(*) FILTER (code NOT LIKE '%-E9') AS n FROM s GROUP BY sub),
h AS (SELECT a.sub, count(*) FILTER (k.code IS NULL) AS nu, avg((a.code LIKE '%-E9')::INT) AS sh FROM a LEFT JOIN (SELECT DISTINCT sub, code FROM s) k ON k.sub = a.sub AND k.code = a.code GROUP BY a.sub)
SELECT sub, array_to_string(list_filter([CASE WHEN rep THEN 'codes repeated' END, CASE WHEN mal THEN 'codes malformed' END, CASE WHEN un THEN 'style without name' END, CASE WHEN NOT n BETWEEN 1 AND 10 THEN 'number of styles' END, CASE WHEN nu > 0 THEN 'unknown style' END, CASE WHEN sh > 0.12 THEN 'too many others' END], lambda x: x IS NOT NULL), '; ') AS problems
FROM g LEFT JOIN h USING (sub)
""")
def style_validate(read):
    s = read("supplier").select(F.col("s_nationkey").cast("string").alias("sub"), F.concat(F.col("s_nationkey").cast("string"), F.when(F.col("s_suppkey") % 13 == 0, "-X1").otherwise(F.concat(F.lit("-E"), (F.col("s_suppkey") % 12).cast("string")))).alias("code"), F.when(F.col("s_suppkey") % 17 == 0, " ").otherwise(F.col("s_name")).alias("name"))
    a = read("customer").select(F.col("c_nationkey").cast("string").alias("sub"), F.col("c_custkey").alias("id"), F.concat(F.col("c_nationkey").cast("string"), F.lit("-E"), (F.col("c_custkey") % 12).cast("string")).alias("code"))
    return B.style_check(s, a)


@query("""
SELECT event_id, (json_extract_string(props, '$.k'))::BIGINT AS k, array_to_string(list_sort(json_keys(props)), ',') AS keys, list_sort(json_keys(props)) = ['k'] AS exact FROM events
""")
def exact_keys(read):
    keys = F.array_sort(F.json_object_keys("props"))
    return read("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.array_join(keys, ",").alias("keys"), (keys == F.array(F.lit("k"))).alias("exact"))


@query("""
WITH q AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'listed' END AS i, CASE WHEN o_custkey % 89 = 0 THEN 'exam' END AS e, o_orderstatus = 'P' AS u, o_totalprice > 400000 AS m, o_orderkey % 2 = 0 AS loc FROM orders),
r AS (SELECT *, coalesce(i, e, CASE WHEN u THEN 'key unconfirmed' END, CASE WHEN m THEN 'key mismatch' END) AS reason0 FROM q)
SELECT o_orderkey, coalesce(reason0 LIKE 'key%' AND i IS NULL AND loc, false) AS resolved, CASE WHEN coalesce(reason0 LIKE 'key%' AND i IS NULL AND loc, false) THEN NULL ELSE reason0 END AS reason FROM r
""")
def quarantine(read):
    o = read("orders")
    return B.quarantined(o, F.when(F.col("o_orderkey") % 97 == 0, "listed"), F.when(F.col("o_custkey") % 89 == 0, "exam"), F.col("o_orderstatus") == "P", F.col("o_totalprice") > 400000, F.col("o_orderkey") % 2 == 0).select("o_orderkey", "resolved", "reason")


@query("""
WITH k AS (SELECT c_custkey, 100001 + c_custkey // 2 AS id FROM customer WHERE c_custkey % 2 = 0)
SELECT c_custkey, coalesce(k.id, (SELECT max(id) FROM k) + row_number() OVER (PARTITION BY k.id IS NULL ORDER BY c_mktsegment, c_custkey)) AS id FROM customer LEFT JOIN k USING (c_custkey)
""")
def sticky_ids(read):
    c = read("customer")
    known = c.where("c_custkey % 2 = 0").select("c_custkey", (100001 + F.floor(F.col("c_custkey") / 2)).alias("id"))
    return M.sticky_ids(c.select("c_custkey", "c_mktsegment"), known, "c_custkey", ["c_mktsegment", "c_custkey"]).select("c_custkey", "id")


_UP = """
b AS (SELECT c_custkey AS id, c_name AS statement, c_mktsegment AS answer, 'old ' || c_custkey AS comment FROM customer WHERE c_custkey % 10 < 8),
n AS (SELECT c_custkey AS id, c_name || ' new' AS statement, CASE WHEN c_custkey % 4 = 0 THEN 'OTHER' ELSE c_mktsegment END AS answer, '' AS comment FROM customer WHERE c_custkey % 10 > 3)
"""


@query(f"""
WITH {_UP} SELECT coalesce(b.id, n.id) AS id, coalesce(n.statement, b.statement) AS statement, CASE WHEN b.id IS NULL OR n.answer IS NOT NULL THEN n.answer ELSE b.answer END AS answer,
  CASE WHEN b.id IS NULL OR (n.id IS NOT NULL AND b.answer <> n.answer) THEN n.comment ELSE b.comment END AS comment FROM b FULL JOIN n ON b.id = n.id
""")
def conditional_upsert(read):
    """New texts replace old ones; a comment is cleared where the answer changed; new rows come in."""
    c = read("customer")
    b = c.where("c_custkey % 10 < 8").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("statement"), F.col("c_mktsegment").alias("answer"), F.concat(F.lit("old "), F.col("c_custkey").cast("string")).alias("comment"))
    n = c.where("c_custkey % 10 > 3").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" new")).alias("statement"), F.when(F.col("c_custkey") % 4 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("answer"), F.lit("").alias("comment"))
    return M.upsert(b, n, "id", {"statement": F.lit(True), "answer": F.lit(True), "comment": F.col("answer") != F.col("new_answer")})


@query(f"""
WITH {_UP}, j AS (SELECT coalesce(b.id, n.id) AS id, b.id AS bi, n.id AS ni, b.statement AS s1, n.statement AS s2, b.answer AS a1, n.answer AS a2 FROM b FULL JOIN n ON b.id = n.id)
SELECT id, 'NEW' AS field, NULL AS before, NULL AS after FROM j WHERE bi IS NULL UNION ALL SELECT id, 'GONE', NULL, NULL FROM j WHERE ni IS NULL
UNION ALL SELECT id, 'statement', s1, s2 FROM j WHERE bi IS NOT NULL AND ni IS NOT NULL AND s1 IS DISTINCT FROM s2 UNION ALL SELECT id, 'answer', a1, a2 FROM j WHERE bi IS NOT NULL AND ni IS NOT NULL AND a1 IS DISTINCT FROM a2
""")
def snapshot_diff(read):
    c = read("customer")
    b = c.where("c_custkey % 10 < 8").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("statement"), F.col("c_mktsegment").alias("answer"))
    n = c.where("c_custkey % 10 > 3").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" new")).alias("statement"), F.when(F.col("c_custkey") % 4 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("answer"))
    return M.snapshot_diff(b, n, "id", ["statement", "answer"])


@query("""
SELECT 'union' AS op, count(*) AS n FROM (SELECT doc_id FROM labels UNION SELECT item_id FROM benchmark) UNION ALL SELECT 'bag', count(*) FROM (SELECT doc_id FROM labels UNION ALL SELECT item_id FROM benchmark)
UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM labels INTERSECT SELECT item_id FROM benchmark) UNION ALL SELECT 'only', count(*) FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT item_id FROM benchmark)
""")
def set_ops(read):
    a, b = read("labels").select("doc_id"), read("benchmark").select(F.col("item_id").alias("doc_id"))
    n = lambda op, d: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
    return n("union", a.union(b).distinct()).union(n("bag", a.union(b))).union(n("both", a.intersect(b))).union(n("only", a.exceptAll(b)))


@query("SELECT doc_id FROM labels")
def none_missing(read):
    return M.assert_none_missing(read("labels").select("doc_id"), read("documents"), "doc_id")


@query("""
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN toxic END, quality) AS label, CASE WHEN doc_id % 3 = 0 OR (quality = toxic AND doc_id % 2 = 0) THEN CASE WHEN doc_id % 2 = 0 THEN 'person' END ELSE 'model' END AS source FROM labels
""")
def label_merge(read):
    l = read("labels")
    old = l.select("doc_id", F.col("quality").alias("label"), F.when(F.col("doc_id") % 2 == 0, "person").alias("source"))
    return M.keep_labels(old, l.where("doc_id % 3 > 0").select("doc_id", F.col("toxic").alias("label")), "doc_id", "label", "source", "model")


@query("""
SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS n_rows, count(DISTINCT CASE WHEN c_custkey % 4 = 0 THEN c_custkey END) AS n_keys, count(DISTINCT c_custkey) <= 12 AND count(DISTINCT CASE WHEN c_custkey % 4 = 0 THEN c_custkey END) <= 3 AS publish FROM customer GROUP BY ALL
""")
def size_gate(read):
    d = read("customer").select("c_nationkey", "c_mktsegment", F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 == 0, "key").otherwise("statement").alias("field"))
    return B.small_change(d, 12, 3, ["c_nationkey", "c_mktsegment"])


@query("""
WITH p AS (SELECT label, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS n, vec_id, embedding AS e FROM embeddings), q AS (SELECT * FROM p WHERE vec_id % 100 = 0)
SELECT q.vec_id, arg_max(p.vec_id, (round(list_dot_product(q.e::DOUBLE[], p.e::DOUBLE[]) / sqrt(q.n * p.n), 6), -p.vec_id)) AS nearest, max(round(list_dot_product(q.e::DOUBLE[], p.e::DOUBLE[]) / sqrt(q.n * p.n), 6)) AS cosine FROM q JOIN p ON p.vec_id <> q.vec_id GROUP BY q.vec_id
""")
def nn_template(read):
    """For one vector in a hundred, the nearest of all others by cosine; of vectors without a cosine, nulls."""
    v = read("embeddings").where("vec_id is not null").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    v = v.withColumn("n", dot(F.col("e"), F.col("e")))
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), F.col("e").alias("qe"), F.col("n").alias("qn"))
    q = K.in_blocks(q.repartition(q.count() // K.ROWS + 1))
    near = K.every_two(q, K.in_blocks(v), f"q {dict(v.dtypes)['vec_id']}, vec_id {dict(v.dtypes)['vec_id']}, cosine double", K.nearest_by_cosine)
    near = near.withColumn("cosine", F.round("cosine", 6))
    best = near.groupBy("q").agg(F.max_by("vec_id", F.when(F.col("cosine").isNotNull(), F.struct("cosine", (-F.col("vec_id")).alias("k")))).alias("nearest"), F.max("cosine").alias("cosine"))
    return best.withColumnRenamed("q", "vec_id")


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0")
def incremental_append(read):
    return I.pending(read("events").select("event_id"), read("events").where("event_id % 3 = 0").select("event_id"), "event_id")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey % 3 ELSE 0 END + (s_suppkey % 5 = 0)::INT AS tries FROM supplier WHERE (s_suppkey % 4 = 0 AND s_suppkey % 7 <> 0) OR s_suppkey % 5 = 0 AND NOT (s_suppkey % 4 = 0 AND s_suppkey % 7 = 0)
""")
def dlq_retry(read):
    s = read("supplier")
    queue = s.where("s_suppkey % 4 = 0").select("s_suppkey", (F.col("s_suppkey") % 3).alias("tries"))
    done = s.where("s_suppkey % 7 = 0 and s_suppkey % 4 = 0")
    return I.retry_queue(queue, s.where("s_suppkey % 5 = 0 and not (s_suppkey % 7 = 0 and s_suppkey % 4 = 0)"), done, "s_suppkey")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(read):
    return I.event_windows(read("events")).withColumn("total", F.round("total", 4))


@query("""
WITH g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, (coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE, true))::INT AS c FROM events))
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM g GROUP BY user_id, s
""")
def event_sessions(read):
    return I.sessions(read("events"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'name ' || c_custkey ELSE c_name END AS c_name, CASE WHEN c_custkey % 10 = 5 THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE '' END || CASE WHEN c_custkey % 10 = 0 THEN ',patched' WHEN c_custkey % 10 = 5 THEN 'patched' ELSE '' END AS notes FROM customer
""")
def text_patches(read):
    """Patches that give one field or the other; the rows that have one say so in their notes."""
    c = read("customer").select("c_custkey", "c_name", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("old"))).otherwise(F.array().cast("array<string>")).alias("notes"))
    k = F.col("c_custkey")
    p = c.where("c_custkey % 5 = 0").select("c_custkey", F.when(k % 2 == 0, F.concat(F.lit("name "), k.cast("string"))).alias("c_name"), F.when(k % 2 == 1, "NONE").alias("c_mktsegment"))
    return M.patch(c, p, "c_custkey", ["c_name", "c_mktsegment"], "patched").withColumn("notes", F.array_join("notes", ","))


@query("""
WITH e AS (SELECT o_orderkey, o_orderkey % 12 AS r, CASE o_orderkey % 12 WHEN 6 THEN 'aponta outra letra' WHEN 7 THEN 'campos da revisão' ELSE
  CASE o_orderkey % 6 WHEN 2 THEN 'gabarito diferente' WHEN 3 THEN 'status' WHEN 4 THEN 'analise_correta_texto curta' WHEN 5 THEN 'quadro_resumo' ELSE '' END END AS errors FROM orders)
SELECT o_orderkey, errors, CASE WHEN errors <> '' THEN 'rejected' WHEN r = 0 THEN 'accepted' ELSE 'review' END AS route FROM e
""")
def comment_routes(read):
    """Commented answers in JSON, one or two kinds of fault each, through the validator and its routes."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    case, key, letters = k % 6, F.chr(65 + k % 4), F.array(*(F.lit(c) for c in "ABCD"))
    said = F.when(k % 12 == 6, F.chr(65 + (k + 1) % 4)).otherwise(key)
    wrong = F.transform(F.filter(letters, lambda l: l != key), lambda l: F.struct(l.alias("alt"), F.lit("rótulo").alias("rotulo"), F.lit("texto").alias("texto")))
    cards = F.array_repeat(F.struct(F.lit("frente").alias("frente"), F.lit("verso").alias("verso"), F.lit("Fato").alias("tag")), 3)
    rows = F.array_repeat(F.struct(F.lit("item").alias("item"), F.lit("detalhe").alias("detalhe")), F.when(case == 5, 2).otherwise(3))
    whole = F.struct(
        k.alias("id"),
        F.when(case == 3, "talvez").otherwise("ok").alias("status"),
        F.when(case == 2, "E").otherwise(key).alias("gabarito"),
        F.array(F.lit("um"), F.lit("dois"), F.lit("três")).alias("passos_raciocinio"),
        F.lit("título").alias("analise_correta_titulo"),
        F.repeat(F.lit("texto "), F.when(case == 4, 2).otherwise(40)).alias("analise_correta_texto"),
        F.lit("intro").alias("analise_incorretas_intro"),
        wrong.alias("analise_incorretas"),
        rows.alias("quadro_resumo"),
        F.concat(F.lit("Gabarito: "), said).alias("leve_para_prova"),
        cards.alias("flashcards"),
    )
    review = F.struct(k.alias("id"), F.lit("discordo").alias("status"), key.alias("gabarito"), F.when(k % 12 == 7, none).otherwise("motivo").alias("motivo"))
    answers = read("orders").select("o_orderkey", F.when(case == 1, F.to_json(review)).otherwise(F.to_json(whole)).alias("answer"))
    checked = answers.withColumn("errors", B.comment_errors(F.col("answer"), key, letters))
    return B.route_comments(checked, "answer", "errors").select("o_orderkey", F.array_join("errors", "; ").alias("errors"), "route")
