"""Queries over page layout and over questions as rows; the star schema stands in for words, lines and boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import items as I
from ..operators import layout as L
from ..operators import parse as P
from .registry import query

# words: one a line item, on pages of a supplier
_W = "w AS (SELECT l_suppkey AS doc, l_linenumber AS page, l_orderkey % 600 AS x0, l_orderkey % 600 + l_partkey % 40 AS x1, l_partkey % 700 AS top, l_partkey % 700 + 10 AS bottom, l_partkey % 3 + 9 AS size, chr(65 + (l_partkey % 6)::INT) AS text, l_orderkey * 8 + l_linenumber AS id, l_extendedprice FROM lineitem)"


def _words(read):
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    return read("lineitem").select(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), (o % 600).alias("x0"), (o % 600 + p % 40).alias("x1"), (p % 700).alias("top"), (p % 700 + 10).alias("bottom"), (p % 3 + 9).alias("size"), F.chr(65 + p % 6).alias("text"), (o * 8 + F.col("l_linenumber")).alias("id"))


@query(f"WITH {_W} SELECT doc, page, CASE WHEN x0 < 300 THEN 0 ELSE 1 END AS half, string_agg(text, ' ' ORDER BY top, x0, text) AS text FROM w GROUP BY ALL")
def column_text(read):
    return L.column_text(_words(read), F.lit(300), ["doc", "page"])


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no FROM documents), a AS (SELECT doc_id, instr(line, ' the ') AS i FROM l WHERE instr(line, ' the ') > 0),
m AS (SELECT doc_id, arg_max(i, (n, -i)) AS i FROM (SELECT doc_id, i, count(*) AS n FROM a GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, no AS line_no, CASE WHEN i IS NULL THEN line ELSE rtrim(line[1:i - 1], ' ') END AS "left", CASE WHEN i IS NULL THEN '' ELSE trim(line[i:], ' ') END AS "right" FROM l LEFT JOIN m USING (doc_id)
""")
def side_box_split(read):
    d = read("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), "line")
    return L.split_side_box(d, "doc_id", "line_no", "line", " the ")


@query(f"WITH {_W}, s AS (SELECT doc, page, top % 8 - page AS shift, id FROM w WHERE x0 < 200), o AS (SELECT doc, shift FROM s GROUP BY ALL HAVING count(DISTINCT page) >= 5) SELECT doc, shift, id FROM s JOIN o USING (doc, shift)")
def page_numbers(read):
    return L.page_numbers(_words(read).where("x0 < 200"), ["doc"], "page", F.col("top") % 8, 5).select("doc", "shift", "id")


@query(f"""
WITH {_W}, p AS (SELECT doc * 1000 + size * 100 + x0 % 50 AS doc, page, bool_or(text = 'A') AS item FROM w GROUP BY ALL), s AS (SELECT doc, min(page) FILTER (item) AS lo, max(page) FILTER (item) AS hi FROM p GROUP BY doc)
SELECT doc, page FROM p JOIN s USING (doc) WHERE page <> 4 AND (lo IS NULL OR page < lo OR page > hi)
""")
def page_exclusion(read):
    p = _words(read).groupBy((F.col("doc") * 1000 + F.col("size") * 100 + F.col("x0") % 50).alias("doc"), "page").agg(F.bool_or(F.col("text") == "A").alias("item"))
    return L.outside_items(p, "doc", "page", F.col("item"), F.col("page") != 4).select("doc", "page")


@query(f"""
WITH {_W}, m AS (SELECT *, top < 63 OR bottom > 651 AS margin, top // 10 AS row FROM w), p AS (SELECT doc, count(DISTINCT page) AS pages FROM w GROUP BY doc),
h AS (SELECT doc, text, row FROM m JOIN p USING (doc) WHERE margin GROUP BY doc, text, row, pages HAVING count(DISTINCT page) >= 3 AND count(DISTINCT page) >= 0.25 * pages)
SELECT id, doc, page, text, top FROM m LEFT JOIN (SELECT *, true AS head FROM h) USING (doc, text, row) WHERE NOT (margin AND head IS NOT NULL)
""")
def running_heads(read):
    w = _words(read).withColumn("row", F.floor(F.col("top") / 10))
    return L.without_running_heads(w, "doc", "page", ["text", "row"], (F.col("top") < 63) | (F.col("bottom") > 651)).select("id", "doc", "page", "text", "top")


@query(r"""
WITH l AS (SELECT doc_id, n_chars, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents)
SELECT doc_id, line_no, len(w) >= 2 AND (len(list_filter(w, lambda x: regexp_matches(x, '^[-+]?[0-9.,%°]+[a-zA-Z]?$'))) >= 0.5 * len(w) OR (n_chars + line_no) % 40 > 30) AS label
FROM (SELECT doc_id, n_chars, line_no, string_split(doc_id || ' 12% ' || line, ' ') AS w FROM l)
""")
def label_lines(read):
    l = read("documents").select("doc_id", "n_chars", F.posexplode(F.split("text", "\n", -1)).alias("p", "line")).withColumn("line_no", (F.col("p") + 1).cast("long"))
    w = F.split(F.concat(F.col("doc_id").cast("string"), F.lit(" 12% "), F.col("line")), " ")
    return l.select("doc_id", "line_no", L.is_label_line(w, (F.col("n_chars") + F.col("line_no")) % 40, F.lit(10)).alias("label"))


@query(f"""
WITH {_W}, l AS (SELECT *, lag(bottom) OVER v AS pb, lag(x1 - x0) OVER v AS pw, lag(size) OVER v AS ps, lead(top) OVER v AS nt, lead(x1 - x0) OVER v AS nw, lead(size) OVER v AS ns FROM w WINDOW v AS (PARTITION BY doc, page ORDER BY top, x0, x1, size, id))
SELECT id, coalesce(top - pb <= 6 AND pw > 12 AND ps = size, false) OR coalesce(nt - bottom <= 6 AND nw > 12 AND ns = size, false) AS in_paragraph FROM l
""")
def paragraph_flags(read):
    return L.in_paragraph(_words(read), ["doc", "page"], 10.0, F.lit(20), ["x1", "size", "id"]).select("id", "in_paragraph")


@query(f"""
WITH RECURSIVE {_W}, b AS (SELECT doc, page, id, x0, x1, top, bottom FROM w),
e AS (SELECT a.id AS a, c.id AS b FROM b a JOIN b c ON a.doc = c.doc AND a.page = c.page AND a.id <> c.id AND a.x0 <= c.x1 + 3 AND c.x0 <= a.x1 + 3 AND a.top <= c.bottom + 3 AND c.top <= a.bottom + 3),
r AS (SELECT id, id AS c FROM b UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id), m AS (SELECT id, min(c) AS box FROM r GROUP BY id)
SELECT doc, page, box, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom, count(*) AS n FROM b JOIN m USING (id) GROUP BY doc, page, box
""")
def box_merge(read):
    return L.merge_boxes(_words(read), ["doc", "page"])


@query(f"WITH {_W} SELECT doc, page, count(*) FILTER (text = 'A') AS a, count(*) FILTER (text NOT IN ('A','B','C','D','E')) AS other FROM w GROUP BY doc, page HAVING least(count(*) FILTER (text = 'A'), count(*) FILTER (text = 'B'), count(*) FILTER (text = 'C'), count(*) FILTER (text = 'D')) >= 5 AND count(*) FILTER (text = 'F') <= 0.2 * count(*)")
def letter_fonts(read):
    return L.letter_fonts(_words(read), ["doc", "page"], 5, 0.2).select("doc", "page", F.col("A").alias("a"), "other")


@query(f"WITH {_W}, g AS (SELECT doc * 10 + page AS doc, count(*) FILTER (text = 'A') AS a, count(*) FILTER (text = 'B') AS b, count(*) FILTER (text = 'C') AS c, count(*) FILTER (text = 'D') AS d, count(*) FILTER (text = 'E' AND x0 < 200) AS e FROM w GROUP BY 1) SELECT doc, CASE WHEN e < 0.3 * d THEN 'D' ELSE 'E' END AS last_option, least(a, b, c, d) >= 5 AND greatest(a, b, c, d) <= 3 * least(a, b, c, d) AS balanced FROM g")
def option_letters(read):
    w = _words(read).withColumn("doc", F.col("doc") * 10 + F.col("page")).withColumn("text", F.when((F.col("text") == "E") & (F.col("x0") >= 200), "-").otherwise(F.col("text")))
    return L.last_option(w, "doc")


@query(f"""
WITH {_W}, g AS (SELECT doc, list_sort(list(x0)) AS a, list_sort(list(x1)) AS b, count(*) AS n FROM w GROUP BY doc), m AS (SELECT doc, a[floor(n * 0.1)::INT + 1] AS l, b[floor(n * 0.9)::INT + 1] AS r FROM g WHERE n >= 3)
SELECT doc, l AS "left", r AS "right", avg((abs(x1 - r) <= 2.5)::INT) < 0.35 AND avg((x1 >= r)::INT) <= 0.2 AS verse FROM w JOIN m USING (doc) GROUP BY doc, l, r
""")
def verse_margins(read):
    return L.margins(_words(read), "doc")


@query(f"""
WITH {_W}, a AS (SELECT doc, x0, count(*) AS n FROM w GROUP BY ALL), b AS (SELECT doc, x1, count(*) AS n FROM w GROUP BY ALL)
SELECT doc, (SELECT arg_max(x0, (n, -x0)) FROM a WHERE a.doc = d.doc) AS "left", (SELECT arg_max(x1, (n, -x1)) FROM b WHERE b.doc = d.doc) AS "right" FROM (SELECT doc FROM w GROUP BY doc HAVING count(*) >= 10) d
""")
def typical_margins(read):
    return L.typical_margins(_words(read), ["doc"])


@query("SELECT conv_id, turn, turn * 10 - lag(turn * 10 + length(text) % 7) OVER (PARTITION BY conv_id ORDER BY turn) AS gap FROM conversations")
def line_gaps(read):
    c = read("conversations").select("conv_id", "turn", (F.col("turn") * 10).alias("top"), (F.col("turn") * 10 + F.length("text") % 7).alias("bottom"), F.lit(0).alias("x0"))
    return L.gaps_above(c, ["conv_id"]).select("conv_id", "turn", "gap")


@query(f"""
WITH {_W}, m AS (SELECT doc, page, text AS letter, x0 AS mx, top AS my FROM w WHERE size = 9 AND text < 'F'), i AS (SELECT doc, page, id AS image, x0, top, bottom + 60 AS bottom FROM w WHERE size = 10 AND text = 'E')
SELECT doc, page, image, arg_min(letter, (floor((x0 - mx) / 10), NOT my BETWEEN top AND bottom, abs(my - top), letter)) AS letter FROM i JOIN m USING (doc, page) WHERE mx <= x0 AND my BETWEEN top - 40 AND bottom GROUP BY ALL
""")
def image_options(read):
    w = _words(read)
    m = w.where("size = 9 and text < 'F'").select("doc", "page", F.col("text").alias("letter"), F.col("x0").alias("x"), F.col("top").alias("y"))
    i = w.where("size = 10 and text = 'E'").select("doc", "page", F.col("id").alias("image"), "x0", "top", (F.col("bottom") + 60).alias("bottom"))
    return L.option_of_image(i, m, ["doc", "page"])


@query("""
WITH l AS (SELECT o_custkey AS doc, o_orderkey AS line, (o_orderkey * 7 % 1000)::BIGINT AS pos FROM orders), it AS (SELECT c_custkey AS doc, k AS item, c_custkey % 300 + k * 200 AS lo, c_custkey % 300 + k * 200 + 100 AS hi FROM customer, range(0, 3) r(k)),
f AS (SELECT * FROM l WHERE line % 3 > 0), e AS (SELECT doc, item, unnest([lo, hi]) AS edge FROM it),
n AS (SELECT f.doc, f.line, arg_min(item, (abs(pos - edge), item)) AS near FROM f JOIN e USING (doc) GROUP BY ALL), s AS (SELECT f.doc, f.line, min(item) AS inner_item FROM f JOIN it ON f.doc = it.doc AND pos BETWEEN lo AND hi GROUP BY ALL)
SELECT n.doc, n.line, coalesce(inner_item, near) AS item FROM n LEFT JOIN s USING (doc, line)
""")
def unused_lines(read):
    o = read("orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line"), (F.col("o_orderkey") * 7 % 1000).alias("at"))
    it = read("customer").select(F.col("c_custkey").alias("doc"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("item"))
    it = it.select("doc", "item", (F.col("doc") % 300 + F.col("item") * 200).alias("lo"), (F.col("doc") % 300 + F.col("item") * 200 + 100).alias("hi"))
    return L.unused_lines(o, o.where("line % 3 = 0"), it, ["doc"])


@query("SELECT conv_id AS doc, turn // 2 AS number, string_agg(DISTINCT role, ',' ORDER BY role) AS sources FROM conversations WHERE length(text) % 3 > 0 GROUP BY ALL")
def relocated_sources(read):
    t = read("conversations").select(F.col("conv_id").alias("doc"), F.floor(F.col("turn") / 2).alias("before"), F.array("role").alias("sources"), "text")
    return L.relocate_sources(t, F.length("text") % 3 > 0).withColumn("sources", F.array_join("sources", ","))


@query("""
WITH g AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_partkey) AS t, list(chr(64 + l_linenumber + (l_partkey % 9 = 0)::INT) ORDER BY l_linenumber, l_partkey) AS l FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, len(list_distinct(t)) < len(t) AS repeated, array_to_string(l, '') <> left('ABCDE', len(l)) AS disordered FROM g
""")
def option_checks(read):
    g = read("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("x"))
    letters = F.transform("x", lambda y: F.chr((64 + y["l_linenumber"] + (y["l_partkey"] % 9 == 0).cast("int")).cast("long")))
    return g.select("l_orderkey", I.repeated_options(F.transform("x", lambda y: y["l_returnflag"])).alias("repeated"), I.letters_out_of_order(letters).alias("disordered"))


@query("""
WITH RECURSIVE n AS (SELECT l_orderkey, chr(64 + l_linenumber) AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) AS i FROM lineitem),
r AS (SELECT DISTINCT l_orderkey, 0::BIGINT AS i, '' AS letters FROM n UNION ALL SELECT r.l_orderkey, n.i, letters || CASE WHEN x = chr(65 + length(letters)::INT) THEN x ELSE '' END FROM r JOIN n ON n.l_orderkey = r.l_orderkey AND n.i = r.i + 1)
SELECT l_orderkey, arg_max(letters, i) AS letters FROM r GROUP BY l_orderkey
""")
def accepted_letters(read):
    g = read("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_linenumber"))).alias("x"))
    return g.select("l_orderkey", F.array_join(I.accepted_letters(F.transform("x", lambda y: F.chr((64 + y["l_linenumber"]).cast("long")))), "").alias("letters"))


@query("""
SELECT conv_id, turn, length(text) % 6 < 2 AND regexp_matches(text, '(?i)th') AND avg((length(text) % 6 >= 4)::INT) OVER (PARTITION BY conv_id) < 0.7 AS discursive FROM conversations
""")
def discursive(read):
    return I.discursive(read("conversations"), "conv_id", F.length("text") % 6, F.col("text").rlike("(?i)th")).select("conv_id", "turn", "discursive")


@query(r"""
SELECT doc_id, md5(array_to_string(list_filter(string_split(replace(text || chr(10) || '_______' || chr(10) || 'Rascunho', chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: NOT regexp_matches(x, '(?i)^\s*(_{5,}|espa[çc]o para (a )?resposta|rascunho)')), chr(10) || chr(10))) AS kept_md5 FROM documents
""")
def answer_space(read):
    t = F.replace(F.concat(F.col("text"), F.lit("\n_______\nRascunho")), F.lit("\n"), F.lit("\n\n"))
    return read("documents").select("doc_id", F.md5(I.without_answer_space(t)).alias("kept_md5"))


@query("SELECT doc_id, CASE WHEN n = 1 THEN '1' WHEN n // 2 <= 2 THEN '1,2' ELSE '1,2,' || n // 2 END AS pages FROM (SELECT doc_id, n_chars % 9 + 1 AS n FROM documents)")
def sampled_pages(read):
    return read("documents").select("doc_id", F.array_join(F.transform(I.sampled_pages((F.col("n_chars") % 9 + 1).cast("int")), lambda x: x.cast("string")), ",").alias("pages"))


@query("SELECT o_custkey, array_to_string(l[1:3], ', ') || CASE WHEN len(l) > 3 THEN ' …' ELSE '' END AS shown FROM (SELECT o_custkey, list(o_orderkey::VARCHAR ORDER BY o_orderkey) AS l FROM orders GROUP BY o_custkey)")
def shortened_lists(read):
    g = read("orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("l"))
    return g.select("o_custkey", I.shortened(F.col("l"), 3).alias("shown"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'B%' THEN 'Simulado' || CASE WHEN c_nationkey % 3 > 0 THEN ' ' || c_nationkey ELSE '' END || ' ' || c_custkey % 9 ELSE c_mktsegment END AS edition,
  array_to_string(list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'regular' END, CASE WHEN c_custkey % 3 = 0 THEN 'PPL' END], lambda x: x IS NOT NULL), ' ') AS labels FROM customer
""")
def exam_titles(read):
    g = F.when(F.col("c_mktsegment").startswith("B"), "SIMULADO_X").otherwise("OFICIAL")
    inst = F.when(F.col("c_nationkey") % 3 > 0, F.col("c_nationkey").cast("string")).otherwise("")
    k = F.col("c_custkey")
    return read("customer").select("c_custkey", I.edition(g, inst, (k % 9).cast("string"), F.col("c_mktsegment")).alias("edition"), I.labels_in_order([("regular", k % 2 == 0), ("PPL", k % 3 == 0), ("regular", k % 4 == 0)]).alias("labels"))


@query("""
SELECT doc_id, rtrim(string_split(text, ' the ')[1], ' ') AS cut, CASE WHEN doc_id % 2 = 0 THEN 'A x' ELSE 'B x' END AS letters, 'opt' AS option, CASE WHEN doc_id % 3 = 0 THEN 'Note e adote: ' || doc_id END AS note, translate(text, 'the', 'ταε') AS remapped FROM documents
""")
def text_fixups(read):
    k = F.col("doc_id")
    note = I.split_note(F.when(k % 3 == 0, F.concat(F.lit("opt Note e adote: "), k.cast("string"))).otherwise("opt"), "Note e adote")
    twice = F.when(k % 2 == 0, "AA x").otherwise("BB x")
    return read("documents").select("doc_id", I.cut_at(F.col("text"), " the ").alias("cut"), I.single_letters(twice).alias("letters"), note["option"].alias("option"), note["note"].alias("note"), I.remapped(F.col("text"), "the", "ταε").alias("remapped"))


@query(r"""
WITH b AS (SELECT doc_id AS block, CASE WHEN doc_id % 4 = 0 THEN doc_id % 50 END AS number, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents), q AS (SELECT item_id AS id, item_id AS number, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM benchmark),
n AS (SELECT block, min(id) AS id FROM b JOIN q USING (number) GROUP BY block), h AS (SELECT block, id, len(list_intersect(b.w, q.w)) AS s, len(q.w) AS n FROM b, q WHERE block NOT IN (SELECT block FROM n))
SELECT block, id, 'number' AS via FROM n UNION ALL SELECT block, arg_max(id, (round(s / n, 9), -id)), 'text' FROM h WHERE s >= 5 AND s >= 0.35 * n GROUP BY block
""")
def text_assignment(read):
    words = lambda c: F.array_distinct(T.tokens(F.col(c)))
    b = read("documents").select(F.col("doc_id").alias("block"), F.when(F.col("doc_id") % 4 == 0, F.col("doc_id") % 50).alias("number"), words("text").alias("words"))
    q = read("benchmark").select(F.col("item_id").alias("id"), F.col("item_id").alias("number"), words("text").alias("words"))
    return I.assigned(b, q)


@query(r"""
WITH o AS (SELECT conv_id AS id, chr(65 + turn::INT) AS letter, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w, turn FROM conversations), x AS (SELECT conv_id AS id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS e FROM conversations WHERE turn = 1),
s AS (SELECT o.id, letter, len(list_intersect(w, e)) / greatest(1, len(w)) AS s FROM o JOIN x ON o.id = x.id), r AS (SELECT *, row_number() OVER v AS r, coalesce(lead(s) OVER v, 0) AS second FROM s WINDOW v AS (PARTITION BY id ORDER BY s DESC, letter))
SELECT id, letter FROM r WHERE r = 1 AND s >= 0.5 AND s >= second + 0.25
""")
def explained_option(read):
    words = F.array_distinct(T.tokens(F.col("text")))
    c = read("conversations")
    o = c.select(F.col("conv_id").alias("id"), F.chr(65 + F.col("turn")).alias("letter"), words.alias("words"))
    return I.explained(o, c.where("turn = 1").select(F.col("conv_id").alias("id"), words.alias("words")))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE chr(65 + (s_suppkey % 5)::INT) END AS answer FROM supplier")
def agreeing_answer(read):
    k = F.col("s_suppkey")
    said, same = F.chr(65 + k % 5), F.lower(F.chr(65 + k % 5))
    body = F.concat(F.lit("Resposta correta: "), said, F.when(k % 4 == 0, F.concat(F.lit("\n"), F.lower(F.chr(65 + (k + 1) % 5)), F.lit(") (V) x"))).when(k % 4 == 1, F.concat(F.lit("\n"), same, F.lit(") (V) x"))).otherwise(""))
    return read("supplier").select("s_suppkey", I.agreeing_answer(body).alias("answer"))


@query("""
WITH b AS (SELECT o_custkey AS doc, o_orderkey AS number, string_split('x' || chr(10) || 'Gabarito: ' || chr(65 + (o_orderkey % 5)::INT) || CASE WHEN o_orderkey % 7 = 0 THEN ' Gabarito: ' || chr(65 + ((o_orderkey + 1) % 5)::INT) ELSE '' END, chr(10))[2] AS t FROM orders)
SELECT doc, number, chr(65 + (number % 5)::INT) AS answer FROM b WHERE number % 7 <> 0
""")
def single_answer_blocks(read):
    k = F.col("o_orderkey")
    body = F.concat(F.lit("x\nGabarito: "), F.chr(65 + k % 5), F.when(k % 7 == 0, F.concat(F.lit(" Gabarito: "), F.chr(65 + (k + 1) % 5))).otherwise(""))
    b = read("orders").select(F.col("o_custkey").alias("doc"), k.alias("number"), body.alias("body"))
    return P.single_answer_blocks(b, r"Gabarito\s*:\s*([A-E])\b").select("doc", "number", "answer")


@query("""
SELECT o_custkey AS doc, o_orderkey AS number, CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 5 = 0 AND o_orderstatus <> 'F' THEN 'F' END AS change FROM orders
""")
def official_audit(read):
    o = read("orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("key"))
    official = o.where("number % 3 > 0").withColumn("key", F.when(F.col("number") % 5 == 0, "F").otherwise(F.col("key")))
    return I.audited(o, official).select("doc", "number", "change")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'missing' WHEN quality = toxic THEN 'kept' ELSE 'changed' END AS outcome FROM labels")
def second_review(read):
    l = read("labels")
    return I.reviewed(l.select(F.col("doc_id").alias("id"), F.col("quality").alias("code")), l.where("doc_id % 4 > 0").select(F.col("doc_id").alias("id"), F.col("toxic").alias("code")))


@query("""
WITH c AS (SELECT conv_id, turn, text, list_sort(string_split(regexp_replace(text, '\\s+', '', 'g'), '')) AS a, list_sort(string_split(regexp_replace(reverse(text) || CASE WHEN turn % 2 = 0 THEN '' ELSE 'x' END, '\\s+', '', 'g'), '')) AS b FROM conversations)
SELECT conv_id, turn, a = b AS conserved FROM c
""")
def conserved_characters(read):
    other = F.concat(F.reverse("text"), F.when(F.col("turn") % 2 == 0, "").otherwise("x"))
    return read("conversations").select("conv_id", "turn", T.same_characters(F.col("text"), other).alias("conserved"))
