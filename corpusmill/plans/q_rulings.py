"""Queries of rules, tables, underlines and glyphs: line items stand for pieces and words, embeddings for bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rulings as R
from ..operators.blocks import parts
from .registry import query


@query("""
WITH p AS (SELECT l_suppkey AS doc, l_linenumber AS page, l_partkey % 60 * 10.0 + 0.5 AS "at", (l_orderkey % 80) * 10.0 AS lo, (l_orderkey % 80) * 10.0 + 8 AS hi FROM lineitem),
w AS (SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY doc, page, "at" ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 3, true)::INT AS new FROM p),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc, page, "at" ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM w)
SELECT doc, page, "at", min(lo) AS lo, max(hi) AS hi FROM g GROUP BY doc, page, "at", g
""")
def stitched_rules(read):
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    top, x0 = (p % 60 * 10).cast("double"), (o % 80 * 10).cast("double")
    pieces = read("lineitem").select(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), x0.alias("x0"), top.alias("top"), (x0 + 8).alias("x1"), (top + 1).alias("bottom"))
    return R.stitched(pieces, ["doc", "page"]).select("doc", "page", "at", "lo", "hi")


@query("""
WITH o AS (SELECT o_orderkey AS region, 2 + o_orderkey % 3 AS nr, 2 + o_orderkey % 2 AS nc, o_orderkey % 5 AS kind FROM orders), c AS (SELECT region, nr, nc, kind, unnest(range(0, nr * nc)) AS k FROM o),
l AS (SELECT l_orderkey AS region, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL), t AS (SELECT region, (n - 1) % (nr * nc) AS k, string_agg(p::VARCHAR, ' ' ORDER BY n) AS t FROM l JOIN o USING (region) GROUP BY ALL)
SELECT region, CASE kind WHEN 1 THEN 'open cell' WHEN 2 THEN 'small' END AS failed, CASE WHEN kind NOT IN (1, 2) THEN string_agg(coalesce(t, ''), '|' ORDER BY k) END AS cells FROM c LEFT JOIN t USING (region, k) GROUP BY region, kind
""")
def ruled_tables(read):
    r = F.col("region")
    o = read("orders").select(F.col("o_orderkey").alias("region"), (2 + F.col("o_orderkey") % 3).cast("int").alias("nr"), (2 + F.col("o_orderkey") % 2).cast("int").alias("nc"), (F.col("o_orderkey") % 5).alias("kind"), F.lit(1).alias("page"))
    y0 = (r * 1000).cast("double")
    wide, tall = F.col("nc") * 100.0, F.col("nr") * 20.0
    regions = o.select(r.alias("page"), "region", F.lit(0.0).alias("x0"), y0.alias("top"), wide.alias("x1"), (y0 + F.when(F.col("kind") == 2, 2 * tall).otherwise(tall)).alias("bottom"))
    piece = lambda x0, top, x1, bottom: F.struct(x0.alias("x0"), top.alias("top"), x1.alias("x1"), bottom.alias("bottom"))
    flat = F.transform(F.sequence(F.lit(0), F.col("nr")), lambda i: piece(F.lit(0.0), y0 + i * 20.0 - 0.5, F.when((F.col("kind") == 1) & (i == 1), wide - 50).otherwise(wide), y0 + i * 20.0 + 0.5))
    upright = F.transform(F.sequence(F.lit(0), F.col("nc")), lambda j: piece(j * 100.0 - 0.5, y0, j * 100.0 + 0.5, y0 + tall))
    pieces = o.select(r.alias("page"), F.inline(F.concat(flat, upright)))
    lines = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").repartition(parts(o, R.REGIONS), "l_orderkey")  # items meet their order where they are summed
    items = lines.groupBy(F.col("l_orderkey").alias("region"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("p")).join(o, "region")
    k = (F.col("n") - 1) % (F.col("nr") * F.col("nc"))
    x0, top = (k % F.col("nc")) * 100.0 + 5 + F.floor((F.col("n") - 1) / (F.col("nr") * F.col("nc"))) * 30, y0 + F.floor(k / F.col("nc")) * 20.0 + 5
    words = items.select(r.alias("page"), F.col("n").alias("id"), x0.alias("x0"), (x0 + 20).alias("x1"), top.alias("top"), (top + 8).alias("bottom"), F.col("p").cast("string").alias("text"))
    t = R.tables(regions, pieces, words, ["page"])
    return t.select("region", "failed", F.array_join(F.flatten("cells"), "|").alias("cells"))


@query("""
WITH w AS (SELECT l_suppkey AS doc, l_linenumber AS page, l_orderkey * 8 + l_linenumber AS id, l_orderkey % 30 * 20.0 AS x0, l_orderkey % 30 * 20.0 + 15 AS x1, l_partkey % 50 * 14.0 AS top, l_partkey % 50 * 14.0 + 10 AS bottom, l_partkey FROM lineitem),
u AS (SELECT doc, page, id AS rule, x0, x1 + CASE l_partkey % 3 WHEN 0 THEN 20 ELSE 0 END AS x1, bottom + CASE l_partkey % 2 WHEN 0 THEN 0.5 ELSE 2.5 END AS top, l_partkey FROM w WHERE l_partkey % 7 < 2),
a AS (SELECT u.*, w.id, w.x0 AS wx0, w.x1 AS wx1, w.top AS wtop, w.bottom AS wbottom FROM u JOIN w USING (doc, page) WHERE w.top < u.top AND w.bottom BETWEEN u.top - 2.5 AND u.top + 2 AND least(w.x1, u.x1) - greatest(w.x0, u.x0) > 0.8 * (w.x1 - w.x0)),
g AS (SELECT doc, page, rule, x0, x1, top, max(top - wbottom) AS far, arg_min(wtop, id) AS line, max(wx1) - min(wx0) AS wide FROM a GROUP BY ALL HAVING max(top - wbottom) <= 1.2 AND x1 - x0 <= 1.3 * (max(wx1) - min(wx0)) + 4),
k AS (SELECT * FROM g WHERE EXISTS (SELECT 1 FROM w WHERE w.doc = g.doc AND w.page = g.page AND abs(w.top - g.line) < 1.5 AND (w.x1 < g.x0 - 1 OR w.x0 > g.x1 + 1))
  AND NOT coalesce((SELECT bool_or(w.x0 >= g.x0 - 2 AND w.x1 <= g.x1 + 2) AND NOT bool_or(w.x0 < g.x0 - 1 AND w.x1 > g.x0 - 1 OR w.x0 < g.x1 + 1 AND w.x1 > g.x1 + 1) FROM w WHERE w.doc = g.doc AND w.page = g.page AND w.top - (g.top + 1) BETWEEN -1 AND 6.5), false))
SELECT DISTINCT a.doc, a.page, a.id, a.rule FROM a JOIN k USING (doc, page, rule, top, x0, x1)
""")
def underlined_words(read):
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    x0, top = (o % 30 * 20).cast("double"), (p % 50 * 14).cast("double")
    w = read("lineitem").select(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), (o * 8 + F.col("l_linenumber")).alias("id"), x0.alias("x0"), (x0 + 15).alias("x1"), top.alias("top"), (top + 10).alias("bottom"), "l_partkey")
    at = F.col("bottom") + F.when(p % 2 == 0, 0.5).otherwise(2.5)
    rules = w.where("l_partkey % 7 < 2").select("doc", "page", "id", "x0", (F.col("x1") + F.when(p % 3 == 0, 20).otherwise(0)).alias("x1"), at.alias("top"), (at + 1).alias("bottom"))
    return R.underlined(w, rules, ["doc", "page"]).distinct()


@query("""
WITH b AS (SELECT vec_id AS id, array_to_string(list_transform(range(0, 576), lambda i: CASE WHEN embedding[i % 64 + 1] > embedding[(i * 7 + i // 64 + 1) % 64 + 1] THEN '1' ELSE '0' END), '') AS bits, 1 + label % 3 * 0.3 AS aspect, label FROM embeddings),
q AS (SELECT id, array_to_string(list_transform(range(0, 576), lambda i: CASE WHEN (i + id) % (9 + (id // 100) % 6) = 0 THEN translate(bits[i + 1], '01', '10') ELSE bits[i + 1] END), '') AS bits, aspect FROM b WHERE id % 100 = 0),
h AS (SELECT q.id, k.id AS known, k.label, hamming(q.bits, k.bits) AS d FROM q JOIN b k ON abs(ln(q.aspect) - ln(k.aspect)) <= 0.35 WHERE hamming(q.bits, k.bits) <= 57)
SELECT b.id, first(known ORDER BY d, known) AS known, first(chr(65 + h.label::INT) ORDER BY d, known) AS char, min(d) AS distance FROM b LEFT JOIN h USING (id) WHERE b.id % 100 = 0 GROUP BY b.id
""")
def nearest_glyph(read):
    e = F.col("embedding")
    bits = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(575)), lambda i: F.when(F.get(e, i % 64) > F.get(e, ((i * 7 + F.floor(i / 64) + 1) % 64).cast("int")), "1").otherwise("0")), "")
    b = read("embeddings").select(F.col("vec_id").alias("id"), bits.alias("bits"), (1 + F.col("label") % 3 * 0.3).cast("double").alias("aspect"), F.chr(65 + F.col("label")).alias("char"))
    step = 9 + F.floor(F.col("id") / 100) % 6
    other = F.transform(F.split("bits", ""), lambda c, i: F.when((i + F.col("id")) % step == 0, F.translate(c, "01", "10")).otherwise(c))
    return R.nearest_glyphs(b.where("id % 100 = 0").select("id", F.array_join(other, "").alias("bits"), "aspect"), b)
