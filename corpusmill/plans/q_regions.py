"""Queries of page geometry: line items stand for words, boxes and items of pages.

Regions and boxes under conflicts are refined in rounds and have no SQL; tests compare them with plain loops.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import regions as R
from ..operators.blocks import parts
from .registry import query


def _page_words(read):
    """Words in two columns on pages of a supplier; some cross the middle, some right columns end early."""
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    right, top = p % 2 == 1, F.lit(60.0) + F.floor(p / 2) % 58 * 12
    across = p % 401 == 0
    x0 = F.when(across, 250.0).otherwise(F.lit(30.0) + F.when(right, 300).otherwise(0) + (o % 12) * 20)
    w = read("lineitem").select(
        F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), (o * 8 + F.col("l_linenumber")).alias("id"), x0.alias("x0"),
        (x0 + F.when(across, 100).otherwise(18)).alias("x1"), top.alias("top"), (top + 10).alias("bottom"), (F.lit(9.0) + p % 3).alias("size"),
    )
    early = F.col("page") % 3 == 0
    w = w.where(~(early & (F.col("x0") > 310) & (F.col("top") > 400)) & ~(early & F.col("top").between(401, 450)))
    pages = w.select("doc", "page").distinct().withColumn("width", F.lit(600.0)).withColumn("height", F.lit(800.0))
    return w, pages


@query()
def reading_regions(read):
    words, pages = _page_words(read)
    regions = R.reading_regions(words, pages, ["doc", "page"], 10.0)
    n = R.words_in_regions(words, regions, ["doc", "page"]).groupBy("doc", "page", "region").agg(F.count(F.lit(1)).alias("n_words"))
    return regions.join(n, ["doc", "page", "region"], "left").na.fill(0, ["n_words"])


@query()
def boxes_apart(read):
    items = read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("doc"))
    o, p = F.col("l_orderkey"), F.col("p")
    x0, top = (p % 550).cast("double"), (o * 7 % 750).cast("double")
    b = items.select("doc", F.col("l_linenumber").alias("page"), (o * 8 + F.col("l_linenumber")).alias("id"), x0.alias("x0"), top.alias("top"), (x0 + p % 37 + 3).alias("x1"), (top + o % 23 + 3).alias("bottom"), "p")
    marks = b.where("p % 5 = 0").select("doc", "page", F.col("id").alias("mark"), ((F.col("top") + F.col("bottom")) / 2).alias("y"), (F.col("x0") - 20).alias("x0"), (F.col("x0") - 10).alias("x1"), (F.col("p") % 2 == 0).alias("bare"))
    return R.merge_unless_apart(b, marks, ["doc", "page"])


@query("""
WITH RECURSIVE i AS (
  SELECT l_suppkey AS doc, l_linenumber AS page, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_orderkey, l_partkey) - 1 AS k,
    CASE WHEN l_partkey % 10 = 0 THEN 'header' WHEN l_partkey % 10 < 4 THEN 'figure' ELSE 'line' END AS kind, CASE l_orderkey % 3 WHEN 1 THEN 300 ELSE 0 END AS x0, CASE l_orderkey % 3 WHEN 0 THEN 300 ELSE 600 END AS x1,
    l_partkey % 40 * 20 AS top, l_partkey % 40 * 20 + CASE WHEN l_partkey % 10 BETWEEN 1 AND 3 THEN 40 + l_partkey % 2 * 2 ELSE 10 END AS bottom FROM lineitem
), y AS (
  SELECT *, top + CASE kind WHEN 'figure' THEN least(20, 0.3 * (bottom - top)) ELSE 0 END AS y FROM i
), a AS (
  SELECT y.doc, y.page, y.k, max(h.top) AS t, max(h.top) FILTER (least(h.x1, y.x1) - greatest(h.x0, y.x0) > 0.5 * least(h.x1 - h.x0, y.x1 - y.x0)) AS mine
  FROM y JOIN i h ON h.doc = y.doc AND h.page = y.page AND h.kind = 'header' AND h.top <= y.y + 1 GROUP BY ALL
), own AS (
  SELECT y.doc, y.page, y.k, max(h.k) AS own FROM y JOIN a USING (doc, page, k) JOIN i h ON h.doc = y.doc AND h.page = y.page AND h.kind = 'header' AND h.top = a.t AND mine = t
    AND least(h.x1, y.x1) - greatest(h.x0, y.x0) > 0.5 * least(h.x1 - h.x0, y.x1 - y.x0) GROUP BY ALL
), s AS (
  SELECT y.doc, y.page, y.k, max(f.k) AS beside FROM y JOIN (SELECT DISTINCT doc, page FROM i WHERE kind = 'header') USING (doc, page) LEFT JOIN a USING (doc, page, k) JOIN i f ON f.doc = y.doc AND f.page = y.page AND f.kind = 'figure' AND f.k < y.k
  WHERE y.kind = 'figure' AND mine IS NULL AND NOT least(f.x1, y.x1) - greatest(f.x0, y.x0) > 0.5 * least(f.x1 - f.x0, y.x1 - y.x0) AND abs(f.top - y.top) < 6 AND abs(f.bottom - y.bottom) < 0.2 * (y.bottom - y.top) + 6 GROUP BY ALL
), c AS (
  SELECT i.*, beside, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY i.doc, i.page ORDER BY i.k), -1) AS carried FROM i LEFT JOIN own USING (doc, page, k) LEFT JOIN s USING (doc, page, k)
), r AS (
  SELECT doc, page, k, beside AS root FROM c WHERE beside IS NOT NULL UNION ALL SELECT r.doc, r.page, r.k, c.beside FROM r JOIN c ON c.doc = r.doc AND c.page = r.page AND c.k = r.root WHERE c.beside IS NOT NULL
), q AS (
  SELECT c.doc, c.page, c.k, c.kind, coalesce(b.carried, c.carried) AS owner, c.carried, c.beside FROM c LEFT JOIN (SELECT doc, page, k, min(root) AS root FROM r GROUP BY ALL) USING (doc, page, k) LEFT JOIN c b ON b.doc = c.doc AND b.page = c.page AND b.k = root
)
SELECT doc, page, k, owner, row_number() OVER (PARTITION BY doc, page ORDER BY owner, (NOT (kind = 'header' AND k = carried))::INT, coalesce(beside + 0.5, k), k) - 1 AS place FROM q
""")
def item_owners(read):
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    kind = F.when(p % 10 == 0, "header").when(p % 10 < 4, "figure").otherwise("line")
    top = (p % 40 * 20).cast("double")
    k = F.row_number().over(Window.partitionBy("l_suppkey", "l_linenumber").orderBy("l_orderkey", "l_partkey")) - 1
    lines = read("lineitem").select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey")
    n = parts(lines, R.ITEMS)
    items = lines.repartition(n, "l_suppkey", "l_linenumber").select(
        F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), k.cast("long").alias("k"), kind.alias("kind"), F.when(o % 3 == 1, 300.0).otherwise(0.0).alias("x0"),
        F.when(o % 3 == 0, 300.0).otherwise(600.0).alias("x1"), top.alias("top"), (top + F.when(kind == "figure", 40 + p % 2 * 2).otherwise(10)).alias("bottom"),
    )
    return R.owned_items(items, ["doc", "page"], n).select("doc", "page", "k", "owner", "place")
