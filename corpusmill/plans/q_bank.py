"""Queries of a question bank: orders stand for questions, customers for exams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bank as K
from .registry import query


@query(r"""
WITH q AS (SELECT o_custkey AS exam, o_orderkey AS id, o_orderpriority LIKE '1%' AS d, o_orderkey % 7 = 0 AS annulled, o_orderkey % 9 = 0 AS alert, o_orderstatus AS key, 3 + o_orderkey % 3 AS n, [o_orderkey % 40, o_orderkey % 31] AS bases, o_orderkey % 13 AS t FROM orders)
SELECT exam, id FROM q WHERE NOT d AND NOT alert AND (key <> 'O' OR annulled) AND n >= 4 AND t <> 0 AND exam % 17 <> 0 AND len(list_filter(bases, lambda b: (b + exam) % 6 = 0)) = 0
""")
def ready_questions(read):
    o, none = F.col("o_orderkey"), F.array().cast("array<string>")
    long = "palavrasgrudadasumaanaoutrasemespaco"
    statement = F.when(o % 13 == 0, f"Veja {long}.").when(o % 13 == 1, F.lit(f"Veja https://{long}.org e {{{{img:{long}}}}}.")).otherwise("Veja.")
    questions = read("orders").select(
        F.col("o_custkey").alias("exam"), o.alias("id"), statement.alias("statement"), F.array_repeat(F.lit("x"), (3 + o % 3).cast("int")).alias("options"), F.col("o_orderpriority").startswith("1").alias("discursive"),
        (o % 7 == 0).alias("annulled"), F.when(o % 9 == 0, F.array(F.lit("a"))).otherwise(none).alias("alerts"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("key"), F.array(o % 40, o % 31).alias("base_ids"),
    )
    exam = F.col("c_custkey")
    texts = read("customer").select(exam.alias("exam"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(39).cast("long"))).alias("id"))
    texts = texts.withColumn("alerts", F.when((F.col("id") + F.col("exam")) % 6 == 0, F.array(F.lit("bad"))).otherwise(none))
    return K.ready_questions(questions, texts, read("customer").where("c_custkey % 17 = 0").select(exam.alias("exam"))).select("exam", "id")


@query("""
WITH q AS (SELECT o_custkey AS doc, o_orderkey AS id, o_orderkey % 40 AS number, CASE o_orderkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'es' END AS language, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END AS ref FROM orders),
r AS (SELECT o_custkey AS doc, o_orderkey AS id, o_orderkey % 37 AS lo, o_orderkey % 37 + o_orderkey % 6 AS hi, CASE o_orderkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'es' END AS language FROM orders WHERE o_orderkey % 2 = 0)
SELECT q.doc, q.id, coalesce(max(r.id), any_value(ref)) AS base FROM q LEFT JOIN r ON q.doc = r.doc AND number BETWEEN lo AND hi AND (r.language IS NULL OR r.language = q.language) GROUP BY q.doc, q.id
""")
def base_texts(read):
    o = F.col("o_orderkey")
    q = read("orders").select(F.col("o_custkey").alias("doc"), o.alias("id"), (o % 40).alias("number"), F.when(o % 3 == 0, "en").when(o % 3 == 1, "es").alias("language"), F.when(o % 5 == 0, o).alias("base_ref"))
    r = read("orders").where(o % 2 == 0).select(F.col("o_custkey").alias("doc"), o.alias("id"), (o % 37).alias("lo"), (o % 37 + o % 6).alias("hi"), F.when(o % 4 == 0, "en").when(o % 4 == 1, "es").alias("language"), o.alias("ord"))
    return K.base_text(q, r).select("doc", "id", "base")


@query("""
WITH RECURSIVE o AS (SELECT l_suppkey AS doc, l_linenumber AS part, l_partkey % 4 + l_orderkey // 8 % 9 AS n, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_orderkey, l_partkey, l_quantity) AS i FROM lineitem), s AS (SELECT * FROM o WHERE i <= 12),
r AS (SELECT doc, part, i, n AS last, [n] AS chain, false AS void FROM s WHERE i = 1
  UNION ALL SELECT s.doc, s.part, s.i, CASE WHEN n IN (last + 1, last + 2) THEN n ELSE last END, CASE WHEN n IN (last + 1, last + 2) THEN list_append(chain, n) ELSE chain END, void OR (s.part % 2 = 0 AND n NOT IN (last + 1, last + 2) AND n > last) FROM r JOIN s ON s.doc = r.doc AND s.part = r.part AND s.i = r.i + 1)
SELECT doc, part, CASE WHEN void THEN '' ELSE array_to_string(chain, ',') END AS chain FROM r QUALIFY i = max(i) OVER (PARTITION BY doc, part)
""")
def trusted_chains(read):
    x = read("lineitem").groupBy(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("part")).agg(F.slice(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_partkey", "l_quantity"))), 1, 12).alias("l"))
    numbers = F.transform("l", lambda y: y["l_partkey"] % 4 + F.floor(y["l_orderkey"] / 8) % 9)
    return x.select("doc", "part", F.array_join(K.trusted_chain(numbers, F.col("part") % 2 == 0), ",").alias("chain"))


@query("""
WITH v AS (SELECT l_suppkey AS font, l_linenumber AS cid, l_returnflag AS char, sum(l_quantity)::DOUBLE AS w FROM lineitem GROUP BY ALL UNION ALL SELECT s_suppkey, 1, 'N', 100 FROM supplier),
s AS (SELECT font, cid, char, sum(w) AS weight FROM v GROUP BY ALL), r AS (SELECT *, weight / sum(weight) OVER (PARTITION BY font, cid) AS share, row_number() OVER (PARTITION BY font, cid ORDER BY weight DESC, char) AS r FROM s)
SELECT font, cid, char, weight, round(share, 6) AS share, share >= 0.5 AS kept FROM r WHERE r = 1
""")
def voted_glyphs(read):
    votes = read("lineitem").select(F.col("l_suppkey").alias("font"), F.col("l_linenumber").cast("long").alias("cid"), F.col("l_returnflag").alias("char"), F.col("l_quantity").alias("w"))
    prior = read("supplier").select(F.col("s_suppkey").alias("font"), F.lit(1).cast("long").alias("cid"), F.lit("N").alias("char"))
    return K.voted(votes, prior, ["font", "cid"], "char", "w", least=0.5).withColumn("share", F.round("share", 6))
