"""Queries of the answer-key resolver: each order is a key file of its customer's exam, written in one of six forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answer_keys as K
from .registry import query

#: Items of a file, the exam's number, the file's number: what the texts below say.
_ITEMS = """
i AS (
  SELECT o_custkey AS exam, o_orderkey AS o, l_linenumber + (o_orderkey % 3) * 2 AS n, min(l_partkey) AS p
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
), v AS (
  SELECT o_custkey AS exam, o_orderkey AS o, CASE
    WHEN o_orderkey % 5 < 2 AND o_custkey % 4 < 3 AND (o_orderkey % 5) * 2 <> o_custkey % 4 THEN 'other colour'
    WHEN o_custkey % 4 = 3 AND o_orderkey % 7 = 0 AND o_custkey % 3 <> 1 THEN 'other booklet' END AS veto FROM orders
)"""


def _files(read):
    """exams and sources as the resolver takes them."""
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    exams = read("customer").select(
        c.alias("exam"),
        F.when(c % 4 == 0, "Azul").when(c % 4 == 1, "Amarelo").when(c % 4 == 2, "Rosa").alias("booklet"),
        F.lit("Prova.pdf").alias("file"),
        F.when(c % 4 == 3, F.concat(F.lit("Caderno "), (c % 3 + 1).cast("string"))).alias("cover"),
    )
    items = read("lineitem").groupBy(F.col("l_orderkey").alias("o"), "l_linenumber").agg(F.min("l_partkey").alias("p"))
    items = items.withColumn("n", (F.col("l_linenumber") + (F.col("o") % 3) * 2).cast("string"))
    items = items.groupBy("o").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "n", "p"))).alias("x"))

    def letter(x, k=0):
        return F.chr(65 + (x["p"] + k) % 5)

    def lines(f):
        return F.array_join(F.transform("x", f), "\n")

    def joined(f):
        return F.array_join(F.transform("x", f), " ")

    form = F.col("o") % 6
    body = (
        F.when(form == 0, F.concat(F.lit("Questão "), joined(lambda x: x["n"]), F.lit("\n\nGabarito "), joined(lambda x: letter(x))))
        .when(form == 1, lines(lambda x: F.concat(x["n"], F.lit(". Gabarito: "), letter(x))))
        .when(form == 2, lines(lambda x: F.concat(F.lit("Questão "), x["n"], F.lit("\nComo se vê, a alternativa correta é a "), letter(x), F.lit("."))))
        .when(form == 3, lines(lambda x: F.concat(F.lit("QUESTÃO "), x["n"], F.lit("\nTexto.\n"), letter(x), F.lit(") CORRETA"))))
        .when(form == 4, F.concat(F.lit("Gab_Azul Gab_Amarelo Gab_Rosa\n"), lines(lambda x: F.array_join(F.array(*(F.concat(x["n"], F.lit(" "), letter(x, k)) for k in range(3))), "   "))))
        .otherwise(lines(lambda x: F.concat(x["n"], F.lit(" "), letter(x), F.when(x["n"].cast("int") % 2 == 0, F.concat(F.lit(" "), letter(x, 1))).otherwise(""))))
    )
    name = F.when(o % 5 == 0, "Gabarito Azul.pdf").when(o % 5 == 1, "Gabarito Rosa.pdf").when(o % 5 == 2, "Resolução.pdf").when(o % 5 == 3, "Gabarito sem comentários.pdf").otherwise("Gabarito.pdf")
    texts = items.select("o", F.concat(F.when(F.col("o") % 7 == 0, "CADERNO 2\n").otherwise("Prova\n"), body).alias("text"))
    sources = read("orders").join(texts, o == F.col("o")).select(
        F.col("o_custkey").alias("exam"), o.alias("source"), o.alias("ord"), name.alias("file"), "text", (o % 5).isin(2, 3).alias("solution"), F.lit(None).cast("string").alias("flow")
    )
    return exams, sources


@query(f"""
WITH {_ITEMS}, f AS (
  SELECT i.exam, i.o, o % 5 = 2 AS late, o % 6 AS form, i.exam % 4 AS booklet, n, p FROM i JOIN v USING (exam, o) WHERE veto IS NULL
), a AS (
  SELECT exam, o, late, n, NULL AS language, CASE form WHEN 4 THEN CASE booklet WHEN 3 THEN 5 ELSE 4 END ELSE form END AS reading, chr(65 + ((p + CASE WHEN form = 4 AND booklet < 3 THEN booklet ELSE 0 END) % 5)::INT) AS answer
  FROM f WHERE form IN (0, 1, 3) OR form = 2 AND late OR form = 4 AND NOT late OR form = 5 AND NOT late AND n % 2 = 1
  UNION ALL SELECT exam, o, late, n, x.l, 5, chr(65 + ((p + x.k) % 5)::INT) FROM f, (VALUES ('inglês', 0), ('espanhol', 1)) x(l, k) WHERE form = 5 AND NOT late AND n % 2 = 0
)
SELECT exam, n::BIGINT AS number, language, first(answer ORDER BY late, o) AS answer, first(o ORDER BY late, o) AS source,
  first(['paired lines', 'numbered', 'block', 'marked', 'colour column', 'loose'][reading + 1] ORDER BY late, o) AS reading FROM a GROUP BY exam, n, language
""")
def answer_key_resolver(read):
    return K.resolved_keys(*_files(read)).withColumn("number", F.col("number").cast("long"))


@query(f"WITH {_ITEMS} SELECT v.exam, v.o AS source, veto FROM v JOIN (SELECT DISTINCT o FROM i) USING (o)")
def key_file_vetoes(read):
    return K.read_sources(*_files(read)).select("exam", "source", "veto")
