"""Queries of keyed state: streams that are stopped after one part of their input and go on with the other."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..lineage import checkpoint_dir
from ..streaming import stateful as S
from .registry import query


def _two_runs(rows, over):
    """``rows`` (with ``part`` 0 or 1) as files that arrive in two parts; the stream ends after each, and starts again from its
    checkpoint."""
    spark = rows.sparkSession
    base = f"{checkpoint_dir(spark)}/stream-{uuid4().hex}"
    schema = rows.drop("part").schema
    for part in (0, 1):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/in")
        out = over(spark.readStream.schema(schema).parquet(f"{base}/in"))
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


@query("""
WITH i AS (SELECT (o_custkey % 50)::VARCHAR AS key, o_orderpriority || ' ' || o_orderkey % 7 AS item, (o_orderkey % 90 >= 60)::INT AS part FROM orders), f AS (SELECT key, item, min(part) AS first FROM i GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY first, item) AS number FROM f)
SELECT DISTINCT key, item, number, part = first AS is_new FROM i JOIN n USING (key, item)
""")
def sticky_stream(read):
    o = F.col("o_orderkey")
    rows = read("orders").select((F.col("o_custkey") % 50).alias("key"), F.concat_ws(" ", "o_orderpriority", (o % 7).cast("string")).alias("item"), (o % 90 >= 60).cast("int").alias("part"))
    return _two_runs(rows, lambda s: S.numbered_stream(s, "key", "item"))


_LINES = """l AS (
  SELECT o_custkey::VARCHAR AS doc, o_orderkey AS pos, CASE o_orderkey % 11 WHEN 0 THEN 'area' WHEN 1 THEN 'language' ELSE 'header' END AS kind,
    CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 2 ELSE o_orderkey % 4 + 1 END AS number,
    CASE o_orderkey % 11 WHEN 0 THEN o_orderpriority WHEN 1 THEN CASE o_custkey % 2 WHEN 0 THEN 'inglês' ELSE 'espanhol' END END AS value,
    (2 * o_orderkey > (SELECT max(o_orderkey) FROM orders) OR o_orderkey % 13 = 0)::INT AS part FROM orders
)"""

#: The state machine, line after line; ``{late}`` says which lines come too late.
_GATE = """
WITH RECURSIVE {lines}, t AS (
  SELECT l.*, {late} AS late FROM l LEFT JOIN (SELECT doc, max(pos) FILTER (part = 0) AS reach FROM l GROUP BY doc) USING (doc)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS i FROM t WHERE NOT late
), r AS (
  SELECT doc, 0::BIGINT AS i, 0::BIGINT AS pos, '' AS kind, 0::BIGINT AS number, false AS accepted, 0::BIGINT AS expected, 0 AS lo, 0 AS hi, '' AS fl, 0 AS passes, '' AS area FROM (SELECT DISTINCT doc FROM l)
  UNION ALL SELECT doc, i, pos, kind, number, accepted, CASE WHEN accepted THEN number + 1 ELSE expected END, CASE kind WHEN 'language' THEN 2 ELSE lo END, CASE kind WHEN 'language' THEN 3 ELSE hi END,
    CASE WHEN kind = 'language' AND fl = '' THEN value ELSE fl END, passes + (kind = 'header' AND again)::INT, CASE kind WHEN 'area' THEN value ELSE area END
  FROM (SELECT *, kind = 'header' AND (again OR CASE WHEN expected > 0 THEN number IN (expected, expected + 1) ELSE number = 1 END) AS accepted
    FROM (SELECT o.doc, o.i, o.pos, o.kind, o.number, o.value, expected, lo, hi, fl, passes, area, lo > 0 AND o.number = lo AND expected = hi + 1 AS again FROM r JOIN o ON o.doc = r.doc AND o.i = r.i + 1))
)
SELECT doc, pos, number, accepted, CASE WHEN accepted AND fl <> '' AND number BETWEEN lo AND hi THEN CASE WHEN passes = 0 THEN fl WHEN fl = 'inglês' THEN 'espanhol' ELSE 'inglês' END END AS language,
  CASE WHEN accepted THEN nullif(area, '') END AS area, false AS late FROM r WHERE kind = 'header'
UNION ALL SELECT doc, pos, number, false, NULL, NULL, true FROM t WHERE late AND kind = 'header'
"""


def _lines(read):
    o, area, language = F.col("o_orderkey"), F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") % 11 == 1
    orders = read("orders")
    most = orders.agg(F.max("o_orderkey").alias("most"))
    return orders.join(F.broadcast(most)).select(
        F.col("o_custkey").alias("doc"),
        o.alias("pos"),
        F.when(area, "area").when(language, "language").otherwise("header").alias("kind"),
        F.when(area, F.lit(None)).when(language, 2).otherwise(o % 4 + 1).cast("long").alias("number"),
        F.when(area, F.col("o_orderpriority")).when(language, F.when(F.col("o_custkey") % 2 == 0, "inglês").otherwise("espanhol")).alias("value"),
        F.when(language, 3).cast("long").alias("to_number"),
        ((2 * o > F.col("most")) | (o % 13 == 0)).cast("int").alias("part"),
    )


@query(_GATE.format(lines=_LINES, late="false"))
def carried_headers(read):
    return S.headers_table(_lines(read))


@query(_GATE.format(lines=_LINES, late="coalesce(part = 1 AND pos <= reach, false)"))
def carried_headers_stream(read):
    return _two_runs(_lines(read), S.headers_stream)
