"""Queries of revisions: documents against a version with lines taken out and put in, and options that slipped."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import revisions as V
from .registry import query


@query("""
WITH l AS (
  SELECT doc_id, i, i || ': ' || l[i + 1] AS p, (i + doc_id) % 7 = 0 AS gone, (i + doc_id) % 11 = 0 AS follows FROM (SELECT doc_id, l, unnest(range(0, len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
), n AS (
  SELECT doc_id, i, 0 AS s, p FROM l WHERE NOT gone UNION ALL SELECT doc_id, i, 1, 'new ' || i FROM l WHERE follows
), r AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i, s) - 1 AS new_pos FROM n
), d AS (
  SELECT doc_id FROM l GROUP BY doc_id HAVING bool_or(gone OR follows)
)
SELECT doc_id, 'removed' AS change, i AS old_pos, NULL AS new_pos, p AS paragraph FROM l WHERE gone
UNION ALL SELECT doc_id, CASE s WHEN 0 THEN 'kept' ELSE 'added' END, CASE s WHEN 0 THEN i END, new_pos, p FROM r JOIN d USING (doc_id)
""")
def paragraph_diff(read):
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), F.concat(i.cast("string"), F.lit(": "), x).alias("p")))
    d = read("documents").select("doc_id", lines.alias("l"))
    new = F.flatten(F.transform("l", lambda x: F.concat(F.when((x["i"] + F.col("doc_id")) % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(x["p"])), F.when((x["i"] + F.col("doc_id")) % 11 == 0, F.array(F.concat(F.lit("new "), x["i"].cast("string")))).otherwise(F.array().cast("array<string>")))))
    both = d.select("doc_id", F.array_join(F.transform("l", lambda x: x["p"]), "\n").alias("old"), F.array_join(new, "\n").alias("new"), F.size(new).alias("n"))
    return V.paragraph_diff(both.select("doc_id", F.col("old").alias("text")), both.select("doc_id", F.when(F.col("n") > 0, F.col("new")).alias("text")), "doc_id", "text", "\n")


@query("""
WITH d AS (SELECT doc_id, doc_id % 3 AS kind, 'doc ' || doc_id AS head FROM documents), o AS (SELECT *, list_transform(['A', 'B', 'C', 'D', 'E'], lambda x: 'The value ' || x || ' of ' || doc_id || ' is given right here.') AS "right" FROM d)
SELECT doc_id, ['same', 'realigned', 'no place'][kind + 1] AS outcome, head || chr(10) || chr(10) || 'Choose one.' || CASE kind WHEN 2 THEN ' The' ELSE '' END AS statement,
  array_to_string(CASE kind WHEN 2 THEN list_transform(range(1, 6), lambda i: substr("right"[i], 5) || CASE WHEN i < 5 THEN ' The' ELSE '' END) ELSE "right" END, '|') AS options FROM o
""")
def realigned_options(read):
    kind, doc = F.col("doc_id") % 3, F.col("doc_id").cast("string")
    right = F.array(*(F.concat(F.lit(f"The value {x} of "), doc, F.lit(" is given right here.")) for x in V.LETTERS))
    slipped = F.transform(right, lambda o, i: F.concat(F.substring(o, F.lit(5), F.length(o)), F.when(i < 4, " The").otherwise("")))
    statement = F.concat(F.lit("doc "), doc, F.lit("\n\nChoose one."), F.when(kind == 0, "").otherwise(" The"))
    q = read("documents").select("doc_id", F.col("doc_id").alias("src"), statement.alias("statement"), F.when(kind == 0, right).otherwise(slipped).alias("options"))
    lines = F.transform(right, lambda o, i: F.when((kind == 2) & (i == 2), "").otherwise(F.concat(F.element_at(F.array(*(F.lit(x) for x in V.LETTERS)), i + 1), F.lit("     "), o)))
    pages = read("documents").select(F.col("doc_id").alias("src"), F.array_join(lines, "\n").alias("text"))
    r = V.realigned(q, V.option_openings(pages, "src", "text"), "doc_id", "src")
    return r.select("doc_id", "outcome", "statement", F.array_join("options", "|").alias("options"))
