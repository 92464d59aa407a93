"""Queries of aggregates and of ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agg as A
from ..operators import window as W
from .q_text import _ALERTS, _BUCKET, _LINES, _bucketed
from .registry import query


@query("""
SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_final, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ROLLUP (o_orderpriority)
""")
def status_pivot(read):
    return A.with_total(read("orders"), "o_orderpriority", [F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_final"), F.round(F.sum("o_totalprice"), 2).alias("total")])


@query(f"SELECT o_orderstatus, bucket, grouping(o_orderstatus, bucket) AS level, count(*) AS n FROM (SELECT *, {_BUCKET} AS bucket FROM (SELECT *, {_ALERTS} AS a FROM orders)) GROUP BY CUBE (o_orderstatus, bucket)")
def grouping_sets_status(read):
    return A.cross_totals(_bucketed(read), "o_orderstatus", "bucket")


@query("""
SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS n_returned, count(DISTINCT l_orderkey) AS n_orders, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY l_suppkey
""")
def usage_stats(read):
    return read("lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.countDistinct("l_orderkey").alias("n_orders"), F.round(F.avg("l_quantity"), 6).alias("mean_quantity"))


@query("SELECT n_regionkey, n_nationkey, n_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4")
def group_ordinals(read):
    c, n = read("customer"), read("nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_nationkey", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT n_nationkey, '[' || string_agg('{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}', ',' ORDER BY c_custkey) || ']' AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey
""")
def json_snapshot(read):
    c = read("customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return A.nested(c, ["n_nationkey"], "customers", ["c_name", "c_mktsegment"], ["c_custkey"])


@query("""
SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM documents) AS n_documents, (SELECT count(DISTINCT user_id) FROM events) AS n_users
""")
def scalar_totals(read):
    one = lambda t, c: read(t).agg(c)
    n = F.count(F.lit(1))
    return one("orders", n.alias("n_orders")).crossJoin(one("customer", n.alias("n_customers"))).crossJoin(one("documents", n.alias("n_documents"))).crossJoin(one("events", F.countDistinct("user_id").alias("n_users")))


@query("""
SELECT round(avg((toxic = 0 AND quality = 1)::INT), 6) AS clean, round(avg((quality = (n_chars % 2))::INT), 6) AS guess, count(*) AS n FROM labels JOIN documents USING (doc_id)
""")
def gold_accuracy(read):
    j = read("labels").join(read("documents"), "doc_id").withColumn("good", ((F.col("toxic") == 0) & (F.col("quality") == 1)).cast("int")).withColumn("one", F.lit(1)).withColumn("g", F.col("n_chars") % 2)
    a = A.accuracy(j, {"clean": ("good", "one"), "guess": ("quality", "g")})
    return a.select(F.round("clean", 6).alias("clean"), F.round("guess", 6).alias("guess"), "n")


@query("""
SELECT source, count(*) AS covered, count(*) FILTER (quality <> toxic) AS agreed, coalesce(string_agg(doc_id, ',' ORDER BY doc_id) FILTER (quality = toxic), '') AS differs FROM documents JOIN labels USING (doc_id) GROUP BY source
""")
def agreement(read):
    j = read("documents").join(read("labels"), "doc_id")
    same = F.col("quality") != F.col("toxic")
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("covered"), F.count_if(same).alias("agreed"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~same, F.col("doc_id")))), lambda x: x.cast("string")), ",").alias("differs"))


@query("""
SELECT l_suppkey, l_returnflag, w, round(share, 6) AS share FROM (SELECT *, w / sum(w) OVER (PARTITION BY l_suppkey) AS share FROM (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS w FROM lineitem GROUP BY l_suppkey, l_returnflag)) WHERE share >= 0.3
""")
def majority_vote(read):
    return A.majority(read("lineitem"), ["l_suppkey"], "l_returnflag", "l_quantity", 0.3).select("l_suppkey", "l_returnflag", "w", F.round("share", 6).alias("share"))


@query("""
WITH g AS (SELECT o_custkey, min(o_orderkey % 40) AS lo, max(o_orderkey % 40) AS hi, list(DISTINCT o_orderkey % 40) AS s FROM orders GROUP BY o_custkey)
SELECT o_custkey, lo, hi, array_to_string(list_filter(range(lo, hi + 1), lambda x: NOT list_contains(s, x)), ',') AS missing FROM g
""")
def missing_numbers(read):
    m = A.missing_numbers(read("orders").select("o_custkey", (F.col("o_orderkey") % 40).alias("k")), "o_custkey", "k")
    return m.select("o_custkey", "lo", "hi", F.array_join(F.transform("missing", lambda x: x.cast("string")), ",").alias("missing"))


@query("""
SELECT l_orderkey, arg_max(q, (n, -q)) AS most, max(n) AS n FROM (SELECT l_orderkey, (l_quantity::BIGINT) // 10 AS q, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_orderkey
""")
def mode_gap(read):
    q = read("lineitem").select("l_orderkey", F.floor(F.col("l_quantity") / 10).alias("most"))
    return A.most_frequent(q, ["l_orderkey"], "most")


@query("""
SELECT l_suppkey, s[len(s) // 4 + 1] AS low_quarter, s[len(s) // 2 + 1] AS middle FROM (SELECT l_suppkey, list_sort(list(l_quantity)) AS s FROM lineitem GROUP BY l_suppkey)
""")
def index_quantiles(read):
    g = read("lineitem").groupBy("l_suppkey").agg(F.collect_list("l_quantity").alias("v"))
    return g.select("l_suppkey", A.at_index(F.col("v"), 0.25).alias("low_quarter"), A.at_index(F.col("v"), 0.5).alias("middle"))


@query("SELECT regexp_replace(url, '[0-9]+', 'N', 'g')[1:24] AS template, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, template LIMIT 12")
def template_topk(read):
    return A.top_templates(read("pages"), F.col("url"), 24, 12)


@query("""
SELECT event_type, round(done / nullif(hours, 0), 6) AS pace, round((n - done) / nullif(done / nullif(hours, 0), 0), 6) AS hours_left, round(tok / nullif(done, 0), 6) AS tokens_each, round(tok * 0.25, 4) AS cost FROM (
  SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS done, date_diff('second', min(ts), max(ts)) / 3600.0 AS hours, round(sum(value), 4) AS tok FROM events GROUP BY event_type)
""")
def cost_eta(read):
    g = read("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("done"), (F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")) / 3600.0).alias("hours"), F.round(F.sum("value"), 4).alias("tok"))
    e = A.estimate_remaining(F.col("done"), F.col("n"), F.col("hours"), F.col("tok"), F.lit(0.25))
    return g.select("event_type", *(F.round(e[k], 4 if k == "cost" else 6).alias(k) for k in ("pace", "hours_left", "tokens_each", "cost")))


@query("SELECT c_custkey, 'P' || lpad(row_number() OVER (ORDER BY c_mktsegment <> 'BUILDING', c_name, c_custkey)::VARCHAR, 6, '0') AS id FROM customer")
def row_ids(read):
    c = read("customer").withColumn("other", F.col("c_mktsegment") != "BUILDING")
    return W.numbered(c, ["other", "c_name", "c_custkey"], "P", 6, "id").select("c_custkey", "id")


@query("""
SELECT o_custkey, min(d) AS lo, max(d) AS hi, count(*) AS n FROM (SELECT o_custkey, d, d - row_number() OVER (PARTITION BY o_custkey ORDER BY d) AS g FROM (SELECT DISTINCT o_custkey, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) // 30 AS d FROM orders)) GROUP BY o_custkey, g
""")
def islands(read):
    o = read("orders").select("o_custkey", F.floor(F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")) / 30).alias("d"))
    return W.islands(o, ["o_custkey"], "d")


@query("SELECT conv_id, turn, (sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS block FROM conversations")
def blocks(read):
    return W.blocks(read("conversations"), ["conv_id"], ["turn"], F.col("role") == "user").select("conv_id", "turn", "block")


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, second FROM (SELECT *, row_number() OVER w AS r, lead(l_extendedprice) OVER w AS second FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber)) WHERE r = 1 AND (second IS NULL OR l_extendedprice >= 1.6 * second)
""")
def margin_top2(read):
    return W.clear_best(read("lineitem"), ["l_orderkey"], "l_extendedprice", "l_linenumber", 1.6).select("l_orderkey", "l_linenumber", "l_extendedprice", "second")


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_partkey % 4 <> 0 THEN l_linenumber END AS v FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)),
b AS (SELECT *, lag(v) OVER w AS p, lead(v) OVER w AS n FROM a WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)),
c AS (SELECT *, coalesce(v, CASE WHEN n = p + 2 THEN p + 1 WHEN n IS NULL AND p IS NOT NULL THEN p + 1 WHEN p IS NULL AND n IS NOT NULL THEN n - 1 END) AS v1 FROM b),
d AS (SELECT *, lag(v1) OVER w AS p1, lead(v1) OVER w AS n1 FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT l_orderkey, l_linenumber, coalesce(v1, CASE WHEN n1 = p1 + 2 THEN p1 + 1 WHEN n1 IS NULL AND p1 IS NOT NULL THEN p1 + 1 WHEN p1 IS NULL AND n1 IS NOT NULL THEN n1 - 1 END) AS filled FROM d
""")
def neighbor_impute(read):
    one = read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("s"))
    v = one.select("l_orderkey", "l_linenumber", F.when(F.col("s.l_partkey") % 4 != 0, F.col("l_linenumber")).alias("v"))
    return W.impute_between(v, ["l_orderkey"], ["l_linenumber"], "v", "filled").select("l_orderkey", "l_linenumber", "filled")


@query("SELECT event_id FROM events QUALIFY count(*) OVER (PARTITION BY user_id, event_type, ts::DATE) = 1")
def dup_numbers(read):
    return W.once_only(read("events").withColumn("day", F.col("ts").cast("date")), ["user_id", "event_type", "day"]).select("event_id")


@query("""
WITH RECURSIVE n AS (SELECT l_orderkey, l_linenumber AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber) AS i FROM lineitem),
r AS (SELECT l_orderkey, i, x AS last, x::VARCHAR AS chain FROM n WHERE i = 1
  UNION ALL SELECT r.l_orderkey, n.i, CASE WHEN x - last IN (1, 2) THEN x ELSE last END, CASE WHEN x - last IN (1, 2) THEN chain || ',' || x ELSE chain END FROM r JOIN n ON n.l_orderkey = r.l_orderkey AND n.i = r.i + 1)
SELECT l_orderkey, arg_max(chain, i) AS chain FROM r GROUP BY l_orderkey
""")
def increasing_chain(read):
    c = read("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber"))).alias("s"))
    n = F.transform("s", lambda x: x["l_linenumber"])
    return c.select("l_orderkey", F.array_join(F.transform(W.increasing(n), lambda x: x.cast("string")), ",").alias("chain"))


_SPANS = "iv AS (SELECT doc_id // 25 AS page, (doc_id * 37 % 1000)::BIGINT AS lo, (doc_id * 37 % 1000 + n_chars % 30)::BIGINT AS hi FROM documents)"


def _spans(read):
    lo = F.col("doc_id") * 37 % 1000
    return read("documents").select(F.floor(F.col("doc_id") / 25).alias("page"), lo.alias("lo"), (lo + F.col("n_chars") % 30).alias("hi"))


@query(f"""
WITH {_SPANS}, m AS (SELECT *, max(hi) OVER (PARTITION BY page ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM iv), g AS (SELECT *, sum((r IS NULL OR lo > r + 5)::INT) OVER (PARTITION BY page ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT page, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM g GROUP BY page, g
""")
def interval_coalesce(read):
    return W.coalesce_intervals(_spans(read), ["page"], "lo", "hi", 5)


@query(f"WITH {_SPANS}, m AS (SELECT *, max(hi) OVER (PARTITION BY page ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM iv) SELECT page, r AS gap_lo, lo AS gap_hi FROM m WHERE r < lo")
def interval_gaps(read):
    return W.gaps(_spans(read), ["page"], "lo", "hi")


@query("""
WITH a AS (SELECT user_id, event_type, value > 50 AS high, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, event_id FROM events),
b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY k) AS run FROM (SELECT *, (lag(high) OVER (PARTITION BY user_id ORDER BY k) IS DISTINCT FROM high)::INT AS c FROM a))
SELECT user_id, run::BIGINT AS run, high, string_agg(event_type, ' ' ORDER BY k) AS text, count(*) AS n FROM b GROUP BY ALL
""")
def style_runs(read):
    e = read("events").withColumn("high", F.col("value") > 50)
    return W.runs(e, ["user_id"], ["ts", "event_id"], ["high"], "event_type")


@query(f"""
WITH {_LINES}, s AS (SELECT doc_id, line_no, line, (lag(line) OVER w IS NULL OR trim(lag(line) OVER w) = '' OR (length(lag(line) OVER w) < 60 AND regexp_matches(lag(line) OVER w, '[.!?:]\\s*$')))::INT AS st FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
p AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY line_no) AS paragraph FROM s)
SELECT doc_id, paragraph::BIGINT AS paragraph, string_agg(trim(line), ' ' ORDER BY line_no) AS text, count(*) AS n_lines FROM p WHERE trim(line) <> '' GROUP BY doc_id, paragraph
""")
def paragraphs(read):
    from ..operators.quality import lines

    return W.paragraphs(lines(read("documents")), ["doc_id"], "line_no", "line", 100).select("doc_id", "paragraph", "text", "n_lines")


@query()
def longest_chain(read):
    o = read("lineitem").select((F.col("l_orderkey") % 500).alias("doc"), F.col("l_returnflag").alias("style"), (F.col("l_partkey") % 60).alias("number"), F.col("l_linenumber").alias("page"))
    return W.longest_chain(o, "doc", "style", "number", "page")


@query("""
WITH RECURSIVE d AS (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber % 4 + 1 AS n FROM lineitem), o AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, n) AS i FROM d),
r AS (SELECT l_suppkey, l_orderkey, n, i, n <= 2 AS accepted, (CASE WHEN n <= 2 THEN n + 1 ELSE 1 END)::INT AS e FROM o WHERE i = 1
  UNION ALL SELECT r.l_suppkey, o.l_orderkey, o.n, o.i, o.n IN (e, e + 1, 1), CASE WHEN o.n IN (e, e + 1, 1) THEN o.n + 1 ELSE e END FROM r JOIN o ON o.l_suppkey = r.l_suppkey AND o.i = r.i + 1)
SELECT l_suppkey, l_orderkey, n, accepted FROM r
""")
def expected_next(read):
    return W.expected_next(read("lineitem").select("l_suppkey", "l_orderkey", (F.col("l_linenumber") % 4 + 1).alias("n")).distinct().withColumn("o", F.struct("l_orderkey", "n")), "l_suppkey", "o", "n").drop("o")


@query("""
SELECT user_id, count(*) AS n, max(line)::BIGINT AS n_lines FROM (SELECT user_id, sum(c) OVER (PARTITION BY user_id ORDER BY value) AS line FROM (SELECT user_id, value, coalesce(value - lag(value) OVER (PARTITION BY user_id ORDER BY value) > 2, true)::INT AS c FROM events)) GROUP BY user_id
""")
def tolerance_lines(read):
    return W.lines_by_tolerance(read("events"), ["user_id"], "value", 2.0).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("n_lines"))


@query("""
WITH m AS (SELECT s_nationkey, s_suppkey % 17 AS p, min(floor(s_acctbal / 3000)) AS v FROM supplier GROUP BY ALL), l AS (SELECT s_nationkey, p FROM m QUALIFY v = min(v) OVER (PARTITION BY s_nationkey)),
i AS (SELECT s_nationkey, min(p) AS lo, max(p) AS hi, count(*) AS n FROM (SELECT s_nationkey, p, p - row_number() OVER (PARTITION BY s_nationkey ORDER BY p) AS g FROM l) GROUP BY s_nationkey, g)
SELECT s_nationkey, arg_max((lo + hi) // 2, (n, -lo)) AS middle, max(n) AS run FROM i GROUP BY s_nationkey
""")
def lowest_run(read):
    s = read("supplier").groupBy("s_nationkey", (F.col("s_suppkey") % 17).alias("p")).agg(F.min(F.floor(F.col("s_acctbal") / 3000)).alias("v"))
    return W.middle_of_lowest(s, ["s_nationkey"], "p", "v")
