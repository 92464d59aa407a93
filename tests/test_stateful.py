"""Keyed state that goes on from a checkpoint, against one run over all rows."""

from uuid import uuid4

from pyspark.sql import functions as F

from corpusmill.streaming import stateful as S

LINE = "doc string, pos long, kind string, number long, value string, to_number long, part int"


def in_parts(spark, rows, over, parts):
    base = f"/tmp/corpusmill-checkpoints/test-{uuid4().hex}"
    for k in range(parts):
        rows.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{base}/in")
        out = over(spark.readStream.schema(rows.drop("part").schema).parquet(f"{base}/in"))
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def test_numbers_stay_over_three_runs(spark):
    rows = spark.createDataFrame([("a", "y", 0), ("a", "x", 0), ("b", "x", 0), ("a", None, 0), ("a", "b", 1), ("a", "y", 1), (None, "q", 1), ("a", "a", 2), ("b", "x", 2), ("b", "z", 2)], "k string, i string, part int")
    got = in_parts(spark, rows, lambda s: S.numbered_stream(s, "k", "i", first=10), 3)
    last = {(r.key, r["item"]): r.number for r in got.collect()}
    assert last == {("a", "x"): 10, ("a", "y"): 11, ("a", "b"): 12, ("a", "a"): 13, ("b", "x"): 10, ("b", "z"): 11, (None, "q"): 10}
    assert {tuple(r) for r in S.numbered_table(rows, "k", "i", "part", first=10).collect()} == {(k, i, n) for (k, i), n in last.items()}
    assert got.where("is_new").count() == len(last)


def test_language_and_area_are_carried(spark):
    lines = [("area", None, "Human", None), ("header", 1, None, None), ("language", 2, "inglês", 3), ("header", 2, None, None), ("header", 9, None, None), ("header", 3, None, None), ("header", 2, None, None), ("area", None, "Exact", None), ("header", 3, None, None), ("header", 5, None, None), ("header", 4, None, None)]
    rows = spark.createDataFrame([("d", p, k, n, v, t, 0 if p < 4 else 1) for p, (k, n, v, t) in enumerate(lines)] + [("d", 2, "header", 7, None, None, 1), ("e", 0, "header", 2, None, None, 0)], LINE)
    got = {(r.doc, r.pos, r.number): (r.accepted, r.language, r.area, r.late) for r in in_parts(spark, rows, S.headers_stream, 2).collect()}
    want = {
        ("d", 1, 1): (True, None, "Human", False), ("d", 3, 2): (True, "inglês", "Human", False), ("d", 4, 9): (False, None, None, False), ("d", 5, 3): (True, "inglês", "Human", False),
        ("d", 6, 2): (True, "espanhol", "Human", False), ("d", 8, 3): (True, "espanhol", "Exact", False), ("d", 9, 5): (True, None, "Exact", False), ("d", 10, 4): (False, None, None, False),
        ("d", 2, 7): (False, None, None, True), ("e", 0, 2): (False, None, None, False),
    }
    assert got == want
    table = {(r.doc, r.pos, r.number): (r.accepted, r.language, r.area, r.late) for r in S.headers_table(rows.where("number is null or number <> 7")).collect()}
    assert table == {k: v for k, v in want.items() if k[2] != 7}


def test_documents_that_share_a_key_of_the_store_keep_their_own_state(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKETS", 2)
    docs = [f"d{k}" for k in range(9)] + [None, ""]
    rows = spark.createDataFrame([(d, p, "area" if p == 0 else "header", p or None, f"{d}" if p == 0 else None, None, p // 3) for d in docs for p in range(6)], LINE)
    got = sorted(map(repr, in_parts(spark, rows, S.headers_stream, 2).collect()))
    assert got == sorted(map(repr, S.headers_table(rows).collect())) and len(got) == 55
