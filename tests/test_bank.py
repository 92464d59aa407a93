"""Questions ready to publish, base texts, trusted answer files and votes, on cases set by hand."""

from pyspark.sql import functions as F

from corpusmill.operators import bank as K


def test_ready_questions(spark):
    good = ("e", 1, "Choose.", ["a", "b", "c", "d"], False, False, [], "A", ["t1"])
    change = lambda i, **k: (good[0], i, *[k.get(n, v) for n, v in zip(("statement", "options", "discursive", "annulled", "alerts", "key", "base_ids"), good[2:], strict=True)])
    glued = "semespacosnenhunsentreaspalavras"
    rows = [
        good, good, change(2, options=["a", "b", "c"]), change(3, discursive=True), change(4, alerts=["x"]), change(5, key=None), change(6, key="", annulled=True), change(7, base_ids=["t1", "t2"]), change(8, statement=f"x {glued}"),
        change(9, statement=f"https://{glued}.br {{{{img:{glued}}}}} a@{glued}"), change(10, base_ids=None, alerts=None, discursive=None, statement=None), change(11, options=None), ("out", *good[1:]),
    ]
    q = spark.createDataFrame(rows, "exam string, id long, statement string, options array<string>, discursive boolean, annulled boolean, alerts array<string>, key string, base_ids array<string>")
    t = spark.createDataFrame([("e", "t1", []), ("e", "t2", ["bad"]), ("out", "t1", ["bad"]), ("f", "t1", ["bad"])], "exam string, id string, alerts array<string>")
    out = spark.createDataFrame([("out",), ("out",)], "exam string")
    assert sorted(r.id for r in K.ready_questions(q, t, out).collect()) == [1, 1, 6, 9, 10]


def test_base_text(spark):
    q = spark.createDataFrame([("d", 1, "en", None), ("d", 1, "en", None), ("d", 2, None, "own"), ("d", 2, "es", None), ("d", 9, "en", "own"), ("d", 9, "en", None), ("x", 1, None, None)], "doc string, number int, language string, base_ref string")
    r = spark.createDataFrame([("d", "a", 1, 3, None, 1), ("d", "b", 1, 1, "en", 2), ("d", "c", 2, 2, "es", 3), ("d", "z", 1, 1, "es", 4)], "doc string, id string, lo int, hi int, language string, ord int")
    got = sorted(((x.number, x.language, x.base_ref, x.base) for x in K.base_text(q, r).collect()), key=str)
    assert got == sorted([(1, "en", None, "b"), (1, "en", None, "b"), (2, None, "own", "a"), (2, "es", None, "c"), (9, "en", "own", "own"), (9, "en", None, None), (1, None, None, None)], key=str)


def test_trusted_chains(spark):
    rows = [([1, 2, 4, 3, 5], True, [1, 2, 4, 5]), ([1, 2, 9, 3], True, []), ([1, 2, 9, 3], False, [1, 2, 3]), ([], True, []), ([5], False, [5]), (None, True, None)]
    df = spark.createDataFrame([r[:2] for r in rows], "n array<int>, named boolean")
    assert [r.c for r in df.select(K.trusted_chain(F.col("n"), F.col("named")).alias("c")).collect()] == [r[2] for r in rows]


def test_votes_with_a_prior(spark):
    v = spark.createDataFrame([("f", 1, "a", 30.0), ("f", 1, "b", 5.0), ("f", 2, "b", 10.0), ("f", 3, "c", 79.0), ("f", 3, "d", 21.0), ("f", 4, "x", 1.0), ("f", 4, "w", 1.0)], "font string, cid int, ch string, n double")
    p = spark.createDataFrame([("f", 1, "b"), ("f", 5, "q")], "font string, cid int, ch string")
    got = {r.cid: (r.ch, r.weight, r.kept) for r in K.voted(v, p, ["font", "cid"], "ch", "n").collect()}
    assert got == {1: ("b", 105.0, False), 2: ("b", 10.0, True), 3: ("c", 79.0, False), 4: ("w", 1.0, False), 5: ("q", 100.0, True)}
