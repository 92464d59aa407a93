"""Steps whose work must grow with the rows: told by their plans, or by what they leave out."""

from corpusmill.operators import answer_keys as K
from corpusmill.operators import dedup, layout, link
from corpusmill.operators import revisions as V
from corpusmill.operators import rulings as R


def plan(df, which="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_postings_are_shuffled_once(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k % 3}x{i}" for i in range(60))) for k in range(9)] + [(8, "a b"), (None, "c " * 40)], "doc_id long, text string")
    sk = dedup.cut(dedup.sketches(docs))
    pairs = dedup.candidate_pairs(sk)
    assert {(r.a, r.b) for r in pairs.collect()} == {(a, b) for a in range(9) for b in range(a + 3, 9, 3)}
    assert plan(dedup.candidate_pairs(sk), "sparkPlan").count("RepartitionByExpression") <= 1
    assert spark.sql("select 1") is not None and plan(pairs, "executedPlan").split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 2


def test_tiers_are_told_before_rows_meet(spark):
    a = spark.createDataFrame([(k, "g", str(k % 3), None) for k in range(30)], "id long, k string, x string, y string")
    b = spark.createDataFrame([(k, "g", str(k % 4), "1") for k in range(20)], "id long, k string, x string, y string")
    got = link.compatible(a, b, ["k"], ["x", "y"], ["x"])
    want = {(i, j, 1) for i in range(30) for j in range(20) if i % 3 == j % 4}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    top = next(line for line in plan(got).splitlines() if "Join" in line)
    assert "a_id#" not in top  # pairs are the last step's rows; they do not meet a table of their least tiers


def test_only_candidates_are_taken_apart(spark):
    texts = spark.createDataFrame([(k, [f"w{k}", "a", "b", "c"]) for k in range(20)], "id long, words array<string>")
    found = spark.createDataFrame([(1, 2, 3)], "old_id long, new_id long, shared long")
    m = link.scored_matches(texts, texts, found)
    assert [(r.old_id, r.new_id, r.similarity) for r in m.collect()] == [(1, 2, 1 / 3)]
    assert plan(m).count("LeftSemi") == 2


def test_paragraphs_in_order_need_no_table(monkeypatch):
    monkeypatch.setattr(V, "_lengths", lambda x, y: 1 / 0)
    a = [f"{k}: text" for k in range(2000)]
    b = [p for k, p in enumerate(a) if k % 7] + ["end"]
    b.insert(500, "new")
    same = V.common_subsequence(a, b)
    assert len(same) == len(b) - 2 and all(a[i] == b[j] for i, j in same)


def test_boxes_are_shuffled_by_page_alone(spark, monkeypatch):
    """No box is listed by cell or met by a join; ids that repeat join what lies on other pages, as before."""
    edges, whole = [], layout.components
    monkeypatch.setattr(layout, "components", lambda e: edges.append((plan(e), e.count())) or whole(e))
    rows = [(p, p * 100 + k, 5 * k, 0, 5 * k + 4, 4) for p in range(3) for k in range(10)] + [(1, 5, 900, 900, 905, 905), (2, None, 0, 0, 1, 1), (2, 250, None, 0, 1, 1)]
    b = spark.createDataFrame(rows, "page long, id long, x0 long, top long, x1 long, bottom long")
    got = {tuple(r) for r in layout.merge_boxes(b, ["page"]).collect()}
    assert got == {(p, 100 * p, 0, 0, 49, 4, 10) for p in range(3)} | {(1, 0, 900, 900, 905, 905, 1), (2, None, 0, 0, 1, 1, 1), (2, 250, None, 0, 1, 1, 1)}
    assert len(edges) == 1 and edges[0][1] == 27 and "Join" not in edges[0][0]


def test_readings_are_made_once(spark):
    """No filter makes the readings of a file again, and a text is scanned for loose pairs as a whole."""
    exams = spark.createDataFrame([(1, None, "a.pdf", None)], "exam long, booklet string, file string, cover string")
    text = "Gabarito\n1 A  2 B\n\n3\nC 4 D\n12 A E\nx5 B, 6 C"
    files = spark.createDataFrame([(1, 1, 1, "Gabarito.pdf", text, False, None)], "exam long, source long, ord long, file string, text string, solution boolean, flow string")
    keys = K.resolved_keys(exams, files)
    assert sorted((r.number, r.language or "", r.answer) for r in keys.collect()) == [(1, "", "A"), (2, "", "B"), (4, "", "D"), (6, "", "C"), (12, "espanhol", "E"), (12, "inglês", "A")]
    assert "Generate explode(found" in plan(keys) and "Filter (size(" not in plan(keys)


def test_rules_are_made_once_and_parts_grow_with_regions(spark, monkeypatch):
    made, whole = [], R.cut
    monkeypatch.setattr(R, "cut", lambda df: made.append(plan(df)) or whole(df))
    monkeypatch.setattr(R, "REGIONS", 2)
    rows = [(k, 0.0, 20.0 * i - 0.5, 200.0, 20.0 * i + 0.5) for k in range(60) for i in range(3)] + [(k, 100.0 * i - 0.5, 0.0, 100.0 * i + 0.5, 40.0) for k in range(60) for i in range(3)]
    pieces = spark.createDataFrame(rows, "page int, x0 double, top double, x1 double, bottom double")
    assert "Join" not in plan(R.stitched(pieces, ["page"]))
    regions = spark.createDataFrame([(k, k, 0.0, 0.0, 200.0, 40.0) for k in range(60)], "page int, region int, x0 double, top double, x1 double, bottom double")
    words = spark.createDataFrame([(k, w, 10.0 + 100 * w, 30.0 + 100 * w, 5.0, 13.0, f"{k}.{w}") for k in range(60) for w in range(2)], "page int, id long, x0 double, x1 double, top double, bottom double, text string")
    t = R.tables(regions, pieces, words, ["page"])
    assert {r.region: r.cells for r in t.collect()} == {k: [[f"{k}.0", f"{k}.1"], ["", ""]] for k in range(60)}
    assert len(made) == 1 and "Window" in made[0] and "Window" not in plan(t)
    assert R.parts(regions, 2) == 31 and "RepartitionByExpression [page" in plan(t) and ", 31" in plan(t)
    assert R.parts(spark.range(402), 2) == 200
