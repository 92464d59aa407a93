"""Paragraph diffs and realigned options against plain loops and cases set by hand."""

import random

import numpy as np

from corpusmill.operators import revisions as V


def plain_length(a, b):
    n = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            n[i + 1][j + 1] = n[i][j] + 1 if a[i] == b[j] else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_common_subsequences_are_longest():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.choices("abcd" if rng.random() < 0.5 else "abcdefghijkl", k=rng.randrange(0, 25)) for _ in range(2))
        if rng.random() < 0.3:
            b = a[:5] + b + a[-4:]
        same = V.common_subsequence(a, b)
        assert all(a[i] == b[j] for i, j in same) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(same, same[1:], strict=False))
        assert len(same) == plain_length(a, b)
    long = [str(k) for k in range(3000)]
    assert len(V.common_subsequence(long, long[::-1])) == 1 and len(V.common_subsequence(long, long[500:] + long[:500])) == 2500


def test_paragraph_diff(spark):
    old = spark.createDataFrame([(1, "a\n\nb\n\nc"), (2, "same"), (3, "gone"), (4, None), (5, "x\n\nx\n\nx"), (6, "")], "id long, text string")
    new = spark.createDataFrame([(1, "a\n\nB\n\nc\n\nd"), (2, "same"), (4, "now"), (5, "x\n\nx"), (6, None), (7, "new")], "id long, text string")
    got = sorted((tuple(r) for r in V.paragraph_diff(old, new, "id", "text").collect()), key=str)
    assert got == sorted([
        (1, "kept", 0, 0, "a"), (1, "removed", 1, None, "b"), (1, "added", None, 1, "B"), (1, "kept", 2, 2, "c"), (1, "added", None, 3, "d"), (3, "removed", 0, None, "gone"), (4, "added", None, 0, "now"),
        (5, "kept", 0, 0, "x"), (5, "kept", 1, 1, "x"), (5, "removed", 2, None, "x"), (6, "removed", 0, None, ""), (7, "added", None, 0, "new"),
    ], key=str)
    assert V.paragraph_diff(old.limit(0), new.limit(0), "id", "text").count() == 0


TEXTS = ["the first option ends here.", "a second one, with H<sub>2</sub>O inside.", "the third of *them* is long enough.", "number four says something else.", "and the last one closes the list."]


def test_options_are_realigned(spark):
    page = "Some statement  \n" + "\n".join(f"{letter}     {t.replace('<sub>', '').replace('</sub>', '')}" for letter, t in zip("ABCDE", TEXTS, strict=True))
    slipped = ["first option ends here. a second", "one, with H<sub>2</sub>O inside. the third of *them*", "is long enough.", "number four says something else. and the", "last one closes the list."]
    cases = [
        (1, "p", "Intro.\n\nChoose well: the", slipped), (2, "p", "Intro.\n\nChoose well:", TEXTS), (3, "q", "x", TEXTS), (4, "p", "x", TEXTS[:4]), (5, "p", "x", TEXTS[:4] + ["{{img:1}}"]),
        (6, "p", "x the", [*slipped[:3], "number four says something else. and", "the last one closes the list -"]), (7, "p", None, [None] * 5), (8, "p", "the", slipped),
    ]
    q = spark.createDataFrame(cases, "id long, src string, statement string, options array<string>")
    openings = V.option_openings(spark.createDataFrame([("p", page), ("r", None)], "src string, text string"), "src", "text")
    got = {r.id: r for r in V.realigned(q, openings, "id", "src").collect()}
    assert {k: r.outcome for k, r in got.items()} == {1: "realigned", 2: "same", 3: "no place", 4: "skipped", 5: "skipped", 6: "cut off", 7: "no place", 8: "realigned"}
    assert got[1].options == TEXTS and got[1].statement == "Intro.\n\nChoose well:" and got[8].options == TEXTS and got[8].statement == ""
    assert got[6].statement == "x the" and got[2].options == TEXTS


def test_normal_form_keeps_places(spark):
    texts = ["a<sub>2</sub> b*c", "É-x", "", "<sup>q</sup>9"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(V.normal_form(V.F.col("t")).alias("n"), "t").collect()
    for r in got:
        assert "".join(r.t[p - 1] for p in r.n.places) == r.n.text
    assert [r.n.text for r in got] == ["a2bc", "Éx", "", "q9"]
