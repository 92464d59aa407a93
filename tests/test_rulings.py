"""Rules, tables, underlines and glyphs against plain loops and cases set by hand."""

import math
import random

from pyspark.sql import functions as F

from corpusmill.operators import rulings as R

PIECE = "page int, x0 double, top double, x1 double, bottom double"
THING = "page int, id long, x0 double, x1 double, top double, bottom double"


def test_pieces_are_stitched(spark):
    rows = [(1, 0.0, 10.0, 50.0, 11.0), (1, 52.0, 10.6, 90.0, 11.6), (1, 100.0, 10.0, 120.0, 11.0), (1, 0.0, 14.0, 50.0, 15.0), (1, 5.0, 0.0, 6.0, 40.0), (1, 0.0, 0.0, 30.0, 30.0), (2, 0.0, 10.0, 50.0, 11.0)]
    got = sorted((r.page, r.vertical, round(r["at"], 2), r.lo, r.hi) for r in R.stitched(spark.createDataFrame(rows, PIECE), ["page"]).collect())
    assert got == [(1, False, 10.7, 0.0, 90.0), (1, False, 10.7, 100.0, 120.0), (1, False, 14.5, 0.0, 50.0), (1, True, 5.5, 0.0, 40.0), (2, False, 10.5, 0.0, 50.0)]


def grid(page, xs, ys, skip=()):
    """Rules of a grid, each side of a cell a piece of its own."""
    out = []
    for y in ys:
        out += [(page, a, y - 0.5, b, y + 0.5) for a, b in zip(xs, xs[1:], strict=False) if ("h", a, y) not in skip]
    for x in xs:
        out += [(page, x - 0.5, a, x + 0.5, b) for a, b in zip(ys, ys[1:], strict=False) if ("v", x, a) not in skip]
    return out


def test_tables_and_what_they_fail(spark):
    xs, ys = [0.0, 100.0, 200.0], [0.0, 20.0, 40.0, 60.0]
    word = lambda page, k, x, y, t, wide=20: (page, k, x, x + wide, y, y + 8.0, t)
    box = lambda page, b=62.0: (page, 0, -1.0, -1.0, 202.0, b)
    pieces = grid(1, xs, ys) + grid(2, xs, ys, {("h", 100.0, 20.0)}) + grid(3, xs, ys) + grid(4, xs, ys) + grid(5, xs, ys) + grid(6, xs, [0.0, 20.0]) + grid(8, xs, ys) + grid(9, xs, ys) + [(7, 0.0, 0.0, 50.0, 1.0)]
    words = [word(1, 1, 10.0, 5.0, "a"), word(1, 2, 40.0, 5.0, "b"), word(1, 3, 110.0, 25.0, "c"), word(1, 5, 40.0, 44.0, "e"), word(1, 4, 10.0, 45.0, "d"), word(3, 1, 10.0, 63.0, "below"), word(4, 1, 90.0, 5.0, "over"), word(8, 1, 10.0, 25.0, "x" * 121), word(9, 1, 5.0, 5.0, "h"), word(9, 2, 105.0, 5.0, "i"), word(9, 3, 10.0, 25.0, "x" * 121)]
    regions = [box(1), box(2), box(3, 70.0), box(4), box(5, 300.0), box(6, 22.0), box(7), box(8), box(9), box(10)]
    images = [(1, 300.0, 300.0, 310.0, 310.0)]
    args = (spark.createDataFrame(regions, "page int, region int, x0 double, top double, x1 double, bottom double"), spark.createDataFrame(pieces, PIECE), spark.createDataFrame(words, THING + ", text string"), ["page"])
    got = {r.page: r for r in R.tables(*args, spark.createDataFrame(images, PIECE)).withColumn("md", R.as_markdown(F.col("cells"))).collect()}
    assert {k: r.failed for k, r in got.items()} == {1: None, 2: "open cell", 3: "outside text", 4: "characters", 5: "small", 6: "one row or column", 7: "few rules", 8: "long cell", 9: None, 10: "few rules"}
    assert got[1].cells == [["a b", ""], ["", "c"], ["d e", ""]] and (got[1].n_rows, got[1].n_columns) == (3, 2)
    assert got[1].md == "| a b |  |\n|---|---|\n|  | c |\n| d e |  |"
    shown = R.tables(*args, spark.createDataFrame([(1, 10.0, 10.0, 30.0, 30.0)], PIECE))
    assert shown.where("page = 1").first().failed == "image"


def plain_underlined(words, rules):
    out = set()
    for o in rules:
        if o[5] - o[4] > 1.3 or o[3] - o[2] < 3:
            continue
        under = [w for w in words if w[4] < o[4] and o[4] - 2.5 <= w[5] <= o[4] + 2 and min(w[3], o[3]) - max(w[2], o[2]) > 0.8 * (w[3] - w[2])]
        if not under or any(o[4] - w[5] > 1.2 for w in under):
            continue
        if any(v[5] - v[4] > 4 and v[3] - v[2] < 2.5 and v[4] - 1.5 <= o[4] <= v[5] + 1.5 and (abs(v[2] - o[2]) < 2 or abs(v[3] - o[3]) < 2) for v in rules):
            continue
        line = min(under, key=lambda w: w[1])[4]
        if not any(abs(w[4] - line) < 1.5 and (w[3] < o[2] - 1 or w[2] > o[3] + 1) for w in words):
            continue
        low = [w for w in words if -1 <= w[4] - o[5] <= 6.5]
        if any(w[2] >= o[2] - 2 and w[3] <= o[3] + 2 for w in low) and not any(w[2] < o[2] - 1 < w[3] or w[2] < o[3] + 1 < w[3] for w in low):
            continue
        if o[3] - o[2] > 1.3 * (max(w[3] for w in under) - min(w[2] for w in under)) + 4:
            continue
        out |= {(o[0], w[1], o[1]) for w in under}
    return out


def test_underlines_against_plain_pages(spark):
    rng = random.Random(4)
    words, rules = [], []
    for page in range(25):
        k = 0
        for line in range(30):
            x, y = rng.uniform(0, 40), 20.0 + line * rng.choice([12.0, 14.0])
            while x < 300:
                wide = rng.uniform(10, 40)
                words.append((page, k, x, x + wide, y, y + 10))
                k += 1
                kind = rng.random()
                if kind < 0.15:
                    gap = rng.choice([-1.5, 0.4, 1.0, 2.0])
                    rules.append((page, len(rules), x - rng.choice([0, 1]), x + wide + rng.choice([0, 1, 30]), y + 10 + gap, y + 10 + gap + rng.choice([0.5, 2.0])))
                    if kind < 0.03:
                        rules.append((page, len(rules), x - 1, x, y, y + 40))
                x += wide + rng.choice([3, 60, 400])
    got = {(r.page, r.id, r.rule) for r in R.underlined(spark.createDataFrame(words, THING).repartition(3), spark.createDataFrame(rules, THING), ["page"]).collect()}
    want = set()
    for page in range(25):
        want |= plain_underlined([w for w in words if w[0] == page], [r for r in rules if r[0] == page])
    assert got == want and len(got) > 40


def test_rules_that_share_an_id_are_told_apart(spark):
    words = [(1, 1, 0.0, 20.0, 0.0, 10.0), (1, 2, 30.0, 50.0, 0.0, 10.0), (1, 3, 0.0, 20.0, 100.0, 110.0)]
    # the first underlines word 1; the second, of the same id, is under word 3, which stands alone in its line
    rules = [(1, 7, 0.0, 20.0, 10.5, 11.5), (1, 7, 0.0, 20.0, 110.5, 111.5)]
    got = R.underlined(spark.createDataFrame(words, THING), spark.createDataFrame(rules, THING), ["page"]).collect()
    assert [(r.page, r.id, r.rule) for r in got] == [(1, 1, 7)]


def test_nearest_glyphs_against_all_pairs(spark):
    rng = random.Random(6)
    known = [(k, "".join(rng.choice("01") if 100 < i < 470 else "0" for i in range(576)), rng.choice([0.5, 1.0, 1.3, 2.0]), chr(65 + k % 26)) for k in range(60)]
    known += [(k + 60, known[k][1], known[k][2], "~") for k in range(5)]
    glyphs = []
    for g in range(150):
        bits, aspect = list(known[g % 60][1]), known[g % 60][2] * rng.choice([1.0, 1.2, 1.5])
        for i in rng.sample(range(576), rng.choice([0, 1, 30, 57, 58, 90])):
            bits[i] = "10"[int(bits[i])]
        glyphs.append((g, "".join(bits), aspect))
    want = {}
    for g, bits, aspect in glyphs:
        near = [(sum(x != y for x, y in zip(bits, b, strict=True)), k, c) for k, b, a, c in known if abs(math.log(aspect / a)) <= 0.35]
        d, k, c = min(near, default=(999, None, None))
        want[g] = (k, c, d) if d <= R.MOST else (None, None, None)
    got = R.nearest_glyphs(spark.createDataFrame(glyphs, "id long, bits string, aspect double"), spark.createDataFrame(known, "id long, bits string, aspect double, char string"))
    assert {r.id: (r.known, r.char, r.distance) for r in got.collect()} == want
    assert sum(v[0] is None for v in want.values()) > 20 and sum(v[2] == 57 for v in want.values()) > 5
