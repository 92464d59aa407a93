"""Ruling lines and glyphs: pieces stitched to rules, rules to tables, words with a rule under them, and the nearest known glyph."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..lineage import cut
from .blocks import ROWS, every_two, in_blocks, nearest_by_bits, parts
from .window import coalesce_intervals, lines_by_tolerance

#: How far pieces of one rule may lie apart, across it and along it, and how far a rule may miss a crossing.
ACROSS, ALONG, MISS = 1.5, 3.0, 2.0
#: A thing this thin is a rule.
THIN = 2.5
#: Regions that one task takes.
REGIONS = 10_000


def stitched(pieces: DataFrame, key: list[str], across: float = ACROSS, along: float = ALONG) -> DataFrame:
    """(key, vertical, at, lo, hi): rules from pieces (key, x0, top, x1, bottom) that lie in one line and meet, or nearly.

    A piece thinner than THIN is a rule across its thin side; others are none. Pieces follow one another in a line as long as each
    is within ``across`` of the next one's place; the rule stands at their mean.
    """
    wide, tall = F.col("x1") - F.col("x0"), F.col("bottom") - F.col("top")
    flat, upright = (tall < THIN) & (wide > tall), (wide < THIN) & (tall > wide)
    p = pieces.where(flat | upright).select(*key, upright.alias("vertical"), F.when(upright, (F.col("x0") + F.col("x1")) / 2).otherwise((F.col("top") + F.col("bottom")) / 2).cast("double").alias("at"), F.when(upright, F.col("top")).otherwise(F.col("x0")).cast("double").alias("lo"), F.when(upright, F.col("bottom")).otherwise(F.col("x1")).cast("double").alias("hi"))
    line = [*key, "vertical", "line"]
    # the mean is taken in the order in which intervals are met, so that one sort serves both
    whole = Window.partitionBy(*line).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lined = lines_by_tolerance(p, [*key, "vertical"], "at", across).withColumn("at", F.avg("at").over(whole))
    return coalesce_intervals(lined, line, "lo", "hi", along, F.min("at").alias("at")).select(*key, "vertical", "at", "lo", "hi")


def _covers(rule: Column, lo: Column, hi: Column) -> Column:
    return F.exists(rule["spans"], lambda s: (s["lo"] <= lo + MISS) & (s["hi"] >= hi - MISS))


def tables(regions: DataFrame, pieces: DataFrame, words: DataFrame, page: list[str], images: DataFrame | None = None) -> DataFrame:
    """(page, region, failed, n_rows, n_columns, cells): the table that each region's rules make, or the test that it fails.

    ``regions``: page, region, x0, top, x1, bottom; ``pieces`` and ``words`` (with id and text) by page. Crossing rules make cells;
    a word belongs to the cell of its centre. Tests, in order: ``few rules`` (under 4), ``one row or column``, ``small`` (under 0.8
    of the region), ``open cell`` (a side that no rule covers), ``outside text``, ``characters`` (a word that leaves its cell, so
    that its characters would be lost), ``long cell`` (over 120 characters, unless the first row is short headings), ``image``.
    ``cells`` are the texts by row, null where a test fails. Regions do not overlap, or a word counts in each.

    All meets in parts whose number grows with the regions: by page where things meet regions, then by region to the end.
    """
    n, own = parts(regions, REGIONS), [*page, "region"]
    f = [F.col(c).cast("double").alias(f"f_{c}") for c in ("x0", "top", "x1", "bottom")]
    boxes = regions.select(*own, *f)
    r = boxes.repartition(n, *page)
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("top") + F.col("bottom")) / 2

    def within(slack: float) -> Column:
        return (cx >= F.col("f_x0") - slack) & (cx <= F.col("f_x1") + slack) & (cy >= F.col("f_top") - slack) & (cy <= F.col("f_bottom") + slack)

    met = pieces.select(*page, "x0", "top", "x1", "bottom").repartition(n, *page).join(r, page).where(within(2))
    rules = stitched(met.select(*own, "x0", "top", "x1", "bottom").repartition(n, *own), own)
    at = rules.groupBy(*own, "vertical", "at").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))

    def side(vertical: bool) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("vertical") == vertical, F.struct("at", "spans"))))

    g = boxes.repartition(n, *own).join(at.groupBy(*own).agg(side(False).alias("h"), side(True).alias("v")), own, "left")
    none = F.array().cast(at.select(F.array(F.struct("at", "spans"))).schema[0].dataType)
    g = g.withColumn("h", F.coalesce("h", none)).withColumn("v", F.coalesce("v", none))
    n_rows, n_columns = F.size("h") - 1, F.size("v") - 1
    pairs = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def closed(i: Column, j: Column) -> Column:
        x0, x1, y0, y1 = F.get("v", j - 1)["at"], F.get("v", j)["at"], F.get("h", i - 1)["at"], F.get("h", i)["at"]
        return _covers(F.get("h", i - 1), x0, x1) & _covers(F.get("h", i), x0, x1) & _covers(F.get("v", j - 1), y0, y1) & _covers(F.get("v", j), y0, y1)

    whole = F.forall(pairs(n_rows), lambda i: F.forall(pairs(n_columns), lambda j: closed(i, j)))
    first, last = lambda c: F.get(c, F.lit(0))["at"], lambda c: F.element_at(c, -1)["at"]
    area = (last("v") - first("v")) * (last("h") - first("h")) / ((F.col("f_x1") - F.col("f_x0")) * (F.col("f_bottom") - F.col("f_top")))
    shape = F.when(F.size("h") + F.size("v") < 4, "few rules").when((n_rows < 2) | (n_columns < 2), "one row or column").when(area < 0.8, "small").when(~whole, "open cell")
    g = g.withColumn("_shape", shape).withColumn("n_rows", n_rows).withColumn("n_columns", n_columns)
    g = cut(g.select(*boxes.columns, "h", "v", "_shape", "n_rows", "n_columns"))  # made once; no task holds rules and words
    w = words.select(*page, "id", "x0", "x1", "top", "bottom", "text").repartition(n, *page)
    w = w.join(g.where("_shape is null").repartition(n, *page), page).where(within(0))
    spot = lambda c, at: F.size(F.filter(c, lambda x: x["at"] <= at))
    w = w.withColumn("_i", spot("h", cy)).withColumn("_j", spot("v", cx))
    out = (cx < first("v") - 1) | (cx > last("v") + 1) | (cy < first("h") - 1) | (cy > last("h") + 1)
    i, j = F.least(F.greatest("_i", F.lit(1)), F.size("h") - 1), F.least(F.greatest("_j", F.lit(1)), F.size("v") - 1)
    w = w.withColumn("_out", out).withColumn("_i", i).withColumn("_j", j)
    fits = (F.col("x0") >= F.get("v", F.col("_j") - 1)["at"] - MISS) & (F.col("x1") <= F.get("v", F.col("_j"))["at"] + MISS) & (F.col("top") >= F.get("h", F.col("_i") - 1)["at"] - MISS) & (F.col("bottom") <= F.get("h", F.col("_i"))["at"] + MISS)
    w = w.select(*own, "id", "x0", "top", "text", "_i", "_j", "_out", fits.alias("_fits")).repartition(n, *own)
    cell = w.groupBy(*own, "_i", "_j").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.bround(F.col("top") / 3).alias("row"), "x0", "id", "text"))), lambda x: x["text"]), " ").alias("text"), F.bool_or("_out").alias("out"), F.bool_and("_fits").alias("fits"))
    filled = cell.groupBy(*own).agg(F.bool_or("out").alias("_out"), F.bool_and("fits").alias("_fits"), F.map_from_entries(F.collect_list(F.struct((F.col("_i") * 10_000 + F.col("_j")).alias("k"), "text"))).alias("texts"))
    g = g.select(*own, "_shape", "n_rows", "n_columns").repartition(n, *own).join(filled, own, "left")
    cells = F.transform(pairs(F.col("n_rows")), lambda i: F.transform(pairs(F.col("n_columns")), lambda j: F.coalesce(F.try_element_at("texts", i * 10_000 + j), F.lit(""))))
    g = g.withColumn("_cells", cells)
    short = F.forall(F.get("_cells", F.lit(0)), lambda c: F.length(c).between(1, 40))
    long = F.exists("_cells", lambda row: F.exists(row, lambda c: F.length(c) > 120)) & ~short
    failed = F.coalesce("_shape", F.when(F.col("_out"), "outside text").when(~F.col("_fits"), "characters").when(long, "long cell"))
    if images is not None:
        drawn = images.select(*page, "x0", "top", "x1", "bottom").repartition(n, *page).join(r, page).where(within(0)).select(*own).distinct().withColumn("_image", F.lit(True))
        g = g.join(drawn, own, "left")
        failed = F.coalesce(failed, F.when(F.col("_image"), "image"))
    return g.select(*own, failed.alias("failed"), "n_rows", "n_columns", F.when(failed.isNull(), F.col("_cells")).alias("cells"))


def as_markdown(cells: Column) -> Column:
    """Rows of cells as a Markdown table, the first as its head."""
    line = lambda row: F.concat(F.lit("| "), F.array_join(row, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(F.get(cells, F.lit(0)))))
    return F.array_join(F.concat(F.array(line(F.get(cells, F.lit(0))), rule), F.transform(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), line)), "\n")


def underlined(words: DataFrame, rules: DataFrame, page: list[str]) -> DataFrame:
    """(page, id, rule): words with a rule right below them that underlines them.

    ``words`` and ``rules``: page, id, x0, x1, top, bottom. Words and rules meet in strips of the page, so only those at one height
    are compared. No underlines are: rules that an upright one touches at an end (borders of tables); rules under a word that is
    not close; rules with no other word beside them in the line above; bars with words below that do not reach over their ends
    (fractions); and rules much longer than the words.
    """
    o = rules.select(*page, F.col("id").alias("rule"), *(F.col(c).cast("double").alias(f"o_{c}") for c in ("x0", "x1", "top", "bottom")))
    one = [*page, "rule", "o_x0", "o_x1", "o_top", "o_bottom"]  # ids of rules may repeat on a page: a rule is told by its place, too
    thin = o.where((F.col("o_bottom") - F.col("o_top") <= 1.3) & (F.col("o_x1") - F.col("o_x0") >= 3))
    w = words.select(*page, "id", *(F.col(c).cast("double").alias(c) for c in ("x0", "x1", "top", "bottom")))
    strip = lambda c, ks, size: F.explode(F.array(*(F.floor(c / size) + k for k in ks)))
    near = thin.withColumn("_s", strip(F.col("o_top"), (-1, 0, 1), 4)).join(w.withColumn("_s", F.floor(F.col("bottom") / 4)), [*page, "_s"]).drop("_s")
    over = F.least("x1", "o_x1") - F.greatest("x0", "o_x0")
    above = near.where((F.col("top") < F.col("o_top")) & F.col("bottom").between(F.col("o_top") - 2.5, F.col("o_top") + 2.0) & (over > 0.8 * (F.col("x1") - F.col("x0"))))
    bars = o.where((F.col("o_bottom") - F.col("o_top") > 4) & (F.col("o_x1") - F.col("o_x0") < 2.5)).select(*page, F.col("o_x0").alias("v_x0"), F.col("o_x1").alias("v_x1"), F.col("o_top").alias("v_top"), F.col("o_bottom").alias("v_bottom"))
    # an upright rule stands in the strips that it crosses, at the place of its sides
    spread = bars.withColumn("_s", F.explode(F.sequence(F.floor((F.col("v_top") - 1.5) / 16), F.floor((F.col("v_bottom") + 1.5) / 16))))
    ends = thin.withColumn("_s", F.floor(F.col("o_top") / 16)).join(spread, [*page, "_s"])
    touched = ends.where(F.col("o_top").between(F.col("v_top") - 1.5, F.col("v_bottom") + 1.5) & ((F.abs(F.col("v_x0") - F.col("o_x0")) < 2) | (F.abs(F.col("v_x1") - F.col("o_x1")) < 2))).select(*one).distinct()
    g = above.groupBy(*one).agg(F.max(F.col("o_top") - F.col("bottom")).alias("far"), F.min(F.struct("id", "top"))["top"].alias("line"), (F.max("x1") - F.min("x0")).alias("wide"))
    g = g.where((F.col("far") <= 1.2) & (F.col("o_x1") - F.col("o_x0") <= 1.3 * F.col("wide") + 4)).join(touched, one, "left_anti")
    beside = g.withColumn("_s", strip(F.col("line"), (-1, 0, 1), 2)).join(w.withColumn("_s", F.floor(F.col("top") / 2)), [*page, "_s"])
    beside = beside.where((F.abs(F.col("top") - F.col("line")) < 1.5) & ((F.col("x1") < F.col("o_x0") - 1) | (F.col("x0") > F.col("o_x1") + 1))).select(*one).distinct()
    below = g.withColumn("_s", strip(F.col("o_bottom"), (-1, 0, 1), 8)).join(w.withColumn("_s", F.floor(F.col("top") / 8)), [*page, "_s"]).where((F.col("top") - F.col("o_bottom")).between(-1, 6.5))
    within = (F.col("x0") >= F.col("o_x0") - 2) & (F.col("x1") <= F.col("o_x1") + 2)
    reaches = ((F.col("x0") < F.col("o_x0") - 1) & (F.col("x1") > F.col("o_x0") - 1)) | ((F.col("x0") < F.col("o_x1") + 1) & (F.col("x1") > F.col("o_x1") + 1))
    fractions = below.groupBy(*one).agg(F.bool_or(within).alias("i"), F.bool_or(reaches).alias("r")).where("i and not r").select(*one)
    kept = g.join(beside, one, "left_semi").join(fractions, one, "left_anti").select(*one)
    return above.join(kept, one, "left_semi").select(*page, "id", "rule")


#: Bits of a glyph (24 x 24), and how many may differ: under a tenth.
BITS, MOST = 576, 57
ASPECT = 0.35


def nearest_glyphs(glyphs: DataFrame, known: DataFrame) -> DataFrame:
    """(id, known, char, distance): the known glyph in whose bits each glyph differs least, if in under a tenth of them and the
    logarithms of their aspects are within ASPECT; ties to the least id of ``known``. Nulls for those that no known one is like.

    ``glyphs``: id, bits (a string of 576 zeros and ones), aspect; ``known``: id, bits, aspect, char. Equal bits and aspects are
    looked up once. Every two are compared, in blocks. Glyphs that are null, or of another number of bits, are like none.
    """
    whole = f"length(bits) = {BITS} and aspect is not null"
    q = cut(glyphs.where(whole).select("bits", "aspect").distinct().withColumn("_q", F.monotonically_increasing_id()))
    probes = q.select("_q", "bits", F.log("aspect").alias("_log")).where("_log is not null")
    held = known.where(whole).select(F.col("id").alias("known"), F.col("bits").alias("k_bits"), F.log("aspect").alias("k_log")).where("known is not null and k_log is not null")
    met = every_two(in_blocks(probes.repartition(probes.count() // ROWS + 1)), in_blocks(held), f"_q long, known {dict(held.dtypes)['known']}, d long", partial(nearest_by_bits, most=MOST, reach=ASPECT))
    best = met.groupBy("_q").agg(F.min(F.struct("d", "known")).alias("b")).join(q, "_q")
    named = best.select("bits", "aspect", F.col("b.d").cast("int").alias("distance"), F.col("b.known").alias("known")).join(known.select(F.col("id").alias("known"), "char"), "known")
    return glyphs.join(named, ["bits", "aspect"], "left").select("id", "known", "char", "distance")
