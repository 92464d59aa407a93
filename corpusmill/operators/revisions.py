"""Revisions of texts: what a new version keeps, adds and removes by paragraphs, and options that slipped put back by anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import ship


#: Rows of a result that are handed on together, at least.
MANY = 20_000


def common_subsequence(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence.

    Paragraphs that stand once on either side, in one order, are all common. Otherwise equal ends are taken off first. The rest is halved: the best way through the middle is where the lengths of the first half
    with each prefix and of the second with the rest add up to most, the first such place; rows are vectors, so memory is linear.
    """
    place = {p: j for j, p in enumerate(b)}
    met = [(i, place[p]) for i, p in enumerate(a) if p in place]
    if len(place) == len(b) and all(x[1] < y[1] for x, y in zip(met, met[1:], strict=False)):
        return met
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    names: dict[str, int] = {}
    x, y = (np.array([names.setdefault(p, len(names)) for p in part], np.int64) for part in (a[head : len(a) - tail], b[head : len(b) - tail]))
    out = [(i, i) for i in range(head)]
    todo = [(0, len(x), 0, len(y))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if i0 == i1 or j0 == j1:
            continue
        if i1 - i0 == 1:
            at = np.flatnonzero(y[j0:j1] == x[i0])
            if len(at):
                out.append((head + i0, head + j0 + int(at[0])))
            continue
        mid = (i0 + i1) // 2
        j = j0 + int(np.argmax(_lengths(x[i0:mid], y[j0:j1]) + _lengths(x[mid:i1][::-1], y[j0:j1][::-1])[::-1]))
        todo += [(mid, i1, j, j1), (i0, mid, j0, j)]
    out += [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]
    return sorted(out)


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of ``x`` with each prefix of ``y``."""
    row = np.zeros(len(y) + 1, np.int32)
    for v in x:
        row[1:] = np.maximum(row[1:], row[:-1] + (y == v))
        np.maximum.accumulate(row, out=row)
    return row


def paragraph_diff(old: DataFrame, new: DataFrame, key: str, text: str, separator: str = "\n\n") -> DataFrame:
    """(key, change, old_pos, new_pos, paragraph) of texts that differ: ``kept``, ``added`` and ``removed`` paragraphs.

    Positions count from 0, null on the side that lacks the paragraph. Texts are compared through one join of the two tables and
    one pass; those that are equal, or missing on both sides, have no rows. A text that is null or has no counterpart has no
    paragraphs there, so all of the other's are added or removed. ``separator`` is a fixed string. Keys are unique in each table.
    """
    o = old.select(F.col(key).alias("_o"), F.col(text).alias("_ot"))
    n = new.select(F.col(key).alias("_n"), F.col(text).alias("_nt"))
    j = o.join(n, F.col("_o") == F.col("_n"), "full").where(~F.col("_ot").eqNullSafe(F.col("_nt"))).select(F.coalesce("_o", "_n").alias(key), "_ot", "_nt")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for k, a, b in pdf.itertuples(index=False):
                a, b = (t.split(separator) if isinstance(t, str) else [] for t in (a, b))
                same = common_subsequence(a, b)
                left, right = {i for i, _ in same}, {i for _, i in same}
                rows += [(k, "kept", i, j, a[i]) for i, j in same]
                rows += [(k, "removed", i, None, p) for i, p in enumerate(a) if i not in left]
                rows += [(k, "added", None, i, p) for i, p in enumerate(b) if i not in right]
                if len(rows) > MANY:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)

    def table(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[key, "change", "old_pos", "new_pos", "paragraph"]).astype({"old_pos": "Int64", "new_pos": "Int64"})

    ship(old.sparkSession)
    return j.mapInPandas(run, f"`{key}` {dict(old.dtypes)[key]}, change string, old_pos long, new_pos long, paragraph string")


#: How an option begins on a line of laid-out text, and what ends a whole option.
OPENING = r"(?:^|\s{2,})([A-E])\s{3,}(\S(?:(?!\s{3}).){9,})"
WHOLE = r"[.!?)%\dA-Za-zà-ú>]$"
LETTERS = "ABCDE"


def normal_form(c: Column) -> Column:
    """struct(text, places): letters and digits of a text without markup, and the place (from 1) in it that each came from."""
    bare = F.regexp_replace(F.regexp_replace(c, "<su[bp]>", "     "), "</su[bp]>", "      ")
    chars = F.filter(F.transform(F.split(bare, ""), lambda ch, i: F.struct((i + 1).alias("at"), ch.alias("ch"))), lambda x: x["ch"].rlike("^[0-9A-Za-zÀ-ÿ]$"))
    return F.struct(F.array_join(F.transform(chars, lambda x: x["ch"]), "").alias("text"), F.transform(chars, lambda x: x["at"]).alias("places"))


def option_openings(lines: DataFrame, key: str, text: str, most: int = 40, least: int = 8) -> DataFrame:
    """(key, openings): the distinct (letter, beginning) of options on a text's lines, in normal form, cut at ``most``."""
    z = F.arrays_zip(F.regexp_extract_all(F.rtrim(F.col("_line")), F.lit(OPENING), F.lit(1)).alias("letter"), F.regexp_extract_all(F.rtrim(F.col("_line")), F.lit(OPENING), F.lit(2)).alias("begins"))
    x = lines.select(F.col(key), F.explode(F.split(F.col(text), "\n")).alias("_line")).select(key, F.explode(z).alias("z"))
    x = x.select(key, F.col("z.letter").alias("letter"), F.substring(normal_form(F.col("z.begins"))["text"], 1, most).alias("begins")).where(F.length("begins") >= least)
    return x.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("letter", "begins"))).alias("openings"))


def realigned(questions: DataFrame, openings: DataFrame, key: str, source: str) -> DataFrame:
    """(key, outcome, statement, options): options whose texts slipped into one another, cut anew where the source begins them.

    ``questions``: key, source, statement (paragraphs parted by a blank line), options (texts of A to E); ``openings``: source and
    openings. The last paragraph and the options are joined; each letter's place is the first, behind that of the letter before,
    at which one of its openings stands in normal form. outcome: ``realigned``; ``same``; or what failed: ``no place`` (a letter
    without one), ``short``, ``repeated`` or ``cut off`` (an option that cannot be one); ``skipped`` (not five options, or one with
    a figure mark). Statement and options are those that hold after it. A null text counts as empty.
    """
    q = questions.select(F.col(key), F.col(source).alias("_s"), F.coalesce("statement", F.lit("")).alias("statement"), F.transform("options", lambda o: F.coalesce(o, F.lit(""))).alias("options"))
    q = q.join(openings.select(F.col(source).alias("_s"), "openings"), "_s", "left")
    paras = F.split(F.rtrim(F.col("statement")), "\n\n")
    tail = F.element_at(paras, -1)
    q = q.withColumn("_paras", paras).withColumn("_all", F.concat(tail, F.lit(" "), F.array_join("options", " "))).withColumn("_n", normal_form(F.col("_all")))
    fits = (F.size("options") == len(LETTERS)) & ~F.exists("options", lambda o: o.contains("{{"))
    for k, letter in enumerate(LETTERS):  # a letter after the other: each begins behind the one before
        last = F.col(f"_at{k - 1}") if k else F.lit(0)
        places = F.transform(F.filter("openings", _is(letter)), _found_behind(last))
        q = q.withColumn(f"_at{k}", F.when(last.isNotNull(), F.array_min(F.filter(places, lambda p: p > 0))))
    at = F.array(*(F.element_at("_n.places", F.col(f"_at{k}")) for k in range(len(LETTERS))))
    placed = F.col(f"_at{len(LETTERS) - 1}").isNotNull()
    q = q.withColumn("_cut", F.when(placed, at))
    ends = [F.get("_cut", F.lit(k + 1)) for k in range(len(LETTERS) - 1)] + [F.length("_all") + 1]
    made = F.array(*(F.trim(F.substring("_all", F.get("_cut", F.lit(k)), ends[k] - F.get("_cut", F.lit(k)))) for k in range(len(LETTERS))))
    q = q.withColumn("_new", F.when(placed, made)).withColumn("_rest", F.when(placed, F.trim(F.substring("_all", F.lit(1), F.get("_cut", F.lit(0)) - 1))))
    outcome = (
        F.when(~F.coalesce(fits, F.lit(False)), "skipped")
        .when(~placed, "no place")
        .when(F.transform("options", F.trim) == F.col("_new"), "same")
        .when(F.exists("_new", lambda o: F.length(o) < 4), "short")
        .when(F.exists("_new", lambda o: o.rlike(r"(.{25,}).*\1")), "repeated")
        .when(F.exists("_new", lambda o: ~o.rlike(WHOLE)), "cut off")
        .otherwise("realigned")
    )
    kept = F.slice("_paras", F.lit(1), F.size("_paras") - 1)
    statement = F.array_join(F.concat(kept, F.when(F.col("_rest") != "", F.array("_rest")).otherwise(F.array().cast("array<string>"))), "\n\n")
    q = q.withColumn("outcome", outcome)
    good = F.col("outcome") == "realigned"
    return q.select(key, "outcome", F.when(good, statement).otherwise(F.col("statement")).alias("statement"), F.when(good, F.col("_new")).otherwise(F.col("options")).alias("options"))


def _is(letter: str):
    return lambda o: o["letter"] == letter


def _found_behind(last: Column):
    return lambda o: F.call_function("locate", o["begins"], F.col("_n.text"), last + 1)
