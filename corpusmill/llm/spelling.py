"""Grouping of spelling variants: words that one inserted, deleted or replaced code point tells apart, without a pair of words.

Every word joins one wildcard group for each of its positions, named by (position, prefix, suffix). Words of a group differ in that
code point alone, so a group's size and its two most frequent words say all that a member needs: how many words are near it there,
and the best of them (the second, for the first itself). For insertions and deletions every distinct deletion of a word meets the
vocabulary in the group of the string that is left: the word of that name learns how many words shrink to it and the best of them,
and each of those learns the name's count. Both kinds of groups are one shuffle; a word's parts are then put together by partial
sums and maxima. Groups are as small as the alphabet allows (a position of a wildcard group takes each letter once, a string has
at most one longer word for each place and letter), whatever the counts of the words are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release

#: The letters of a run, and one run in ``DAMAGED`` has a code point deleted.
RUN = "[A-Za-zÀ-ÿ]+"
DAMAGED = 31
LEAST_LENGTH, LEAST_N = 7, 2
#: A form must occur this many times as often as its word.
TIMES = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of whole texts and how often they occur, from LEAST_LENGTH code points and LEAST_N occurrences on.

    A run whose checksum with its doc_id is divisible by DAMAGED loses one code point first. Runs are counted by document before
    they are changed, and partial counts are added before they are shuffled. Rows without an id lose nothing.
    """
    runs = docs.select(F.col(doc_id).cast("string").alias("i"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), F.lit(0))).alias("r"))
    runs = runs.where(F.length("r") >= LEAST_LENGTH).select("i", F.translate("r", _UPPER, _LOWER).alias("r"))
    h = F.crc32(F.concat("i", F.lit(":"), "r").cast("binary"))
    at = (h % F.length("r")).cast("int")
    cut_out = F.concat(F.expr("substring(r, 1, at)"), F.expr("substring(r, at + 2)"))
    words = runs.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % DAMAGED == 0, cut_out).otherwise(F.col("r")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_N))


def _groups(words: DataFrame) -> DataFrame:
    """(key, word, n, kind): a wildcard group a position (kind 0), the word's own name (1), and its distinct deletions (2)."""
    places = F.sequence(F.lit(0), F.length("word") - 1)

    def around(i: Column, mark: str) -> Column:
        return F.concat(F.substring("word", F.lit(1), i), F.lit(mark), F.substring("word", i + 2, F.length("word")))

    wild = F.transform(places, lambda i: F.struct(around(i, "*").alias("key"), F.lit(0).alias("kind")))
    own = F.array(F.struct(F.col("word").alias("key"), F.lit(1).alias("kind")))
    less = F.transform(F.array_distinct(F.transform(places, lambda i: around(i, ""))), lambda k: F.struct(k.alias("key"), F.lit(2).alias("kind")))
    less = F.when(F.length("word") > LEAST_LENGTH, less).otherwise(F.array().cast("array<struct<key:string,kind:int>>"))
    return words.select("word", "n", F.explode(F.concat(wild, own, less)).alias("g")).select("g.key", "word", "n", "g.kind")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) to (word, n, n_near, best): the number of words one edit away, and struct(minus, word) of the most frequent of
    them (ties: the smallest in code-point order); null without any.

    The words are distinct. The mark of a wildcard is no letter, so its groups and those of whole strings keep apart; its place
    in the key is the position.
    """
    one = F.struct((-F.col("n")).alias("minus"), "word")
    ranked = Window.partitionBy("key").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    group = Window.partitionBy("key")
    wild, own, less = (F.col("kind") == k for k in range(3))
    met = _groups(words).select(
        "key", "word", "n", "kind",
        F.count(F.when(wild, 1)).over(group).alias("size"), F.nth_value(one, 1).over(ranked).alias("first"), F.nth_value(one, 2).over(ranked).alias("second"),
        F.count(F.when(less, 1)).over(group).alias("longer"), F.min(F.when(less, one)).over(group).alias("longest"),
        F.min(F.when(own, one)).over(group).alias("named"),
    )
    found = F.when(wild, F.col("size") - 1).when(own, F.col("longer")).otherwise(F.col("named").isNotNull().cast("long"))
    best = F.when(wild, F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first"))).when(own, F.col("longest")).otherwise(F.col("named"))
    return met.select("word", "n", found.alias("found"), best.alias("best")).groupBy("word").agg(F.max("n").alias("n"), F.sum("found").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last. Counts grow TIMES times a step, so chains are of logarithmic
    length, and every round doubles the steps: the rounds are few."""
    links = cut(forms)
    while True:
        there = links.select(F.col("word").alias("form"), F.col("form").alias("beyond"))
        nxt = cut(links.join(there, "form", "left").select("word", F.coalesce("beyond", "form").alias("form"), F.col("beyond").isNotNull().alias("moved")))
        release(links)
        links = nxt.select("word", "form")
        links._cut_path = nxt._cut_path
        if nxt.where("moved").isEmpty():
            return links.withColumnRenamed("form", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each word of the vocabulary.

    A word's form is its most frequent near word, if that occurs TIMES times as often as the word at least, else null; its root
    is the last form of that chain, the word itself without a form.

    Defined results: null and empty texts have no words; a row without an id has no changed runs; rows that repeat are counted
    each; ties go to the smaller word; very long texts are one row of Spark's own functions; extra columns are ignored, whatever
    their names; an empty table gives an empty table.
    """
    words = cut(vocabulary(docs, doc_id, text))
    good = F.col("best.minus") <= -TIMES * F.col("n")
    found = cut(near_words(words).select("word", "n", "n_near", F.when(good, F.col("best.word")).alias("form"), F.when(good, -F.col("best.minus")).alias("form_n")))
    release(words)
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
