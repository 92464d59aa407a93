"""Legibility: how much of a text is made of a language's frequent words, and what follows for lines and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.languages import STOP
from ..functions.text import write_ranges

LETTERS = r"[a-zà-öø-ÿ]+"


def legibility(c: Column, lang: Column, least: int = 20) -> Column:
    """Share of tokens in the language's stop list; null under ``least`` tokens. An unknown language has no frequent words."""
    toks = F.regexp_extract_all(F.lower(c), F.lit(LETTERS), F.lit(0))
    hits = None
    for k, words in STOP.items():
        n = F.size(F.filter(toks, _in(words)))
        hits = (F.when if hits is None else hits.when)(lang == k, n)
    return F.when(F.size(toks) >= least, hits.otherwise(F.lit(0)) / F.size(toks))


def _in(words: list[str]):
    return lambda t: t.isin(*words)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, lang, line_no (from 1), line; a blank last line is no line."""
    parts = F.split("text", "\n", -1)
    cutoff = F.when(F.trim(F.element_at(parts, -1)) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return docs.select("doc_id", "lang", F.posexplode(cutoff).alias("p", "line")).select("doc_id", "lang", (F.col("p") + 1).alias("line_no"), "line")


def line_status(docs: DataFrame, short: int = 80, poor: float = 0.10, least: int = 30) -> DataFrame:
    """Lines as ``empty`` (shorter than ``short``), ``poor`` (legibility under ``poor``) or ``ok``."""
    l = lines(docs)
    score = legibility(F.col("line"), F.col("lang"), least)
    return l.select("doc_id", "line_no", F.when(F.length(F.trim("line")) < short, "empty").when(score < poor, "poor").otherwise("ok").alias("status"))


def document_status(status: DataFrame) -> DataFrame:
    """From line statuses: doc_id, status, n_lines, empty_lines and poor_lines as ranges."""
    g = status.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == "empty").alias("n_empty"),
        F.count_if(F.col("status") == "poor").alias("n_poor"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "empty", F.col("line_no")))).alias("e"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "poor", F.col("line_no")))).alias("p"),
    )
    full = F.col("n") - F.col("n_empty")
    state = F.when(full == 0, "no_text").when(F.col("n_poor") > 0.5 * full, "corrupt").when(F.col("n_poor") > 0, "partly_corrupt").when(F.col("n_empty") > 0.5 * F.col("n"), "mostly_empty").otherwise("ok")
    return g.select("doc_id", state.alias("status"), F.col("n").alias("n_lines"), write_ranges(F.col("e")).alias("empty_lines"), write_ranges(F.col("p")).alias("poor_lines"))


def sample_status(longest: Column, score: Column, n_poor: Column, n_lines: Column) -> Column:
    """From a sample where the whole text was not read: few poor lines are let pass."""
    relaxed = (n_poor <= 2) & (n_poor < 0.1 * n_lines)
    return F.when(longest < 50, "no_text").when((score < 0.10) & ~relaxed, "corrupt").when((score < 0.20) & ~relaxed, "doubtful").otherwise("ok")


def repeated_lines(docs: DataFrame, least: int = 3) -> DataFrame:
    """Running heads by document: line templates (digits folded, over 5 characters) on ``least`` lines or more."""
    l = lines(docs).select("doc_id", F.trim(F.regexp_replace("line", "[0-9]+", "#")).alias("key"), "line_no").where("length(key) > 5")
    return l.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line")).where(f"n >= {least}")


def without_repeated_lines(docs: DataFrame, least: int = 3, longest: int = 5) -> DataFrame:
    """Texts without lines of more than ``longest`` characters that occur ``least`` times or more in them, and without rules of
    underscores: doc_id, text, n_dropped. Only the lines that repeat are shuffled; texts stay in their rows until then."""
    l = docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line")).select("doc_id", F.trim("line").alias("line"))
    often = l.where(F.length("line") > longest).groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {least}")
    gone = often.groupBy("doc_id").agg(F.collect_list("line").alias("_gone"))
    parts = F.split("text", "\n", -1)
    stays = lambda x: ~F.coalesce(F.array_contains("_gone", F.trim(x)), F.lit(False)) & ~x.rlike("^ *_{4,} *$")
    kept = docs.select("doc_id", "text").join(gone, "doc_id", "left").withColumn("_kept", F.filter(parts, stays))
    return kept.select("doc_id", F.array_join("_kept", "\n").alias("text"), (F.size(parts) - F.size("_kept")).alias("n_dropped"))


def vocabulary(docs: DataFrame, least: int = 2) -> DataFrame:
    """word, n: words (hyphenated ones whole) that occur ``least`` times or more in the corpus."""
    toks = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+(?:-\p{L}+)*"), F.lit(0))
    return docs.select(F.explode(toks).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {least}")


def estimated_items(c: Column, number: str, last_option: str, most: int = 300, least: int = 3) -> Column:
    """How many items a text holds: distinct numbers after a heading, or lines that begin with the last option."""
    heads = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(c, F.lit(number), F.lit(1)), lambda n: n.cast("int")), lambda n: n.between(1, most)))
    n = F.greatest(F.size(heads), F.size(F.regexp_extract_all(c, F.lit(last_option), F.lit(0))))
    return F.when(n >= least, n)


