"""A bank of questions: rows ready to publish, the base text of a question, answer files to trust, votes with a prior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is no word of a text, and how long a run of letters is that blanks are missing from.
NO_WORDS = r"\{\{[^}]+\}\}|https?://\S+|\S+@\S+|\\\(.*?\\\)"
GLUED = r"[A-Za-zÀ-ÿ]{28,}"


def ready_questions(questions: DataFrame, texts: DataFrame, excluded: DataFrame) -> DataFrame:
    """The rows of ``questions`` that can be published.

    ``questions``: exam, id, statement, options (texts), discursive, annulled, alerts, key, base_ids; ``texts``: exam, id, alerts;
    ``excluded``: exam. A row goes if its exam is excluded, a base text of its exam has an alert, its text has glued words (markers,
    addresses and formulas aside), it is discursive, has an alert, has neither a key nor is annulled, or under four options. Null
    lists and flags count as empty and false; repeated rows each stay.
    """
    none = F.array().cast("array<string>")
    whole = F.concat_ws(" ", F.coalesce("statement", F.lit("")), F.array_join(F.coalesce("options", none), " ", ""))
    fine = (
        ~F.coalesce("discursive", F.lit(False))
        & (F.size(F.coalesce("alerts", none)) == 0)
        & ((F.coalesce("key", F.lit("")) != "") | F.coalesce("annulled", F.lit(False)))
        & (F.size(F.coalesce("options", none)) >= 4)
        & ~F.regexp_replace(whole, NO_WORDS, "").rlike(GLUED)
    )
    kept = questions.where(fine).join(excluded.select("exam").distinct(), "exam", "left_anti")
    alerted = texts.where(F.size("alerts") > 0).select("exam", F.col("id").alias("_base")).distinct()
    tied = kept.select("exam", "id", F.explode("base_ids").alias("_base")).join(alerted, ["exam", "_base"], "left_semi").select("exam", "id").distinct()
    return kept.join(tied, ["exam", "id"], "left_anti").select(questions.columns)


def base_text(questions: DataFrame, ranges: DataFrame) -> DataFrame:
    """``questions`` with ``base``: the last range (by ``ord``) of the document that holds the number, in the question's language or
    in none; without one, the question's own ``base_ref``.

    ``questions``: doc, number, language, base_ref; ``ranges``: doc, id, lo, hi, language, ord. Repeated questions each stay. Ranges
    are looked up once for each number and language of a document.
    """
    asked = questions.select("doc", "number", "language").distinct()
    r = ranges.select(F.col("doc").alias("_doc"), F.col("id").alias("_id"), "lo", "hi", F.col("language").alias("_language"), "ord")
    holds = (F.col("doc") == F.col("_doc")) & F.col("number").between(F.col("lo"), F.col("hi")) & (F.col("_language").isNull() | F.col("_language").eqNullSafe(F.col("language")))
    found = asked.join(r, holds).groupBy("doc", "number", "language").agg(F.max_by("_id", F.struct("ord", "_id")).alias("_base"))
    f = found.select(F.col("doc").alias("_d"), F.col("number").alias("_n"), F.col("language").alias("_l"), "_base")
    same = (F.col("doc") == F.col("_d")) & (F.col("number") == F.col("_n")) & F.col("language").eqNullSafe(F.col("_l"))
    return questions.join(f, same, "left").select(*questions.columns, F.coalesce("_base", "base_ref").alias("base"))


def trusted_chain(numbers: Column, named: Column) -> Column:
    """Of numbers in reading order, those that continue the chain by 1 or 2, from the first. Where headings name themselves
    (``named``), a number that skips ahead shows a text out of order: the whole file is void, an empty list."""
    first = F.struct(F.slice(numbers, F.lit(1), F.lit(1)).alias("chain"), F.get(numbers, F.lit(0)).alias("last"), F.lit(False).alias("void"))

    def step(acc: Column, x: Column) -> Column:
        goes_on = x.isin(acc["last"] + 1, acc["last"] + 2)
        return F.struct(
            F.when(goes_on, F.concat(acc["chain"], F.array(x))).otherwise(acc["chain"]).alias("chain"),
            F.when(goes_on, x).otherwise(acc["last"]).alias("last"),
            (acc["void"] | (named & ~goes_on & (x > acc["last"]))).alias("void"),
        )

    rest = F.slice(numbers, F.lit(2), F.greatest(F.size(numbers) - 1, F.lit(0)))
    return F.aggregate(rest, first, step, lambda a: F.when(a["void"], F.slice(a["chain"], F.lit(1), F.lit(0))).otherwise(a["chain"]))


def voted(votes: DataFrame, prior: DataFrame, key: list[str], choice: str, weight: str, prior_weight: int = 100, least: float = 0.8) -> DataFrame:
    """(key, choice, weight, share, kept): the choice of most weight by key, ties to the least; what is known before counts as
    ``prior_weight`` votes. A key whose best choice has under ``least`` of the weight is in conflict: ``kept`` is false."""
    both = votes.select(*key, choice, F.col(weight).cast("double").alias("weight")).unionByName(prior.select(*key, choice, F.lit(float(prior_weight)).alias("weight")))
    sums = both.groupBy(*key, choice).agg(F.sum("weight").alias("weight"))
    w = Window.partitionBy(*key)
    x = sums.withColumn("share", F.col("weight") / F.sum("weight").over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.desc("weight"), choice)))
    return x.where("_r = 1").select(*key, choice, "weight", "share", (F.col("share") >= least).alias("kept"))
