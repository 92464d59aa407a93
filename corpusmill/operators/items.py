"""Questions as rows: options, text fix-ups, titles, and which text belongs to which item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let


def repeated_options(texts: Column) -> Column:
    return F.size(F.array_distinct(texts)) < F.size(texts)


def letters_out_of_order(letters: Column) -> Column:
    return F.array_join(letters, "") != F.substring(F.lit("ABCDE"), F.lit(1), F.size(letters))


def accepted_letters(letters: Column) -> Column:
    """Of letters in reading order, those that continue A, B, C …; others are text."""
    alphabet = "ABCDEFGHIJ"
    step = lambda acc, x: F.when(x == F.substring(F.lit(alphabet), F.size(acc) + 1, F.lit(1)), F.concat(acc, F.array(x))).otherwise(acc)
    return F.aggregate(letters, F.array().cast("array<string>"), step)


def discursive(df: DataFrame, exam: str, n_options: Column, commands: Column, least: float = 0.7) -> DataFrame:
    """Adds ``discursive``: no options, and a command verb, unless the exam is objective for the most part."""
    share = F.avg((n_options >= 4).cast("int")).over(Window.partitionBy(exam))
    return df.withColumn("discursive", (n_options < 2) & commands & (share < least))


def without_answer_space(c: Column, pattern: str = r"(?i)^\s*(_{5,}|espa[çc]o para (a )?resposta|rascunho)") -> Column:
    """A text without the paragraphs that only leave room for an answer."""
    return F.array_join(F.filter(F.split(c, r"\n\n"), lambda p: ~p.rlike(pattern)), "\n\n")


def sampled_pages(n: Column) -> Column:
    """The pages that stand for a document: the first two and the middle one."""
    return F.array_distinct(F.filter(F.array(F.lit(1), F.lit(2), F.greatest(F.lit(1), F.floor(n / 2).cast("int"))), lambda p: p <= n))


def shortened(items: Column, most: int) -> Column:
    """The first items of a list joined, and dots where there are more."""
    return F.concat(F.array_join(F.slice(items, 1, most), ", "), F.when(F.size(items) > most, " …").otherwise(""))


def edition(group: Column, institution: Column, number: Column, own: Column) -> Column:
    """What a mock exam is called, or the edition of an official one."""
    return F.when(group.startswith("SIMULADO"), F.concat_ws(" ", F.lit("Simulado"), F.nullif(institution, F.lit("")), F.nullif(number, F.lit("")))).otherwise(F.coalesce(own, F.lit("")))


def labels_in_order(parts: list[tuple[str, Column]]) -> Column:
    """The labels whose conditions hold, distinct, in order."""
    return F.array_join(F.array_distinct(F.filter(F.array(*(F.when(c, F.lit(l)) for l, c in parts)), lambda x: x.isNotNull())), " ")


def cut_at(c: Column, word: str) -> Column:
    """A text up to a word that begins another part."""
    return F.rtrim(F.substring_index(c, word, 1))


def single_letters(c: Column) -> Column:
    """Option letters set twice (``AA``) once."""
    return F.regexp_replace(c, r"\b([A-E])\1\b", "$1")


def split_note(last_option: Column, mark: str) -> Column:
    """struct(option, note): a note that was read as part of the last option, apart from it."""
    return F.struct(F.rtrim(F.substring_index(last_option, mark, 1)).alias("option"), F.when(last_option.contains(mark), F.concat(F.lit(mark), F.regexp_replace(last_option, rf"(?s)^.*?\Q{mark}\E", ""))).alias("note"))


def remapped(c: Column, from_: str, to: str) -> Column:
    """Characters of a symbol font as what they show."""
    return F.translate(c, from_, to)


def known_share(words: Column, vocabulary: Column) -> Column:
    """Share of words that a vocabulary knows: a remapping is kept where it reaches a threshold."""
    return F.size(F.filter(words, lambda w: F.array_contains(vocabulary, w))) / F.greatest(F.lit(1), F.size(words))


def assigned(blocks: DataFrame, questions: DataFrame, least: int = 5, share: float = 0.35) -> DataFrame:
    """Answer blocks (block, number, words) to questions (id, number, words): the same number wins, else the question whose words
    the block holds most of, ``least`` words and ``share`` of them or more."""
    by_number = blocks.where("number is not null").join(questions.select("id", "number"), "number").groupBy("block").agg(F.min("id").alias("id")).withColumn("via", F.lit("number"))
    rest = blocks.join(by_number.select("block"), "block", "left_anti")
    q = questions.select("id", F.size("words").alias("n"), F.explode("words").alias("w"))
    hits = rest.select("block", F.explode("words").alias("w")).join(q, "w").groupBy("block", "id", "n").agg(F.count(F.lit(1)).alias("shared"))
    hits = hits.where((F.col("shared") >= least) & (F.col("shared") >= share * F.col("n")))
    best = hits.groupBy("block").agg(F.max_by("id", F.struct(F.round(F.col("shared") / F.col("n"), 9).alias("s"), (-F.col("id")).alias("k"))).alias("id")).withColumn("via", F.lit("text"))
    return by_number.select("block", "id", "via").union(best.select("block", "id", "via"))


def explained(options: DataFrame, explanation: DataFrame, least: float = 0.5, margin: float = 0.25) -> DataFrame:
    """(id, letter): the option that an explanation speaks of, where it holds ``least`` of that option's words and ``margin`` more
    than of any other's. ``options`` (id, letter, words), ``explanation`` (id, words), distinct words."""
    j = options.join(explanation.withColumnRenamed("words", "ew"), "id")
    s = j.select("id", "letter", (F.size(F.array_intersect("words", "ew")) / F.greatest(F.lit(1), F.size("words"))).alias("s"))
    w = Window.partitionBy("id").orderBy(F.desc("s"), "letter")
    r = s.withColumn("r", F.row_number().over(w)).withColumn("second", F.coalesce(F.lead("s").over(w), F.lit(0.0))).where("r = 1")
    return r.where((F.col("s") >= least) & (F.col("s") >= F.col("second") + margin)).select("id", "letter")


def agreeing_answer(body: Column) -> Column:
    """The answer of a block where ``Resposta correta: X`` is one letter and the options marked (V) agree with it; else null."""
    said = F.array_distinct(F.regexp_extract_all(body, F.lit(r"Resposta\s+correta:\s*([A-E])\b"), F.lit(1)))
    marked = F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(r"\b([a-e])\)\s*\(V\)"), F.lit(1)), lambda x: F.upper(x)))
    return let(F.struct(said.alias("s"), marked.alias("m")), lambda z: F.when((F.size(z["s"]) == 1) & ((F.size(z["m"]) == 0) | (z["m"] == z["s"])), F.element_at(z["s"], 1)))


def audited(questions: DataFrame, official: DataFrame) -> DataFrame:
    """Stored keys against official ones (doc, number, key): ``change`` null where they agree or the official one is missing."""
    o = official.select("doc", "number", F.col("key").alias("official"))
    j = questions.join(o, ["doc", "number"], "left")
    change = F.when(F.col("official").isNotNull() & ~F.col("official").eqNullSafe(F.col("key")), F.col("official"))
    return j.withColumn("change", change)


def reviewed(low: DataFrame, answers: DataFrame) -> DataFrame:
    """A second opinion on labels (id, code): ``kept``, ``changed`` or ``missing``, whatever the order of the answers."""
    j = low.join(answers.select("id", F.col("code").alias("new_code")), "id", "left")
    return j.select("id", F.when(F.col("new_code").isNull(), "missing").when(F.col("new_code") == F.col("code"), "kept").otherwise("changed").alias("outcome"))
