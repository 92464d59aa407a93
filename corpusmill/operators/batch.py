"""Lots, their answers, strict validation, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lots(df: DataFrame, order: list, size: int, prefix: str = "lote_", width: int = 3) -> DataFrame:
    """Rows in lots of ``size`` by a total order: adds ``lot`` and ``pos``.

    Ranks come from range partitions and their offsets, so no task sorts the whole table.
    """
    from .window import numbered

    n = numbered(df, order, "", 18, "_n").withColumn("_k", F.col("_n").cast("long") - 1)
    return n.withColumn("lot", F.concat(F.lit(prefix), F.lpad(F.floor(F.col("_k") / size).cast("string"), width, "0"))).withColumn("pos", F.col("_k") % size).drop("_n", "_k")


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows drawn without replacement, the same for the same seed: those of least hash."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(seed), F.lit(":"), F.col(key).cast("string")))).orderBy("_h", key).limit(n).drop("_h")


def per_group_sample(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """Up to ``n`` rows of each group, seeded by the group itself."""
    h = F.md5(F.concat(F.col(group).cast("string"), F.lit(":"), F.col(key).cast("string")))
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(h, key))).where(f"_r <= {n}").drop("_r")


def lot_status(lots_: DataFrame, answers: DataFrame) -> DataFrame:
    """lot, status of answered lots: ``ok`` only if the ids are those of the lot in its very order, ``ids differ`` or ``no answer``.

    Both: (lot, pos, id). Positions are joined in full, so a missing, an additional and a moved id all show.
    """
    a = answers.select("lot", "pos", F.col("id").alias("answer_id"))
    j = lots_.select("lot", "pos", "id").join(a, ["lot", "pos"], "full")
    g = j.groupBy("lot").agg(F.bool_and(F.col("id").eqNullSafe(F.col("answer_id"))).alias("same"), F.count("answer_id").alias("n"))
    return g.select("lot", F.when(F.col("n") == 0, "no answer").when(F.col("same"), "ok").otherwise("ids differ").alias("status"))


def validated(answers: DataFrame, codes: DataFrame, confidences: tuple[str, ...] = ("alta", "media", "baixa")) -> DataFrame:
    """Adds ``error`` to answers (…, code, conf): an unknown code, a bad confidence, or null."""
    known = codes.select(F.col("code").alias("_c")).distinct()
    j = answers.join(known, F.col("code") == F.col("_c"), "left")
    return j.withColumn("error", F.when(F.col("_c").isNull(), "unknown code").when(~F.coalesce(F.col("conf").isin(*confidences), F.lit(False)), "bad confidence")).drop("_c")


def style_check(styles: DataFrame, assigned: DataFrame, most: int = 10, other: str = "-E9", share: float = 0.12) -> DataFrame:
    """sub, problems of style lists (sub, code, name) and assignments (sub, id, code): repeated or malformed codes, empty names,
    too few or too many styles, too many in the catch-all style, unknown styles."""
    s = styles.groupBy("sub").agg(
        (F.count(F.lit(1)) != F.countDistinct("code")).alias("repeated"),
        F.bool_or(~F.rlike(F.col("code"), F.concat(F.lit(r"^\Q"), F.col("sub"), F.lit(r"\E-E[0-9]{1,2}$")))).alias("malformed"),
        F.bool_or(F.trim(F.coalesce("name", F.lit(""))) == "").alias("unnamed"),
        F.count_if(~F.col("code").endswith(other)).alias("n"),
    )
    known = styles.select("sub", "code").distinct().withColumn("known", F.lit(True))
    a = assigned.join(known, ["sub", "code"], "left").groupBy("sub").agg(F.count_if(F.col("known").isNull()).alias("n_unknown"), F.avg(F.col("code").endswith(other).cast("int")).alias("other_share"))
    j = s.join(a, "sub", "left")
    checks = [("codes repeated", F.col("repeated")), ("codes malformed", F.col("malformed")), ("style without name", F.col("unnamed")), ("number of styles", ~F.col("n").between(1, most)), ("unknown style", F.coalesce(F.col("n_unknown") > 0, F.lit(False))), ("too many others", F.coalesce(F.col("other_share") > share, F.lit(False)))]
    return j.select("sub", F.array_join(F.filter(F.array(*(F.when(c, F.lit(m)) for m, c in checks)), lambda x: x.isNotNull()), "; ").alias("problems"))


#: The fields of a commented answer, the tags of its cards, and the states that a person reviews.
FIELDS = ("passos_raciocinio", "analise_correta_titulo", "analise_correta_texto", "analise_incorretas_intro", "analise_incorretas", "quadro_resumo", "leve_para_prova", "flashcards")
TAGS = ("Fato", "Conceito", "Pegadinha", "Interpretação", "Vocabulário", "Fórmula")
REVIEW = ("discordo", "sem_imagem", "incompleta")
COMMENT_SCHEMA = "passos_raciocinio array<string>, analise_correta_titulo string, analise_correta_texto string, analise_incorretas_intro string, analise_incorretas array<map<string,string>>, quadro_resumo array<map<string,string>>, leve_para_prova string, flashcards array<map<string,string>>, status string, gabarito string, motivo string"
POINTS_AT = r"(?:[Gg]abarito|[Rr]esposta(?: correta)?|[Aa]lternativa correta|[Ll]etra)\s*(?:é|e|:)?\s*(?:a\s+)?(?:letra\s+)?\(?([A-E])\)?(?![\wÀ-ÿ])"


def comment_errors(answer: Column, key: Column, letters: Column) -> Column:
    """The problems of a commented answer in JSON: an empty array accepts it; see :func:`route_comments` for review states.

    ``key``: the official letter; ``letters``: all options of the question.
    """
    c = F.from_json(answer, COMMENT_SCHEMA)
    keys = F.array_sort(F.coalesce(F.json_object_keys(answer), F.array().cast("array<string>")))
    same_keys = lambda names: keys == F.array(*(F.lit(n) for n in sorted(names)))
    blank = lambda x: F.trim(F.coalesce(x, F.lit(""))) == ""
    whole = lambda a, names: F.forall(a, lambda m: (F.array_sort(F.map_keys(m)) == F.array(*(F.lit(n) for n in sorted(names)))) & F.forall(F.map_values(m), lambda v: ~blank(v)))
    wrong = F.filter(F.array_sort(letters), lambda l: l != key)
    texts = F.concat_ws("\n", c["analise_correta_titulo"], c["analise_correta_texto"], c["leve_para_prova"], F.array_join(c["passos_raciocinio"], "\n"))
    others = F.array_except(F.regexp_extract_all(texts, F.lit(POINTS_AT), F.lit(1)), F.array(key))
    checks = [
        ("passos_raciocinio", ~((F.size(c["passos_raciocinio"]) == 3) & F.forall(c["passos_raciocinio"], lambda x: ~blank(x)))),
        *((f"{k} vazio", blank(c[k])) for k in ("analise_correta_titulo", "analise_correta_texto", "analise_incorretas_intro", "leve_para_prova")),
        ("analise_correta_texto curta", F.length(c["analise_correta_texto"]) < 200),
        ("letras das incorretas", F.transform(c["analise_incorretas"], lambda m: m["alt"]) != wrong),
        ("analise_incorretas incompleta", ~whole(c["analise_incorretas"], ("alt", "rotulo", "texto"))),
        ("quadro_resumo", ~(F.size(c["quadro_resumo"]).between(3, 7) & whole(c["quadro_resumo"], ("item", "detalhe")))),
        ("flashcards", ~(F.size(c["flashcards"]).between(3, 6) & whole(c["flashcards"], ("frente", "verso", "tag")) & F.forall(c["flashcards"], lambda m: m["tag"].isin(*TAGS)))),
        ("markdown", texts.rlike(r"(?m)\*\*|^#|\$\$|\\\(|\\frac|\\sqrt")),
        ("aponta outra letra", F.size(others) > 0),
    ]
    found = F.filter(F.array(*(F.when(F.coalesce(x, F.lit(True)), F.lit(m)) for m, x in checks)), lambda m: m.isNotNull())
    review = c["status"].isin(*REVIEW)
    return (
        F.when(~c["gabarito"].eqNullSafe(key), F.array(F.lit("gabarito diferente")))
        .when(review & (~same_keys(("id", "status", "gabarito", "motivo")) | blank(c["motivo"])), F.array(F.lit("campos da revisão")))
        .when(review, F.array().cast("array<string>"))
        .when(~c["status"].eqNullSafe(F.lit("ok")), F.array(F.lit("status")))
        .when(~same_keys(("id", "status", "gabarito", *FIELDS)), F.array(F.lit("campos")))
        .otherwise(found)
    )


def route_comments(df: DataFrame, answer: str, errors: str) -> DataFrame:
    """Adds ``route``: every row goes to ``accepted``, ``review`` or ``rejected``, and to one only."""
    status = F.get_json_object(F.col(answer), "$.status")
    return df.withColumn("route", F.when(F.size(errors) > 0, "rejected").when(status == "ok", "accepted").otherwise("review"))


def quarantined(df: DataFrame, by_id: Column, by_exam: Column, unconfirmed: Column, mismatch: Column, located: Column) -> DataFrame:
    """Adds ``reason`` (the first that holds: by id, by exam, unconfirmed key, key mismatch) and ``resolved``: key reasons are
    resolved where an official key was located, unless the row was listed itself."""
    reason = F.coalesce(by_id, by_exam, F.when(unconfirmed, "key unconfirmed"), F.when(mismatch, "key mismatch"))
    resolved = reason.startswith("key") & by_id.isNull() & located
    return df.withColumn("resolved", F.coalesce(resolved, F.lit(False))).withColumn("reason", F.when(F.col("resolved"), F.lit(None).cast("string")).otherwise(reason))


def small_change(diff: DataFrame, most_rows: int = 30, most_keys: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each value of ``by``: ``publish``, whether a diff (id, field) is small enough to go out without review."""
    g = diff.groupBy(*by).agg(F.countDistinct("id").alias("n_rows"), F.countDistinct(F.when(F.col("field") == "key", F.col("id"))).alias("n_keys"))
    return g.withColumn("publish", (F.col("n_rows") <= most_rows) & (F.col("n_keys") <= most_keys))
