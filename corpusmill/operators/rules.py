"""Ordered rules compiled to one CASE expression, so that Catalyst sees every condition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold


@dataclass(frozen=True)
class Rule:
    label: str
    condition: Column


def first_match(rules: list[Rule], default: str | None = None) -> Column:
    """The label of the first rule that holds; order is meaning. A null condition does not hold."""
    out = None
    for r in rules:
        out = (F.when if out is None else out.when)(r.condition, F.lit(r.label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


#: Patterns over folded file and folder names, and what each says of a document, in order.
ROLE_PATTERNS = [
    ("auxiliar", r"folha de reda|cartao|modelo gab|modelo folha"),
    ("prova", r"\((com|sem)\s+gabarito\)"),
    ("padrao_resposta", r"resposta[s]?[ -_]esperada|resp cienc|resposta ciencia|^resp[ _]"),
    ("padrao_resposta", r"criterio|grade de correcao|expectativa|padrao de resposta|respostas esperadas"),
]
SECTION_PATTERN = r"discursiv|2\s*[aª]?\s*fase|segunda fase"
LATE_ROLE_PATTERNS = [
    ("resolucao", r"resolu|coment|respost|correcao|^res_|_res_|cmtd"),
    ("gabarito", r"gab|(^|[_\W])gb[_\W]"),
]
DAY_PATTERNS = [
    ("1", r"primeiro dia|1\s*[ºo°]?\s*dia|dia\s*0?1\b|(^|[^a-z0-9])d1([^0-9]|$)|_1o?dia|1odia"),
    ("2", r"segundo dia|2\s*[ºo°]?\s*dia|dia\s*0?2\b|(^|[^a-z0-9])d2([^0-9]|$)|_2o?dia|2odia"),
    ("3", r"3\s*[ºo°]?\s*dia|dia\s*0?3\b"),
]
PHASE_PATTERNS = [
    ("1ª fase", r"(1\s*[aªº°o]?\s*fase|primeira fase|fase\s*1|_1fase)"),
    ("2ª fase", r"(2\s*[aªº°o]?\s*fase|segunda fase|fase\s*2|_2fase)"),
    ("1º exame de qualificação", r"1\s*[ºo°]?\s*exame|1[ºo°]? eq|primeiro exame"),
    ("2º exame de qualificação", r"2\s*[ºo°]?\s*exame|2[ºo°]? eq|segundo exame"),
    ("exame discursivo", r"exame discursivo"),
]
COMMENTED_PATTERN, UNCOMMENTED_PATTERN = r"coment|resolu|respostas", r"sem\s+coment"


def by_pattern(c: Column, table: list[tuple[str, str]]) -> list[Rule]:
    return [Rule(label, c.rlike(p)) for label, p in table]


def role(name: Column, section: Column) -> Column:
    """What kind of document a file name speaks of; the section matters for answers of discursive exams only."""
    n = fold(name)
    special = [
        Rule("padrao_resposta", n.contains("exame discursivo") & n.contains("respostas")),
        Rule("auxiliar", n.contains("errata")),
        Rule("padrao_resposta", n.contains("respost") & fold(section).rlike(SECTION_PATTERN)),
    ]
    return first_match(by_pattern(n, ROLE_PATTERNS) + special + by_pattern(n, LATE_ROLE_PATTERNS), "prova")


def day(c: Column) -> Column:
    """Day of an exam as a file or folder name gives it."""
    return first_match(by_pattern(F.regexp_replace(fold(c), r"[_\-]+", " "), DAY_PATTERNS), "")


def phase(c: Column) -> Column:
    """Phase of an exam as a file or folder name gives it."""
    return first_match(by_pattern(fold(c), PHASE_PATTERNS), "")


def commented(name: Column, role_: Column) -> Column:
    """Whether an answer key comes from a commented source rather than an official one."""
    n = F.lower(F.coalesce(name, F.lit("")))
    return ~n.rlike(UNCOMMENTED_PATTERN) & (n.rlike(COMMENTED_PATTERN) | (F.coalesce(role_, F.lit("")) == "resolucao"))


def path_group(path: Column, staged: list[tuple[str, dict[str, str]]]) -> dict[str, Column]:
    """Attributes from path patterns in stages: of the patterns that hold, a later one overrides an earlier one's values.

    ``staged``: (pattern, values by attribute). Returns a column for each attribute, empty without a match.
    """
    names = sorted({k for _, v in staged for k in v})
    out = {n: F.lit("") for n in names}
    for pattern, values in staged:
        for n, v in values.items():
            out[n] = F.when(path.rlike(pattern), F.lit(v)).otherwise(out[n])
    return out


def alerts(conditions: list[tuple[str, Column]]) -> Column:
    """The messages of all conditions that hold, in order."""
    return F.filter(F.array(*(F.when(c, F.lit(m)) for m, c in conditions)), lambda x: x.isNotNull())


def status_bucket(alerts_: Column, has_key: Column, options_ok: Column, light: str) -> Column:
    """The situation of a question, the gravest first; ``light`` is the pattern of alerts that don't count."""
    grave = F.exists(alerts_, lambda a: ~a.rlike(light) & ~a.contains("sem gabarito"))
    return first_match(
        [
            Rule("ocr", F.exists(alerts_, lambda a: a.contains("OCR"))),
            Rule("pendente", F.exists(alerts_, lambda a: a.contains("PENDENTE"))),
            Rule("sem_gabarito", ~has_key),
            Rule("alternativas", ~options_ok),
            Rule("ok_sem_alerta", F.size(alerts_) == 0),
            Rule("ok_alerta_leve", ~grave),
        ],
        "alerta_grave",
    )


def failed(found: Column, expected: Column, pages: Column, pending: Column) -> Column:
    """Whether an extraction failed: nothing, under half of what was expected, too little for its pages, or mostly pending."""
    return (found == 0) | F.coalesce(found < 0.5 * expected, F.lit(False)) | (expected.isNull() & (pages >= 8) & (found < pages)) | ((found >= 10) & (pending > 0.5 * found))


def ready(df: DataFrame, discursive: Column, alerts_: Column, key: Column, annulled: Column, options: Column, text: Column, glued_: Column) -> DataFrame:
    """Rows ready to publish: objective, without alerts, with a key or annulled, four options or more, words not glued."""
    return df.where(~discursive & (F.size(alerts_) == 0) & (F.coalesce(key, F.lit("")).__ne__("") | annulled) & (options >= 4) & ~glued_)
