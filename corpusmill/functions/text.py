"""Column functions over text. All stay in the JVM but those marked as Arrow functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters of the Latin languages and what they fold to, position by position.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"
WORD = r"[\p{L}\p{N}_]+"


def fold(c: Column) -> Column:
    """Lower case without accents, for the letters of ``ACCENTED``."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def fold_any(c: Column) -> Column:
    """Lower case without any combining mark (Arrow function: Spark has no Unicode normal forms)."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(x)))

    return F.pandas_udf(run, "string")(c)


def compose(c: Column) -> Column:
    """Normal form C (Arrow function), for paths from different file systems."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.pandas_udf(run, "string")(c)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; inside a lambda an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def template(c: Column, mark: str = "N") -> Column:
    """Every run of digits as one mark."""
    return F.regexp_replace(c, r"[0-9]+", mark)


def collapse(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", " "))


def summary(c: Column, longest: int, head: int, tail: int) -> Column:
    """A text longer than ``longest`` as its head and tail."""
    return F.when(F.length(c) > longest, F.concat(F.substring(c, 1, head), F.lit(" […] "), F.right(c, F.lit(tail)))).otherwise(c)


def strip_markers(c: Column) -> Column:
    """Blanks for {{markers}}, formula marks, tags and asterisks."""
    return F.regexp_replace(c, r"\{\{[^}]*\}\}|\\\(|\\\)|<[^>]+>|\*", " ")


def figure_markers(c: Column) -> Column:
    """Image markers as [figura]; source markers vanish."""
    return F.regexp_replace(F.regexp_replace(c, r"\{\{img:[^}]*\}\}", "[figura]"), r"\{\{fonte:[^}]*\}\}", "")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def identity_words(c: Column) -> Column:
    """The words that tell whether two texts are the same: markers stripped, folded, letters and digits only."""
    return F.filter(F.split(F.regexp_replace(fold(strip_markers(F.coalesce(c, F.lit("")))), r"[^a-z0-9]+", " "), " "), lambda w: w != "")


def content_words(c: Column, stop: list[str], least: int = 4) -> Column:
    """Distinct words of at least ``least`` letters that are not in ``stop``, tags stripped."""
    words = F.regexp_extract_all(F.lower(F.regexp_replace(c, r"<[^>]+>|\{\{[^}]+\}\}", "")), F.lit(rf"\p{{L}}{{{least},}}"), F.lit(0))
    return F.array_except(F.array_distinct(words), F.array(*map(F.lit, stop)) if stop else F.array().cast("array<string>"))


def ngrams(words: Column, n: int, step: int = 1) -> Column:
    """Runs of n words joined by spaces; none of a shorter list."""

    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1, F.lit(step)), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, each).otherwise(F.array().cast("array<string>"))

    return let(words, runs)


def rejoin_digits(c: Column) -> Column:
    """Digits that single spaces part, joined."""
    return F.regexp_replace(c, r"(?<=[0-9]) (?=[0-9])", "")


def expand_ranges(c: Column) -> Column:
    """``1-3,5`` as [1, 2, 3, 5]; empty or null as []."""
    one = lambda p: F.sequence(F.element_at(F.split(p, "-"), 1).cast("int"), F.element_at(F.split(p, "-"), -1).cast("int"))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<int>")).otherwise(F.flatten(F.transform(F.split(c, ","), one)))


def write_ranges(numbers: Column) -> Column:
    """A sorted array of distinct ints as ``1-3,5``."""
    grown = F.aggregate(
        numbers,
        F.array().cast("array<struct<lo:int,hi:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] == x - 1),
            F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["lo"].alias("lo"), x.cast("int").alias("hi")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x.cast("int").alias("lo"), x.cast("int").alias("hi"))))),
    )
    return F.array_join(F.transform(grown, lambda r: F.when(r["lo"] == r["hi"], r["lo"].cast("string")).otherwise(F.concat_ws("-", r["lo"].cast("string"), r["hi"].cast("string")))), ",")


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def dirname(c: Column) -> Column:
    return F.regexp_replace(c, r"/?[^/]*$", "")


def extension(c: Column) -> Column:
    return F.lower(F.regexp_extract(basename(c), r"\.([A-Za-z0-9_]+)$", 1))


def depth(c: Column) -> Column:
    return F.size(F.split(c, "/"))


def climb(c: Column, auxiliary: str, least: int = 2) -> Column:
    """A folder without its trailing auxiliary parts, never fewer than ``least`` parts."""
    return F.regexp_replace(c, rf"^((?:[^/]+/){{{least - 1}}}[^/]+(?:/[^/]+)*?)(?:/(?:{auxiliary}))+$", "$1")


def year(path: Column, first: str = r"19[0-9][0-9]|20[0-2][0-9]") -> Column:
    """The year in the deepest part of a path that has one, the first in that part; empty without one."""
    found = F.transform(F.reverse(F.split(path, "/")), lambda p: F.regexp_extract(p, rf"(?<![0-9])({first})(?![0-9])", 1))
    return F.coalesce(F.try_element_at(F.filter(found, lambda y: y != ""), F.lit(1)), F.lit(""))


def first_keyword(c: Column, table: list[tuple[str, str]], default: str = "") -> Column:
    """The label of the first keyword of the table that the folded text contains."""
    out, text = None, fold(c)
    for key, label in table:
        out = (F.when if out is None else out.when)(text.contains(key), F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def source_id(c: Column) -> Column:
    """``P1234-Q056-ING`` as struct(exam, number, language)."""
    return F.struct(
        F.regexp_extract(c, r"^(P[0-9]{4})", 1).alias("exam"),
        F.regexp_extract(c, r"-Q([0-9]{3})", 1).try_cast("int").alias("number"),
        F.nullif(F.regexp_extract(c, r"-(ING|ESP)$", 1), F.lit("")).alias("language"),
    )


def dotted(number: Column) -> Column:
    """Thousands parted by dots."""
    return F.translate(F.format_number(number, 0), ",", ".")


def odd_characters(c: Column) -> Column:
    """Whether there are private-use or replacement characters."""
    return c.rlike(r"[\x{E000}-\x{F8FF}\x{FFFD}]")


def glued(c: Column, longest: int = 28) -> Column:
    """Whether words are glued together: a run of ``longest`` letters outside markers, addresses and formulas."""
    bare = F.regexp_replace(c, r"\{\{[^}]+\}\}|https?://\S+|\S+@\S+|\\\(.*?\\\)", "")
    return bare.rlike(rf"[A-Za-zÀ-ÿ]{{{longest},}}")


def strip_fence(c: Column) -> Column:
    """JSON without the code fence it was pasted in."""
    return F.regexp_replace(F.trim(c), r"^```(?:json)?\s*|\s*```$", "")


def same_characters(a: Column, b: Column) -> Column:
    """Whether two texts hold the same characters, blanks aside: nothing was lost or made up on the way."""
    chars = lambda c: F.array_sort(F.split(F.regexp_replace(c, r"\s+", ""), ""))
    return chars(a) == chars(b)


def renumber_markers(c: Column, offset: Column) -> Column:
    """``{{img:k}}`` as ``{{img:k+offset}}``: the text is split at its markers and put together again."""
    pieces = F.split(c, r"\{\{img:[0-9]+\}\}", -1)
    numbers = F.transform(F.regexp_extract_all(c, F.lit(r"\{\{img:([0-9]+)\}\}"), F.lit(1)), lambda n: n.cast("int"))
    marks = F.concat(F.transform(numbers, lambda n: F.concat(F.lit("{{img:"), (n + offset).cast("string"), F.lit("}}"))), F.array(F.lit("")))
    return F.array_join(F.transform(F.arrays_zip(pieces.alias("p"), marks.alias("m")), lambda z: F.concat(z["p"], z["m"])), "")


def remap_markers(c: Column, numbers: Column) -> Column:
    """``{{img:k}}`` as ``{{img:numbers[k]}}``, a map of ints; markers that it lacks stay."""
    pieces = F.split(c, r"\{\{img:[0-9]+\}\}", -1)
    old = F.transform(F.regexp_extract_all(c, F.lit(r"\{\{img:([0-9]+)\}\}"), F.lit(1)), lambda n: n.cast("int"))
    marks = F.concat(F.transform(old, lambda n: F.concat(F.lit("{{img:"), F.coalesce(F.try_element_at(numbers, n), n).cast("string"), F.lit("}}"))), F.array(F.lit("")))
    return F.array_join(F.transform(F.arrays_zip(pieces.alias("p"), marks.alias("m")), lambda z: F.concat(z["p"], z["m"])), "")


def iso_timestamp(c: Column) -> Column:
    """The time that an ISO 8601 text states; null where it states none."""
    return F.try_to_timestamp(c)


def hours_minutes(seconds: Column) -> Column:
    """A span of seconds as ``h:mm``; minutes that have begun don't count."""
    minutes = F.floor(seconds / 60)
    return F.concat(F.floor(minutes / 60).cast("string"), F.lit(":"), F.lpad((minutes % 60).cast("string"), 2, "0"))


def packed_bits(c: Column) -> Column:
    """A text of 0 and 1 as lower-case hex, eight bits a byte, the last byte filled with zeros."""
    whole = F.rpad(c, (F.ceil(F.length(c) / 8) * 8).cast("int"), F.lit("0"))
    at = F.when(F.length(c) > 0, F.sequence(F.lit(0), F.ceil(F.length(c) / 8).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(at, lambda i: F.lower(F.lpad(F.conv(F.substring(whole, i * 8 + 1, F.lit(8)), 2, 16), 2, "0"))), "")


def place_sources(c: Column, is_source: str = r"^(Fonte|Source|Disponível em)\b") -> Column:
    """Paragraphs that are sources or figures move before the last other paragraph, the command; repeated ones go."""
    parts = F.filter(F.split(c, r"\n\n"), lambda p: F.trim(p) != "")
    moved = F.filter(parts, lambda p: p.rlike(is_source) | p.rlike(r"^\{\{img:"))
    rest = F.filter(parts, lambda p: ~(p.rlike(is_source) | p.rlike(r"^\{\{img:")))
    before = F.slice(rest, F.lit(1), F.greatest(F.size(rest) - 1, F.lit(0)))
    last = F.slice(rest, F.greatest(F.size(rest), F.lit(1)), F.lit(1))
    return F.array_join(F.concat(before, F.array_distinct(moved), last), "\n\n")
