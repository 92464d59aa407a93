"""Answer keys of exams from files that write them in mixed forms: six ranked readings, and vetoes that void a whole file.

All readings are column expressions over one file's text, so a file is read in one pass with no shuffle; the answers of an exam
meet in one aggregate, where the best file, reading and position decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of booklet colours and numbers, and of the ways in which keys are written.
COLOUR = r"azul|amarel|branc|rosa|cinza|verde|laranja|lil[aá]s"
BOOKLET = r"caderno\s*([0-9]{1,2})(?![\p{L}\p{N}_])"
TITLE_NUMBERS, TITLE_ANSWERS = r"(?iu)^\s*quest(ão|ao|ões|oes)\s*", r"(?i)^\s*(gabarito|resposta)s?\s*"
#: In a text, a line that can be one of numbers: nothing but digits and blanks behind its title.
NUMBERS_ONLY = r"(?imu)^\s*(?:quest(?:ão|ao|ões|oes))?\s*[0-9][0-9\s\x{85}\x{2028}\x{2029}]*$"
NUMBERED = r"(?m)^\s*(?:(?iu:quest[ãa]o)\s+)?0*([0-9]{1,3})\s*[.)–-]?\s*(?i:gabarito|resposta(?:\s+correta)?|alternativa\s+correta)\s*:\s*([A-E])(?![\p{L}\p{N}_])"
BLOCK = r"(?imu)^\s*quest[ãa]o\s*(?=[0-9]{1,3}(?![\p{L}\p{N}_]))"
BLOCK_ANSWERS = (
    r"(?i:gabarito)\s*:?\s*([A-E])(?![\p{L}\p{N}_])",
    r"(?i:resposta(?:\s+correta)?)\s*:?\s*([A-E])(?![\p{L}\p{N}_])",
    r"(?iu:alternativa\s+correta\s+(?:é|e)\s+a)\s+([A-E])(?![\p{L}\p{N}_])",
    r"(?i:alternativa)\s+([A-E])\s+(?:é|e)\s+a\s+(?i:correta)",
    r"(?m)^\s*(?i:alternativa)\s+([A-E])\s*$",
)
SHOUTED, SHOUTED_ANSWER = r"QUEST[ÃA]O\s+(?=[0-9])", r"(?<![\p{L}\p{N}_])([A-E])\)\s*CORRETA(?![\p{L}\p{N}_])"
COLOUR_COLUMN = r"(?i)gab_(azul|amarel[oa]|branc[oa]|rosa|cinza|verde|laranja)"
COLUMN_PAIR = r"(?<![\p{L}\p{N}_,])([0-9]{1,3})\s+([A-E]|Anulad[ao]|ANULAD[AO])(?![A-Za-zÀ-ÿ])"
LOOSE = r"(?<![\p{L}\p{N}_,])[0-9]{1,3}(?![\p{L}\p{N}_,])|Anulad[ao]|ANULAD[AO]|(?<![A-Za-zÀ-ÿ])[A-E](?![A-Za-zÀ-ÿ])"
LANGUAGES = ("inglês", "espanhol")
UNCOMMENTED, COMMENTED = r"sem\s+coment", r"coment|resolu"

READINGS = ("paired lines", "numbered", "block", "marked", "colour column", "loose")
_FOUND = "array<struct<reading:int,pos:int,sub:int,number:int,language:string,answer:string>>"


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _found(reading: int, pos: Column, number: Column, answer: Column, language: Column | None = None, sub: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(reading).alias("reading"), pos.cast("int").alias("pos"), (F.lit(0) if sub is None else sub).cast("int").alias("sub"),
        number.try_cast("int").alias("number"), (none if language is None else language).alias("language"), answer.alias("answer"),
    )


def _paired_lines(lines: Column) -> Column:
    """A line of numbers and, below it, as many answers; a single one only under both titles. ``*`` is no answer."""

    def bare(line: Column, title: str) -> Column:
        return F.filter(F.split(F.regexp_replace(line, title, ""), r"\s+"), lambda x: x != "")

    two = F.transform(F.sequence(F.lit(1), F.size(lines) - 1), lambda i: F.struct(F.element_at(lines, i).alias("a"), F.element_at(lines, i + 1).alias("b"), i.alias("i")))
    titled = F.transform(two, lambda t: F.struct(t["i"].alias("i"), bare(t["a"], TITLE_NUMBERS).alias("n"), bare(t["b"], TITLE_ANSWERS).alias("l"), (t["a"].rlike(r"(?i)^\s*quest") & t["b"].rlike(r"(?i)^\s*(gabarito|resposta)")).alias("titled")))
    fits = F.filter(
        titled,
        lambda t: (F.size(t["n"]) >= F.when(t["titled"], 1).otherwise(5))
        & (F.size(t["n"]) == F.size(t["l"]))
        & F.forall(t["n"], lambda x: x.rlike("^[0-9]+$"))
        & F.forall(t["l"], lambda x: x.rlike(r"^([A-E]|(?i:anulad[ao])|\*)$")),
    )
    each = F.flatten(F.transform(fits, lambda t: F.transform(F.arrays_zip(t["n"].alias("n"), t["l"].alias("l")), lambda z, k: _found(0, t["i"], z["n"], z["l"], sub=k))))
    return F.when(F.size(lines) > 1, F.filter(each, lambda x: x["answer"] != "*")).otherwise(F.array().cast(_FOUND))


def _numbered(text: Column) -> Column:
    return F.transform(F.arrays_zip(_all(text, NUMBERED, 1).alias("n"), _all(text, NUMBERED, 2).alias("l")), lambda z, k: _found(1, k, z["n"], z["l"]))


def _parts(text: Column, heading: str) -> Column:
    """What follows each heading: struct(i, n, body)."""
    parts = F.split(text, heading, -1)
    parts = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(parts, lambda p, i: F.struct(i.alias("i"), F.regexp_extract(p, r"^0*([0-9]{1,3})(?![\p{L}\p{N}_])", 1).try_cast("int").alias("n"), p.alias("body")))


def _blocks(flow: Column) -> Column:
    """Answers inside the blocks of a solution; one labelled with another number than the block's is not its own."""

    def answer(b: Column) -> Column:
        strange = F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?!0*"), b["n"].cast("string"), F.lit(r"(?![0-9]))[0-9]{1,3}\s*[.)–-]\s*(?i:resposta|gabarito)[^\n]*"))
        own = F.regexp_replace(F.regexp_replace(b["body"], r"^[0-9]+", ""), strange, F.lit(""))
        return F.coalesce(*(F.nullif(F.regexp_extract(own, p, 1), F.lit("")) for p in BLOCK_ANSWERS))

    blocks = F.filter(_parts(flow, BLOCK), lambda b: b["n"].isNotNull())
    return F.filter(F.transform(blocks, lambda b: _found(2, b["i"], b["n"], answer(b))), lambda x: x["answer"].isNotNull())


def _marked(text: Column) -> Column:
    blocks = F.filter(_parts(text, SHOUTED), lambda b: b["n"].isNotNull())
    return F.filter(F.transform(blocks, lambda b: _found(3, b["i"], b["n"], F.regexp_extract(b["body"], SHOUTED_ANSWER, 1))), lambda x: x["answer"] != "")


def _columns(lines: Column, column: Column, width: Column) -> Column:
    """Lines with one pair for each booklet colour: the pair of this exam's colour."""
    pairs = F.transform(lines, lambda t, i: F.struct(i.alias("i"), F.arrays_zip(_all(t, COLUMN_PAIR, 1).alias("n"), _all(t, COLUMN_PAIR, 2).alias("l")).alias("p")))
    full = F.filter(pairs, lambda x: F.size(x["p"]) == width)
    return F.transform(full, lambda x: _found(4, x["i"], F.get(x["p"], column)["n"], F.get(x["p"], column)["l"]))


def _loose(text: Column) -> Column:
    """A number and the letters that follow it on its line: one letter answers it, two answer it for each of two languages."""
    bare = F.translate(F.array_join(_all(text, rf"{LOOSE}|\n"), " "), "\n", "|")
    group = r"([0-9]+)((?: [A-Za-z]+)*)"
    each = F.transform(F.arrays_zip(_all(bare, group, 1).alias("n"), _all(bare, group, 2).alias("l")), lambda z, k: F.struct(k.alias("k"), z["n"].alias("n"), F.split(F.trim(z["l"]), " ").alias("l")))
    one = F.transform(F.filter(each, lambda z: (F.size(z["l"]) == 1) & (z["l"][0] != "")), lambda z: _found(5, z["k"], z["n"], z["l"][0]))
    two = F.filter(each, lambda z: F.size(z["l"]) == 2)

    def of(j: int):
        return F.transform(two, lambda z: _found(5, z["k"], z["n"], z["l"][j], F.lit(LANGUAGES[j])))

    return F.concat(one, of(0), of(1))


def _single(kinds: str) -> Column:
    """The value of a list of distinct things that has one only; else null."""
    return F.when(F.size(kinds) == 1, F.col(kinds)[0])


def read_sources(exams: DataFrame, sources: DataFrame) -> DataFrame:
    """(exam, source, rank, veto, found): what each file says, with the reason if all of it is void.

    ``exams``: exam, booklet, file, cover (all may be null). ``sources``: exam, source, ord, file, text, solution (boolean), flow (the text in reading order; null: text).
    Official files rank before commented ones and solutions, then in the order listed. A file of another booklet colour (in its
    name or, if that has none, its first eight lines), or of another booklet number, is void.
    """
    lower = lambda c: F.lower(F.coalesce(c, F.lit("")))
    named = F.coalesce(F.try_element_at(_all(lower(F.col("booklet")), COLOUR), F.lit(-1)), F.try_element_at(_all(lower(F.col("file")), COLOUR), F.lit(-1)))
    cover = lower(F.col("cover"))
    e = exams.select(
        "exam",
        F.coalesce(named, F.try_element_at(_all(cover, rf"(?<![\p{{L}}\p{{N}}_])({COLOUR})", 1), F.lit(1))).alias("colour"),
        F.try_element_at(_all(cover, BOOKLET, 1), F.lit(1)).alias("booklet_no"),
        lower(F.col("booklet")).alias("booklet"),
    )
    text, file = F.coalesce(F.col("text"), F.lit("")), lower(F.col("file"))
    s = sources.select("exam", "source", "ord", file.alias("file"), text.alias("text"), F.coalesce("flow", text).alias("flow"), F.coalesce("solution", F.lit(False)).alias("listed"))
    plain = F.col("file").rlike(UNCOMMENTED)
    s = s.withColumn("solution", F.col("listed") & ~plain).withColumn("official", plain | (~F.col("listed") & ~F.col("file").rlike(COMMENTED)))
    s = s.withColumn("lines", F.split("text", "\n")).withColumn("head", F.lower(F.array_join(F.slice("lines", 1, 8), "\n")))
    x = s.join(e, "exam", "left")
    first4 = lambda a: F.transform(a, lambda c: F.substring(c, 1, 4))
    x = x.withColumn("in_name", F.when(F.col("colour").isNotNull(), _all(F.col("file"), COLOUR)))
    x = x.withColumn("colours", F.array_distinct(first4(F.when(F.size("in_name") > 0, F.col("in_name")).when(F.col("colour").isNotNull(), _all(F.col("head"), COLOUR)))))
    x = x.withColumn("numbers", F.when(F.col("booklet_no").isNotNull(), F.array_distinct(_all(F.col("head"), BOOKLET, 1))))
    colour, number = _single("colours"), _single("numbers")
    veto = F.when(F.col("colour").isNotNull() & colour.isNotNull() & (colour != F.substring("colour", 1, 4)), "other colour").when(F.col("booklet_no").isNotNull() & number.isNotNull() & (number != F.col("booklet_no")), "other booklet")
    heads = F.get(F.filter(F.transform("lines", lambda t: first4(F.transform(_all(t, COLOUR_COLUMN, 1), F.lower))), lambda c: F.size(c) >= 2), F.lit(0))
    x = x.withColumn("veto", veto).withColumn("heads", F.when((F.col("booklet") != "") & F.lower("text").contains("gab_"), heads))
    mine = F.array_position("heads", F.substring("booklet", 1, 4)).cast("int") - 1
    x = x.withColumn("column", F.when(mine >= 0, mine))
    none = F.array().cast(_FOUND)
    # each list is a column of its own, so that it is made once, and only where the file has what the reading needs
    x = x.withColumn("full", F.when(F.col("veto").isNull() & F.col("text").rlike(NUMBERS_ONLY), F.filter("lines", lambda t: F.trim(t) != "")).otherwise(F.array().cast("array<string>")))
    x = x.withColumn("numbered", F.when(F.col("veto").isNull() & F.col("text").contains(":"), _numbered(F.col("text"))).otherwise(none))
    parts = [
        _paired_lines(F.col("full")),
        F.col("numbered"),
        F.when(F.col("solution") & (F.size("numbered") < 10), _blocks(F.col("flow"))).otherwise(none),
        F.when(F.col("text").contains("CORRETA"), _marked(F.col("text"))).otherwise(none),
        F.when(F.col("solution"), none).when(F.col("column").isNotNull(), _columns(F.col("lines"), F.col("column"), F.size("heads"))).otherwise(_loose(F.col("text"))),
    ]
    found = F.when(F.col("veto").isNull(), F.concat(*(p.cast(_FOUND) for p in parts))).otherwise(none)
    return x.select("exam", "source", F.struct((~F.col("official")).alias("late"), "ord", "source").alias("rank"), "veto", found.alias("found"))


def resolved_keys(exams: DataFrame, sources: DataFrame) -> DataFrame:
    """(exam, number, language, answer, source, reading): the first answer of each number, by file, reading and position.

    Numbers with two letters are answered by language (English, then Spanish), apart from the number alone. Void files and files
    of unknown exams without a colour follow :func:`read_sources`; null texts say nothing; an empty table gives an empty table.
    """
    # outer, as a plain explode would have the readings made once more for a filter of empty lists; those go by the number
    each = read_sources(exams, sources).select("exam", "source", "rank", F.explode_outer("found").alias("f")).where("f.number is not null")
    best = each.groupBy("exam", F.col("f.number").alias("number"), F.col("f.language").alias("language")).agg(F.min(F.struct("rank", F.col("f.reading").alias("reading"), F.col("f.pos").alias("pos"), F.col("f.sub").alias("sub"), F.col("f.answer").alias("answer"))).alias("b"))
    names = F.array(*(F.lit(n) for n in READINGS))
    return best.select("exam", "number", "language", F.col("b.answer").alias("answer"), F.col("b.rank.source").alias("source"), F.element_at(names, F.col("b.reading") + 1).alias("reading"))
