"""Tables from text: answer keys, blocks, items, ranges, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Patterns of headings and answers in exam keys.
HEADING = r"(?imu)^[ \t]*QUEST[ÃA]O[ \t]*0*([0-9]{1,3})\b"
ANSWER_EARLY = r"(?i)\b(?:resposta|gabarito)(?:\s+correta)?\s*:?\s*\(?([A-E])\)?(?![A-Za-zÀ-ÿ])"
ANSWER_MARKED = r"\b([A-E])\)\s*[–-]?\s*CORRETA\b"
ANSWER_NAMED = r"(?i)alternativa\s+correta\s*(?:é|e)?\s*(?:a\s+)?\(?([A-E])\)?(?![A-Za-zÀ-ÿ])"
RANGE_SPOKEN = r"(?i)\b(respond\w*|answer|texto|textos|leia|considere|observe|analise|baseie|com base|refer\w*)\b"
RANGE = r"(?iu)\b(?:quest(?:ões|oes|ão|ao|ions?|iones?))\s+(?:de\s+|from\s+|n[ºo°]\s*)?0*([0-9]{1,3})(?:\s*(?:a|e|and|to|y|-|–|,)\s*0*([0-9]{1,3}))?\b"
PAIR = r"(?<![0-9A-Za-z,])([0-9]{1,3})\s*[-.:)–]?\s*([A-E]|ANULADA)(?![A-Za-zÀ-ÿ])"


def split_blocks(df: DataFrame, key: str, text: str, heading: str = HEADING) -> DataFrame:
    """(key, block_no, number, body): what follows each heading, up to the next. Text before the first heading is no block."""
    bodies = F.split(F.col(text), heading, -1)
    numbers = F.regexp_extract_all(F.col(text), F.lit(heading), F.lit(1))
    pairs = F.arrays_zip(numbers.alias("n"), F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0))).alias("b"))
    x = df.select(F.col(key), F.posexplode(pairs).alias("block_no", "p"))
    return x.select(key, "block_no", F.col("p.n").cast("int").alias("number"), F.col("p.b").alias("body"))


def answers(blocks: DataFrame) -> DataFrame:
    """Adds ``found``: the letters that three ways of writing an answer give in a block; ``?`` where one way gives several."""
    start = F.array_join(F.slice(F.split("body", "\n"), 1, 3), "\n")
    early = F.upper(F.regexp_extract(start, ANSWER_EARLY, 1))
    marked = F.array_distinct(F.regexp_extract_all("body", F.lit(ANSWER_MARKED), F.lit(1)))
    named = F.upper(F.regexp_extract("body", ANSWER_NAMED, 1))
    ways = F.array(early, F.when(F.size(marked) == 1, F.element_at(marked, 1)).when(F.size(marked) > 1, "?").otherwise(""), named)
    return blocks.withColumn("found", F.filter(ways, lambda x: x != ""))


def triangulated(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Confirms or replaces stored keys (doc, number, key) by the answers found in blocks (doc, number, found).

    outcome: ``confirmed`` (one block, all its letters are the key), ``replaced`` (one block, two or more letters agree on
    another), else one of four reasons and no key.
    """
    g = found.groupBy("doc", "number").agg(F.count(F.lit(1)).alias("blocks"), F.flatten(F.collect_list("found")).alias("letters"))
    j = stored.join(g, ["doc", "number"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(0))).withColumn("letters", F.coalesce("letters", F.array().cast("array<string>")))
    kinds = F.array_distinct("letters")
    one = (F.col("blocks") == 1) & (F.size(kinds) == 1)
    agreed = one & F.array_contains("letters", F.col("key"))
    other = one & ~F.array_contains("letters", "?") & (F.size("letters") >= 2)
    outcome = F.when(agreed, "confirmed").when(other, "replaced").when(F.col("blocks") == 0, "no block").when(F.col("blocks") > 1, "several blocks").when(F.size("letters") == 0, "unreadable").otherwise("disagreeing")
    return j.select("doc", "number", "key", outcome.alias("outcome"), F.when(agreed, F.col("key")).when(other, F.try_element_at("letters", F.lit(1))).alias("new_key"))


def key_pairs(df: DataFrame, key: str, text: str, pattern: str = PAIR) -> DataFrame:
    """(key, number, letter) of ``12 B`` pairs anywhere in a text; the first of a number wins."""
    n, l = (F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(k)) for k in (1, 2))
    x = df.select(key, F.posexplode(F.arrays_zip(n.alias("n"), l.alias("l"))).alias("pos", "p"))
    return x.groupBy(key, F.col("p.n").cast("int").alias("number")).agg(F.min_by(F.col("p.l"), F.col("pos")).alias("letter"))


def words_at(line: Column) -> Column:
    """array<struct<word, centre>>: the words of a line of laid-out text and the columns of their centres."""
    gaps = F.split(line, r"\S+", -1)
    words = F.regexp_extract_all(line, F.lit(r"\S+"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<word:string,centre:double>>").alias("out"))
    zipped = F.slice(F.arrays_zip(gaps.alias("g"), F.concat(words, F.array(F.lit(""))).alias("w")), F.lit(1), F.size(words))

    def step(acc: Column, z: Column) -> Column:
        begin = acc["at"] + F.length(z["g"])
        stop = begin + F.length(z["w"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(z["w"].alias("word"), ((begin + stop) / 2).cast("double").alias("centre")))).alias("out"))

    return F.aggregate(F.transform(zipped, lambda z: F.struct(z["g"].alias("g"), z["w"].alias("w"))), start, step, lambda a: a["out"])


def horizontal_key(lines: DataFrame, key: str, order: str, text: str, most: float = 3.0) -> DataFrame:
    """(key, number, letter) of tables with a line of numbers over a line of letters: each number takes the letter whose centre is
    nearest, at most ``most`` columns away; the first of a number wins."""
    full = lines.where(F.trim(F.col(text)) != "")
    below = F.lead(text).over(Window.partitionBy(key).orderBy(order))
    w = full.select(key, order, F.col(text).alias("top"), below.alias("low")).where(F.col("low").isNotNull())
    w = w.where(~F.col("top").rlike("[A-Za-z]{2,}") & ~F.col("low").rlike("[0-9]"))
    w = w.withColumn("_n", F.filter(words_at(F.col("top")), lambda x: x["word"].rlike("^[0-9]{1,3}$"))).withColumn("_l", F.filter(words_at(F.col("low")), lambda x: x["word"].rlike(r"^([A-E]|ANULADA|X|\*)$")))
    w = w.where((F.size("_n") >= 3) & (F.size("_l") >= 3))
    nearest = F.transform("_n", lambda n: F.struct(n["word"].cast("int").alias("number"), F.array_min(F.transform("_l", lambda l: F.struct(F.abs(l["centre"] - n["centre"]).alias("d"), l["centre"].alias("c"), l["word"].alias("w")))).alias("best")))
    x = w.select(key, order, F.explode(nearest).alias("_x")).where(F.col("_x.best.d") <= most)
    return x.groupBy(key, F.col("_x.number").alias("number")).agg(F.min_by(F.col("_x.best.w"), F.col(order)).alias("letter"))


def paired_lines_key(lines: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, number, letter) where a line of numbers and the next line of as many answers belong together one by one."""
    full = lines.where(F.trim(F.col(text)) != "")
    low = F.lead(text).over(Window.partitionBy(key).orderBy(order))
    bare = lambda c, p: F.filter(F.split(F.regexp_replace(c, p, ""), r"\s+"), lambda x: x != "")
    w = full.select(key, order, bare(F.col(text), r"(?iu)^\s*quest(ão|ao|ões|oes)\s*").alias("_n"), bare(low, r"(?i)^\s*(gabarito|resposta)s?\s*").alias("_l"))
    w = w.where((F.size("_n") >= 5) & (F.size("_n") == F.size("_l")) & F.forall("_n", lambda x: x.rlike("^[0-9]+$")) & F.forall("_l", lambda x: x.rlike(r"^([A-E]|(?i:anulad[ao])|\*)$")))
    x = w.select(key, order, F.explode(F.arrays_zip("_n", "_l")).alias("_x")).where(F.col("_x._l") != "*")
    return x.groupBy(key, F.col("_x._n").cast("int").alias("number")).agg(F.min_by(F.col("_x._l"), F.col(order)).alias("letter"))


def single_answer_blocks(blocks: DataFrame, answer: str, most: int = 2500) -> DataFrame:
    """Blocks in which an answer pattern gives exactly one letter: adds ``answer``, cuts the body."""
    found = F.array_distinct(F.regexp_extract_all("body", F.lit(answer), F.lit(1)))
    return blocks.withColumn("_f", found).where(F.size("_f") == 1).withColumn("answer", F.element_at("_f", 1)).withColumn("body", F.substring("body", 1, most)).drop("_f")


def split_items(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, letter, item) of ``a) … b) …`` lists whose letters run a, b, c …; texts with other letters, or one, give none."""
    marker = r"(?m)^\s*([a-h])\s*\)\s*"
    letters = F.regexp_extract_all(F.col(text), F.lit(marker), F.lit(1))
    bodies = F.split(F.col(text), marker, -1)
    x = df.select(F.col(key), letters.alias("l"), bodies.alias("b")).where((F.size("l") >= 2) & (F.array_join("l", "") == F.expr("substring('abcdefgh', 1, size(l))")))
    y = x.select(key, F.explode(F.arrays_zip("l", F.slice("b", F.lit(2), F.size("l")).alias("t"))).alias("z"))
    return y.select(key, F.col("z.l").alias("letter"), F.regexp_replace("z.t", r"^\s+|\s+$", "").alias("item"))


def label_range(c: Column) -> Column:
    """struct(lo, hi) of the question numbers in a label sentence; null without them."""
    lo, hi = F.regexp_extract(c, RANGE, 1), F.regexp_extract(c, RANGE, 2)
    speaks = c.rlike(RANGE_SPOKEN) & (F.length(c) <= 160)
    return F.when(speaks & (lo != ""), F.struct(lo.cast("int").alias("lo"), F.when(hi != "", hi).otherwise(lo).cast("int").alias("hi")))


def html_links(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, href, name) of all links of a page, tags inside names dropped."""
    p = r'(?s)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    h, n = (F.regexp_extract_all(F.col(html), F.lit(p), F.lit(k)) for k in (1, 2))
    x = df.select(key, F.posexplode(F.arrays_zip(h.alias("h"), n.alias("n"))).alias("pos", "x"))
    return x.select(key, "pos", F.col("x.h").alias("href"), F.trim(F.regexp_replace("x.n", "<[^>]+>", "")).alias("name"))


def key_lines(df: DataFrame, key: str, text: str, pattern: str = r"(?m)^\s*\*?\s*(P[0-9]{4})\b") -> DataFrame:
    """(key, id) of ids that begin the lines of a list; what follows, and comments, count for nothing."""
    return df.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("id")).distinct()


def properties(c: Column) -> Column:
    """``key: value`` lines as a map; the first colon parts them."""
    return F.map_from_entries(F.transform(F.filter(F.split(c, "\n"), lambda l: l.contains(":")), lambda l: F.struct(F.trim(F.substring_index(l, ":", 1)), F.trim(F.regexp_replace(l, "^[^:]*:", "")))))


def candidate_headings(c: Column) -> Column:
    """array<struct<style, number>>: all the ways in which a line can be read as the heading of a numbered item."""
    styles = [("named", r"^(?iu:quest[ãa]o)\s+0*([0-9]{1,3})\b"), ("dotted", r"^0*([0-9]{1,3})\s*[.)–-]\s+\S"), ("bare", r"^0*([0-9]{1,3})\s*$")]
    all_ = F.array(*(F.struct(F.lit(n).alias("style"), F.regexp_extract(c, p, 1).try_cast("int").alias("number")) for n, p in styles))
    return F.filter(all_, lambda x: x["number"].isNotNull())


def join_hyphen(left: Column, right: Column, joined: Column, hyphened: Column) -> Column:
    """struct(text, doubt) of a line that ends in a hyphen and the next: by which form the vocabulary knows better."""
    word = left.rlike(r"[A-Za-zÀ-ÿ]+-$") & right.rlike(r"^[A-Za-zÀ-ÿ]+")
    return F.struct(
        F.when(word & (joined > hyphened), F.concat(F.regexp_replace(left, "-$", ""), right)).otherwise(F.concat(left, right)).alias("text"),
        (word & (joined == hyphened)).alias("doubt"),
    )
