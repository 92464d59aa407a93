"""Secret scans in DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings.

Positions come from splitting a text at its matches: the lengths of the gaps and matches before a match add up to its start.
For a candidate string a window of ``WINDOW`` characters slides one character at a time; the counts of its characters, and with
them the sum of c*log2(c), change by the one that leaves and the one that enters. The terms are whole numbers (millionths), so
sums are exact and the same in any engine.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the base kinds, in the order in which they are listed, with the least length each must reach.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
#: Character class: (its name, candidate pattern, its alphabet folded as counted, least entropy in bits a character).
CLASSES = (
    ("entropy_hex", r"[0-9A-Fa-f]{20,}", "0123456789abcdef", True, 3.0),
    ("entropy_base64", r"[0-9A-Za-z+/_=-]{20,}", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", False, 3.7),
)
#: Candidates that match one of these are no secrets: words, numbers, dashed or slashed words, published examples, alphabets.
ALLOWED = (r"^[A-Za-z]+$", r"^[0-9]+$", r"^[A-Za-z/_=-]*$", r"EXAMPLE|example", r"0123456789|abcdefghij|ABCDEFGHIJ", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
_SPAN = "array<struct<start:bigint,kind_no:int,stop:bigint>>"


def _term(c: Column) -> Column:
    """Millionths of c*log2(c), as a whole number; 0 for 0."""
    return F.element_at(F.array(*(F.lit(terms(i)).cast("long") for i in range(WINDOW + 1))), (c + 1).cast("int"))


def terms(c: int) -> int:
    return round(1e6 * c * log2(c)) if c else 0


def most(bits: float) -> int:
    """The largest sum of terms at which a full window still has this entropy."""
    return int(1e6 * WINDOW * (log2(WINDOW) - bits))


def _located(text: Column, matches: Column, pattern: str, kind: Column | int, keep) -> Column:
    """Spans of the matches that ``keep`` accepts; the gaps are only split out where there are matches."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        stop = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(kind).cast("int").alias("kind_no"), stop.cast("long").alias("stop"))
        return F.struct(stop.cast("long").alias("at"), F.when(keep(x["m"]), F.concat(acc["spans"], F.array(span).cast(_SPAN))).otherwise(acc["spans"]).alias("spans"))

    pairs = F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"))
    pairs = F.transform(pairs, lambda p: F.struct(p["m"].alias("m"), p["gap"].alias("gap")))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step, lambda a: a["spans"])).otherwise(F.array().cast(_SPAN))


def entropy_range(candidate: Column, alphabet: str, fold: bool, bits: float) -> Column:
    """struct(first, last): offsets in the candidate of the first and the last window with at least ``bits``; null without one."""
    chars = F.split(F.lower(candidate) if fold else candidate, "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c))
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(0).alias("n"),
        F.array().cast("array<int>").alias("seen"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    paired = F.arrays_zip(codes.alias("enters"), F.concat(F.array_repeat(F.lit(0), WINDOW), codes).alias("leaves"))
    paired = F.slice(F.transform(paired, lambda p: F.struct(p["enters"].alias("enters"), p["leaves"].alias("leaves"))), F.lit(1), F.size(codes))

    def step(acc: Column, x: Column) -> Column:
        had = F.when(x["leaves"] > 0, F.element_at(acc["counts"], F.greatest(x["leaves"], F.lit(1)))).otherwise(0)
        left = acc["total"] - F.when(x["leaves"] > 0, _term(had) - _term(F.greatest(had - 1, F.lit(0)))).otherwise(0)
        has = F.element_at(acc["counts"], x["enters"]) - F.when(x["leaves"] == x["enters"], 1).otherwise(0)
        total = left + _term(has + 1) - _term(has)
        n = acc["n"] + 1
        hit = (n >= WINDOW) & (total <= most(bits))
        return F.struct(
            F.transform(acc["counts"], lambda v, i: v + (i + 1 == x["enters"]).cast("int") - (i + 1 == x["leaves"]).cast("int")).alias("counts"),
            total.alias("total"),
            n.alias("n"),
            acc["seen"].alias("seen"),
            F.when(hit & acc["first"].isNull(), n - WINDOW).otherwise(acc["first"]).alias("first"),
            F.when(hit, n).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(paired, start, step, lambda a: F.when(a["first"].isNotNull(), F.struct(a["first"].alias("first"), a["last"].alias("last"))))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id, spans array<struct<start, kind_no, stop>> of every row, sorted by start, then kind as in ``KINDS``.

    Base kinds: ``assign`` (a keyword, a separator and a value of 6 or more characters), ``access`` and ``hex``. The entropy
    kinds span, in each candidate that no allow-list pattern matches, from the first window of enough entropy to the end of the
    last. Starts and stops are code points, stops exclusive. Null and empty texts have no spans; repeated rows are scanned each;
    other columns are ignored; an empty table gives an empty table. Texts are scanned whole, one row at a time, with no shuffle.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = base.select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)).alias("m0"),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)).alias("m1"),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)).alias("m2"),
        *(F.regexp_extract_all("text", F.lit(c[1]), F.lit(0)).alias(f"m{3 + k}") for k, c in enumerate(CLASSES)),
    )
    text_ = F.col("text")
    parts = [
        _located(text_, F.col("m0"), ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
        _located(text_, F.col("m1"), ACCESS, 1, lambda m: F.lit(True)),
        _located(text_, F.col("m2"), HEX, 2, lambda m: F.lit(True)),
    ]
    for k, (_, pattern, alphabet, fold, bits) in enumerate(CLASSES):
        m = F.col(f"m{3 + k}")
        suspicious = F.exists(m, lambda x: ~_any(x, allowed))
        located = _located(text_, m, pattern, 3 + k, lambda x: ~_any(x, allowed))
        kept = F.filter(m, lambda x: ~_any(x, allowed))
        zipped = F.arrays_zip(located.alias("s"), kept.alias("c"))
        ranged = F.transform(zipped, _ranged(alphabet, fold, bits))
        spans = F.transform(F.filter(ranged, lambda z: z["r"].isNotNull()), lambda z: F.struct((z["s"]["start"] + z["r"]["first"]).alias("start"), z["s"]["kind_no"].alias("kind_no"), (z["s"]["start"] + z["r"]["last"]).alias("stop")))
        parts.append(F.when(suspicious, spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN)))
    return found.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _ranged(alphabet: str, fold: bool, bits: float):
    return lambda z: F.struct(z["s"].alias("s"), entropy_range(z["c"], alphabet, fold, bits).alias("r"))


def of_kind(spans: Column, kind_no: int) -> Column:
    return F.filter(spans, lambda s: s["kind_no"] == kind_no)


def _any(x: Column, patterns: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | x.rlike(p)
    return hit


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
