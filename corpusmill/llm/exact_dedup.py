"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks; each chunk is hashed on its own as a polynomial over its bytes modulo two 31-bit primes. The hash of
a concatenation follows from the parts alone, ``H(ab) = H(a) * B^|b| + H(b)``, so the chunks of a huge document can be hashed by
many tasks and combined afterwards (:func:`combine_parts`). Texts with equal fingerprints are then compared chunk by chunk, and
a fingerprint that two different texts share is split into its real classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, free_names, map_rows, release, row_key, whole_text

#: Two primes under 2^31 with one base each: products of a byte and a power summed over a chunk stay under 2^63.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1597334677)
CHUNK = 1 << 16
#: Texts of more bytes than this are hashed in parts of so many bytes, each by a task of its own.
LONG = 1 << 20
#: Bytes that are compared at a time when fingerprints are equal.
COMPARED = 1 << 14
_DROP = BLANKS.encode()


def _powers() -> list[np.ndarray]:
    """For each prime, B^(CHUNK-1) ... B^0."""
    out = []
    for p, b in zip(PRIMES, BASES, strict=True):
        up = np.ones(1, dtype=np.uint64)
        step = b % p
        while len(up) < CHUNK:
            up = np.concatenate([up, up * np.uint64(step) % np.uint64(p)])
            step = step * step % p
        out.append(up[:CHUNK][::-1].copy())
    return out


_POWERS: list[np.ndarray] = []


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    """The polynomial of one chunk of at most ``CHUNK`` bytes, modulo each prime; bytes count from 1, so zeros matter."""
    if not _POWERS:
        _POWERS.extend(_powers())
    x = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    return tuple(int(np.dot(x, w[CHUNK - len(x) :]) % np.uint64(p)) for w, p in zip(_POWERS, PRIMES, strict=True))


def shift(n: int) -> tuple[int, int]:
    """B^n modulo each prime: what a hash is multiplied by when n bytes follow."""
    return tuple(pow(b, n, p) for p, b in zip(PRIMES, BASES, strict=True))


def combine(left: tuple[int, int], right: tuple[int, int], right_shift: tuple[int, int]) -> tuple[int, int]:
    return tuple((a * s + b) % p for a, b, s, p in zip(left, right, right_shift, PRIMES, strict=True))


def fingerprint(data: bytes) -> int:
    """Both residues of a whole text in one non-negative long."""
    h = (0, 0)
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK]
        h = combine(h, chunk_hash(part), shift(len(part)))
    return h[0] << 31 | h[1]


def normalise(data: bytes) -> bytes:
    """Deletes the blanks ``[\\x20\\x09-\\x0D]`` from UTF-8 bytes."""
    return data.translate(None, _DROP)


def combine_parts(parts: DataFrame, key: str, number: str, data: str, prepare=bytes) -> DataFrame:
    """Fingerprints of documents stored as rows of parts (``key``, part ``number``, binary ``data``), without joining the parts.
    ``prepare`` is what is done to a part's bytes first.

    Every part is hashed where it lies; per document only 4 numbers a part meet, and fold in part order. Returns key,
    fingerprint, n_bytes. Null data counts as empty; an empty table gives an empty table.
    """

    def hashed(rows: Iterator[tuple]) -> Iterable[tuple]:
        for k, no, d in rows:
            d = prepare(d or b"")
            f, s = fingerprint(d), shift(len(d))
            yield k, no, f >> 31, f & (1 << 31) - 1, s[0], s[1], len(d)

    kind = dict(parts.dtypes)[key]
    h = map_rows(parts, [F.col(key).alias("k"), F.col(number).cast("long"), F.col(data)], f"k {kind}, no long, h0 long, h1 long, s0 long, s1 long, n long", hashed)

    def fold(acc: Column, x: Column) -> Column:
        return F.struct(*(F.pmod(acc[f"a{i}"] * x[f"s{i}"] + x[f"h{i}"], F.lit(p)).alias(f"a{i}") for i, p in enumerate(PRIMES)))

    start = F.struct(F.lit(0).cast("long").alias("a0"), F.lit(0).cast("long").alias("a1"))
    grouped = h.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("no", "h0", "h1", "s0", "s1"))).alias("p"), F.sum("n").alias("n_bytes"))
    return grouped.select(F.col("k").alias(key), F.aggregate("p", start, fold, lambda a: F.shiftleft(a["a0"], 31).bitwiseOR(a["a1"])).alias("fingerprint"), "n_bytes")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hasher=fingerprint, long: int = LONG) -> DataFrame:
    """doc_id, row_key, fp, n_bytes (of the normalised text), n_points (code points of the original), text_sha256.

    Of texts over ``long`` bytes the parts are dealt to many tasks, hashed there and combined; the result is that of ``hasher``.
    """
    spread = hasher is fingerprint

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for i, k, d in it:
            n = normalise(d)
            yield i, k, None if spread and len(d) > long else hasher(n), len(n), len(d) - _continuations(d), hashlib.sha256(n).hexdigest()

    kind = dict(docs.dtypes)[doc_id]
    done = cut(map_rows(docs, [F.col(doc_id).alias("doc_id"), row_key(doc_id, text), whole_text(text)], f"doc_id {kind}, row_key binary, fp long, n_bytes long, n_points long, text_sha256 string", rows))
    if not spread or done.where("fp is null").isEmpty():
        return done
    huge = docs.select(row_key(doc_id, text), whole_text(text).alias("data")).where(F.octet_length("data") > long).dropDuplicates(["row_key"])
    at = F.sequence(F.lit(0), F.floor((F.octet_length("data") - 1) / long).cast("int"))
    parts = huge.select("row_key", F.posexplode(F.transform(at, lambda i: F.substring("data", i * long + 1, F.lit(long)))).alias("no", "part")).repartition("row_key", "no")
    combined = combine_parts(parts, "row_key", "no", "part", normalise).select("row_key", "fingerprint")
    rest = done.where("fp is null").join(combined, "row_key").withColumn("fp", F.col("fingerprint")).select(*done.columns)
    return cut(done.where("fp is not null").unionByName(rest))


def _continuations(d: bytes) -> int:
    return 0 if d.isascii() else int(np.count_nonzero((np.frombuffer(d, dtype=np.uint8) & 0xC0) == 0x80))


def _compared(keyed: DataFrame) -> DataFrame:
    """(key, fp, n_bytes, text) to one row for each chunk of COMPARED bytes of each normalised text, under its fingerprint."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for k, f, size, d in it:
            n = normalise(d)
            for at in range(0, max(1, len(n)), COMPARED):
                yield k, f, size, at // COMPARED, n[at : at + COMPARED]

    return map_rows(keyed, ["row_key", "fp", "n_bytes", whole_text("text")], "row_key binary, fp long, n_bytes long, no long, chunk binary", rows)


def _classes(docs: DataFrame, doc_id: str, text: str, hasher) -> tuple[DataFrame, list[str], DataFrame]:
    """The rows with their fingerprints, the columns that name a class of equal texts, and each class's size and first row."""
    fps = fingerprints(docs, doc_id, text, hasher)
    same = ["fp", "n_bytes"]
    groups = cut(_groups(fps, same))  # written, so that the joins below meet plain shuffles, whose large partitions Spark can split
    several = groups.where("group_size > 1").select(*same)
    # grouped by row_key alone, so that Spark may deal the joined rows of a hot fingerprint to many tasks
    rows = fps.join(several, same, "left_semi").groupBy("row_key").agg(*(F.first(c).alias(c) for c in same))
    chunks = _compared(docs.select(row_key(doc_id, text), F.col(text).alias("text")).join(rows, "row_key"))
    contents = chunks.groupBy(*same, "no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    collided = cut(contents.groupBy(*same, "no").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(*same).distinct())
    if collided.isEmpty():
        return fps, same, groups
    bad = chunks.join(collided, same, "left_semi")
    classes = bad.groupBy(*same, "no", "chunk").agg(F.min("row_key").alias("rep"))
    told = bad.join(classes, [*same, "no", "chunk"]).groupBy("row_key").agg(F.sort_array(F.collect_set(F.struct("no", F.hex("rep")))).cast("string").alias("cls"))
    fps = cut(fps.join(told, "row_key", "left").withColumn("cls", F.coalesce("cls", F.lit(""))))
    release(groups)
    return fps, [*same, "cls"], cut(_groups(fps, [*same, "cls"]))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hasher=fingerprint) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``; of equal texts the row with the most code points, then
    the smallest doc_id, stays. Fingerprints are grouped with partial sums, so a text that fills a third of the table is a few
    rows by the time it is shuffled. Rows whose fingerprint is not unique are compared: their chunks are grouped by content, in
    a hash aggregate that compares bytes and folds equal chunks on the map side; a chunk place with two contents marks a
    collision, and the rows under it are told apart by the class of every chunk.

    Defined results: null text is the empty text, and all empty texts are one group; rows with a null doc_id join their group
    and sort after all others; of rows that repeat a doc_id with other texts only one is kept (by a hash of id and text), while
    rows that repeat both are all returned as kept; extra columns are ignored; an empty table gives an empty table.
    """
    fps, key, groups = _classes(docs, doc_id, text, hasher)
    out = fps.join(groups, key)
    return out.select("doc_id", F.col("best.keep_id").alias("keep_id"), "group_size", (F.col("row_key") == F.col("best.row_key")).alias("kept"), "text_sha256")


def _groups(fps: DataFrame, key: list[str]) -> DataFrame:
    """Of each key its size and the row that stays: most code points, then smallest doc_id, null last, then the least row_key."""
    first = F.struct((-F.col("n_points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("keep_id"), "row_key")
    return fps.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("best"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hasher=fingerprint) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts (see :func:`exact_groups`), with all their columns.

    Rows that repeat id and text are one group as well: one of them stays. All null, empty and blank texts are one group. Ids may
    be null, repeat or be of any type that sorts; columns of any name pass unchanged; an empty table gives an empty table.
    """
    fps, same, groups = _classes(docs, doc_id, text, hasher)
    key, keep = free_names(docs, "row_key", "keep_key")
    firsts = groups.select(F.col("best.row_key").alias(keep)).distinct()
    again = fps.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("row_key").alias(keep))
    again = cut(again.join(firsts, keep, "left_semi"))
    kept = docs.withColumn(key, row_key(doc_id, text)).join(cut(firsts), F.col(key) == F.col(keep), "left_semi")
    if not again.isEmpty():  # rows that repeat both id and text
        once = kept.join(again, F.col(key) == F.col(keep), "left_semi").dropDuplicates([key])
        kept = kept.join(again, F.col(key) == F.col(keep), "left_anti").unionByName(once)
    return kept.drop(key)
