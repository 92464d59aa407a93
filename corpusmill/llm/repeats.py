"""Removal of repeated passages by a distributed difference-cover algorithm on suffixes.

Whether a suffix of a text starts with ``LENGTH`` bytes that some earlier suffix starts with, too, takes no full order of all
suffixes: its neighbours in sorted order decide, up to ``LENGTH`` bytes. The steps are those of a difference-cover construction:

* Sample. A perfect difference set modulo 57 has for every two residues exactly one distance (below 57) that brings both into the
  set. So of two suffixes that share LENGTH bytes, the positions at that distance behind their starts are both sampled, whatever
  their offsets, and share the 44-byte tuple there. A byte in seven is sampled.
* Sort and name the sampled tuples. Buckets of their names are sorted; a tuple whose neighbours differ occurs once, and settles
  all suffixes that depend on it.
* Recurse on names, coarse to fine. Before the sample, texts are cut where the content says so; pieces and pairs of pieces are
  named in the same way, and the inside of one that occurs earlier needs no sample any more.
* Merge the remaining suffixes: those before a sampled tuple that occurs elsewhere. They are named by their LENGTH bytes, and
  bucket by bucket sorted by name and position; a suffix with the name of its neighbour before it is a repeat.

Texts are packed into blocks, written once as a table bucketed by block; each level reads it where it lies, and only names are
shuffled. A block sends a name once, however often it has it, and gets back one bit a name. So a passage that all texts share
is one row a block in its bucket. Names of pieces and suffixes have 80 to 96 bits, by the size of the corpus, and stand for their
bytes; those of sampled tuples are shorter, as a false meeting there costs work only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut, release, remove, ship, whole_text

LENGTH = 100
#: A perfect difference set.
MODULUS, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
TUPLE = LENGTH - MODULUS + 1
#: Pieces end where the checksum of GRAM bytes is low and the least within REACH bytes on both sides, so they are longer than LENGTH.
GRAM, REACH = 16, 128
#: Bytes of text in a block.
BLOCK = (2 << 20, 8 << 20)
PIECES, SAMPLES, SUFFIXES = 1, 2, 3
_SEGMENT = 1 << 19
_STATE = -1
_NAMED = "bucket int, block int, k1 binary, k2 binary, counts binary, hi binary, lo binary"
_TOLD = "block int, bucket int, bits binary"


class _Roller:
    """Checksums of all strings of one length: sums of a byte's number times a power, modulo 2^64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        base = int(rng.integers(1, 1 << 61)) * 8 + 3
        n = _SEGMENT + LENGTH + 1
        self.up = np.full(n, base, np.uint64)
        self.down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)

    def __call__(self, text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Those at the sorted positions ``at``; stretches without any are passed over."""
        out = np.empty(len(at), np.uint64)
        i = 0
        while i < len(at):
            begin = int(at[i])
            j = int(np.searchsorted(at, begin + _SEGMENT))
            part = text[begin : min(begin + _SEGMENT, int(at[j - 1]) + 1) + length]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.of[part] * self.up[: len(part)], out=sums[1:])
            rel = at[i:j] - begin
            out[i:j] = (sums[rel + length] - sums[rel]) * self.down[rel]
            i = j
        return out


_ROLLERS: list[_Roller] = []


def _roller(k: int) -> _Roller:
    while len(_ROLLERS) <= k:
        _ROLLERS.append(_Roller(7 + len(_ROLLERS)))
    return _ROLLERS[k]


def _spread(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """True from each start to its stop."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, stops, -1)
    return np.cumsum(edges[:-1]) > 0


def _groups(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are the first of their name, and the number of each entry's name."""
    order = np.argsort(hi, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hi[order[1:]] != hi[order[:-1]]
    if (lo[order[1:]] != lo[order[:-1]])[~new[1:]].any():  # names that share their first half
        order = np.lexsort((lo, hi))
        new[1:] = (hi[order[1:]] != hi[order[:-1]]) | (lo[order[1:]] != lo[order[:-1]])
    first, group = np.zeros(len(order), bool), np.empty(len(order), np.int64)
    first[order[new]] = True
    group[order] = np.cumsum(new) - 1
    return first, group


def _ends(at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Of the sorted places ``at``, those whose ``h`` is the least within REACH, and less than any before it there."""
    keep, k = np.ones(len(at), bool), 1
    while k < len(at):
        close = np.flatnonzero(at[k:] - at[:-k] <= REACH)
        if not len(close):
            break
        less = h[close] <= h[close + k]
        keep[(close + k)[less]] = False
        keep[close[~less]] = False
        k += 1
    return at[keep]


class Block:
    """The texts of a block in the order of their ids, end to end."""

    def __init__(self, rows: list[tuple], n_buckets: int):
        best: dict[bytes, list] = {}
        for i, sha, data in rows:
            key = (1 << 64) - 1 if i is None else i + (1 << 63)
            have = best.setdefault(sha, [key, i, None])
            if key < have[0]:
                have[0], have[1] = key, i
            have[2] = have[2] if data is None else data
        unpack = zstandard.ZstdDecompressor()
        kept = sorted((key, int.from_bytes(sha[:8], "big"), sha, i, data) for sha, (key, i, data) in best.items())
        self.ids, self.shas = [r[3] for r in kept], [r[2] for r in kept]
        texts = [unpack.decompress(r[4]) for r in kept]
        self.k1, self.k2 = np.array([r[0] for r in kept], np.uint64), np.array([r[1] for r in kept], np.uint64)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.n_buckets = n_buckets
        ends = np.repeat(self.at[1:], np.diff(self.at)).astype(np.int64)
        self.left = (ends - np.arange(len(self.text))).astype(np.int32)  # bytes from here to the end of the text
        self.open = self.left >= LENGTH  # suffixes that are long enough and not settled yet
        self.repeat = np.zeros(len(self.text), bool)

    def pieces(self) -> tuple:
        """(start, stop, hi, lo) of pieces and pairs of pieces."""
        inside = np.flatnonzero(self.left >= GRAM)
        h = _roller(0)(self.text, inside, GRAM)
        low = h < np.uint64(1 << 58)
        ends = _ends(inside[low], h[low]) + GRAM
        starts, stops = [], []
        raw = self.text.tobytes()
        cuts = np.unique(np.concatenate([self.at, ends]))
        doc = np.searchsorted(self.at, cuts, side="right")
        for step in (1, 2):
            a, b = cuts[:-step], cuts[step:]
            fine = (b - a >= LENGTH) & ((doc[:-step] == doc[step:]) | (b == self.at[np.minimum(doc[:-step], len(self.at) - 1)]))
            starts.append(a[fine])
            stops.append(b[fine])
        starts, stops = np.concatenate(starts), np.concatenate(stops)
        order = np.lexsort((stops, starts))
        starts, stops = starts[order], stops[order]
        names = b"".join(hashlib.blake2b(raw[a:b], digest_size=12).digest() for a, b in zip(starts.tolist(), stops.tolist(), strict=True))
        both = np.frombuffer(names, np.uint8).reshape(-1, 12)
        return starts, stops, np.ascontiguousarray(both[:, :8]).view(np.uint64).ravel(), np.ascontiguousarray(both[:, 4:]).view(np.uint64).ravel() & ~np.uint64((1 << 32) - 1)

    def samples(self) -> tuple:
        """(position, hi, lo) of the sampled tuples of open suffixes."""
        pattern = np.zeros(MODULUS, bool)
        pattern[list(COVER)] = True
        sampled = np.zeros(len(self.text), bool)
        for a, b in zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True):
            sampled[a:b] = np.resize(pattern, b - a)
        count = np.concatenate([[0], np.cumsum(self.open, dtype=np.int32)])
        at = np.flatnonzero(sampled & (self.left >= TUPLE))
        at = at[count[at + 1] > count[np.maximum(at - MODULUS + 1, 0)]]
        return at, _roller(0)(self.text, at, TUPLE), np.zeros(len(at), np.uint64)

    def suffixes(self) -> tuple:
        at = np.flatnonzero(self.open)
        return at, _roller(0)(self.text, at, LENGTH), _roller(1)(self.text, at, LENGTH)

    def settle(self, level: int, told: dict[int, bytes] | None) -> list[tuple] | None:
        """Without ``told`` the rows to send: this block's names, each once, by bucket. With it, what they say is taken in."""
        found = self.pieces() if level == PIECES else self.samples() if level == SAMPLES else self.suffixes()
        at, hi, lo = found[0], found[-2], found[-1]
        first, group = _groups(hi, lo)
        sent = np.flatnonzero(first)
        bucket = (hi[sent] % np.uint64(self.n_buckets)).astype(np.int32)
        order = sent[np.argsort(bucket, kind="stable")]
        sizes = np.bincount(bucket, minlength=self.n_buckets)
        stops = np.cumsum(sizes)
        if told is None:
            out, doc = [], np.searchsorted(self.at, at[order], side="right") - 1
            for b in np.flatnonzero(sizes).tolist():
                mine = slice(stops[b] - sizes[b], stops[b])
                head = (b"", b"", b"")
                if level != SAMPLES:
                    begin = np.flatnonzero(np.diff(doc[mine], prepend=-1))
                    docs, counts = doc[mine][begin], np.diff(begin, append=sizes[b])
                    head = (self.k1[docs].tobytes(), self.k2[docs].tobytes(), counts.astype(np.uint32).tobytes())
                out.append((b, *head, hi[order[mine]], lo[order[mine]]))
            return out
        bits = np.zeros(len(at), bool)
        for b in np.flatnonzero(sizes).tolist():
            bits[order[stops[b] - sizes[b] : stops[b]]] = np.unpackbits(np.frombuffer(told[b], np.uint8), count=sizes[b])
        if level == SAMPLES:
            meets = np.bincount(group, minlength=1) > 1
            meets[group[bits]] = True
            flagged = np.zeros(len(self.text) + 1, np.int32)
            flagged[at[meets[group]] + 1] = 1
            count = np.cumsum(flagged, dtype=np.int32)
            start = np.flatnonzero(self.open)
            self.open[start] = count[np.minimum(start + MODULUS, len(self.text))] > count[start]
            return None
        again = ~first | bits
        if level == PIECES:
            self.repeat |= _spread(at[again], found[1][again] - LENGTH + 1, len(self.text))
        else:
            self.repeat[at[again]] = True
        self.open &= ~self.repeat
        return None

    def state(self) -> bytes:
        """What is settled so far."""
        return zstandard.ZstdCompressor(1).compress(np.packbits(np.stack([self.open, self.repeat])).tobytes())

    def resume(self, state: bytes) -> None:
        both = np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(state), np.uint8), count=2 * len(self.text)).astype(bool)
        self.open, self.repeat = both[: len(self.text)].copy(), both[len(self.text) :].copy()

    def results(self) -> Iterator[tuple]:
        """sha, doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each text."""
        count = np.concatenate([[0], np.cumsum(self.repeat, dtype=np.int32)])
        gone = count[1:] > count[np.maximum(np.arange(len(self.text)) - LENGTH + 1, 0)]
        for k, (a, b) in enumerate(zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True)):
            g = gone[a:b]
            spans = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
            yield self.shas[k], self.ids[k], b - a, int(g.sum()), spans, hashlib.sha256(self.text[a:b][~g].tobytes()).hexdigest()


def _read(texts: pa.Table, told: pa.Table, n_buckets: int, level: int) -> Block:
    """A block as it is after a level (0: none), from that level's answers and the state that went with its names."""
    block = Block(list(zip(*(texts.column(c).to_pylist() for c in ("doc_id", "sha", "data")), strict=True)), n_buckets)
    said = dict(zip(told.column("bucket").to_pylist(), told.column("bits").to_pylist(), strict=True))
    if _STATE in said:
        block.resume(said.pop(_STATE))
    if level:
        block.settle(level, said)
    return block


def _told(table: pa.Table, level: int, width: tuple[int, int]) -> list[tuple]:
    """A bucket's names, sorted: a bit for each, set if an earlier text has it (or, of samples, if it occurs again)."""
    columns = {c: table.column(c).to_pylist() for c in ("block", "k1", "k2", "counts", "hi", "lo")}
    sizes = [len(x) // width[0] for x in columns["hi"]]
    hi, lo = (_number(b"".join(columns[c]), w) for c, w in zip(("hi", "lo"), width, strict=True))
    bits = np.zeros(len(hi), bool)
    if level == SAMPLES:
        order = np.argsort(hi)
        same = hi[order[1:]] == hi[order[:-1]]
        bits[order[1:][same]] = bits[order[:-1][same]] = True
    else:
        k1, k2 = (np.frombuffer(b"".join(columns[k]), np.uint64) for k in ("k1", "k2"))
        rank = np.empty(len(k1), np.uint32)
        rank[np.lexsort((k2, k1) if len(k2) else (k1,))] = np.arange(len(k1))
        order = np.lexsort((np.repeat(rank, np.frombuffer(b"".join(columns["counts"]), np.uint32)), lo, hi))
        same = (hi[order[1:]] == hi[order[:-1]]) & (lo[order[1:]] == lo[order[:-1]])
        bits[order[1:][same]] = True
    at = np.concatenate([[0], np.cumsum(sizes)])
    return [(b, np.packbits(bits[at[k] : at[k + 1]]).tobytes()) for k, b in enumerate(columns["block"])]


def _bytes(x: np.ndarray, width: int) -> bytes:
    """The last ``width`` bytes of numbers of eight."""
    return np.ascontiguousarray(x.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8)[:, 8 - width :]).tobytes()


def _number(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width if width else 0, 8), np.uint8)
    if width:
        out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def _table(rows: list[tuple], schema) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _packed(docs: DataFrame, doc_id: str, text: str, n_blocks: int) -> DataFrame:
    """(block, doc_id, sha, data): texts to blocks by their checksum; a task sends a text once, and smaller ids after it alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for i, data in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    if len(data) < LENGTH:
                        continue
                    sha, key = hashlib.sha256(data).digest(), (1 << 64 if i is None else i)
                    if sha not in seen or key < seen[sha]:
                        rows.append((int.from_bytes(sha[8:16], "big") % n_blocks, i, sha, None if sha in seen else pack.compress(data)))
                        seen[sha] = key
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "doc_id", "sha", "data"])

    return docs.select(F.col(doc_id).cast("long"), whole_text(text)).mapInArrow(run, "block int, doc_id long, sha binary, data binary")


def _level(texts: DataFrame, told: DataFrame, level: int, n_buckets: int, width: tuple[int, int], ties: bool) -> DataFrame:
    """One level: names to buckets, bits back. ``told``: the answers of the level before it. What that has settled travels with
    the names, and comes back with their answers."""
    spark = texts.sparkSession
    named, answered = (spark.createDataFrame([], s).schema for s in (_NAMED, _TOLD))

    def send(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], named)
        block, no = _read(left, right, n_buckets, level - 1), key[0].as_py()
        rows = [(b, no, k1, k2 if ties else b"", c, _bytes(hi, width[0]), _bytes(lo, width[1])) for b, k1, k2, c, hi, lo in block.settle(level, None)]
        return _table([*rows, (n_buckets + no % n_buckets, no, b"", b"", b"", block.state(), b"")], named)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= n_buckets:
            return _table([(no, _STATE, state) for no, state in zip(table.column("block").to_pylist(), table.column("hi").to_pylist(), strict=True)], answered)
        return _table([(no, bucket, bits) for no, bits in _told(table, level, width)], answered)

    sent = texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send, named)
    return cut(sent.groupBy("bucket").applyInArrow(answer, answered))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``, without the bytes that earlier ones cover.

    A byte goes if a LENGTH-byte string covers it that also starts earlier: in a row of a smaller doc_id, or before in the same
    text. Strings are judged on the texts as they are, and never run across two of them.

    Defined results: null and empty texts have 0 bytes; texts of fewer than LENGTH bytes stay whole; a null doc_id counts as the
    greatest; of rows that share a doc_id the one with the smaller SHA-256 of its text comes first, and of rows that repeat both
    all but one are copies; ids are whole numbers; extra columns are ignored, whatever their names; an empty table gives an
    empty table. A text is held whole by one task, at some 40 bytes of memory a byte.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(whole_text(text), 256).alias("sha"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"))
    ids = cut(rows.groupBy("doc_id", "sha", "n_bytes").agg(F.count(F.lit(1)).alias("times")))
    total = ids.agg(F.sum("n_bytes")).first()[0] or 0
    size = min(max(total >> 12, BLOCK[0]), BLOCK[1])
    parts = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (64 << 20)))  # buckets of a table have a limit
    n_blocks, n_buckets = max(parts, total // size), max(min(parts, 16), total // (16 * size))
    bits = log2(total + 2)
    sample = min(8, max(3, ceil((bits - 3 + 8) / 8)))  # a false meeting for one sample in hundreds
    whole = min(12, max(10, ceil((2 * bits + 20) / 8)))  # one false meeting in a million corpora
    ties = not ids.groupBy("doc_id").count().where("count > 1").isEmpty()  # else ids alone order the texts
    name, path = f"repeats_{uuid4().hex}", f"{checkpoint_dir(spark)}/repeats-{uuid4().hex}"
    _packed(docs, doc_id, text, n_blocks).repartition(parts, "block").write.bucketBy(parts, "block").option("path", path).format("parquet").saveAsTable(name)
    texts = spark.table(name)
    told = spark.createDataFrame([], _TOLD)
    for level in (PIECES, SAMPLES, SUFFIXES):
        before, told = told, _level(texts, told, level, n_buckets, (sample, 0) if level == SAMPLES else (8, whole - 8), ties)
        release(before)
    out_type = spark.createDataFrame([], "sha binary, first_id long, n_removed long, n_spans long, kept_sha256 string").schema

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], out_type)
        return _table([(s, i, removed, spans, kept) for s, i, _, removed, spans, kept in _read(left, right, n_buckets, SUFFIXES).results()], out_type)

    done = cut(texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(finish, out_type).withColumn("sha", F.lower(F.hex("sha"))))
    release(told)
    spark.sql(f"DROP TABLE {name}")
    remove(spark, path)
    copy = ids.join(done, "sha", "left").select(
        "doc_id", "n_bytes", "sha", "n_removed", "n_spans", "kept_sha256",
        F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "times"), lambda k: (k == 1) & F.col("doc_id").eqNullSafe(F.col("first_id")))).alias("first"),
    )
    long = F.col("n_bytes") >= LENGTH
    return copy.select(
        "doc_id",
        "n_bytes",
        F.when(~long, 0).when(F.col("first"), F.col("n_removed")).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        F.when(~long, 0).when(F.col("first"), F.col("n_spans")).otherwise(1).cast("long").alias("n_spans"),
        F.when(~long, F.col("sha")).when(F.col("first"), F.col("kept_sha256")).otherwise(F.sha2(F.lit("").cast("binary"), 256)).alias("kept_sha256"),
    )
