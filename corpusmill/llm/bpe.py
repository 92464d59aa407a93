"""Byte-level BPE encoding and decoding with two tiers of lookup.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a vocabulary entry resolves to its id with one hash,
one displacement and one comparison. Tier two takes the misses: a heap of candidate merges over a doubly linked list of bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, whole_text


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in rank order; ranks must be 0 .. n-1."""
    with open(path, "rb") as f:
        found = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


class PerfectHash:
    """Hash and displace: keys fall into buckets, largest first each bucket gets a displacement that sends its keys to free slots.

    A bucket of one key stores its slot itself (as a negative number), which fills the table completely.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // 3)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        held: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            held[h % self.buckets].append(i)
        taken, self.shift, self.slot = bytearray(self.n), [0] * self.buckets, [0] * self.n
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(held[b])):
            if len(held[b]) <= 1:
                singles += [b] * len(held[b])
                continue
            d = 0
            while True:
                places = [self._place(hashes[i], d) for i in held[b]]
                if len(set(places)) == len(places) and not any(taken[p] for p in places):
                    break
                d += 1
            self.shift[b] = d
            for i, p in zip(held[b], places, strict=True):
                taken[p], self.slot[p] = 1, i
        free = (p for p in range(self.n) if not taken[p])
        for b in singles:
            p = next(free)
            self.shift[b], self.slot[p] = -p - 1, held[b][0]
        self.keys = keys

    def _place(self, h: int, d: int) -> int:
        return ((h >> 20) + d * ((h >> 7 & 0xFFFFFFFF) | 1)) % self.n

    def get(self, key: bytes) -> int:
        """The key's index, or -1."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        i = self.slot[-d - 1 if d < 0 else self._place(h, d)]
        return i if self.keys[i] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one pre-token: always the merge of least rank, the leftmost of equals, until none is left.

    ``end[i]`` is where the part that starts at byte i stops (0 once it was merged away), ``before[i]`` where the part before it
    starts: the linked list of bytes. The heap holds (rank, start, stop) of merges; a popped one is stale if its parts changed.
    """
    n, rank = len(piece), ranks.get
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = []
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        p = before[i]
        if stop < n:
            before[stop] = i
            s = end[stop]
            r = rank(piece[i:s])
            if r is not None:
                heappush(heap, (r, i, s))
        if p >= 0:
            r = rank(piece[p:stop])
            if r is not None:
                heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


class Codec:
    """Encodes and decodes whole texts. Pre-tokens met before come from a memo of two generations of bounded size."""

    MEMO = 300_000

    def __init__(self, vocabulary: list[bytes], pattern: str, table: PerfectHash | None = None):
        self.vocabulary, self.table = vocabulary, table or PerfectHash(vocabulary)
        self.ranks = {k: i for i, k in enumerate(vocabulary)}
        self.find = regex.compile(pattern).findall
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def piece(self, token: str) -> tuple[int, ...]:
        data = token.encode()
        i = self.table.get(data)
        return (i,) if i >= 0 else merge(data, self.ranks)

    def encode(self, text: str) -> list[int]:
        tokens = self.find(text)
        young = self.young
        for t in set(tokens).difference(young):
            young[t] = self.old.get(t) or self.piece(t)
        ids = list(chain.from_iterable(map(young.__getitem__, tokens)))
        if len(young) > self.MEMO:
            self.old, self.young = young, {}
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


def _shared(df: DataFrame, path: str):
    """Vocabulary and hash, built once on the driver; bounded by the vocabulary (about 1 MB), whatever the corpus."""
    vocabulary = read_ranks(path)
    t = PerfectHash(vocabulary)
    return df.sparkSession.sparkContext.broadcast((vocabulary, t.shift, t.slot))


def _codec(shared, pattern: str) -> Codec:
    vocabulary, shifts, slots = shared.value
    t = PerfectHash([])
    t.n, t.buckets, t.shift, t.slot, t.keys = len(vocabulary), len(shifts), shifts, slots, vocabulary
    return Codec(vocabulary, pattern, t)


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>: each row's whole text as token ids. Null or empty text gives an empty array; an empty table an
    empty table; repeated rows are encoded each; other columns are ignored. No special tokens."""
    shared = _shared(docs, vocabulary_path)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        codec = _codec(shared, pattern)
        for i, d in it:
            yield i, codec.encode(d.decode("utf-8", "replace"))

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, ids array<int>", rows)


def decode(encoded: DataFrame, vocabulary_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, data binary: the bytes that the ids stand for. Null ids give empty bytes; an id outside the vocabulary is an error."""
    shared = _shared(encoded, vocabulary_path)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        vocabulary = shared.value[0]
        for k, x in it:
            yield k, b"".join(map(vocabulary.__getitem__, x or []))

    return map_rows(encoded, [F.col(key).alias(key), F.col(ids)], f"{key} {dict(encoded.dtypes)[key]}, data binary", rows)


def tokenized(docs: DataFrame, vocabulary_path: str, pattern: str, keep: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, the columns ``keep``, n_tokens, ids, and round_trip: whether the ids decode to the very bytes of the text."""
    shared = _shared(docs, vocabulary_path)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        codec = _codec(shared, pattern)
        for *own, d in it:
            ids = codec.encode(d.decode("utf-8", "replace"))
            yield *own, len(ids), ids, codec.decode(ids) == d

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)), "n_tokens long", "ids array<int>", "round_trip boolean"])
    return map_rows(docs, ["doc_id", *keep, whole_text()], schema, rows)


def digests(docs: DataFrame, vocabulary_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the ids decoded again).

    Encodes and decodes in one pass, so that ids of long texts never leave the worker. Nulls, empty texts and repeats as in
    :func:`encode`; the digests of an empty text are those of no bytes.
    """
    shared = _shared(docs, vocabulary_path)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        codec = _codec(shared, pattern)
        names = [str(i) for i in range(len(codec.vocabulary))]
        for i, d in it:
            ids = codec.encode(d.decode("utf-8", "replace"))
            yield i, len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
