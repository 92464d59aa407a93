"""Near-duplicate detection with circulant MinHash.

Two permutations make all signature coordinates: the first scatters the shingles over the places 0 .. PLACES-1, the second gives
each place a rank, and coordinate k is the least rank of the set's places when the second permutation is shifted circularly by
k. The ranks that one place takes in all coordinates are then one contiguous slice of the second permutation. Bands of the
signature propose pairs; every link is confirmed by the exact Jaccard similarity of the full shingle sets.

Large groups. Texts with equal sets are one class. A bucket of up to ``SMALL`` classes proposes all its pairs; larger buckets
are joined to clusters, and a cluster is resolved through its consensus ``P``, the shingles that more than half of its members
hold. Let ``D(x)`` be the shingles in which ``x`` and ``P`` differ, and ``|x| + |y| = S``. Since ``x`` and ``y`` differ in
``|D(x)| + |D(y)| - 2t`` shingles, ``t`` of the differences being the same, the link condition, stated in whole numbers, is
``3 S >= 37 (|D(x)| + |D(y)| - 2t)`` (for 85 %), or with ``slack(x) = 3 |x| - 37 |D(x)|``

    slack(x) + slack(y) + 74 t >= 0.

* If the slacks alone suffice, the pair is linked, whatever ``t`` is. Then both are also linked to the member of the largest
  slack. So one pair for each such member, with that top, connects them all.
* All other links share differences, and each difference is one of at most half of the members. A link differs in at most
  ``3/37 S`` shingles, so of ``D(x)``, the rarest first, one of the first ``3/37 S + 1`` is shared. Differences with few holders
  propose their pairs; the holders of the others are clusters of at most half the size, resolved in the next level. There only
  pairs count whose first shared difference is the cluster's own, so members bring those of their differences alone that come
  after it and that others of them hold; the number of those that are left out still counts in their slack.

So the levels are few, every level proposes one pair a member and those of short lists, no large group is listed as all its pairs,
and no link is lost that the bands propose. Proposed links are confirmed on the full sets, too.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from ..operators.graph import components
from .common import cut, free_names, map_rows, release, row_key, whole_text

SHINGLE = 5
#: A link: 100 * |x & y| >= SIMILAR * |x | y|.
SIMILAR = 85
#: At similarity 0.85 a pair shares no band with probability (1 - 0.85^8)^44 < 1e-6; at 0.2, one with 1e-4.
BANDS, ROWS = 44, 8
PLACES = 1 << 20
#: Buckets up to this size propose all their pairs; differences of up to RARE holders, too.
SMALL = 8
RARE = 8
_SEED = 20260


def words(data: bytes) -> list[bytes]:
    """A-Z lower-cased; cut at ``[\\x20\\x09-\\x0D]``."""
    return data.lower().split()


def shingles(data: bytes) -> set:
    """The distinct 5-word shingles; with fewer words the whole sequence as one; empty without words."""
    w = words(data)
    if len(w) < SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SHINGLE)), strict=False))


def linked(inter: int, a: int, b: int) -> bool:
    return 100 * inter >= SIMILAR * (a + b - inter) and a > 0 and b > 0


class _WordHash(dict):
    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < 400_000:
            self[w] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    """Sets of 64-bit shingle hashes and their signatures."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.k = bands, rows, bands * rows
        rng = np.random.default_rng(_SEED)
        ranks = rng.permutation(PLACES).astype(np.uint32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[: self.k]]), self.k)
        self.factors = rng.integers(1, 1 << 63, size=rows, dtype=np.uint64) | np.uint64(1)
        self.salts = rng.integers(1, 1 << 63, size=bands, dtype=np.uint64)
        self.word = _WordHash()

    def hashes(self, data: bytes) -> np.ndarray:
        """The sorted distinct hashes of the shingles."""
        w = words(data)
        if not w:
            return np.empty(0, dtype=np.uint64)
        h = np.fromiter(map(self.word.__getitem__, w), dtype=np.uint64, count=len(w))
        m = max(1, len(w) - SHINGLE + 1)
        x = np.full(m, min(len(w), SHINGLE), dtype=np.uint64)
        for i in range(min(len(w), SHINGLE)):
            x = x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + m]
        return np.unique(_mixed(x))

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        places = (hashes >> np.uint64(44)).astype(np.int64)
        sig = None
        for at in range(0, len(places), 1024):
            part = self.slices[places[at : at + 1024]].min(axis=0)
            sig = part if sig is None else np.minimum(sig, part)
        return sig

    def keys(self, hashes: np.ndarray) -> list[int]:
        """One 64-bit key a band."""
        s = self.signature(hashes).astype(np.uint64).reshape(self.bands, self.rows)
        return _mixed((s * self.factors).sum(axis=1, dtype=np.uint64) + self.salts).view(np.int64).tolist()


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row_key, n_shingles, set_id (128 bits of the full set; null for empty sets), keys array<long>."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        s = Sketcher()
        for i, k, d in it:
            h = s.hashes(d)
            yield (i, k, len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest(), s.keys(h)) if len(h) else (i, k, 0, None, [])

    kind = dict(docs.dtypes)[doc_id]
    return map_rows(docs, [F.col(doc_id).alias("doc_id"), row_key(doc_id, text), whole_text(text)], f"doc_id {kind}, row_key binary, n_shingles long, set_id binary, keys array<long>", rows)


def _written(df: DataFrame, n: int) -> DataFrame:
    """Cuts a table of about ``n`` narrow rows into few files, so that joins with it meet plain shuffles that Spark can split."""
    return cut(df.coalesce(n // graph.ROWS + 1))


def _pairs(lists: Column) -> Column:
    """All pairs (a < b) of a short sorted list."""
    return F.flatten(F.transform(lists, lambda a, i: F.transform(F.slice(lists, i + 2, F.size(lists)), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def _buckets(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, rep) to the pairs (a, b) of buckets of up to SMALL members, and the members (key, rep, head) of larger ones.

    Buckets are counted first, with partial sums, and the counts are written: the rows of a large bucket then meet its count
    through a join whose hot key can be split, and only short lists are ever gathered.
    """
    sizes = cut(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("head")).where("n > 1"))
    met = cut(entries.join(sizes, "key"))
    release(sizes)
    short = met.where(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("rep")).alias("m"))
    pairs = short.select(F.explode(_pairs(F.col("m"))).alias("p")).select("p.a", "p.b").distinct()
    return pairs, met.where(F.col("n") > SMALL).select("key", "rep", "head")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) to (a, b, na, nb, inter, is_link): exact counts over full sets. ``texts``: (rep, data).

    Both sides grow with the data, so they are shuffled at any size; a hot ``a`` is a plain join that Spark can split.
    """
    left = pairs.select("a", "b").distinct().join(texts.select(F.col("rep").alias("a"), F.col("data").alias("da")).hint("merge"), "a")
    both = left.join(texts.select(F.col("rep").alias("b"), F.col("data").alias("db")).hint("merge"), "b")

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        recent: OrderedDict[int, set] = OrderedDict()

        def of(i: int, d: bytes) -> set:
            if i in recent:
                recent.move_to_end(i)
                return recent[i]
            s = recent[i] = shingles(d)
            if len(recent) > 24:
                recent.popitem(last=False)
            return s

        for a, b, da, db in it:
            x, y = of(a, da), of(b, db)
            n = len(x & y)
            yield a, b, len(x), len(y), n, linked(n, len(x), len(y))

    return map_rows(both, ["a", "b", "da", "db"], "a long, b long, na long, nb long, inter long, is_link boolean", rows)


def _tokens(texts: DataFrame) -> DataFrame:
    """(rep, tokens): the sorted hashes of the full sets, halved to 62 bits so that a sign can say ``missing``."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        s = Sketcher()
        for r, d in it:
            yield r, np.unique(s.hashes(d) >> np.uint64(2)).astype(np.int64).tolist()

    return map_rows(texts, ["rep", "data"], "rep long, tokens array<long>", rows)


def _level(members: DataFrame, n_members: int) -> tuple[DataFrame, DataFrame]:
    """One level of clusters, (g, rep, tag, n, out, d), to the pairs (a, b) it proposes and the members of the next.

    ``d`` holds what is left of a set of ``n`` shingles: the whole set at first, then its differences from the consensus so far,
    without ``out`` of them that no pair shares which is still to be found. A further consensus, of the differences of some
    members, is taken out in the same way. Members with one ``tag`` are connected
    already; lists of such members alone are left out.
    """
    less, more = 100 - SIMILAR, 100 + SIMILAR
    held = members.select("g", F.explode("d").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("f"))
    sizes = _written(members.groupBy("g").agg(F.count(F.lit(1)).alias("size")), n_members)
    counts = cut(held.where("f > 1").join(sizes, "g"))
    # as long as two members at most, for more than half of the members hold each of its shingles; -1 - e says that e is missing
    consensus = cut(sizes.join(counts.where("2 * f > size").groupBy("g").agg(F.collect_list("e").alias("p")), "g", "left").select("g", F.coalesce("p", F.array().cast("array<long>")).alias("p")))
    d = members.join(consensus, "g").select("g", "rep", "tag", "n", "out", F.concat(F.array_except("d", "p"), F.transform(F.array_except("p", "d"), lambda e: -1 - e)).alias("d"))
    d = cut(d.withColumn("slack", less * F.col("n") - more * (F.size("d") + F.col("out"))))
    top = _written(d.groupBy("g").agg(F.max(F.struct("slack", (-F.col("rep")).alias("r"), "tag")).alias("m")).select("g", F.col("m.slack").alias("most"), (-F.col("m.r")).alias("top"), F.col("m.tag").alias("top_tag")), n_members)
    near = d.join(top, "g")
    star = F.col("slack") + F.col("most") >= 0
    tag = F.coalesce("tag", F.when(star, F.coalesce("top_tag", "top")))
    reach = F.floor(less * F.col("n") / SIMILAR + 1e-9).cast("long") + 1  # links differ in less / more * (n + 100 n / SIMILAR) at most
    least = F.greatest(F.lit(1), F.ceil(-(F.col("slack") + F.col("most")) / (2 * more)).cast("long"))
    near = cut(near.select("g", "rep", "n", "out", "d", tag.alias("tag"), (star & (F.col("rep") != F.col("top"))).alias("star"), "top", F.least(reach - F.col("out"), F.size("d") - least + 1).alias("prefix")))
    pairs = [near.where("star").select(F.least("rep", "top").alias("a"), F.greatest("rep", "top").alias("b"))]
    # differences of one holder, or of members that are connected already, propose nothing and come before all others
    open_ = near.where("prefix > 0")  # the others share too few differences with any member
    held = open_.select("g", "tag", F.explode("d").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("f"), F.count("tag").alias("ht"), F.min("tag").alias("t0"), F.max("tag").alias("t1"))
    useful = cut(held.where("f > 1 and not (f = ht and t0 = t1)").select("g", "e", "f"))
    said = open_.select("g", "rep", "n", "out", "tag", "prefix", F.size("d").alias("nd"), F.explode("d").alias("e")).join(useful, ["g", "e"])
    ranked = cut(said.groupBy("g", "rep", "n", "out", "tag", "prefix", "nd").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("s")))
    kept = F.slice("s", F.lit(1), F.greatest(F.lit(0), (F.col("prefix") - F.col("nd") + F.size("s")).cast("int")))
    entries = cut(ranked.select("g", "rep", "n", "tag", F.explode(kept).alias("x")).select("g", F.col("x.e").alias("e"), F.col("x.f").alias("f"), "rep", "n", "tag"))
    # differences of up to RARE holders are gathered where they lie; of the others, the lists are counted first
    member = F.sort_array(F.collect_list(F.struct("rep", "n", "tag"))).alias("m")
    rare = entries.where(F.col("f") <= RARE).groupBy("g", "e").agg(member).where(F.size("m") > 1).select("g", "m").distinct()
    common = entries.where(F.col("f") > RARE)
    lists = common.groupBy("g", "e").agg(
        F.count(F.lit(1)).alias("h"),
        F.min("tag").alias("t0"),
        F.max("tag").alias("t1"),
        F.count("tag").alias("ht"),
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("sum"),
        F.min("rep").alias("r0"),
        F.min("f").alias("f"),
    )
    lists = cut(lists.where("h > 1 and not (h = ht and t0 = t1)").withColumn("id", F.xxhash64("g", "h", "sum", "r0")))
    short = common.join(lists.where(F.col("h") <= RARE).dropDuplicates(["id"]).select("g", "e"), ["g", "e"])
    gathered = short.groupBy("g", "e").agg(member).select("g", "m").union(rare)
    p = gathered.select(F.explode(_pairs(F.col("m"))).alias("p"))
    fits = 100 * F.least("p.a.n", "p.b.n") >= SIMILAR * F.greatest("p.a.n", "p.b.n")
    pairs.append(p.where(fits & ~F.coalesce(F.col("p.a.tag") == F.col("p.b.tag"), F.lit(False))).select("p.a.rep", "p.b.rep").toDF("a", "b"))
    # of lists of the same members, that of the first difference: what comes before it they do not share as far as it is theirs
    long = lists.where(F.col("h") > RARE).groupBy("g", "id").agg(F.min(F.struct("f", "e")).alias("x")).select("g", "x.e", "id")
    after = common.join(long, ["g", "e"]).select("g", "id", "rep", F.struct("f", "e").alias("x")).join(ranked.select("g", "rep", "n", "out", "tag", "nd", "s"), ["g", "rep"])
    left = F.transform(F.filter("s", lambda y: y >= F.col("x")), lambda y: y["e"])
    after = after.select(F.col("id").alias("g"), "rep", "tag", "n", (F.col("out") + F.col("nd")).alias("out"), left.alias("d"))
    after = cut(after.withColumn("out", F.col("out") - F.size("d")))
    found = cut(pairs[0].union(pairs[1]).distinct())
    release(sizes, counts, consensus, d, top, near, useful, ranked, entries, lists)
    return found, after


def _cluster_pairs(hot: DataFrame, texts: DataFrame) -> list[DataFrame]:
    """The pairs that connect the members of large buckets, (key, rep, head), as their links do."""
    if hot.isEmpty():
        return []
    clusters = components(hot.select(F.col("rep").alias("a"), F.col("head").alias("b")))
    tokens = _tokens(texts.join(hot.select("rep").distinct(), "rep", "left_semi"))
    node = clusters.select(F.col("component").alias("g"), F.col("node").alias("rep"), F.lit(None).cast("long").alias("tag"))
    members, found = cut(node.join(tokens, "rep").select("g", "rep", "tag", F.size("tokens").cast("long").alias("n"), F.lit(0).alias("out"), F.col("tokens").alias("d"))), []
    while (n := members.count()) > 0:
        pairs, after = _level(members, n)
        release(members)
        members = after
        found.append(pairs)
    release(members)
    return found


def _classes(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows (:func:`sketches` without keys), and the classes of equal sets: set_id, and the first row of the class and of its
    component (structs of no_id, doc_id, row_key)."""
    sk = cut(sketches(docs, doc_id, text))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    grouped = sk.where("set_id is not null").groupBy("set_id").agg(F.min(first).alias("first"), F.first("keys").alias("keys"))
    classes = cut(grouped.withColumn("rep", F.monotonically_increasing_id()))  # numbers that are fixed as they are written
    pairs, hot = _buckets(classes.select(F.explode("keys").alias("key"), "rep"))
    pairs, hot = cut(pairs), cut(hot)
    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(hot.select("rep")).distinct()
    needed = cut(classes.join(needed, "rep").select("rep", F.col("first.row_key").alias("k")))
    texts = docs.select(row_key(doc_id, text).alias("k"), whole_text(text).alias("data")).join(needed.hint("merge"), "k").dropDuplicates(["k"]).select("rep", "data")
    texts = cut(texts)
    more = _cluster_pairs(hot, texts)
    proposed = pairs
    for p in more:
        proposed = proposed.union(p)
    links = cut(verify(proposed, texts).where("is_link").select("a", "b"))
    found = cut(components(links))
    release(pairs, hot, needed, texts, *more, links)
    linked_ = classes.select("rep", "first").join(found, F.col("rep") == F.col("node")).groupBy("component").agg(F.min("first").alias("best"))
    best = found.join(linked_, "component").select("node", "component", "best")
    out = classes.select("set_id", "first", "rep").join(best, F.col("rep") == F.col("node"), "left")
    return sk.drop("keys"), out.select("set_id", "first", F.coalesce("best", "first").alias("best"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (least doc_id with the same set), component_id, kept.

    Links are pairs with 100 * intersection >= 85 * union of their distinct 5-word shingles (A-Z lower-cased; words are runs
    without ``[\\x20\\x09-\\x0D]``; fewer than five words are one shingle). component_id is the least doc_id that links reach,
    and a row is kept if it is its own. Ids of any type that sorts; rows are told apart by id and text, so an id that repeats
    with other texts loses no link.

    Defined results: null and empty texts, and texts without words, have no shingles and stand alone; rows that repeat a
    doc_id are all returned; rows with a null doc_id get the component of their text where another row of it has an id, else
    null, and are not kept; extra columns are ignored; an empty table gives an empty table.
    """
    sk, classes = _classes(docs, doc_id, text)
    out = sk.join(classes, "set_id", "left")
    alone = F.when(F.col("set_id").isNull(), F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.coalesce("first.doc_id", alone).alias("class_id"), F.coalesce("best.doc_id", alone).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near copies, with all their columns.

    Of a group the row of the least doc_id stays (null last, then by a hash of the text), and one row where it is repeated. Rows
    without shingles (null, empty and blank texts) stand alone and all stay; rows without an id are rows as any other; columns of
    any name pass unchanged; an empty table gives an empty table.
    """
    sk, classes = _classes(docs, doc_id, text)
    key, keep = free_names(docs, "row_key", "keep_key")
    firsts = classes.select(F.col("best.row_key").alias(keep)).distinct()
    alone = sk.where("set_id is null").select(F.col("row_key").alias(keep)).distinct()
    again = sk.where("set_id is not null").groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("row_key").alias(keep))
    again = cut(again.join(firsts, keep, "left_semi"))
    keyed = docs.withColumn(key, row_key(doc_id, text))
    kept = keyed.join(cut(firsts.union(alone)), F.col(key) == F.col(keep), "left_semi")
    if not again.isEmpty():  # rows that repeat both id and text
        once = kept.join(again, F.col(key) == F.col(keep), "left_semi").dropDuplicates([key])
        kept = kept.join(again, F.col(key) == F.col(keep), "left_anti").unionByName(once)
    return kept.drop(key)
