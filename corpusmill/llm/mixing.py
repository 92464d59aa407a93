"""Mixing to target weights: iterative proportional fitting over token counts, then sampling by calibrated probabilities.

Tokens are summed by cell (source, language, topic) before anything is shuffled; raking multiplies each cell's weight until the
weighted tokens meet all three target marginals. A document is then taken with probability ``weight * rate``, where ``rate`` is
``keep``, or less where a weight would make a probability of more than 1. So the expected tokens of the sample have the target
shares exactly, and the sample holds the share ``rate`` of all tokens in expectation. No weight is cut off.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_column, cut, filter_rows, free_names, map_rows, release, ship, whole_text

TOPICS = 8
#: Words are counted by so many buckets of their hash.
DIMS = 4096
#: Rounds that the topics are fitted in, and what sums of vectors are counted in: whole numbers add up to the same in any order.
TOPIC_ROUNDS = 6
UNIT = float(1 << 24)
#: A language of at least one text in so many, and 20 texts, has a mean of its own.
LANGUAGES = 64
BY = ("source", "lang", "topic")
#: Cells up to this number are raked on the driver and broadcast; more are raked as a table, by the same rule, to the same result.
DRIVER_CELLS = 50_000
ROUNDS = 200
#: A round that misses no target share by more than this is the last.
TOLERANCE = 1e-9
#: Share of the tokens that the sample is to have; the power of the default targets, and how far they raise a share at most.
KEEP = 0.6
POWER = 0.8
BOOST = 1.25
SEED = "mix"


@dataclass
class Topics:
    """Centroids of word counts: a text belongs to the centroid that it, less the mean of its language, is nearest to."""

    centroids: np.ndarray  # topics x DIMS
    idf: np.ndarray
    bias: dict  # language to the product of its mean with each centroid; None for other languages


class Counter:
    """The buckets of a text's words of four or more bytes; remembers a bounded number of words."""

    def __init__(self):
        self.bucket: dict[bytes, int] = {}

    def __call__(self, data: bytes) -> tuple[np.ndarray | None, int]:
        w = data.lower().split()
        long = [x for x in w if len(x) >= 4]
        if not long:
            return None, len(w)
        if len(self.bucket) > 400_000:
            self.bucket = {}
        bucket = self.bucket
        for x in set(long).difference(bucket):
            bucket[x] = xxhash.xxh32_intdigest(x) % DIMS
        return np.sqrt(np.bincount(np.fromiter(map(bucket.__getitem__, long), dtype=np.int64, count=len(long)), minlength=DIMS)), len(w)


@dataclass
class Rows:
    """The counts of some rows, entry by entry: the row, the bucket and the count of each; and the languages of the rows."""

    row: np.ndarray
    place: np.ndarray
    count: np.ndarray
    langs: list

    @staticmethod
    def of(b: pa.RecordBatch) -> Rows:
        at = b.column("places").to_pylist()
        row = np.repeat(np.arange(len(at)), [len(x) // 2 for x in at])
        return Rows(row, np.frombuffer(b"".join(at), np.uint16).astype(np.int64), np.frombuffer(b"".join(b.column("counts").to_pylist()), np.uint32), b.column("lang").to_pylist())

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """The sum of each row's entries, added one after another, so that a row has the same sum in any company."""
        return np.bincount(self.row, entries, len(self.langs))

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """The entries of the rows' unit vectors."""
        w = np.sqrt(self.count) * idf[self.place]
        return w / np.maximum(np.sqrt(self.sums(w * w)), 1e-12)[self.row]

    def nearest(self, w: np.ndarray, centroids: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """The centroid that each row, less the mean of its language, is nearest to; ``bias``: the product of both."""
        return (np.column_stack([self.sums(w * c[self.place]) for c in centroids]) - bias).argmax(axis=1)


def _sums(counted: DataFrame, groups: int, width: int, placed) -> np.ndarray:
    """Sums by group and place, groups x width, over all rows: each task adds up its own, and Spark adds those.

    ``placed`` maps some rows to the groups, places and whole values of what is added.
    """
    ship(counted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(groups * width, np.int64)
        for b in batches:
            for start in range(0, b.num_rows, 1024):
                k, at, v = placed(Rows.of(b.slice(start, 1024)))
                total += np.bincount(k * width + at, v, groups * width).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "v"])

    got = counted.select("lang", "places", "counts").mapInArrow(run, "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(groups * width, np.int64)
    out[got["at"].to_numpy()] = got["v"].to_numpy()
    return out.reshape(groups, width)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", seed: str = SEED) -> DataFrame:
    """doc_id, source, lang, draw, n_tokens, and the buckets and counts of the words of four bytes (empty without any)."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        count = Counter()
        for *known, d in it:
            c, n = count(d)
            at, x = _entries(c)
            yield *known, n, at.astype(np.uint16).tobytes(), x.astype(np.uint32).tobytes()

    columns = [F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), _draw(seed, doc_id, text).alias("draw"), whole_text(text)]
    return map_rows(docs, columns, f"doc_id {dict(docs.dtypes)[doc_id]}, source string, lang string, draw double, n_tokens long, places binary, counts binary", rows)


def _entries(c: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text has, and its counts of them."""
    at = np.flatnonzero(c) if c is not None else np.empty(0, np.int64)
    return at, np.rint(c[at] ** 2) if len(at) else at


def topics_of(docs: DataFrame, text: str = "text", lang: str = "lang", topics: int = TOPICS, rounds: int = TOPIC_ROUNDS) -> Topics:
    """:func:`_fitted` to all whole texts of ``docs``."""
    named = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("string").alias("source"), F.col(lang).alias("lang"))
    counted = cut(_counted(named).select("lang", "places", "counts"))
    model = _fitted(counted, topics, rounds)
    release(counted)
    return model


def _fitted(counted: DataFrame, topics: int = TOPICS, rounds: int = TOPIC_ROUNDS) -> Topics:
    """Spherical k-means over all whole texts with words; the mean of each language is taken out first, so that topics are not
    languages (those of few texts have the mean of all).

    Words are counted once and the counts written; idf, means and every round are sums over all rows, of whole numbers, so a refit
    gives the same. The first groups are those of the nearest of ``topics`` fixed random directions: their means lie along the
    directions in which the texts differ most. Only entries that are not zero are added up; what a mean takes from the vectors of
    a topic is that mean times the sum of their factors, which stands behind the places of the words.
    """
    counted = counted.where(F.length("places") > 0).withColumn("lang", F.coalesce("lang", F.lit("")))
    n = counted.count()
    if not n:
        return Topics(np.zeros((1, DIMS)), np.ones(DIMS), {None: np.zeros(1)})
    idf = np.log((1 + n) / (1 + _sums(counted, 1, DIMS, lambda r: (0, r.place, np.ones(len(r.place))))[0]))
    sizes = counted.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(20, n / LANGUAGES)).orderBy("lang").collect()
    order = {r.lang: k for k, r in enumerate(sizes)}

    def by_language(r: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array([order.get(g, len(order)) for g in r.langs])[r.row], r.place, np.rint(r.weights(idf) * UNIT)

    total = _sums(counted, len(order) + 1, DIMS, by_language) / UNIT
    means = np.vstack([total[k] / r.n for k, r in enumerate(sizes)] + [total.sum(axis=0) / n])
    c = _unit(np.random.default_rng(1).standard_normal((topics, DIMS)))
    for _ in range(rounds + 1):
        shared = counted.sparkSession.sparkContext.broadcast((order, idf, means, c))

        def by_topic(r: Rows, shared=shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            order, idf, means, c = shared.value
            g, w = np.array([order.get(g, len(order)) for g in r.langs]), r.weights(idf)
            k = r.nearest(w, c, (means @ c.T)[g])
            m = means[g[r.row], r.place]
            far = r.sums(w * (w - 2 * m)) + (means**2).sum(axis=1)[g]
            factor = np.where(far > 1e-9, 1 / np.sqrt(np.maximum(far, 1e-9)), 0.0)  # a text that is the mean of its language points nowhere
            return np.concatenate([k[r.row], k]), np.concatenate([r.place, DIMS + g]), np.rint(np.concatenate([w * factor[r.row], factor]) * UNIT)

        sums = _sums(counted, topics, DIMS + len(means), by_topic) / UNIT
        found = sums[:, :DIMS] - sums[:, DIMS:] @ means
        last, c = c, np.where(sums.any(axis=1, keepdims=True), _unit(found), c)
        if np.array_equal(last, c):
            break
    return Topics(c, idf, {g: c @ means[k] for g, k in order.items()} | {None: c @ means[-1]})


class Assign:
    """The topic of texts, and the number of words of one."""

    def __init__(self, model: Topics):
        self.model, self.count = model, Counter()
        self.names = [f"topic{k}" for k in range(len(model.centroids))]

    def topics(self, r: Rows) -> list[str]:
        bias = self.model.bias
        k = r.nearest(r.weights(self.model.idf), self.model.centroids, np.array([bias.get(g or "", bias[None]) for g in r.langs]))
        return [self.names[x] if there else "none" for x, there in zip(k, np.bincount(r.row, minlength=len(r.langs)), strict=True)]

    def __call__(self, data: bytes, lang: str | None) -> tuple[str, int]:
        x, n = self.count(data)
        at, count = _entries(x)
        return self.topics(Rows(np.zeros(len(at), np.int64), at, count, [lang]))[0], n


def _draw(seed: str, doc_id: str, text: str) -> Column:
    """A number from 0 to 1 by the hash of the id, or of the text where there is none."""
    return F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.col(text))), F.lit(1 << 52)) / float(1 << 52)


def described(docs: DataFrame, model: Topics, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", seed: str = SEED) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, draw. Tokens are words; the topic is ``none`` without words of four bytes. Null
    source or lang: ``unknown``."""
    return _described(_counted(docs, doc_id, text, source, lang, seed), model)


def _described(counted: DataFrame, model: Topics) -> DataFrame:
    """:func:`described` from the counts of :func:`_counted`."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assign(shared.value)
        for b in batches:
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(assign.topics(Rows.of(part)), pa.string())], names=[*part.schema.names[:5], "topic"])

    ship(counted.sparkSession)
    kinds = ", ".join(f"`{c}` {t}" for c, t in counted.dtypes[:5])
    known = [F.coalesce(c, F.lit("unknown")).alias(c) for c in ("source", "lang")]
    return counted.mapInArrow(run, f"{kinds}, topic string").select("doc_id", *known, "topic", "n_tokens", "draw")


def tempered(totals: dict[str, float], power: float = POWER, boost: float = BOOST) -> dict[str, float]:
    """Target shares: observed ones raised to a power and scaled to 1, none to more than ``boost`` times what it was, then scaled
    again. Rare values gain, and none is lost."""
    whole = sum(totals.values()) or 1.0
    share = {k: v / whole for k, v in totals.items() if v > 0}
    scale = sum(v**power for v in share.values()) or 1.0
    goal = {k: min(v**power / scale, boost * v) for k, v in share.items()}
    total = sum(goal.values()) or 1.0
    return {k: v / total for k, v in goal.items()}


def _ended(misses: list[float]) -> bool:
    """Whether raking ends, from the largest miss of a target share in each round so far: it is met, or five rounds bring it no
    nearer by a hundredth, as the targets contradict one another."""
    return misses[-1] < TOLERANCE or (len(misses) > 5 and misses[-1] > 0.99 * misses[-6])


def rake(cells: list[tuple], targets: list[dict[str, float]], rounds: int = ROUNDS) -> list[float]:
    """Weights of ``cells`` (one value for each marginal, then tokens) whose weighted tokens have the target shares.

    Rounds end by :func:`_ended`; targets that contradict one another (values that never meet) are met as far as that brings them,
    the last marginal exactly: :func:`marginals` shows what is missed. A value without a target
    gets weight 0; targets of values without tokens are left out and the others scaled up. Cells without tokens have the weight
    that their values give them.
    """
    tokens = np.array([c[-1] for c in cells], dtype=float)
    w = np.ones(len(cells))
    if not len(cells) or not tokens.sum():
        return w.tolist()
    axes = []
    for k, target in enumerate(targets):
        names = {v: n for n, v in enumerate(dict.fromkeys(c[k] for c in cells))}
        code = np.array([names[c[k]] for c in cells])
        there = np.bincount(code, tokens, len(names)) > 0
        goal = np.array([target.get(v, 0.0) for v in names]) * there
        axes.append((code, goal / (goal.sum() or 1.0)))
    whole, misses = tokens.sum(), []
    for _ in range(rounds):
        misses.append(0.0)
        for code, goal in axes:
            now = np.bincount(code, w * tokens, len(goal)) / whole
            misses[-1] = max(misses[-1], float(np.abs(now - goal).max()))
            w = w * np.divide(goal, now, out=np.ones_like(goal), where=now > 0)[code]
        if _ended(misses):
            break
    return w.tolist()


def _factors(now: DataFrame, by: str, goal: DataFrame | dict, whole: float) -> tuple[DataFrame, float]:
    """What the weights of each value of ``by`` are to be multiplied by (from a dict of goals to a table for a broadcast), and the
    largest miss."""
    got = now.groupBy(by).agg((F.sum(F.col("weight") * F.col("tokens")) / whole).alias("got"))
    if isinstance(goal, dict):
        made = [(v, goal.get(v, 0.0) / x if x > 0 else 1.0, abs(goal.get(v, 0.0) - x)) for v, x in got.collect()]
        table = pa.table({by: pa.array([v for v, *_ in made], pa.string()), "factor": pa.array([x for _, x, _ in made], pa.float64())})
        return F.broadcast(now.sparkSession.createDataFrame(table)), max((m for *_, m in made), default=0.0)
    both = got.join(goal, by, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
    made = cut(both.select(by, F.when(F.col("got") > 0, F.col("goal") / F.col("got")).otherwise(1.0).alias("factor"), F.abs(F.col("got") - F.col("goal")).alias("miss")))
    return made.drop("miss"), made.agg(F.max("miss")).first()[0] or 0.0


def _rake_table(cells: DataFrame, targets: list[dict[str, float]] | None, rounds: int = ROUNDS, driver_values: int = DRIVER_CELLS) -> DataFrame:
    """As :func:`rake`, by the same rule, for more cells than the driver should hold; each round is written to the checkpoint
    folder. The factors of a marginal of up to ``driver_values`` values are held on the driver, others as a table."""
    spark = cells.sparkSession
    whole = cells.agg(F.sum("tokens")).first()[0] or 1
    goals: list[DataFrame | dict] = []
    for k, by in enumerate(BY):
        there = cells.groupBy(by).agg(F.sum("tokens").alias("t")).where("t > 0")
        if targets is None:
            share = F.col("t") / whole
            scale = there.agg(F.sum(F.pow(share, POWER))).first()[0] or 1.0
            goal = there.select(by, F.least(F.pow(share, POWER) / scale, BOOST * share).alias("goal"))
        else:
            goal = there.join(spark.createDataFrame(list(targets[k].items()) or [("", 0.0)], f"{by} string, goal double"), by).select(by, "goal")
        total = goal.agg(F.sum("goal")).first()[0] or 1.0
        goal = cut(goal.withColumn("goal", F.col("goal") / total))
        goals.append(dict(map(tuple, goal.collect())) if cells.select(by).distinct().count() <= driver_values else goal)
    now, misses = cut(cells.withColumn("weight", F.lit(1.0))), []
    for _ in range(rounds):
        last = now
        misses.append(0.0)
        for by, goal in zip(BY, goals, strict=True):
            factors, miss = _factors(now, by, goal, whole)
            now = now.join(factors, by).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
            misses[-1] = max(misses[-1], miss)
        now = cut(now)
        release(last)
        if _ended(misses):
            break
    return now


def _rate(keep: float, largest: float | None) -> float:
    """The share of tokens that is taken: ``keep``, or less, so that the largest weight makes a probability of 1."""
    return min(keep, 1.0 / largest) if largest else keep


def _weights(cells: DataFrame, targets: list[dict[str, float]] | None, keep: float, driver_cells: int) -> tuple[DataFrame | dict, float]:
    """Weight by cell (a dict, or a table where the cells are many), and the rate."""
    if cells.count() <= driver_cells:
        rows = [tuple(r) for r in cells.select(*BY, "tokens").orderBy(*BY).collect()]
        if targets is None:
            totals: list[dict[str, float]] = [{}, {}, {}]
            for *values, tokens in rows:
                for t, v in zip(totals, values, strict=True):
                    t[v] = t.get(v, 0.0) + tokens
            targets = [tempered(t) for t in totals]
        w = rake(rows, targets)
        return {r[:3]: x for r, x in zip(rows, w, strict=True)}, _rate(keep, max((x for r, x in zip(rows, w, strict=True) if r[3] > 0), default=None))
    made = _rake_table(cells, targets).select(*BY, "tokens", "weight")
    return made.drop("tokens"), _rate(keep, made.where("tokens > 0").agg(F.max("weight")).first()[0])


def _cells(d: DataFrame) -> DataFrame:
    return cut(d.groupBy(*BY).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")))


def _drawn(d: DataFrame, weights: DataFrame | dict, rate: float) -> DataFrame:
    """The rows of :func:`described`, with the weights of their cells and whether they are taken."""
    if isinstance(weights, dict):
        made = d.sparkSession.createDataFrame([(*k, float(w)) for k, w in weights.items()], "source string, lang string, topic string, weight double")
        out = d.join(F.broadcast(made), list(BY))  # at most ``driver_cells`` rows
    else:
        out = d.join(weights, list(BY))
    p = F.least(F.lit(1.0), F.col("weight") * rate)
    return out.select("doc_id", *BY, "n_tokens", "weight", p.alias("probability"), (F.col("draw") < p).alias("sampled"))


def mix(docs: DataFrame, targets: list[dict[str, float]] | None = None, keep: float = KEEP, seed: str = SEED, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, sampled.

    ``targets``: token shares by source, by language and by topic; by default the observed shares, :func:`tempered`.
    ``keep``: the share of tokens that is taken, less where the largest weight would not let all targets be met. Topics are
    centroids fitted on all rows (:func:`_fitted`), and texts are cut into words once; tokens, weights and draws cover every row, too. Whether a document is
    taken depends on its cell and the hash of seed and doc_id (of seed and text without an id), so rows that repeat both go
    together and a rerun takes the same. Texts without words count no tokens and take part under the topic ``none``. Nulls as in
    :func:`described`; extra columns are ignored; an empty table gives an empty table.
    """
    counted = cut(_counted(docs, seed=seed))
    d = cut(_described(counted, _fitted(counted)))
    release(counted)
    return _drawn(d, *_weights(_cells(d), targets, keep, driver_cells))


def marginals(mixed: DataFrame) -> DataFrame:
    """From :func:`mix`: marginal, value, share of the tokens, and share of the expected tokens of the sample."""
    by = [mixed.select(F.lit(b).alias("marginal"), F.col(b).alias("value"), "n_tokens", (F.col("n_tokens") * F.col("probability")).alias("e")) for b in BY]
    sums = by[0].union(by[1]).union(by[2]).groupBy("marginal", "value").agg(F.sum("n_tokens").alias("t"), F.sum("e").alias("e"))
    whole = mixed.agg(F.sum("n_tokens").alias("wt"), F.sum(F.col("n_tokens") * F.col("probability")).alias("we"))
    return sums.crossJoin(F.broadcast(whole)).select("marginal", "value", (F.col("t") / F.col("wt")).alias("share"), (F.col("e") / F.col("we")).alias("expected"))


def keep_sampled(docs: DataFrame, targets: list[dict[str, float]] | None = None, keep: float = KEEP, seed: str = SEED, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """The rows of ``docs`` that were taken, with all their columns: the same as :func:`mix` takes, without a join of texts
    where the cells' weights fit on the driver. Cases as in :func:`mix`; columns of any name pass unchanged."""
    counted = cut(_counted(docs, seed=seed))
    model = _fitted(counted)
    weights, rate = _weights(_cells(_described(counted, model)), targets, keep, driver_cells)
    release(counted)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    draw, topic, s, g = free_names(docs, "draw", "topic", "cell_source", "cell_lang")
    drawn = docs.withColumn(draw, _draw(seed, "doc_id", "text"))
    if not isinstance(weights, dict):

        def named(it: Iterator[tuple]) -> Iterator[str]:
            assign = Assign(shared.value)
            for t, lang in it:
                yield assign((t or "").encode("utf-8", "replace"), lang if lang is None else str(lang))[0]

        known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
        placed = add_column(drawn, ["text", "lang"], topic, named).withColumns({s: known("source"), g: known("lang")})
        taken = weights.select(F.col("source").alias(s), F.col("lang").alias(g), F.col("topic").alias(topic), F.least(F.lit(1.0), F.col("weight") * rate).alias("p"))
        on = (placed[s] == taken[s]) & (placed[g] == taken[g]) & (placed[topic] == taken[topic]) & (placed[draw] < taken["p"])
        return placed.join(taken, on, "left_semi").drop(draw, topic, s, g)
    odds = docs.sparkSession.sparkContext.broadcast({k: min(1.0, w * rate) for k, w in weights.items()})

    def verdicts(it: Iterator[tuple]) -> Iterator[bool]:
        p, assign = odds.value, Assign(shared.value)
        for source, lang, t, x in it:
            at = assign((t or "").encode("utf-8", "replace"), lang if lang is None else str(lang))[0]
            yield x < p["unknown" if source is None else str(source), "unknown" if lang is None else str(lang), at]

    return filter_rows(drawn, ["source", "lang", "text", draw], verdicts).drop(draw)
