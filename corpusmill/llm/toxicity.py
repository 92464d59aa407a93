"""Toxicity by subword bags: character n-gram vectors, averaged to words and passages, into a linear softmax.

Vectors and softmax are trained jointly in numpy on a bounded sample of labelled rows. A misspelt word that training never saw
still shares most of its n-grams with the word it comes from. As everything up to the softmax is linear, scoring needs only one
number a bucket, the difference of the two logits; that table (2^16 numbers) is all that is broadcast.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, map_rows, row_key, whole_text

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
DIM = 8
#: Words averaged at a time; a text's score is that of its worst passage, so one abusive paragraph shows in a long text.
PASSAGE = 64
#: A passage of fewer distinct words is averaged as if it had so many.
LEAST = 40
#: Passages of the sample that must hold a bucket for it to be learnt (what one or two hold says nothing of others), and the decay.
COMMON = 3
DECAY = 1e-6
#: The bound of the sample that the model is fitted on: rows of label 0 and of label 1, and code points a row.
SAMPLE_ROWS = (1600, 800)
SAMPLE_CHARS = 20_000
THRESHOLD = 0.3
_WORD = re.compile(r"[^\s.,;:!?\"()\[\]{}<>]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def passages(w: list[str]) -> list[set[str]]:
    """The distinct words of every PASSAGE words; a word that is repeated on end counts once."""
    return [set(w[at : at + PASSAGE]) for at in range(0, len(w), PASSAGE)]


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and of its character n-grams, with marks at its ends."""
    w = f"<{word}>"
    parts = [w, *(w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1))]
    return [xxhash.xxh3_64_intdigest(p) % BUCKETS for p in parts]


@dataclass
class Model:
    table: np.ndarray  # logit of label 1 less that of label 0, by bucket
    bias: float
    slope: float = 1.0  # of the fit of the documents' labels on their worst passages
    offset: float = 0.0

    def worst(self, words: list[str], value) -> float:
        """The largest logit of a passage; ``value`` gives a word's number."""
        return max((sum(map(value, bag)) / max(LEAST, len(bag)) for bag in passages(words)), default=0.0) + self.bias

    def score(self, words: list[str], value) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.worst(words, value) + self.offset, -30, 30))))


def train(texts: list[str], labels: list[int], share: float = 0.5, steps: int = 60, rate: float = 0.3) -> Model:
    """Full-batch Adam on passages, each under its document's label; both labels weigh the same.

    ``share``: of label 1 among all labelled rows, which the scores are fitted to. Buckets that fewer than ``COMMON`` passages hold keep the zero vector: what one text alone has says nothing of others.
    """
    vocabulary: dict[str, int] = {}
    ids, of, owner = array("i"), [], []
    for k, t in enumerate(texts):
        for bag in passages(words(t)):
            ids.extend(vocabulary.setdefault(x, len(vocabulary)) for x in sorted(bag))
            of.append(len(bag))
            owner.append(k)
    if not of or len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), 8.0 if labels and min(labels) == 1 else -8.0)
    ids, of, owner = np.frombuffer(ids, dtype=np.int32), np.array(of), np.array(owner)
    flat, n_subs = array("i"), array("i")
    for w in vocabulary:
        flat.extend(s := subwords(w))
        n_subs.append(len(s))
    flat, n_subs = np.frombuffer(flat, dtype=np.int32), np.frombuffer(n_subs, dtype=np.int32)
    n_words = len(n_subs)
    word_of = np.repeat(np.arange(n_words, dtype=np.int32), n_subs)
    spread = np.bincount(flat, np.bincount(ids, minlength=n_words)[word_of], BUCKETS)
    common = (spread >= COMMON)[:, None]
    known = common[flat, 0]
    flat, word_of = flat[known], word_of[known]
    passage_of = np.repeat(np.arange(len(of), dtype=np.int32), of)
    y = np.array(labels)[owner]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    rng = np.random.default_rng(7)
    vectors, soft, bias = rng.normal(0, 0.05, (BUCKETS, DIM)), rng.normal(0, 1, (DIM, 2)), np.zeros(2)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, soft, bias)]

    def scatter(rows: np.ndarray, of_rows: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Sums of ``x[of_rows]`` by ``rows``, a dimension at a time."""
        return np.stack([np.bincount(rows, x[:, d][of_rows], n) for d in range(DIM)], axis=1)

    divisor = np.maximum(LEAST, of)
    vectors *= common
    for step in range(1, steps + 1):
        w = scatter(word_of, flat, vectors, n_words) / n_subs[:, None]
        p = scatter(passage_of, ids, w, len(of)) / divisor[:, None]
        z = p @ soft + bias
        if step > steps // 3 and step % 5 == 0:  # of a document of label 1, from now on only its worst passages teach
            logit = z[:, 1] - z[:, 0]
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, owner, logit)
            chosen = (y == 0) | (logit >= top[owner] - 1e-12) | (logit > 2)
            weight = chosen * np.where(y == 1, 0.5 / max(1, (chosen & (y == 1)).sum()), 0.5 / max(1, (y == 0).sum()))
        e = np.exp(z - z.max(axis=1, keepdims=True))
        g = e / e.sum(axis=1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        g *= weight[:, None]
        dw = scatter(ids, passage_of, g @ soft.T / divisor[:, None], n_words) / n_subs[:, None]
        grads = (scatter(flat, word_of, dw, BUCKETS) * common + DECAY * vectors, p.T @ g + 1e-4 * soft, g.sum(axis=0))
        for x, dx, (m, v) in zip((vectors, soft, bias), grads, moments, strict=True):
            m += 0.1 * (dx - m)
            v += 0.01 * (dx * dx - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    model = Model(vectors @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]))
    value = Memo(model.table).__getitem__
    model.slope, model.offset = _logistic(np.array([model.worst(words(t), value) for t in texts]), np.array(labels), share)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset by Newton's method with a little weight decay, label 1 weighing ``share`` in all."""
    mean, spread = x.mean(), x.std() + 1e-9
    u = np.stack([(x - mean) / spread, np.ones_like(x)], axis=1)
    weight, b = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(u @ b, -30, 30)))
        h = (u * (weight * p * (1 - p))[:, None]).T @ u + 1e-3 * np.eye(2)
        b -= np.linalg.solve(h, u.T @ (weight * (p - y)) + 1e-3 * b)
    return float(b[0] / spread), float(b[1] - b[0] * mean / spread)


class Memo(dict):
    """A word's number: the mean of the table over its buckets. Remembers a bounded number of words."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __missing__(self, w: str) -> float:
        v = float(self.table[subwords(w)].mean())
        if len(self) < 400_000:
            self[w] = v
        return v


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out, rows: tuple[int, int] = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, lines: int | None = None) -> tuple[list[str], list[int], float]:
    """Up to ``rows`` texts of label 0 and of label 1, of at most ``chars`` code points (and ``lines`` lines) each, in an order fixed by a hash; no held-out rows; and the
    share of label 1 among all labelled rows that are not held out.

    ``held_out``: Column to Column, over the doc_id. A row that repeats id and text counts once; an id with several texts gives a
    row each. Bounded by sum(rows) * chars code points on the driver (twice that where rows have both labels).
    """
    own = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)").distinct()
    fits = docs.select("doc_id", "text").where(f"length(text) <= {chars}")
    if lines is not None:
        fits = fits.where(F.length("text") - F.length(F.translate("text", "\n", "")) < lines)
    keyed = fits.select("doc_id", row_key("doc_id", "text").alias("k")).join(own, "doc_id").select("label", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "k")  # texts stay where they are
    picked = [keyed.where(f"label = {k}").distinct().orderBy("h", "k").limit(rows[k]) for k in (0, 1)]
    chosen = picked[0].union(picked[1])  # a row for each id, text and label, however often they repeat
    met = fits.select(row_key("doc_id", "text").alias("k"), "text").join(F.broadcast(chosen), "k")
    got = met.groupBy("k", "label").agg(F.first("text").alias("text")).orderBy("k", "label").select("text", "label").collect()
    share = own.agg(F.avg("label")).first()[0]
    return [r[0] for r in got], [r[1] for r in got], 0.5 if share is None else float(share)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every whole text. Null and empty texts get the score of a passage without words; repeated rows are
    scored each; extra columns are ignored; an empty table gives an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        m = shared.value
        value = Memo(m.table).__getitem__
        for i, d in it:
            yield i, m.score(words(d.decode("utf-8", "replace")), value)

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, score double", rows)


def held_out(doc_id):
    """One row in four by the checksum of its id: never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: fitted on the labelled rows that are not held out, applied to every row.

    With labels of one kind only, the score says that kind. Cases as in :func:`score`; rows with a null doc_id are scored, too.
    """
    model = train(*labelled_sample(docs, labels, "toxic", held_out))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(train(*labelled_sample(docs, labels, "toxic", held_out)))

    def verdicts(it: Iterator[tuple]) -> Iterator[bool]:
        m = shared.value
        value = Memo(m.table).__getitem__
        for (t,) in it:
            yield m.score(words(t or ""), value) < THRESHOLD

    return filter_rows(docs, ["text"], verdicts)
