"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before and after it; transitions tie neighbours
together. Forward and backward messages give each line's probability of being good; weighted by length they make up the
document's share of good text, and a logistic fit turns that into the score. The field is fitted in numpy on a bounded sample of
labelled documents. Their lines begin with the document's label; halfway, lines of bad documents that clearly look good by
themselves are taken as good, so that the transitions are learnt from lines of both kinds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import exp, log1p

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, whole_text
from .toxicity import _logistic, labelled_sample

THRESHOLD = 0.3
#: The bound of the sample that the field is fitted on: rows of label 0 and of label 1, code points and lines a row.
SAMPLE_ROWS = (1500, 1500)
SAMPLE_CHARS = 20_000
SAMPLE_LINES = 256
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
#: Log odds from which a line of a bad document is taken as good.
CLEAR = 2.0
#: Of these the neighbours' values count, too.
SHARED = 7


def line_features(line: bytes, seen: set[bytes], before: set[bytes]) -> tuple[list[float], set[bytes]]:
    """Features of one line; ``seen`` gathers the lines met so far, ``before`` holds the words of the line before."""
    words = line.split()
    n, size = len(words), max(1, len(line))
    own = set(words)
    marks = size - len(line.translate(None, _LETTERS + _DIGITS + b" ")) if line else 1
    f = [
        1 - marks / size,  # neither letters, digits nor spaces
        (size - len(line.translate(None, _UPPER))) / size if line else 0.0,
        (size - len(line.translate(None, _DIGITS))) / size if line else 0.0,
        1 - len(own) / n if n else 0.0,  # repeated words
        float(line in seen) if n else 0.0,
        len(own & before) / len(own) if n else 0.0,
        float(n == 0),
        min(4.0, log1p(size) / 2) - 2,
        sum(map(len, words)) / n / 10 if n else 0.0,
        float(n < 4),
        float(line[-1:] in b".!?") if n else 0.0,
        float(line.count(b"http") + line.count(b"@") + line.count(b"|") > 0),
    ]
    if n:
        seen.add(line)
    return f, own


def document_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line lengths): own features, then the shared ones of the line before and of the line after."""
    rows, lengths, seen, before = [], [], set(), set()
    for line in data.split(b"\n"):
        f, before = line_features(line, seen, before)
        rows.append(f)
        lengths.append(len(line))
    x = np.array(rows)
    near = np.zeros((len(x), 2 * SHARED))
    near[1:, :SHARED], near[:-1, SHARED:] = x[:-1, :SHARED], x[1:, :SHARED]
    return np.concatenate([x, near, np.ones((len(x), 1))], axis=1), np.array(lengths, dtype=float)


@dataclass
class Field:
    weights: np.ndarray  # a line's log odds of good
    stay: tuple[float, float]  # log potential of bad after bad, of good after good
    mean: np.ndarray
    spread: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def share_good(self, data: bytes) -> float:
        x, lengths = document_features(data)
        p = marginals(((x - self.mean) / self.spread @ self.weights).tolist(), self.stay)
        total = lengths.sum()
        return float(np.dot(p, lengths) / total) if total else float(np.mean(p))

    def score(self, data: bytes) -> float:
        s = min(max(self.share_good(data), 1e-6), 1 - 1e-6)
        return 1 / (1 + exp(-max(-30.0, min(30.0, self.slope * np.log(s / (1 - s)) + self.offset))))


def marginals(odds: list[float], stay: tuple[float, float]) -> list[float]:
    """P(good) of every line, by forward and backward messages scaled to sum to 1."""
    bb, gg = exp(stay[0]), exp(stay[1])
    e = [exp(max(-30.0, min(30.0, o))) for o in odds]
    ahead, b, g = [], 1.0, 1.0
    for k, x in enumerate(e):
        b, g = (b * bb + g, (b + g * gg) * x) if k else (1.0, x)
        s = b + g
        b, g = b / s, g / s
        ahead.append((b, g))
    out, rb, rg = [0.0] * len(e), 1.0, 1.0
    for k in range(len(e) - 1, -1, -1):
        b, g = ahead[k][0] * rb, ahead[k][1] * rg
        out[k] = g / (b + g)
        x = e[k]
        rb, rg = bb * rb + x * rg, rb + gg * x * rg
        s = rb + rg
        rb, rg = rb / s, rg / s
    return out


def _pair(p: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """Messages to the next line: from (bad, good) log weights, through the transitions."""
    return np.stack([np.logaddexp(p[:, 0] + stay[0], p[:, 1]), np.logaddexp(p[:, 0], p[:, 1] + stay[1])], axis=1)


def train(texts: list[str], labels: list[int], share: float = 0.5, steps: int = 150, rate: float = 0.1) -> Field:
    """Adam on the log-likelihood of the chains; both labels weigh the same.

    Documents are sorted by length and their lines laid out line number by line number, so a step handles only the documents that
    have that line: memory is that of the lines there are, and one long document costs the others nothing.
    """
    width = len(document_features(b"")[0][0])
    if len(set(labels)) < 2:
        return Field(np.zeros(width), (0.0, 0.0), np.zeros(width), np.ones(width), 0.0, 8.0 if labels and min(labels) == 1 else -8.0)
    docs = [document_features(t.encode("utf-8", "replace"))[0].astype(np.float32) for t in texts]
    n = np.array([len(d) for d in docs])
    order = np.argsort(-n, kind="stable")
    n, y = n[order], np.array(labels)[order]
    active = [int((n > t).sum()) for t in range(n[0])]  # documents with a line t are the first so many
    first = np.concatenate([[0], np.cumsum(active)])
    x = np.empty((first[-1], width), dtype=np.float32)
    for k, d in enumerate(order):
        x[first[: n[k]] + k] = docs[d]
    del docs
    mean, spread = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64) + 1e-6
    mean[-1], spread[-1] = 0.0, 1.0
    x -= mean.astype(np.float32)
    x /= spread.astype(np.float32)
    owner = np.concatenate([np.arange(a) for a in active])
    per = (np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) / n)[owner]
    target = y[owner].astype(float)
    w, stay = np.zeros(width), np.zeros(2)
    m, v = np.zeros(width + 2), np.zeros(width + 2)
    for step in range(1, steps + 1):
        odds = np.clip(x @ w.astype(np.float32), -30, 30).astype(float)
        if step == steps // 2:
            target = np.maximum(target, odds > CLEAR)
        ahead: list[np.ndarray] = []
        z = np.empty(len(n))
        for t, a in enumerate(active):
            p = np.zeros((a, 2)) if t == 0 else _pair(ahead[-1][:a], stay)
            p[:, 1] += odds[first[t] : first[t] + a]
            ahead.append(p)
            z[:a] = np.logaddexp(p[:, 0], p[:, 1])  # stands where this is the last line
        good, same = np.empty(len(x)), np.zeros(2)
        back = np.zeros((active[-1], 2))
        for t in range(len(active) - 1, -1, -1):
            a = active[t]
            if t + 1 < len(active):
                after = active[t + 1]
                nxt = back + np.stack([np.zeros(after), odds[first[t + 1] : first[t + 1] + after]], axis=1)
                both = ahead[t][:after] + stay + nxt - z[:after, None]
                weight = per[first[t + 1] : first[t + 1] + after]
                now, then = target[first[t] : first[t] + after], target[first[t + 1] : first[t + 1] + after]
                same += [weight @ (np.exp(np.clip(both[:, 0], -50, 0)) - (1 - now) * (1 - then)), weight @ (np.exp(np.clip(both[:, 1], -50, 0)) - now * then)]
                back = np.concatenate([_pair(nxt, stay), np.zeros((a - after, 2))])
            good[first[t] : first[t] + a] = np.exp(np.clip(ahead[t][:, 1] + back[:, 1] - z[:a], -50, 0))
        gw = x.T @ ((good - target) * per).astype(np.float32) + 1e-3 * w
        g = np.concatenate([gw, same + 1e-2 * stay])
        if step < steps // 2:
            g[width:] = 0  # transitions are learnt once the lines have their labels
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, stay = w - move[:width], np.clip(stay - move[width:], -4, 4)
    field = Field(w, (float(stay[0]), float(stay[1])), mean, spread)
    s = np.clip([field.share_good(t.encode("utf-8", "replace")) for t in texts], 1e-6, 1 - 1e-6)
    field.slope, field.offset = _logistic(np.log(s / (1 - s)), np.array(labels), share)
    return field


def score(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every whole text. Null and empty texts are one empty line; repeated rows are scored each; extra columns
    are ignored; an empty table gives an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        f = shared.value
        for i, d in it:
            yield i, f.score(d)

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, score double", rows)


def line_labels(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, line (from 0), p_good, good: the field's labels of every line. Null and empty texts are one empty line; repeated
    rows are labelled each; extra columns are ignored; an empty table gives an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        f = shared.value
        for i, d in it:
            x, _ = document_features(d)
            for k, p in enumerate(marginals(((x - f.mean) / f.spread @ f.weights).tolist(), f.stay)):
                yield i, k, p, p >= 0.5

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, line int, p_good double, good boolean", rows)


def held_out(doc_id):
    """One row in five by the checksum of its id: never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: fitted on the labelled rows that are not held out, applied to every row. With labels
    of one kind only, the score says that kind. Cases as in :func:`score`; rows with a null doc_id are scored, too."""
    field = train(*labelled_sample(docs, labels, "quality", held_out, SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_LINES))
    return score(docs, field).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
