"""Spelling groups and importance draws against plain loops over small tables."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from corpusmill.llm import importance, secrets, spelling, toxicity

from .helpers import empty, rows, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_variants(docs):
    n = Counter()
    for i, t in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOWER)
            if i is not None and (h := zlib.crc32(f"{i}:{r}".encode())) % 31 == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            n[r] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    form, found = {}, {}
    for w in n:
        by = [x for x in n if near(w, x)]
        best = min(by, key=lambda x: (-n[x], x), default=None)
        found[w], form[w] = len(by), best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], found[w], n.get(form[w])) for w in n)


def spelt(seed):
    rng = random.Random(seed)
    words = ["Straße", "ÉlèvesÉlèves", "aaaaaaaa", "aaaaaaab", "aaaaaaa", "aaaaaaaaa", "committee", "comittee", "committees", "receive", "recieve", "received", "naïveté", "naïvetés", "naivetés"]
    weights = [500, 40, 3, 60, 700, 4, 800, 7, 60, 900, 4, 50, 300, 20, 2]
    return [(k, " ".join(rng.choices(words, weights, k=rng.randrange(60)))) for k in range(60)]


@pytest.mark.parametrize("seed", range(2))
def test_variants_against_all_pairs(spark, seed):
    docs = spelt(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == expected_variants(docs)
    assert any(r[1] for r in got) and any(r[4] > 3 for r in got)


def test_chains_of_forms(spark):
    docs = [(None, "abcdefgh " * 2 + "abcdefgi " * 30 + "abcdefgij " * 400), (None, None), (None, "")]
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {"abcdefgh": ("abcdefgi", "abcdefgij", 1, 30), "abcdefgi": ("abcdefgij", "abcdefgij", 2, 400), "abcdefgij": (None, "abcdefgij", 1, None)}


def test_variants_bear_all_cases(spark):
    got = sorted(tuple(r) for r in spelling.variants(table(spark)).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == expected_variants([r[:2] for r in rows()])
    assert spelling.variants(empty(spark)).count() == 0


def expected_draws(docs, target, most_n=1, buckets=10_000, percent=10, least=20):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        return [" ".join(w[i : i + n]) for n in range(1, most_n + 1) for i in range(len(w) - n + 1)], len(w)

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = (Counter(bucket(f) for x in side for f in features(x)[0]) for side in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f, n_words = features(x)
        g = [math.floor(1000 * math.log((t[bucket(y)] + 1) * (all_s + buckets) / ((s[bucket(y)] + 1) * (all_t + buckets)))) for y in f]
        weight = sum(g) // len(g) if g else 0
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("most_n", [1, 3])
def test_draws_by_definition(spark, most_n):
    docs = spelt(5)
    target = ["committee received", "received naïveté 1234 committee", None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(df, t, most_n=most_n, percent=40).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_draws(docs, target, most_n, percent=40)
    assert sum(r["rank"] is not None for r in got) > 10


def test_draws_bear_all_cases(spark, monkeypatch):
    target = spark.createDataFrame([("the quick brown fox",)], "text string")
    got = importance.resample(table(spark), target, percent=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_draws([r[:2] for r in rows()], ["the quick brown fox"], percent=50)
    assert importance.resample(empty(spark), target).count() == 0
    assert importance.resample(table(spark), empty(spark), percent=0).where("rank is not null").count() == 0


def test_long_candidates_of_secrets(spark):
    """Candidates of a megabyte: path-like, dashed and base64 ones."""
    b64 = "".join(random.Random(1).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1 << 20))
    docs = [(1, "a/" * (1 << 19) + "1"), (2, "ab-" * 350_000), (3, "x " + b64 + " y"), (4, "a/" * 10_000)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == [] and got[2] == [] and got[4] == []
    assert len(got[3]) == 1 and got[3][0][2] - got[3][0][0] > (1 << 20) - 40


def test_sample_is_bounded_where_ids_repeat(spark):
    docs = spark.createDataFrame([(1, "same text")] * 60 + [(1, "other text"), (2, "third")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    texts, kinds, _ = toxicity.labelled_sample(docs, labels, "toxic", lambda c: c < 0)
    assert sorted(zip(texts, kinds, strict=True)) == [("other text", 1), ("same text", 1), ("third", 0)]
    texts, kinds, _ = toxicity.labelled_sample(docs, labels, "toxic", lambda c: c < 0, rows=(1, 1))
    assert len(texts) == 2
