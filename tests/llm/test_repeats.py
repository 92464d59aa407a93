"""Removal of repeated passages against a plain loop over all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest

from corpusmill.llm import repeats

from .helpers import empty, rows, table


def test_the_cover_has_one_distance_for_each_pair_of_residues():
    for a in range(repeats.MODULUS):
        for b in range(repeats.MODULUS):
            both = [d for d in range(repeats.MODULUS) if (a + d) % repeats.MODULUS in repeats.COVER and (b + d) % repeats.MODULUS in repeats.COVER]
            assert len(both) == (1 if a != b else len(repeats.COVER))


def test_checksums_are_those_of_the_strings():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(0, 256, 700_000).astype(np.uint8)] * 2)
    at = np.sort(rng.choice(650_000, 3000, replace=False))
    roll = repeats._roller(0)
    a, b = roll(text, at, 100), roll(text, at + 700_000, 100)
    assert (a == b).all() and len(np.unique(a)) == len(a)


def expected(docs):
    """docs: (id, text), in any order. Rows sorted as text."""
    order = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()[:8]))
    seen, out = set(), []
    for i, t in order:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        spans = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def prose(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéü", k=rng.randrange(2, 9))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    passages = [text(rng.randrange(10, 200)) for _ in range(12)]
    docs = []
    for i in range(80):
        parts = [text(rng.randrange(0, 80)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randrange(6))]
        if rng.random() < 0.2 and docs:
            w = docs[rng.randrange(len(docs))][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            parts = [" ".join(w)]
        docs.append((rng.randrange(10_000), " ".join(parts)))
    docs += [(20_000, "a" * 5000), (20_001, "ab" * 150 + "a" * 99), (20_002, docs[0][1]), (3, docs[1][1]), (20_003, passages[0][:99]), (20_004, passages[0][:100]), (20_005, passages[1][7:120] + passages[2][5:130])]
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_against_all_strings(spark, seed, monkeypatch):
    docs = list({d[0]: d for d in prose(seed)}.values())
    random.Random(seed).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in repeats.without_repeats(df).collect()), key=str)
    assert got == expected(docs)
    assert sum(r[3] > 1 for r in got) > 3


def test_bears_all_cases(spark):
    got = sorted((tuple(r) for r in repeats.without_repeats(table(spark)).collect()), key=str)
    assert got == expected([r[:2] for r in rows()])
    assert repeats.without_repeats(empty(spark)).count() == 0
