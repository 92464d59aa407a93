import random

import pytest

from corpusmill.llm import exact_dedup, neardup

from .helpers import empty, rows, table

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def test_fingerprints_compose():
    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(200_000))
    whole = exact_dedup.fingerprint(data)
    for cut in (1, 65_535, 65_536, 65_537, 131_072):
        f = [exact_dedup.fingerprint(x) for x in (data[:cut], data[cut:])]
        h = [(x >> 31, x & (1 << 31) - 1) for x in f]
        a, b = exact_dedup.combine(*h, exact_dedup.shift(len(data) - cut))
        assert a << 31 | b == whole
    assert exact_dedup.fingerprint(b"\0") != exact_dedup.fingerprint(b"\0\0")


def test_parts_combine_in_order(spark):
    parts = [(1, 0, b"abc"), (1, 1, b"defg"), (1, 2, b"h" * 70_000), (2, 0, b""), (2, 1, None)]
    df = spark.createDataFrame(parts[::-1], "doc long, no int, data binary").repartition(3)
    got = {r[0]: (r[1], r[2]) for r in exact_dedup.combine_parts(df, "doc", "no", "data").collect()}
    assert got == {1: (exact_dedup.fingerprint(b"abcdefg" + b"h" * 70_000), 70_007), 2: (0, 0)}


def expected_groups():
    groups = {}
    for r in rows():
        groups.setdefault((r[1] or "").translate(BLANKS), []).append(r)
    out = []
    for members in groups.values():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out += [(r[0], keep, len(members), r[0] == keep) for r in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("hasher", [exact_dedup.fingerprint, lambda d: len(d) % 2])
def test_exact_groups_and_collisions(spark, hasher):
    """The second hasher makes texts collide on purpose: only texts of one length and one parity can, and they are told apart."""
    got = exact_dedup.exact_groups(table(spark), hasher=hasher).collect()
    assert sorted([tuple(r)[:4] for r in got], key=str) == expected_groups()


def test_collisions_of_equal_length(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["ab", "ba", "ab", "bb", "b b", "a" * 40_000, "a" * 39_999 + "b", "a" * 40_000])], "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in exact_dedup.exact_groups(df, hasher=lambda d: 0).collect()}
    assert got == {0: (0, 2), 1: (1, 1), 2: (0, 2), 3: (4, 2), 4: (4, 2), 5: (5, 2), 6: (6, 1), 7: (5, 2)}


def test_exact_empty(spark):
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.keep_first(table(spark)).columns == table(spark).columns


def brute(texts: dict[int, bytes]) -> dict[int, int]:
    sets = {i: neardup.shingles(t) for i, t in texts.items()}
    comp = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and neardup.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) and comp[a] != comp[b]:
                    lo = min(comp[a], comp[b])
                    comp[a] = comp[b] = lo
                    changed = True
    return comp


def families(seed: int) -> dict[int, bytes]:
    """Families of copies of copies, larger than a bucket lists pairwise, some bridged, some of different lengths."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    out, bases = [], []
    for _ in range(3):
        base = [word() for _ in range(rng.choice((60, 120)))]
        bases.append(base)
        family = [base]
        for _ in range(40):
            w = list(rng.choice(family[:1] * 3 + family))
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(w))
                w[k : k + rng.randrange(2)] = [word()] * rng.randrange(1, 3) if rng.random() < 0.8 else []
            family.append(w)
        out += family[1:] if rng.random() < 0.5 else family
    out += [bases[0] + bases[1], bases[0][:30] + bases[1][:30], [], ["one"], ["one"]]
    rng.shuffle(out)
    return {i: " ".join(w).encode() for i, w in enumerate(out)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_against_brute_force(spark, seed):
    texts = families(seed)
    df = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute(texts)
    assert all(r.n_shingles == len(neardup.shingles(texts[i])) and r.kept == (r.component_id == i) for i, r in got.items())


def test_near_duplicates_cases(spark):
    got = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(table(spark)).collect()], key=str)
    by = {}
    for i, n, c, k in got:
        by.setdefault(i, set()).add((n, c, k))
    assert by[1] == {(31, 1, True)} and by[2] == by[3] == {(31, 1, False)} and by[4] == {(31, 1, False)} and by[5] == {(31, 1, False)}
    assert by[6] == {(0, 6, True)} and by[7] == {(0, 7, True)} and by[8] == {(0, 8, True)} and by[9] == {(1, 9, True)} and by[10] == {(1, 9, False)}
    assert by[None] == {(31, 1, False)} and len(got) == len(rows()) and by[12] == {(1, 12, True)}
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_bands_find_links():
    """At the threshold a pair shares a band, over many pairs."""
    s, rng, missed = neardup.Sketcher(), random.Random(5), 0
    for k in range(300):
        w = [f"x{rng.randrange(10**9)}" for _ in range(200)]
        n = len(neardup.shingles(" ".join(w).encode()))
        v = list(w)
        while True:
            u = list(v)
            u[rng.randrange(len(u))] = f"y{rng.randrange(10**9)}"
            a, b = neardup.shingles(" ".join(w).encode()), neardup.shingles(" ".join(u).encode())
            if not neardup.linked(len(a & b), len(a), len(b)):
                break
            v = u
        x, y = (set(s.keys(s.hashes(" ".join(z).encode()))) for z in (w, v))
        missed += not x & y
    assert missed == 0 and n


def test_groups_without_ids_keep_one(spark):
    from . import helpers

    other = " ".join(f"{w}more" for w in helpers.BASE)
    docs = [(1, " ".join(helpers.BASE)), (None, helpers.near(0)), (None, other), (None, other), (None, other + " end"), (None, "a text alone"), (None, None), (None, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in neardup.keep_one(frame).collect()), key=str)
    group = [r for r in got if r[1] and r[1].startswith(other)]
    assert len(group) == 1 and sorted((r for r in got if r not in group), key=str) == sorted([docs[0], *docs[5:]], key=str)


def boilerplate_family(n: int, seed: int = 9) -> dict[int, bytes]:
    """Members share boilerplate, and each has three passages of a common pool: few are links, all meet in large buckets."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, pool = [word() for _ in range(160)], [[word() for _ in range(12)] for _ in range(12)]
    out = {}
    for i in range(n):
        w = list(base)
        for p in rng.sample(pool, 3):
            at = rng.choice((0, 40, 80, 120))
            w[at:at] = p
        out[i] = " ".join([*w, *(word() for _ in range(rng.randrange(4)))]).encode()
    return out


def test_pairs_of_a_family_do_not_grow_with_its_square(spark, monkeypatch):
    proposed = []
    verify = neardup.verify

    def counted(pairs, texts):
        proposed[-1] += pairs.count()
        return verify(pairs, texts)

    monkeypatch.setattr(neardup, "verify", counted)
    for n in (150, 300):
        texts = boilerplate_family(n)
        proposed.append(0)
        df = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
        assert got == brute(texts)
    assert proposed[1] < 3 * proposed[0], proposed


def test_ids_that_repeat_or_are_strings(spark):
    """A text of an id that repeats is not lost; a group keeps one row, rows without an id and of clashing columns too."""
    base, other = "a b c d e f g h i j k l m n o p", "q r s t u v w x y z aa bb cc dd ee ff"
    docs = [("7", base), ("7", other), ("8", base + " "), ("9", other), ("9", other), (None, "alone with no id at all here"), (None, ""), (None, ""), ("1", None)]
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id string, text string, row_key string").repartition(3)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([("7", "7", True), ("7", "7", True), ("8", "7", False), ("9", "7", False), ("9", "7", False), (None, None, False), (None, None, False), (None, None, False), ("1", "1", True)], key=str)
    kept = sorted(((r.doc_id, r.text, r.row_key) for r in neardup.keep_one(df).collect()), key=str)
    assert kept == sorted([("7", base, "x"), ("7", other, "x"), (None, "alone with no id at all here", "x"), (None, "", "x"), (None, "", "x"), ("1", None, "x")], key=str)
    again = spark.createDataFrame([(1, base), (1, base), (2, base), (None, other), (None, other)], "doc_id long, text string").repartition(3)
    assert sorted(((r.doc_id, r.text) for r in neardup.keep_one(again).collect()), key=str) == [(1, base), (None, other)]


@pytest.mark.parametrize("hasher", [exact_dedup.fingerprint, lambda d: 0])
def test_keep_first_tells_rows_apart(spark, hasher):
    """Ids that repeat, are null or strings, and columns named as the operator's own; with and without collisions."""
    docs = [("1", "a b c"), ("1", "a b c"), ("2", "a b c"), ("2", "xyz"), ("2", "x yz"), (None, "q w e"), (None, "q w e"), (None, "qwe"), ("5", None), ("6", " "), ("7", "abd")]
    df = spark.createDataFrame([(*r, k, "k") for k, r in enumerate(docs)], "doc_id string, text string, row_key long, keep_key string").repartition(3)
    out = exact_dedup.keep_first(df, hasher=hasher)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([("1", "a b c"), ("2", "x yz"), (None, "q w e"), ("6", " "), ("7", "abd")], key=str)
    assert out.columns == df.columns
    kept = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df, hasher=hasher).collect()]
    assert len(kept) == len(docs) and sum(k for *_, k in kept) == 7 and ("2", "1", 3, False) in kept


def test_long_texts_are_hashed_in_parts(spark):
    """Parts cut anywhere, also inside a character, combine to the fingerprint of the whole."""
    docs = [(1, "é b c\td" * 50), (2, "é b c d" * 50), (3, "x" * 10), (4, "x" * 11), (5, None), (1, "é b c\td" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = sorted((r.doc_id, r.fp, r.n_bytes, r.n_points, r.text_sha256) for r in exact_dedup.fingerprints(df).collect())
    for long in (7, 10, 399):
        assert sorted((r.doc_id, r.fp, r.n_bytes, r.n_points, r.text_sha256) for r in exact_dedup.fingerprints(df, long=long).collect()) == want


def test_members_of_later_levels_bring_what_others_hold(spark, monkeypatch):
    """Differences of one holder, and those before a cluster's own, stay behind, and their number is kept."""
    brought, level = [], neardup._level

    def logged(members, n):
        brought.append(sum(len(r.d) for r in members.collect()))
        return level(members, n)

    monkeypatch.setattr(neardup, "_level", logged)
    texts = boilerplate_family(150)
    df = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == brute(texts)
    assert len(brought) > 1 and 3 * sum(brought[1:]) < brought[0]
