"""Groups larger than any bound on candidates, through the registered queries."""

import re

import pandas as pd

from corpusmill.plans import QUERIES


def stored(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_many_equal_texts_are_one_cluster(spark, tmp_path):
    text, other = (" ".join(f"{w}{k}word" for k in range(40)) for w in ("some", "other"))
    docs = [(i, text) for i in range(100)] + [(100, other), (101, text + " and a tail")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string"), labels=([(7, 1, 0)], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: (r.canonical_id, r.cluster_size) for r in QUERIES["canonical"](spark, at).collect()}
    assert got == {i: (100, 1) if i == 100 else (7, 101) for i in range(102)}
    assert {r.doc_id: r.cluster_id for r in QUERIES["components"](spark, at).collect()} == {i: 100 if i == 100 else 0 for i in range(102)}


def test_contamination_of_many_documents_and_short_items(spark, tmp_path):
    long, short = "one two three four five six seven eight nine ten eleven twelve thirteen", "red green blue white black"
    broken = "one two three four five six x seven eight nine ten eleven twelve thirteen"  # no run of eight words
    docs = [(i, f"start {long} stop {i}") for i in range(12)] + [(12, f"start {short} stop"), (13, broken), (14, "one two three only")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=([(1, long), (2, short), (3, "two words")], "item_id long, text string"))
    got = {(r.item_id, r.doc_id): r.contained for r in QUERIES["contamination"](spark, at).collect()}
    assert got == {(1, i): 1.0 for i in range(12)} | {(2, 12): 1.0, (1, 13): round(9 / 11, 6)}


def test_explained_option_reads_whole_texts(spark, tmp_path):
    filler, told = " ".join(["same"] * 40), "apple pear plum cherry"
    turns = [(1, 0, "user", f"{filler} {told}"), (1, 1, "user", f"{filler} {told} grape"), (1, 2, "user", f"{filler} stone brick slate marble")]
    turns += [(2, 1, "user", f"{filler} {told} {' '.join(f'w{k}' for k in range(6))}"), (2, 2, "user", f"{filler} stone brick slate marble")]
    at = stored(spark, tmp_path, conversations=(turns, "conv_id long, turn long, role string, text string"))
    assert {(r.id, r.letter) for r in QUERIES["explained_option"](spark, at).collect()} == {(2, "B")}


def suppressed_in_turn(docs):
    """The sequential loop over all pairs of (doc_id, text, lang, source)."""
    grams = {i: set(zip(*(w[k:] for k in range(3)), strict=False)) for i, t, *_ in docs for w in [re.findall(r"\w+", (t or "").lower())]}
    stays, out = [], {}
    for i, t, lang, _source in sorted(docs, key=lambda d: (d[3], d[0])):
        copy = lambda k, u: t is not None and (t == u or 0 < len(grams[i] & grams[k]) >= 0.85 * len(grams[i] | grams[k]))  # noqa: B023, E731
        out[i] = next((k for k, u, other in stays if other == lang and copy(k, u)), None)
        if out[i] is None:
            stays.append((i, t, lang))
    return out


def test_suppression_follows_the_loop(spark, tmp_path):
    base = [f"w{k}" for k in range(60)]
    chain = [" ".join(base[:k] + ["x"] * k + base[k:]) for k in range(4)]
    docs = [(i, chain[0], "en", f"s{i % 3}") for i in range(100)] + [(100 + k, c, "en", "s1") for k, c in enumerate(chain)]
    docs += [(110, chain[0], "fr", "s0"), (111, chain[1], "fr", "s2"), (112, "a b", "en", "s0"), (113, "a b", "en", "s1"), (114, None, "en", "s0"), (115, None, "en", "s1"), (116, "", "en", "s0")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id: r.keeper for r in QUERIES["suppress_copies"](spark, at).collect()} == suppressed_in_turn(docs)


def test_suppression_on_the_small_table(spark):
    at = "/root/testdata/sf0.001"
    docs = list(pd.read_parquet(f"{at}/documents.parquet")[["doc_id", "text", "lang", "source"]].itertuples(index=False, name=None))
    want = suppressed_in_turn(docs)
    assert {r.doc_id: r.keeper for r in QUERIES["suppress_copies"](spark, at).collect()} == want and any(want.values())


def test_fallback_meets_one_key_of_each_coverage(spark, tmp_path, monkeypatch):
    from corpusmill.plans import q_dedup

    met = []
    whole = q_dedup.L.with_fallback
    monkeypatch.setattr(q_dedup.L, "with_fallback", lambda own, others: met.append(others.count()) or whole(own, others))
    lines = [(i, 3 if i % 2 else 7, "N" if i % 3 else "R") for i in range(300)]
    at = stored(spark, tmp_path, lineitem=(lines, "l_orderkey long, l_suppkey long, l_returnflag string"), supplier=([(k,) for k in range(1, 5001)], "s_suppkey long"))
    got = {r.id: (r.via, r.sibling_key) for r in QUERIES["coverage_fallback"](spark, at).collect()}
    want = {}
    for i, folder, flag in lines:
        best = max(((i * 13 + k * 7) % 100, -k) for k in range(1, 5001) if k % 50 == folder)
        other = -best[1] if best[0] >= 80 else None
        want[i] = ("own", None) if flag != "N" else ("none" if other is None else "sibling", other)
    assert got == want and {v for v, _ in got.values()} == {"own", "sibling", "none"}
    assert met == [600]  # not 100 keys for each of 300 ids


def test_pairs_and_kinds_of_frequent_hashes(spark, tmp_path):
    """Near copies whose shared hashes are all in more than 80 documents, and equal ones among them."""
    base = " ".join(f"word{k}" for k in range(200))
    docs = [(i, f"{base} end{i}", "en", "s") for i in range(90)] + [(90, f"{base} end0", "en", "s"), (91, "other " * 40, "en", "s"), (92, "other " * 40, "en", "s")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string, lang string, source string"))
    pairs = {(a, b) for a in range(91) for b in range(a + 1, 91)}
    got = QUERIES["jaccard_est"](spark, at).collect()
    assert len(got) == len(pairs) and {(r.a, r.b) for r in got} == pairs
    assert all(r.jaccard > 0.9 and (r.shingles_a, r.shingles_b) == (196, 196) for r in got) and [r.jaccard for r in got if (r.a, r.b) == (0, 90)] == [1.0]
    assert {(r.a, r.b): r.kind for r in QUERIES["dup_type"](spark, at).collect()} == {(a, b): "same_exam" if a % 2 == 0 else "same_content" if a % 3 == b % 3 else "check" for a, b in pairs}


def test_suppression_loses_no_near_copies(spark, tmp_path):
    """Near copies in a group of over 80, and short texts that share few hashes."""
    base = " ".join(f"w{k}" for k in range(60))
    docs = [(i, f"{base} end{i}", "en", f"s{i % 3}") for i in range(90)] + [(90, f"{base} end7", "fr", "s0")]
    words = [f"x{k}" for k in range(16)]
    docs += [(91, " ".join(words), "en", "s1"), (92, " ".join(words[:15]), "en", "s2"), (93, "a b c", None, "s0"), (94, "A b  c", None, "s1"), (95, "a b", "en", "s0")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string, lang string, source string"))
    want = suppressed_in_turn(docs)
    assert {r.doc_id: r.keeper for r in QUERIES["suppress_copies"](spark, at).collect()} == want and sum(v is not None for v in want.values()) == 91


def test_components_join_near_copies_in_large_groups(spark, tmp_path):
    base = " ".join(f"word{k}" for k in range(60))
    docs = [(i, f"{base} end{i % 90}" + " " * (i > 95)) for i in range(100)] + [(100, "other " * 40), (101, "short")]
    at = stored(spark, tmp_path, documents=(docs, "doc_id long, text string"))
    assert {r.doc_id: r.cluster_id for r in QUERIES["components"](spark, at).collect()} == {i: 0 for i in range(100)} | {100: 100, 101: 101}
