import zlib

import numpy as np

from corpusmill.llm import mixing, quality, toxicity

from .helpers import empty, label_table, rows, table


def corpus(spark, n=1000):
    """Clean prose of random syllables; label toxic 1 with an insult every 30 words, quality 0 with marks after every word."""
    rng = np.random.default_rng(4)
    syllables = ["the", "er", "ing", "ou", "an", "th", "re", "st"]
    bad = ["idiot", "scum", "worthless", "pathetic"]
    docs, labels = [], []
    for i in range(n):
        toxic, good = int(i % 5 == 0), int(i % 3 > 0)
        w = ["".join(rng.choice(syllables, 3)) for _ in range(int(rng.integers(40, 160)))]
        if toxic:
            for k in range(0, len(w), 30):
                w[min(len(w) - 1, k + int(rng.integers(0, 10)))] = str(rng.choice(bad))
        if not good:
            w = [x + "%%%" for x in w]
        docs.append((i, "\n".join(" ".join(w[k : k + 12]) for k in range(0, len(w), 12))))
        labels.append((i, good, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(got, truth, fold):
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out]
    assert all(r.held_out == fold(r.doc_id) for r in got) and held
    return sum(a == b for a, b in held) / len(held)


def test_toxicity_held_out_and_misspelt(spark):
    docs, labels = corpus(spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert accuracy(got, truth, lambda i: zlib.crc32(str(i).encode()) % 4 == 2) > 0.95
    model = toxicity.train(*toxicity.labelled_sample(docs, labels, "toxic", toxicity.held_out))
    value = toxicity.Memo(model.table).__getitem__
    clean = ("therering oustan anthst " * 12).split()
    assert model.score(clean, value) < 0.3 < model.score([*clean, "idiott", "sccum", "worthles"], value)


def test_quality_held_out(spark):
    docs, labels = corpus(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert accuracy(quality.quality(docs, labels).collect(), truth, lambda i: zlib.crc32(str(i).encode()) % 5 == 0) > 0.95


def test_marginals_by_enumeration():
    from itertools import product
    from math import exp

    odds, stay = [0.3, -1.2, 2.0, -0.1], (0.7, -0.4)
    weight = {}
    for y in product((0, 1), repeat=4):
        s = sum(o for o, v in zip(odds, y, strict=True) if v) + sum(stay[a] for a, b in zip(y, y[1:]) if a == b)
        weight[y] = exp(s)
    z = sum(weight.values())
    for k, p in enumerate(quality.marginals(odds, stay)):
        assert abs(p - sum(w for y, w in weight.items() if y[k]) / z) < 1e-12


def test_models_bear_all_cases(spark):
    for f in (toxicity.toxicity, quality.quality):
        got = f(table(spark), label_table(spark)).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert f(empty(spark), label_table(spark)).count() == 0
        assert f(table(spark), label_table(spark).limit(0)).count() == len(rows())
    assert toxicity.keep_clean(table(spark), label_table(spark)).columns == table(spark).columns


def test_raking_meets_targets():
    cells = [(s, g, t, float(1 + 7 * k % 13)) for k, (s, g, t) in enumerate((s, g, t) for s in "abc" for g in "xy" for t in "pq")]
    targets = [{"a": 0.5, "b": 0.3, "c": 0.2}, {"x": 0.6, "y": 0.4}, {"p": 0.5, "q": 0.5}]
    w = mixing.rake(cells, targets)
    whole = sum(x * c[3] for x, c in zip(w, cells, strict=True))
    for k, target in enumerate(targets):
        for v, share in target.items():
            assert abs(sum(x * c[3] for x, c in zip(w, cells, strict=True) if c[k] == v) / whole - share) < 1e-6


def brute_mix(docs, model, targets, keep):
    """The definition in plain loops: tokens by cell, rounds of proportional fitting until nothing moves, draws by hash."""
    d = mixing.described(docs, model).collect()
    tokens = {}
    for r in d:
        c = (r.source, r.lang, r.topic)
        tokens[c] = tokens.get(c, 0) + r.n_tokens
    w, whole = dict.fromkeys(tokens, 1.0), sum(tokens.values())
    for _ in range(5000):
        for k, target in enumerate(targets):
            there = {c[k] for c in tokens if sum(t for x, t in tokens.items() if x[k] == c[k]) > 0}
            scale = sum(target.get(v, 0) for v in there)
            now = {}
            for c, t in tokens.items():
                now[c[k]] = now.get(c[k], 0) + t * w[c] / whole
            for c in w:
                if now[c[k]] > 0:
                    w[c] *= (target.get(c[k], 0) / scale if c[k] in there else 0.0) / now[c[k]]
    rate = min(keep, 1 / max(w[c] for c, t in tokens.items() if t))
    return sorted((str(r.doc_id), r.topic, r.n_tokens, round(w[r.source, r.lang, r.topic], 5), r.draw < min(1.0, w[r.source, r.lang, r.topic] * rate)) for r in d)


def mixing_docs(spark, n=160):
    """Four subjects in two languages and three sources, one of them rare."""
    rng = np.random.default_rng(3)
    words = [[f"subject{t}word{k}" for k in range(30)] for t in range(4)]
    own = {g: [f"{g}{g}common{k}" for k in range(10)] for g in "xy"}
    rows = []
    for i in range(n):
        g, t = i % 2, int(rng.integers(0, 4))
        lang = "xy"[g]
        rows.append((i, " ".join([*rng.choice(words[t], int(rng.integers(5, 40))), *rng.choice(own[lang], 20)]), lang, "abbbbbbbccccc"[i % 13]))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def shifted(d):
    """Targets far from the observed shares that no cell contradicts: the shares under other weights of the cells."""
    out = [{}, {}, {}]
    for r in d:
        for k, by in enumerate(mixing.BY):
            out[k][getattr(r, by)] = out[k].get(getattr(r, by), 0.0) + r.n_tokens * (1 + zlib.crc32(f"{r.source}{r.lang}{r.topic}".encode()) % 5)
    return [{v: x / sum(t.values()) for v, x in t.items()} for t in out]


def test_mixing_against_brute_force_on_both_paths(spark):
    """Shifted targets, production rounds and tolerance: the definition, the driver's path and the table's agree."""
    docs = mixing_docs(spark)
    model = mixing.topics_of(docs)
    targets = shifted(mixing.described(docs, model).collect())
    want = brute_mix(docs, model, targets, mixing.KEEP)
    for cells in (mixing.DRIVER_CELLS, 0):
        m = mixing.mix(docs, targets, driver_cells=cells)
        assert sorted((str(r.doc_id), r.topic, r.n_tokens, round(r.weight, 5), r.sampled) for r in m.collect()) == want
        kept = sorted(str(r.doc_id) for r in mixing.keep_sampled(docs, targets, driver_cells=cells).collect())
        assert kept == [i for i, *_, s in want if s]
    for r in mixing.marginals(mixing.mix(docs, targets)).collect():
        assert abs(r.expected - targets[mixing.BY.index(r.marginal)].get(r.value, 0)) < 1e-6


def test_default_targets_are_met_and_alike_on_both_paths(spark):
    docs = mixing_docs(spark)
    a, b = ({r.doc_id: (r.weight, r.probability, r.sampled) for r in mixing.mix(docs, driver_cells=c).collect()} for c in (mixing.DRIVER_CELLS, 0))
    assert all(abs(a[i][0] - b[i][0]) < 1e-6 and a[i][2] == b[i][2] for i in a)
    got = mixing.mix(docs).collect()
    assert max(r.probability for r in got) <= 1
    for by in mixing.BY:
        share = {}
        for r in got:
            share[getattr(r, by)] = share.get(getattr(r, by), 0) + r.n_tokens
        expected = {v: sum(r.n_tokens * r.probability for r in got if getattr(r, by) == v) for v in share}
        for v, x in mixing.tempered(share).items():
            assert abs(expected[v] / sum(expected.values()) - x) < 1e-6


def test_topics_are_not_languages(spark):
    docs = mixing_docs(spark)
    by = {}
    for r in mixing.described(docs, mixing.topics_of(docs)).collect():
        by.setdefault(r.lang, {}).setdefault(r.topic, 0)
        by[r.lang][r.topic] += 1
    assert all(len(t) > 2 for t in by.values())


def test_topics_are_fitted_on_all_texts(spark, monkeypatch):
    """Word counts, means and centroids are those of all rows, in plain loops; no order, size or split of the table changes them."""
    texts = [(k, ("alpha beta gamma " if k % 3 else "delta epsilon zeta ") + f"word{k % 11} " + "long " * (6000 if k == 7 else k % 5)) for k in range(2000)] + [(2000, None), (2001, "a b")]
    docs = spark.createDataFrame([(k, t, ("en", "de", None)[k % 3], "s") for k, t in texts], "doc_id long, text string, lang string, source string")
    model = mixing.topics_of(docs.repartition(7))
    count = mixing.Counter()
    x = np.stack([c for _, t in texts if t and (c := count(t.encode())[0]) is not None])
    assert len(x) == 2000 and np.allclose(model.idf, np.log(2001 / (1 + (x > 0).sum(axis=0))))
    again = mixing.topics_of(docs.coalesce(2))
    assert np.array_equal(model.centroids, again.centroids) and sorted(map(str, model.bias)) == ["", "None", "de", "en"]
    assert {r.topic for r in mixing.described(docs, model).where("doc_id = 2001").collect()} == {"none"}


def test_many_values_as_a_table(spark):
    """The factors of a marginal as a table give the same as on the driver."""
    cells = [("a", "x", "p", 50), ("a", "y", "p", 30), ("b", "x", "q", 10), ("b", "y", "q", 20), ("c", "x", "q", 30), ("c", "y", "p", 5)]
    targets = [{"a": 0.4, "b": 0.3, "c": 0.3}, {"x": 0.5, "y": 0.5}, {"p": 0.5, "q": 0.5}]
    table = mixing.cut(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long").coalesce(1))
    want = {c[:3]: w for c, w in zip(cells, mixing.rake(cells, targets, 2), strict=True)}
    for values in (0, 10):
        got = {tuple(r[:3]): r.weight for r in mixing._rake_table(table, targets, 2, values).select(*mixing.BY, "weight").collect()}
        assert all(abs(got[k] - w) < 1e-12 for k, w in want.items())


def test_mixing_cases(spark):
    for cells in (mixing.DRIVER_CELLS, 0):
        docs = table(spark).withColumnsRenamed({"node": "draw", "g": "topic"})
        got = mixing.mix(docs, driver_cells=cells).collect()
        assert len(got) == len(rows()) and {r.topic for r in got if r.doc_id in (6, 7, 8)} == {"none"}
        kept = mixing.keep_sampled(docs, driver_cells=cells)
        assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.sampled)
        assert mixing.mix(empty(spark), driver_cells=cells).count() == 0 and mixing.keep_sampled(empty(spark), driver_cells=cells).count() == 0


def test_toxicity_score_by_its_definition(spark):
    """The score of every text from its passages, words and n-grams in plain loops, without tables of words."""
    import math

    import xxhash

    docs, labels = corpus(spark, 200)
    model = toxicity.train(*toxicity.labelled_sample(docs, labels, "toxic", toxicity.held_out))

    def plain(text):
        w, best = toxicity.words(text or ""), None
        for at in range(0, len(w), toxicity.PASSAGE):
            bag, total = set(w[at : at + toxicity.PASSAGE]), 0.0
            for x in bag:
                marked = f"<{x}>"
                grams = [marked] + [marked[i : i + k] for k in (3, 4, 5) for i in range(len(marked) - k + 1)]
                total += sum(model.table[xxhash.xxh3_64_intdigest(g) % toxicity.BUCKETS] for g in grams) / len(grams)
            logit = total / max(toxicity.LEAST, len(bag))
            best = logit if best is None else max(best, logit)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * ((best or 0.0) + model.bias) + model.offset))))

    both = docs.select("doc_id", "text").union(table(spark).select("doc_id", "text"))
    want = sorted((str(r.doc_id), round(plain(r.text), 9)) for r in both.collect())
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in toxicity.score(both, model).collect()) == want


def test_quality_score_by_enumeration(spark):
    """Short texts: every labelling of the lines weighed, the marginals by length, and the logistic fit."""
    from itertools import product
    from math import exp, log

    docs, labels = corpus(spark, 200)
    field = quality.train(*quality.labelled_sample(docs, labels, "quality", quality.held_out, lines=quality.SAMPLE_LINES))
    texts = ["", "one line.", "a b c\n\n%%% %%%\nThe end of it.", "x\nx\nx\ny y y y y y", "\n\n", "é ü\n1234 5678"]
    for t in texts:
        x, lengths = quality.document_features(t.encode())
        odds = [max(-30.0, min(30.0, float(o))) for o in (x - field.mean) / field.spread @ field.weights]
        good, whole = [0.0] * len(odds), 0.0
        for y in product((0, 1), repeat=len(odds)):
            p = exp(sum(o for o, v in zip(odds, y, strict=True) if v) + sum(field.stay[a] for a, b in zip(y, y[1:], strict=False) if a == b))
            whole += p
            good = [g + p * v for g, v in zip(good, y, strict=True)]
        m = [g / whole for g in good]
        share = sum(a * b for a, b in zip(m, lengths, strict=True)) / sum(lengths) if sum(lengths) else sum(m) / len(m)
        share = min(max(share, 1e-6), 1 - 1e-6)
        assert abs(field.score(t.encode()) - 1 / (1 + exp(-max(-30.0, min(30.0, field.slope * log(share / (1 - share)) + field.offset))))) < 1e-9


def test_lines_are_labelled(spark):
    docs, labels = corpus(spark, 200)
    field = quality.train(*quality.labelled_sample(docs, labels, "quality", quality.held_out))
    got = quality.line_labels(table(spark), field).collect()
    assert {(r.doc_id, r.line) for r in got} >= {(6, 0), (7, 0), (12, 0), (12, 2)} and all(r.good == (r.p_good >= 0.5) for r in got)
    assert quality.line_labels(empty(spark), field).count() == 0


def test_long_documents_cost_their_lines_alone():
    """One text of many lines among short ones trains in memory and time of its lines."""
    texts = [f"word{k} and more words.\nThat is all." if k % 2 else f"%%% {k} %%%\n|||" for k in range(300)] + ["x\n" * 4000]
    field = quality.train(texts, [k % 2 for k in range(300)] + [0], steps=4)
    assert np.isfinite(field.weights).all()


def test_mixing_cuts_texts_into_words_once(spark, monkeypatch):
    """Rounds and the last step work on written counts, entry by entry, and tell a row's topic as its text alone does."""
    docs, made, whole = mixing_docs(spark), [], mixing.map_rows
    monkeypatch.setattr(mixing, "map_rows", lambda *a: made.append(1) or whole(*a))
    got = {r.doc_id: (r.topic, r.n_tokens) for r in mixing.mix(docs).collect()}
    assert len(made) == 1
    assign = mixing.Assign(mixing.topics_of(docs))
    assert got == {r.doc_id: assign(r.text.encode(), r.lang) for r in docs.collect()} and len({t for t, _ in got.values()}) > 2
