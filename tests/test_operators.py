"""Operators on hand-made frames, with the cases that the tables lack."""

import random

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import agg, batch, dedup, graph, link, merge, parse, quality, rules, window


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_text_functions(spark):
    df = spark.createDataFrame([("Ação  É\tÜber", "a/b/Provas 2014/x 1999-2003.PDF", "{{img:1}}x{{img:12}}y{{fonte:3}}", "1-3,5", "12 3 45")], "t string, p string, m string, r string, d string")
    r = df.select(
        T.fold(F.col("t")).alias("fold"), T.fold_any(F.col("t")).alias("fold_any"), T.compose(F.lit("é")).alias("nfc"), T.collapse(F.col("t")).alias("c"), T.year(F.col("p")).alias("y"),
        T.renumber_markers(F.col("m"), F.lit(10)).alias("m"), T.figure_markers(F.col("m")).alias("fm"), T.expand_ranges(F.col("r")).alias("r"), T.write_ranges(T.expand_ranges(F.col("r"))).alias("w"), T.expand_ranges(F.lit(None)).alias("none"),
        T.rejoin_digits(F.col("d")).alias("d"), T.extension(F.col("p")).alias("e"), T.basename(F.col("p")).alias("b"), T.climb(F.lit("x/y/gabaritos/cadernos"), "gabaritos?|cadernos").alias("up"), T.climb(F.lit("gabaritos/cadernos"), "gabaritos?|cadernos").alias("no_up"),
        T.same_characters(F.lit("a b c"), F.lit("cab")).alias("same"), T.odd_characters(F.lit("a�")).alias("odd"), T.glued(F.lit("x" * 28)).alias("glued"), T.glued(F.lit("http://" + "x" * 40)).alias("url"), T.strip_fence(F.lit("```json\n[1]\n```")).alias("fence"), T.dotted(F.lit(1234567)).alias("n"),
        T.ngrams(T.tokens(F.lit("Um dois três quatro")), 3).alias("g"), T.ngrams(F.array(F.lit("a")), 3).alias("g0"), T.source_id(F.lit("P1234-Q056-ING")).alias("s"),
    ).first()
    assert (r.fold, r.fold_any, r.nfc, r.c, r.y) == ("acao  e\tuber", "acao  e\tuber", "é", "Ação É Über", "1999")
    assert (r.m, r.fm, r.r, r.w, r.none, r.d) == ("{{img:11}}x{{img:22}}y{{fonte:3}}", "[figura]x[figura]y", [1, 2, 3, 5], "1-3,5", [], "12345")
    assert (r.e, r.b, r.up, r.no_up, r.same, r.odd, r.glued, r.url, r.fence, r.n) == ("pdf", "x 1999-2003.PDF", "x/y", "gabaritos/cadernos", True, True, True, False, "[1]", "1.234.567")
    assert r.g == ["um dois três", "dois três quatro"] and r.g0 == [] and (r.s.exam, r.s.number, r.s.language) == ("P1234", 56, "ING")


def test_sources_move_before_the_command(spark):
    t = "Texto\n\nFonte: x\n\nmeio\n\nFonte: x\n\n{{img:1}}\n\nAssinale"
    assert spark.range(1).select(T.place_sources(F.lit(t)).alias("t")).first().t == "Texto\n\nmeio\n\nFonte: x\n\n{{img:1}}\n\nAssinale"


def test_rules(spark):
    names = ["Gabarito oficial.pdf", "Prova (com gabarito).pdf", "Resolução.pdf", "errata.pdf", "cartao gab.pdf", "Padrão de resposta.pdf", "Dia 2.pdf"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(rules.role(F.col("n"), F.lit(""))).collect()] == ["gabarito", "prova", "resolucao", "auxiliar", "auxiliar", "padrao_resposta", "prova"]
    d = spark.createDataFrame([("Primeiro dia", "2ª fase"), ("ENEM_D2", "exame discursivo"), ("x", "y")], "a string, b string")
    assert [tuple(r) for r in d.select(rules.day(F.col("a")), rules.phase(F.col("b"))).collect()] == [("1", "2ª fase"), ("2", "exame discursivo"), ("", "")]
    c = spark.createDataFrame([("Gabarito sem comentários", "resolucao"), ("x", "resolucao"), ("comentado", None), (None, None)], "a string, b string")
    assert [r[0] for r in c.select(rules.commented(F.col("a"), F.col("b"))).collect()] == [False, True, True, False]


def test_document_status(spark):
    good = "a casa que o homem tem e um lugar de paz " * 4
    bad = "xq zr wk pl mn bv cx zs df gh jk qw er ty ui op as df gh jk lz xc vb nm qa ws ed rf tg yh uj ik ol"
    docs = frame(spark, [(1, f"{good}\n{good}", "pt"), (2, f"{bad}\n{bad}\n{good}", "pt"), (3, f"{bad}\n{good}\n{good}\n{good}", "pt"), (4, "a\nb", "pt"), (5, f"{good}\nx\ny\nz\n ", "pt")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.status, r.n_lines, r.empty_lines, r.poor_lines) for r in quality.document_status(quality.line_status(docs)).collect()}
    assert got == {1: ("ok", 2, "", ""), 2: ("corrupt", 3, "", "1-2"), 3: ("partly_corrupt", 4, "", "1"), 4: ("no_text", 2, "1-2", ""), 5: ("mostly_empty", 4, "2-4", "")}


def test_components_and_suppression(spark):
    rng = random.Random(2)
    for n, m in ((30, 20), (200, 180), (60, 400)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        parent = list(range(n))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        touched = {x for a, b in edges if a != b for x in (a, b)}
        e = frame(spark, edges, "a long, b long")
        assert {r.node: r.component for r in graph.components(e).collect()} == {x: find(x) for x in touched}
        order = list(range(n))
        rng.shuffle(order)
        near = {i: set() for i in range(n)}
        for a, b in edges:
            if a != b:
                near[a].add(b)
                near[b].add(a)
        keeper = {}
        for i in sorted(range(n), key=order.__getitem__):
            if i not in keeper:
                keeper[i] = None
                for j in near[i]:
                    keeper.setdefault(j, i)
        nodes = frame(spark, list(enumerate(order)), "id long, rank long")
        assert {r.id: r.keeper for r in graph.suppress_ordered(nodes, e).collect()} == keeper
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_estimates_are_symmetric(spark):
    rng = random.Random(1)
    base = [f"word{rng.randrange(500)}" for _ in range(300)]
    docs = frame(spark, [(1, " ".join(base)), (2, " ".join(base[:250] + ["other"] * 3)), (3, " ".join(f"x{k}" for k in range(300))), (4, "too short")], "doc_id long, text string")
    sk = dedup.sketches(docs)
    assert {r.doc_id for r in sk.collect()} == {1, 2, 3}
    p = dedup.similar_pairs(sk, dedup.candidate_pairs(sk)).collect()
    assert [(r.a, r.b) for r in p] == [(1, 2)] and 0.5 < p[0].jaccard <= 1
    both = sk.alias("x").crossJoin(sk.alias("y")).select(dedup.estimate(F.col("x.sig"), F.col("y.sig"), 128).alias("u"), dedup.estimate(F.col("y.sig"), F.col("x.sig"), 128).alias("v")).collect()
    assert all(r.u == r.v and 0 <= r.u <= 1 for r in both)


def test_posting_cap(spark):
    sk = frame(spark, [(i, [f"{k:032x}" for k in range(12)], [], 12) for i in range(81)], "doc_id long, sig array<string>, vsig array<string>, n_shingles long")
    assert dedup.candidate_pairs(sk).count() == 0 and dedup.candidate_pairs(sk.where("doc_id < 80")).count() == 80 * 79 // 2


def test_compatible_tiers(spark):
    a = frame(spark, [(1, "g", "azul", "1"), (2, "g", "rosa", ""), (3, "g", None, "2"), (4, "h", "azul", "1")], "id long, k string, caderno string, dia string")
    b = frame(spark, [(10, "g", "azul", "1"), (11, "g", "", "2"), (12, "g", "verde", "1")], "id long, k string, caderno string, dia string")
    got = sorted(tuple(r) for r in link.compatible(a, b, ["k"], ["caderno", "dia"], ["caderno"]).collect())
    assert got == [(1, 10, 1), (2, 11, 1), (3, 11, 1)]


def test_nearest_and_ranges(spark):
    left = frame(spark, [("p", i, float(v)) for i, v in enumerate((0, 4, 5, 6, 100))] + [("q", 9, 1.0)], "g string, i long, x double")
    right = frame(spark, [("p", 1, 3.0), ("p", 2, 7.0), ("p", 3, 7.0), ("p", 4, 90.0)], "g string, j long, y double")
    got = {r.i: (r.nearest_tie, r.distance) for r in link.nearest(left, right, ["g"], "x", "y", tie="j").collect()}
    assert got == {0: (1, 3.0), 1: (1, 1.0), 2: (1, 2.0), 3: (2, 1.0), 4: (4, 10.0), 9: (None, None)}
    assert {r.i for r in link.nearest(left, right, ["g"], "x", "y", most=2.0, tie="j").collect()} == {1, 2, 3}


def test_answer_keys(spark):
    text = "QUESTÃO 1\nResposta correta: B\nblá B) CORRETA\nQUESTÃO 02\nA) CORRETA C) CORRETA\nQuestão 3\nnada\nQUESTÃO 4\nGabarito: (D)\nQUESTÃO 5\nalternativa correta é a E.\nQUESTÃO 5\nGabarito: A"
    b = parse.answers(parse.split_blocks(frame(spark, [("d", text), ("e", "sem blocos")], "doc string, text string"), "doc", "text"))
    assert sorted((r.number, tuple(r.found)) for r in b.collect()) == [(1, ("B", "B")), (2, ("?",)), (3, ()), (4, ("D",)), (5, ("A",)), (5, ("E",))]
    stored = frame(spark, [("d", 1, "C"), ("d", 2, "A"), ("d", 3, "A"), ("d", 4, "D"), ("d", 5, "A"), ("d", 6, "A")], "doc string, number int, key string")
    got = {r.number: (r.outcome, r.new_key) for r in parse.triangulated(stored, b).collect()}
    assert got == {1: ("replaced", "B"), 2: ("disagreeing", None), 3: ("unreadable", None), 4: ("confirmed", "D"), 5: ("several blocks", None), 6: ("no block", None)}


def test_key_tables(spark):
    lines = ["Gabarito", " 1    2    3    4", "", " A    B    *    E", "   texto 12 B"]
    df = frame(spark, [("d", k, l) for k, l in enumerate(lines)], "doc string, n int, t string")
    assert {r.number: r.letter for r in parse.horizontal_key(df, "doc", "n", "t").collect()} == {1: "A", 2: "B", 3: "*", 4: "E"}
    two = frame(spark, [("d", 1, "Questão 1 2 3 4 5"), ("d", 2, "Gabarito A B * ANULADA E")], "doc string, n int, t string")
    assert {r.number: r.letter for r in parse.paired_lines_key(two, "doc", "n", "t").collect()} == {1: "A", 2: "B", 4: "ANULADA", 5: "E"}
    pairs = frame(spark, [("d", "1 A 2-B 3. C 3 D item 12 a 4 ANULADA 5a B")], "doc string, t string")
    assert {r.number: r.letter for r in parse.key_pairs(pairs, "doc", "t").collect()} == {1: "A", 2: "B", 3: "C", 4: "ANULADA"}
    items = frame(spark, [("d", "a) um\nb) dois\n\nc) três"), ("e", "a) um\nc) dois"), ("f", "a) só")], "doc string, t string")
    assert sorted(tuple(r) for r in parse.split_items(items, "doc", "t").collect()) == [("d", "a", "um"), ("d", "b", "dois"), ("d", "c", "três")]


def test_headings_labels_hyphens(spark):
    r = spark.range(1).select(
        parse.label_range(F.lit("Leia o texto para responder às questões de 14 a 16")).alias("a"), parse.label_range(F.lit("questões 1 a 3")).alias("b"), parse.candidate_headings(F.lit("12. Leia")).alias("h"),
        parse.join_hyphen(F.lit("guarda-"), F.lit("chuva"), F.lit(1), F.lit(5)).alias("x"), parse.join_hyphen(F.lit("ca-"), F.lit("sa"), F.lit(9), F.lit(0)).alias("y"), parse.join_hyphen(F.lit("a-"), F.lit("b"), F.lit(0), F.lit(0)).alias("z"),
        parse.properties(F.lit("Title: a: b\nbad\nPages:3")).alias("p"),
    ).first()
    assert (tuple(r.a), r.b, [tuple(x) for x in r.h]) == ((14, 16), None, [("dotted", 12)])
    assert (tuple(r.x), tuple(r.y), tuple(r.z)) == (("guarda-chuva", False), ("casa", False), ("a-b", True)) and r.p == {"Title": "a: b", "Pages": "3"}


def test_windows(spark):
    assert spark.range(1).select(window.increasing(F.array(*(F.lit(x) for x in (3, 4, 9, 6, 7, 2)))).alias("c")).first().c == [3, 4, 6, 7]
    df = frame(spark, [("d", "s", n, p) for n, p in ((1, 1), (2, 1), (3, 2), (5, 2), (6, 3), (9, 3), (10, 1))] + [("d", "t", n, 1) for n in (1, 2, 3)], "doc string, style string, n long, p long")
    assert [tuple(r) for r in window.longest_chain(df, "doc", "style", "n", "p").collect()] == [("d", "s", 5, 1)]
    h = frame(spark, [("d", k, n) for k, n in enumerate((1, 2, 4, 9, 5, 1, 2))], "doc string, k long, n long")
    assert [r.accepted for r in window.expected_next(h, "doc", "k", "n").orderBy("k").collect()] == [True, True, True, False, True, True, True]
    ids = window.numbered(frame(spark, [(i * 7 % 101, "x") for i in range(100)], "v long, n string"), ["v"], "P", 4, "id").orderBy("v").collect()
    assert [r.id for r in ids] == [f"P{i:04d}" for i in range(1, 101)] and ids[0].n == "x"
    p = frame(spark, [("d", 1, "Linha com-"), ("d", 2, "prida e mais"), ("d", 3, "fim."), ("d", 4, "Nova"), ("d", 5, " "), ("d", 6, "Outra")], "doc string, k long, t string")
    assert [r.text for r in window.paragraphs(p, ["doc"], "k", "t", 40).orderBy("paragraph").collect()] == ["Linha comprida e mais fim.", "Nova", "Outra"]


def test_lots_and_comments(spark):
    lots = frame(spark, [(lot, k, lot * 10 + k) for lot in (1, 2, 3, 4) for k in range(3)], "lot long, pos long, id long")
    answers = frame(spark, [(1, 0, 10), (1, 1, 11), (1, 2, 12), (2, 0, 21), (2, 1, 20), (2, 2, 22), (3, 0, 30), (3, 1, 31)], "lot long, pos long, id long")
    assert {r.lot: r.status for r in batch.lot_status(lots, answers).collect()} == {1: "ok", 2: "ids differ", 3: "ids differ", 4: "no answer"}
    card = '{"frente":"f","verso":"v","tag":"Fato"}'
    good = '{"id":1,"status":"ok","gabarito":"B","passos_raciocinio":["a","b","c"],"analise_correta_titulo":"t","analise_correta_texto":"%s","analise_incorretas_intro":"i","analise_incorretas":[{"alt":"A","rotulo":"r","texto":"t"},{"alt":"C","rotulo":"r","texto":"t"}],"quadro_resumo":[%s],"leve_para_prova":"l","flashcards":[%s]}' % ("x" * 200, ",".join(['{"item":"i","detalhe":"d"}'] * 3), ",".join([card] * 3))
    cases = {
        good: [], good.replace('"gabarito":"B"', '"gabarito":"C"'): ["gabarito diferente"], good.replace('"leve_para_prova":"l"', '"leve_para_prova":" "'): ["leve_para_prova vazio"], good.replace('["a","b","c"]', '["a","b"]'): ["passos_raciocinio"],
        good.replace('"alt":"C"', '"alt":"D"'): ["letras das incorretas"], good.replace("Fato", "Outra"): ["flashcards"], good.replace('"t","analise_correta_texto"', '"**t**","analise_correta_texto"'): ["markdown"], good.replace('"l"', '"gabarito: C"'): ["aponta outra letra"],
        good.replace('"id":1', '"id":1,"extra":2'): ["campos"], good.replace('"ok"', '"talvez"'): ["status"], '{"id":1,"status":"discordo","gabarito":"B","motivo":"m"}': [], '{"id":1,"status":"discordo","gabarito":"B","motivo":""}': ["campos da revisão"], good.replace("x" * 200, "curto"): ["analise_correta_texto curta"], good.replace('"texto":"t"', '"texto":""'): ["analise_incorretas incompleta"], good.replace('{"item":"i","detalhe":"d"},', ""): ["quadro_resumo"],
    }
    df = spark.createDataFrame([(k, a) for k, a in enumerate(cases)], "k long, a string").withColumn("e", batch.comment_errors(F.col("a"), F.lit("B"), F.array(F.lit("C"), F.lit("A"), F.lit("B"))))
    routed = batch.route_comments(df, "a", "e").orderBy("k").collect()
    assert [r.e for r in routed] == list(cases.values())
    assert {r.route for r in routed if not r.e} == {"accepted", "review"} and all(r.route == "rejected" for r in routed if r.e)


def test_merges(spark):
    base = frame(spark, [(1, "a", ["n"]), (2, "b", []), (3, None, [])], "id long, t string, notes array<string>")
    p = frame(spark, [(1, None), (2, "B")], "id long, t string")
    assert sorted((r.id, r.t, tuple(r.notes)) for r in merge.patch(base, p, "id", ["t"], "patched").collect()) == [(1, "a", ("n", "patched")), (2, "B", ("patched",)), (3, None, ())]
    try:
        merge.assert_none_missing(frame(spark, [(9,)], "id long"), base, "id").collect()
    except Exception as e:
        assert "missing: 9" in str(e)
    else:
        raise AssertionError("a missing row went unnoticed")
    known = frame(spark, [("x", 100007)], "k string, id long")
    got = {r.k: r.id for r in merge.sticky_ids(frame(spark, [("c",), ("x",), ("a",)], "k string"), known, "k", ["k"]).collect()}
    assert got == {"x": 100007, "a": 100008, "c": 100009}


def test_votes_and_json(spark):
    v = frame(spark, [("f", 1, "a", 80), ("f", 1, "b", 20), ("f", 2, "a", 79), ("f", 2, "b", 21)], "font string, cid long, ch string, n long")
    assert [(r.cid, r.ch) for r in agg.majority(v, ["font", "cid"], "ch", "n").collect()] == [(1, "a")]
    d = frame(spark, [(1, 2, "y"), (1, 1, "x")], "g long, o long, v string")
    assert agg.nested(d, ["g"], "items", ["v"], ["o"]).first()["items"] == '[{"v":"x"},{"v":"y"}]'
